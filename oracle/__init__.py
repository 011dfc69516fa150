"""DuckDB SQL that the Spark queries are compared with."""
