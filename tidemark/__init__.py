"""tidemark: daily banking KPIs over a bronze / silver / gold lake, written as Spark DataFrame operators."""
