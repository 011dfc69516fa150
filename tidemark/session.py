"""Spark session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "tidemark", cpus: int | str = "*", **extra: str) -> SparkSession:
    """Local session for tests and the bench. On a cluster the caller brings its own session."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in {**CONF, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder that every executor can reach, as the session names it in ``spark.checkpoint.dir``.

    Only a local session without the setting falls back to a temporary folder.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    root = root or sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="tidemark-")
    sc.setCheckpointDir(root)
    return root


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here and lost executors cost nothing.

    The session's compression is used unless another one is named, such as ``zstd`` for tables of whole texts.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    writer = df.write.option("compression", compression) if compression else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few constant rows whose size the optimizer can see."""
    fields = [part.split() for part in schema.split(",")]
    cells = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, fields)]) for row in rows]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*cells)))
