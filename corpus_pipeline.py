"""Documents to packed training sequences: quality classifier, quality rules, near duplicates, personal data, packing.

Every stage takes the documents its predecessor kept, as written Parquet, and all but the last return the columns of
documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import golay_simhash, knn_quality, packing, pii_bootstrap, repetition
from tidemark.llm.common import read
from tidemark.session import materialise, scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ROW = "_row"


def _numbered(docs: DataFrame, label: str) -> DataFrame:
    """The columns of documents with a number per row, written once: repeated and null ids are rows of their own."""
    return materialise(docs.select(*COLUMNS).withColumn(ROW, F.monotonically_increasing_id()), label, "zstd")


def _by_row(rows: DataFrame) -> DataFrame:
    """The texts under their row numbers, as the operators take documents."""
    return rows.select(F.col(ROW).alias("doc_id"), "text")


def _keep(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows whose number is in ``kept`` (doc_id)."""
    kept = kept.select(F.col("doc_id").alias("_kept"))
    return rows.join(kept, rows[ROW] == kept["_kept"], "left_semi").select(*COLUMNS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects rows whose neighbours vote below the classifier's threshold; each row by its own text."""
    model = knn_quality.fit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    rows = _numbered(docs, "rows-classifier")
    return _keep(rows, knn_quality.score(_by_row(rows), model).where(F.col("score") >= knn_quality.REJECT_BELOW))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects rows that the repetition rules do not keep; each row by its own text."""
    rows = _numbered(docs, "rows-rules")
    return _keep(rows, repetition.repetition_rules(_by_row(rows)).where("kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of every group of near duplicates: that of the smallest id, a null id last, any one of equal ids."""
    rows = _numbered(docs, "rows-duplicates")
    found = golay_simhash.near_duplicates(_by_row(rows)).select("doc_id", "component_id")
    ids = rows.select(F.col("doc_id").alias("own"), F.col(ROW).alias("doc_id"))
    order = F.struct(F.col("own").isNull(), "own", "doc_id")
    firsts = found.join(ids, "doc_id").groupBy("component_id").agg(F.min_by("doc_id", order).alias("doc_id"))
    return _keep(rows, firsts)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind."""
    return pii_bootstrap.redact(docs.select(*COLUMNS))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences."""
    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("best-fit packing", best_fit_packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
