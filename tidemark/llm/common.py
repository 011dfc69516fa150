"""What the operators share: tables, Arrow batches, words, written steps, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import materialise

#: A word is a run of characters other than these six; ``bytes.split()`` cuts at exactly them.
WORD_SPACES = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table by any path that Spark's readers can open."""
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{table}.parquet")


def utf8(text: str) -> bytes:
    """UTF-8 of a text; a lone surrogate, which Spark cannot hold anyway, becomes a question mark."""
    return text.encode("utf-8", "replace")


def map_rows(df: DataFrame, work: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """``work`` over Arrow batches: Spark deals the rows out, a task holds one batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from work(batch)

    return df.mapInArrow(run, schema)


def text_slices(ids: list, texts: list, limit: int) -> Iterator[tuple[list, list]]:
    """Consecutive (ids, texts) of about ``limit`` characters, so that arrays over a slice stay small."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= limit:
            yield ids[start : i + 1], texts[start : i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield ids[start:], texts[start:]


def doc_columns(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the key and the text, by fixed names; other columns, whatever their names, stay out."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Smallest node reachable from each node of ``edges`` (a, b): rows (node, root).

    Rounds of large-star and small-star: every node points at the smallest node it has seen, until
    no pointer moves. Each round is a written table, so lineage stays short and a lost executor costs
    one task. A hub's neighbours are only aggregated (minimum, combined before the shuffle) and joined back,
    never gathered. Nodes without an edge are absent; null ends and self-links are ignored.
    """
    pairs = edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).where("lo < hi").distinct()
    current = materialise(pairs, label)
    while True:
        # large star: neighbours above a node point at the smallest of its neighbourhood
        both = current.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            current.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).where("lo < hi")
        ).distinct()
        large = materialise(large, label)
        # small star: the smaller neighbours of a node, and the node itself, point at its smallest one
        down = large.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
        small = (
            large.withColumnRenamed("hi", "u")
            .join(down, "u")
            .select("m", F.explode(F.array(F.col("lo"), F.col("u"))).alias("hi"))
            .where("m < hi")
            .select(F.col("m").alias("lo"), "hi")
        ).distinct()
        nxt = materialise(small, label)
        # a forest of stars over roots that are nobody's leaf is final
        tops = nxt.select(F.col("lo").alias("top")).distinct()
        if nxt.join(tops, nxt.hi == tops.top, "left_semi").isEmpty() and _each_once(nxt):
            leaves = nxt.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
            return leaves.union(tops.select(F.col("top").alias("node"), F.col("top").alias("root")))
        current = nxt


def _each_once(stars: DataFrame) -> bool:
    return stars.groupBy("hi").count().where("count > 1").isEmpty()
