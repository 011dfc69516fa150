"""Ranked lexical search: term at a time with a limited set of accumulators, over blocks of documents.

Spark scans the documents once into postings of the items' terms, adds up the statistics of the whole collection, and
deals the postings out in blocks. In a block each item takes its terms from the rarest on. A document gets an accumulator
only while what the remaining terms can add at most reaches the k-th best partial score; then only the accumulators that
can still get there go on, and are updated exactly. The best of the blocks meet in a ranking per item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import doc_columns, map_rows, utf8
from tidemark.session import materialise

TOP = 50
#: Texts of items that are searched for together, in bytes; documents and postings that are scored together.
ITEM_BYTES, BLOCK_DOCS, BLOCK_POSTINGS = 4 << 20, 1 << 16, 1 << 22
POSTINGS = "doc_id long, n long, terms array<int>, counts array<int>"
FOUND = "item int, doc_id long, score long"
#: What is no part of a term becomes a space, upper-case ASCII letters become lower case; bytes from 128 on are kept.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a text with repeats: maximal runs of ASCII letters, digits and characters beyond ASCII."""
    return utf8(text or "").translate(_FOLD).split()


class Items(NamedTuple):
    """Items of one block: their ids, the terms of each once, and the number of each term."""

    ids: list[int | None]
    terms: list[list[int]]
    numbers: dict[bytes, int]


class Statistics(NamedTuple):
    """Figures of the whole collection: documents with a term, terms, weight and frequency of each term."""

    documents: int
    length: int
    weights: np.ndarray
    frequencies: np.ndarray


def number_terms(rows: list[tuple[int | None, str | None]]) -> Items:
    numbers: dict[bytes, int] = {}
    terms = [[numbers.setdefault(t, len(numbers)) for t in dict.fromkeys(terms_of(text))] for _, text in rows]
    return Items([i for i, _ in rows], terms, numbers)


def postings(docs: DataFrame, numbers: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, terms, counts) of every row: its number of terms, and those asked for with their occurrences."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)

    def work(batch: pa.RecordBatch):
        find, found, sizes, lengths = shared.value.get, [], [], []
        for at, text in enumerate(batch.column(1)):
            words = terms_of(text.as_py())
            lengths.append(len(words))
            hits = np.array([k for k in map(find, words) if k is not None], np.int64)
            terms, counts = np.unique(hits, return_counts=True)
            found.append((terms, counts))
            sizes.append(len(terms))
        ends = pa.array(np.cumsum([0, *sizes]), pa.int32())
        flat = [pa.array(np.concatenate([f[i] for f in found] or [[]]).astype(np.int32)) for i in range(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(lengths, pa.int64()), *(pa.ListArray.from_arrays(ends, f) for f in flat)],
            names=[c.split()[0] for c in POSTINGS.split(", ")],
        )

    return map_rows(doc_columns(docs, id_col, text_col), work, POSTINGS)


def statistics(posted: DataFrame, n_terms: int) -> Statistics:
    """Counts over all documents; per term of the items one number reaches the driver."""
    total = posted.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    frequencies = np.zeros(n_terms, np.int64)
    for term, df in posted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        frequencies[term] = df
    weights = [math.floor(1000 * math.log((2 * total.documents + 2) / (2 * df + 1))) for df in frequencies.tolist()]
    return Statistics(total.documents, total.length, np.array(weights, np.int64), frequencies)


class Block:
    """Postings of a block of documents by term: documents and what the term adds to the score of each."""

    def __init__(self, ids: pa.Array, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray, known: Statistics):
        self.ids = ids
        rows = np.repeat(np.arange(len(n)), sizes)
        norm = 50 + (50 * n * known.documents) // max(known.length, 1)
        tf = counts.astype(np.int64)
        added = known.weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 20 * norm[rows]))
        order = np.argsort(terms, kind="stable")
        self.rows, self.added = rows[order], added[order]
        self.at = np.searchsorted(terms[order], np.arange(len(known.weights) + 1))
        self.most = np.zeros(len(known.weights), np.int64)
        held = np.flatnonzero(self.at[1:] > self.at[:-1])
        if len(held):
            self.most[held] = np.maximum.reduceat(self.added, self.at[held])
        self.scores = np.zeros(len(n), np.int64)

    def posted(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        span = slice(self.at[term], self.at[term + 1])
        return self.rows[span], self.added[span]

    def best(self, terms: list[int], top: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the documents that may be among the ``top``; those certain to stay below ``floor`` are left out."""
        terms = [t for t in terms if self.most[t]]
        left = np.cumsum([0, *(self.most[t] for t in reversed(terms))])[::-1].tolist()
        scores, at = self.scores, 0
        while at < len(terms) and left[at] >= floor:
            rows, added = self.posted(terms[at])
            scores[rows] += added
            at += 1
            if left[0] - left[at] > left[at]:  # only then can a partial score exceed what is left
                floor = max(floor, _kth(scores[scores > 0], top))
        alive = np.flatnonzero(scores)
        held = scores[alive]
        scores[alive] = 0
        for k in range(at, len(terms)):
            good = held + left[k] >= floor
            alive, held = alive[good], held[good]
            rows, added = self.posted(terms[k])
            place = np.minimum(np.searchsorted(rows, alive), len(rows) - 1)
            held = held + np.where(rows[place] == alive, added[place], 0)
            floor = max(floor, _kth(held, top))
        good = held >= max(floor, _kth(held, top))
        return alive[good], held[good]


def _kth(scores: np.ndarray, k: int) -> int:
    """The k-th largest score, 0 where there are fewer."""
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def _rank_block(block: Block, items: list[list[int]], top: int, floors: list[np.ndarray]) -> pa.RecordBatch:
    numbers, rows, scores = [], [], []
    key = block.ids.fill_null(np.iinfo(np.int64).max).to_numpy()
    for item, terms in enumerate(items):
        at, score = block.best(terms, top, _kth(floors[item], top))
        pick = np.lexsort((key[at], -score))[:top]
        floors[item] = np.sort(np.concatenate([floors[item], score[pick]]))[-top:]
        numbers.append(np.full(len(pick), item, np.int32))
        rows.append(at[pick])
        scores.append(score[pick])
    taken = np.concatenate(rows).astype(np.int64)
    columns = [pa.array(np.concatenate(numbers)), block.ids.take(pa.array(taken)), pa.array(np.concatenate(scores).astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in FOUND.split(", ")])


def candidates(posted: DataFrame, items: Items, known: Statistics, top: int = TOP) -> DataFrame:
    """(item, doc_id, score): of every block of postings the ``top`` documents of each item."""
    order = [sorted(terms, key=lambda t: (known.frequencies[t], t)) for terms in items.terms]
    shared = posted.sparkSession.sparkContext.broadcast((order, known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, known = shared.value
        floors = [np.zeros(0, np.int64)] * len(order)
        held: list[pa.RecordBatch] = []

        def score() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            lists = [table.column(i).combine_chunks() for i in (2, 3)]
            block = Block(
                table.column(0).combine_chunks(), table.column(1).to_numpy(), lists[0].value_lengths().to_numpy(),
                lists[0].flatten().to_numpy(), lists[1].flatten().to_numpy(), known,
            )
            return _rank_block(block, order, top, floors)

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                if sum(b.num_rows for b in held) >= BLOCK_DOCS or sum(len(b.column(2).flatten()) for b in held) >= BLOCK_POSTINGS:
                    yield score()
                    held = []
        if held:
            yield score()

    return posted.select("doc_id", "n", "terms", "counts").mapInArrow(run, FOUND)


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, item_col: str = "item_id", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each row of ``items``, equal scores by ascending id.

    All documents are searched for all items; items go in blocks of bounded size. Null and empty texts have no term: such
    an item finds nothing, such a document is never found and counts for nothing. Repeated documents are found each;
    repeated items are ranked each, under their own equal id. A null doc_id comes last among equal scores. Other columns
    stay out. Without documents or items the result is empty.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(f"`{item_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0)).alias("size")).first().size
    blocks, out = max(1, -(-size // ITEM_BYTES)), None
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))
    for block in range(blocks):
        numbered = number_terms([(r.id, r.text) for r in dealt.where(F.col("block") == block).collect()])
        posted = materialise(postings(docs, numbered.numbers, id_col, text_col), "postings")
        found = candidates(posted, numbered, statistics(posted, len(numbered.numbers)), top)
        names = spark.createDataFrame(
            [(n, i, block) for n, i in enumerate(numbered.ids)], "item int, item_id long, block int"
        )
        rows = found.join(F.broadcast(names), "item")
        out = rows if out is None else out.unionByName(rows)
    best = Window.partitionBy("block", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")
