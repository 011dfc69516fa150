"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into segments of 23, 23 and 18 bits (the last padded). A segment is decoded to every
codeword of the perfect (23, 12) Golay code within four errors: one or six codeword indices. Two segments that differ in at
most two bits always share an index: take the codeword whose distance to both is within four.

Pigeonhole for at most four errors: either a segment is exact and another has at most two (keys: exact segment, index
of another), or all three have errors and then two of them have a single one, so one half of each of these is exact,
and the third has at most two (keys: two halves, index of the third). Every link shares a key, and a verified distance
follows. Fingerprints are reduced to distinct ones first, so copies are never paired.

Groups are found without writing the pairs of a key. At first every key compares its fingerprints with the smallest of them;
a key in which all link with it is done. In a further round a key names one pivot, the smallest fingerprint outside its
largest group, and all its fingerprints are compared with that pivot alone; groups that a verified link joins become one.
Keys whose fingerprints are all in one group are done and left out. When no pivot joins anything more, or few comparisons
are left, the mixed keys are compared outright: the fingerprints outside the largest group with all others of other groups.
"""

from __future__ import annotations

from itertools import combinations, permutations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import components, doc_columns, map_rows, utf8
from tidemark.session import materialise

SHINGLE, MAX_BITS, SEED = 4, 4, 42
#: (lowest bit, bits) of the segments.
SEGMENTS = ((0, 23), (23, 23), (46, 18))
#: Fixed value: generator polynomial of the binary Golay code.
GENERATOR = 0b101011100011
BLOCK = 100_000
#: Comparisons for each row of the mixed keys up to which they are made outright.
PAIRS_A_ROW = 4


def _remainders(values: np.ndarray) -> np.ndarray:
    """Syndromes of 23-bit words: remainders modulo the generator polynomial."""
    out = values.astype(np.int64)
    for bit in range(22, 10, -1):
        out = np.where(out >> bit & 1, out ^ (GENERATOR << (bit - 11)), out)
    return out


def _patterns() -> np.ndarray:
    """Error patterns of at most four bits by syndrome, six columns; a syndrome with one pattern repeats it."""
    found: list[list[int]] = [[] for _ in range(2048)]
    words = [sum(1 << b for b in bits) for n in range(5) for bits in combinations(range(23), n)]
    for word, syndrome in zip(words, _remainders(np.array(words)).tolist()):
        found[syndrome].append(word)
    return np.array([(p * 6)[:6] if len(p) == 1 else p for p in found], np.int64)


class Golay:
    def __init__(self):
        self.patterns = _patterns()

    def indices(self, words: np.ndarray) -> np.ndarray:
        """Six codeword indices of each 23-bit word (repeated where there is only one)."""
        return (words[:, None] ^ self.patterns[_remainders(words)]) >> 11


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): SimHash over the XXH64 of word shingles, repeats included; fp is the unsigned value in a long's bits.

    A text of fewer words is one shingle; a null text, or one without words, has fingerprint 0. Repeated rows and null
    ids stay; further columns are left out. Texts of any length are read whole, in blocks of shingles.
    """

    def one(text: str | None) -> int:
        words = utf8(text or "").lower().split()
        if not words:
            return 0
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.r_[0, ends[:-1]]
        last = np.minimum(np.arange(max(1, len(words) - shingle + 1)) + shingle, len(words)) - 1
        stops, total, n = (ends[last] - 1).tolist(), np.zeros(64, np.int64), len(last)
        digest = xxhash.xxh64_intdigest
        for at in range(0, n, BLOCK):
            spans = zip(starts[at : min(at + BLOCK, n)].tolist(), stops[at : at + BLOCK])
            hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], ">u8")
            total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big", signed=True)

    def work(batch: pa.RecordBatch):
        prints = [one(t.as_py()) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], names=["id", "fp"])

    return map_rows(doc_columns(docs, id_col, text_col), work, "id long, fp long")


def fuzzy_keys(prints: DataFrame) -> DataFrame:
    """(key, fp) of distinct fingerprints: the keys that any two within four bits have in common."""
    golay = Golay()

    def work(batch: pa.RecordBatch):
        for at in range(0, batch.num_rows, 2048):
            fp = batch.column(0).slice(at, 2048).to_numpy(zero_copy_only=False).astype(np.int64)
            parts = [(fp >> low) & ((1 << bits) - 1) for low, bits in SEGMENTS]
            index = [golay.indices(p) for p in parts]
            halves = [(p & 0xFFF, p >> 12) if n == 23 else (p & 0x1FF, p >> 9) for p, (_, n) in zip(parts, SEGMENTS)]
            keys, tag = [], 0
            for exact, near in permutations(range(3), 2):
                keys.append((tag << 36) | (parts[exact] << 12)[:, None] | index[near])
                tag += 1
            for near in range(3):
                a, b = (i for i in range(3) if i != near)
                for x, y in product(range(2), repeat=2):
                    keys.append((tag << 36) | (halves[a][x] << 24)[:, None] | (halves[b][y] << 12)[:, None] | index[near])
                    tag += 1
            wide = np.sort(np.concatenate(keys, axis=1), axis=1)
            fresh = np.c_[np.ones(len(fp), bool), wide[:, 1:] != wide[:, :-1]]
            owner = np.repeat(fp, fresh.sum(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(wide[fresh]), pa.array(owner)], names=["key", "fp"])

    return map_rows(prints.select("fp"), work, "key long, fp long")


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b), a < b: all pairs of distinct fingerprints at most ``max_bits`` (up to 4) bits apart.

    A group of near copies has as many as the square of its size; where groups are enough, :func:`groups` writes none.
    """
    if not 0 <= max_bits <= 4:
        raise ValueError("the keys cover distances up to 4")
    keys = fuzzy_keys(prints)
    left, right = keys.select("key", F.col("fp").alias("a")), keys.select("key", F.col("fp").alias("b"))
    return left.join(right, "key").where((F.col("a") < F.col("b")) & (_apart("a", "b") <= max_bits)).select("a", "b").distinct()


def _shared(prints: DataFrame, max_bits: int) -> DataFrame:
    """(key, fp, pivot, far) for the keys of two fingerprints or more: the key's smallest fingerprint, and how many of the
    key do not link with it. A key's rows pass sorted windows, which can spill."""
    same = Window.partitionBy("key")
    keys = fuzzy_keys(prints).withColumns({"n": F.count("*").over(same), "pivot": F.min("fp").over(same)}).where("n > 1")
    return keys.withColumn("far", F.count_if(_apart("fp", "pivot") > max_bits).over(same)).drop("n")


def _apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def groups(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root) of the distinct fingerprints that link with another: root is the smallest fingerprint links lead to.

    Two fingerprints link at most ``max_bits`` (up to 4) bits apart. Every link is verified and none is missed.
    """
    if not 0 <= max_bits <= 4:
        raise ValueError("the keys cover distances up to 4")
    shared = materialise(_shared(prints, max_bits), "simhash-shared")
    rooted = shared.select("fp").distinct().withColumn("root", F.col("fp"))
    near = shared.where((F.col("fp") != F.col("pivot")) & (_apart("fp", "pivot") <= max_bits))
    first = near.select(F.col("pivot").alias("a"), F.col("fp").alias("b")).distinct()
    rooted = _merged(rooted, materialise(first, "simhash-joined"))
    # where all link with the pivot, the key is one group already and has nothing more to compare
    left, stuck, same = shared.where("far > 0").select("key", "fp"), False, Window.partitionBy("key")
    while True:
        size = F.struct(F.count("*").over(Window.partitionBy("key", "root")).alias("n"), "root")
        placed = left.join(rooted, "fp").repartition("key").withColumn("size", size)
        placed = placed.withColumn("main", F.max("size").over(same)["root"]).drop("size")
        other = F.col("root") != F.col("main")
        least = F.min(F.when(other, F.struct(F.col("fp").alias("pivot"), F.col("root").alias("other")))).over(same)
        mixed = placed.withColumns({"apart": F.count_if(other).over(same), "least": least}).where("apart > 0")
        mixed = materialise(mixed.select("key", "fp", "root", "main", "apart", "least.*"), "simhash-mixed")
        pairs, rows = mixed.agg(F.sum("apart"), F.count("*")).first()
        outright = stuck or not rows or pairs <= PAIRS_A_ROW * rows
        met = mixed
        if outright:
            few = mixed.where(other).select("key", F.col("fp").alias("pivot"), F.col("root").alias("other"))
            met = mixed.drop("pivot", "other").join(few, "key")
        met = met.where((F.col("root") != F.col("other")) & (_apart("fp", "pivot") <= max_bits))
        joined = met.select(F.least("root", "other").alias("a"), F.greatest("root", "other").alias("b")).distinct()
        joined = materialise(joined, "simhash-joined")
        stuck = joined.isEmpty()
        if not stuck:
            rooted = _merged(rooted, joined)
        if outright:
            return rooted
        left = mixed.select("key", "fp")


def _merged(rooted: DataFrame, joined: DataFrame) -> DataFrame:
    """(fp, root) with the roots that the links ``joined`` (a, b) between roots lead to, written."""
    found = components(joined, "simhash-links").select(F.col("node").alias("root"), F.col("root").alias("new"))
    rooted = rooted.join(found, "root", "left").select("fp", F.coalesce("new", "root").alias("root"))
    return materialise(rooted, "simhash-rooted")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; component_id is the smallest id that links lead to.

    Null ids are ignored in that minimum. Rows with equal ids keep their own fingerprints. An empty table gives none.
    """
    prints = materialise(fingerprints(docs, shingle, id_col, text_col), "simhash")
    classes = materialise(prints.groupBy("fp").agg(F.min("id").alias("least")), "simhash-classes")
    roots = groups(classes, max_bits)
    rooted = classes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
