"""Byte-level BPE: a minimal perfect hash for pre-tokens that are vocabulary entries, a heap over linked bytes for the rest.

The tables are built once on the driver and broadcast; their size is that of the vocabulary. A task remembers the ids of
the space-delimited units it has met, in a memory of bounded size, so that a frequent unit is looked up once.
"""

from __future__ import annotations

import base64
import re
import struct
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import doc_columns, map_rows, text_slices, utf8

#: White space as the pattern's \s means it, inside a character class.
SPACE = "\t-\r \x85\xa0  -     　"
#: A unit: one space before and a run without white space, or a piece of white space, cut as the pattern cuts it. No
#: pre-token of the pattern reaches over the end of a unit, and what it finds in a unit depends on the unit alone.
UNIT = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
MEMORY_UNITS = 400_000
SLICE_CHARS = 2_000_000
BUCKET_KEYS = 4


class PerfectHash:
    """Minimal perfect hash by hash and displace: n keys on n slots, one probe and one comparison per look-up."""

    def __init__(self, keys: list[bytes]):
        self.n = len(keys)
        self.n_buckets = max(1, -(-self.n // BUCKET_KEYS))
        self.shift: list[int] = [0] * self.n_buckets
        self.slots: list[int] = [-1] * self.n
        buckets: list[list[tuple[int, int, int]]] = [[] for _ in range(self.n_buckets)]
        for number, key in enumerate(keys):
            b, f, g = self._hashes(key)
            buckets[b].append((f, g, number))
        taken = np.zeros(self.n, bool)
        order = sorted(range(self.n_buckets), key=lambda b: -len(buckets[b]))
        for b in order:
            held = buckets[b]
            if len(held) < 2:
                break
            f, g = (np.array([h[i] for h in held], np.int64)[:, None] for i in (0, 1))
            low = 0
            while True:
                tries = np.arange(low, low + 64)
                at = (f + tries * g + tries // 64) % self.n  # the last term leaves short cycles of g
                ordered = np.sort(at, axis=0)
                good = ~taken[at].any(axis=0) & (ordered[1:] != ordered[:-1]).all(axis=0)
                if good.any():
                    break
                low += 64
            pick = int(np.argmax(good))
            self.shift[b] = low + pick
            taken[at[:, pick]] = True
            for (_, _, number), slot in zip(held, at[:, pick].tolist()):
                self.slots[slot] = number
        free = iter(np.flatnonzero(~taken).tolist())
        for b in order:
            if len(buckets[b]) == 1:  # a single key goes straight to a free slot
                slot = next(free)
                self.shift[b] = -1 - slot
                self.slots[slot] = buckets[b][0][2]

    def _hashes(self, key: bytes) -> tuple[int, int, int]:
        h = xxhash.xxh3_64_intdigest(key)
        return (h & 0xFFFFFF) % self.n_buckets, (h >> 24) % self.n, 1 + (h >> 44) % max(1, self.n - 1)

    def number(self, key: bytes) -> int:
        """Number of the only key that ``key`` can be; the caller compares."""
        b, f, g = self._hashes(key)
        shift = self.shift[b]
        return self.slots[-1 - shift if shift < 0 else (f + shift * g + shift // 64) % self.n]


class _Known(dict):
    """Ranks of byte strings met in merges, -1 for those without one; what is new goes through the perfect hash."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, token: bytes) -> int:
        rank = self.vocabulary.rank(token)
        self[token] = found = -1 if rank is None else rank
        return found


class Vocabulary:
    """Tokens by id, their perfect hash, and the encoder of one unit. What it remembers between texts is bounded."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens, self.pattern = tokens, pattern
        self.hash = PerfectHash(tokens)
        self._forget()

    def _forget(self) -> None:
        self.units: dict[str, bytes] = {}
        self.merged: dict[str, bytes] = {}  # bytes, which the collector need not visit
        self.known = _Known(self)
        self.compiled = None

    def __getstate__(self):
        return {"tokens": self.tokens, "pattern": self.pattern, "hash": self.hash}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._forget()

    def rank(self, token: bytes) -> int | None:
        number = self.hash.number(token)
        return number if self.tokens[number] == token else None

    def merge(self, piece: bytes) -> list[int]:
        """BPE of a piece that is no vocabulary entry: the lowest rank first, the leftmost of equals."""
        n = len(piece)
        after = list(range(1, n + 2))  # end of the part that starts here, -1 where none does any more
        before = list(range(-1, n))  # start of the part that ends here
        known = self.known
        if len(known) > MEMORY_UNITS:
            known.clear()
        heap = []
        for i in range(n - 1):
            rank = known[piece[i : i + 2]]
            if rank >= 0:
                heap.append((rank, i, i + 2))
        heapify(heap)
        while heap:
            _, start, end = heappop(heap)
            middle = after[start]
            if after[middle] != end:  # of a part that is gone: after[-1] is beyond every end
                continue
            after[middle] = -1
            after[start] = end
            if start:
                left = before[start]
                rank = known[piece[left:end]]
                if rank >= 0:
                    heappush(heap, (rank, left, end))
            if end < n:
                before[end] = start
                right = after[end]
                rank = known[piece[start:right]]
                if rank >= 0:
                    heappush(heap, (rank, start, right))
        if after[0] == n:
            return [known[piece]]
        ids, at = [], 0
        while at < n:
            ids.append(known[piece[at : after[at]]])
            at = after[at]
        return ids

    def encode_unit(self, unit: str) -> bytes:
        if self.compiled is None:
            self.compiled = regex.compile(self.pattern)
        merged, parts = self.merged, []
        for piece in self.compiled.findall(unit):
            coded = merged.get(piece)
            if coded is None:
                data = utf8(piece)
                whole = self.rank(data)
                ids = self.merge(data) if whole is None else [whole]
                coded = struct.pack(f"<{len(ids)}i", *ids)
                if len(merged) > MEMORY_UNITS:
                    merged.clear()
                merged[piece] = coded
            parts.append(coded)
        return parts[0] if len(parts) == 1 else b"".join(parts)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian 32-bit integers."""
        units, found = self.units, UNIT.findall(text)
        try:
            return b"".join(map(units.__getitem__, found))
        except KeyError:
            if len(units) > MEMORY_UNITS:
                units.clear()
            for unit in [u for u in set(found) if u not in units]:
                units[unit] = self.encode_unit(unit)
            out = b"".join(map(units.__getitem__, found))
            if len(units) > 2 * MEMORY_UNITS:  # one text with very many units
                units.clear()
            return out


def load_vocabulary(path: str, pattern: str) -> Vocabulary:
    """Ranks from a tiktoken file: a base64 token and its rank on each line, ranks 0..n-1, all single bytes included."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must be 0..n-1")
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"single bytes without a rank: {missing}")
    return Vocabulary(tokens, pattern)


def share_vocabulary(spark: SparkSession, path: str, pattern: str) -> Broadcast:
    return spark.sparkContext.broadcast(load_vocabulary(path, pattern))


def _lists(parts: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(p) // 4 for p in parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(parts), "<i4")))


def encode(docs: DataFrame, vocabulary: Broadcast, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) of every row; the ids are those of the vocabulary's own library without special tokens.

    A null or empty text has no ids. Repeated rows and null keys stay as they are; further columns are left out; an
    empty table gives an empty result; a text is encoded whole, whatever its length.
    """

    def work(batch: pa.RecordBatch):
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for some, part in text_slices(ids, texts, SLICE_CHARS):
            coded = [vocabulary.value.encode(t) if t else b"" for t in part]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), _lists(coded)], names=["id", "ids"])

    return map_rows(doc_columns(docs, id_col, text_col), work, "id long, ids array<int>")


def decode(coded: DataFrame, vocabulary: Broadcast) -> DataFrame:
    """(id, ids, bytes): the bytes that the ids of a row stand for; null ids count as none."""

    def work(batch: pa.RecordBatch):
        tokens = pa.array(vocabulary.value.tokens, pa.binary())
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            ids = pc.fill_null(part.column(1), pa.scalar([], part.column(1).type))
            flat = pc.list_flatten(ids)
            ends = pa.array(np.cumsum(np.r_[0, pc.list_value_length(ids).to_numpy(zero_copy_only=False)]), pa.int32())
            pieces = pa.ListArray.from_arrays(ends, tokens.take(flat))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), ids, pc.binary_join(pieces, b"")], names=["id", "ids", "bytes"]
            )

    return map_rows(coded.select("id", "ids"), work, "id long, ids array<int>, bytes binary")


def digests(decoded: DataFrame) -> DataFrame:
    """Counts and digests of ids and bytes, one row per row of :func:`decode`."""
    written = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return decoded.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(written, 256).alias("ids_sha256"),
        F.sha2(F.col("bytes"), 256).alias("decoded_sha256"),
    )
