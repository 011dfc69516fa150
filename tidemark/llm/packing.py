"""Bulk-synchronous best-fit packing of token pieces into sequences of bounded length.

Pieces are ranked inside their length by a distributed sort. Lengths and gaps are at most the capacity, so a round (one
length, from long to short) is a sweep over at most that many classes: all pieces of the length go to the successor, the
smallest class of gaps that holds them, as ranges of ranks onto ranges of sequences, conflicts being settled by rank; the
gaps are updated and the sweep repeats until the length is placed. Only class counts reach the driver. Rows meet
their range by rank.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import doc_columns, map_rows, utf8
from tidemark.session import materialise

CAPACITY, END_ID = 4096, 1
#: Rows that one task ranks at a time, on average; and the least number of parts a length is dealt to.
RANKED_ROWS, MIN_PARTS = 100_000, 64
MEMORY_UNITS = 800_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"
_ENCODERS: dict[str, Encoder] = {}


class Encoder:
    """Ids of texts; what stands between ASCII white space is encoded apart and remembered, within a bound.

    The tokenizer lower-cases and gives letters, digits and marks ids of their own, so units are told apart by their lower
    case only, and a unit of parts that need no normalizing is the ids of its parts, each by the tokenizer's model. Added
    tokens are matched and combining marks composed before lower-casing: a unit that holds one, the token in any case, is
    told apart as it stands and encoded by the whole tokenizer, like all other units.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.memory = _Memory(self.tokenizer, {})
        self.odd = [utf8(t.content).lower() for t in self.tokenizer.get_added_tokens_decoder().values()] + _COMBINING

    def _units(self, text: str) -> list[bytes]:
        data = utf8(text)
        lower = data.lower()
        if not any(t in lower for t in self.odd):
            return lower.split()
        units = [u if any(t in low for t in self.odd) else low for u, low in zip(data.split(), lower.split())]
        for unit in {u for u in units if any(t in u.lower() for t in self.odd)}.difference(self.memory):
            self.memory[unit] = self.memory.whole(unit)
        return units

    def encode(self, text: str) -> bytes:
        if len(self.memory) > MEMORY_UNITS:
            self.memory.older = {}
            self.memory = _Memory(self.tokenizer, self.memory)
        return b"".join(map(self.memory.__getitem__, self._units(text)))


class _Memory(dict):
    """Ids by unit, worked out when first asked for. Units met lately, and those met before them, are two memories; the
    older one is dropped when the newer one is full."""

    def __init__(self, tokenizer: Tokenizer, older: dict[bytes, bytes]):
        super().__init__()
        self.tokenizer, self.model, self.older = tokenizer, tokenizer.model, older

    def whole(self, unit: bytes) -> bytes:
        return array("I", self.tokenizer.encode(unit.decode(), add_special_tokens=False).ids).tobytes()

    def __missing__(self, unit: bytes) -> bytes:
        ids = self.older.get(unit)
        if ids is None:
            parts = [unit] if unit.isalpha() else _PARTS.findall(unit)
            if sum(map(len, parts)) < len(unit):
                ids = self.whole(unit)
            elif len(parts) > 1:
                ids = b"".join([self[part] for part in parts])
            else:
                name = unit.decode() if unit.isascii() else unit.decode("latin-1").translate(_BYTE_LEVEL)
                ids = array("I", [token.id for token in self.model.tokenize(name)]).tobytes()
        self[unit] = ids
        return ids


#: Parts that the tokenizer cuts apart and leaves as they are: lower-case letters (ASCII and Latin-1), a digit, ASCII marks
#: but the apostrophe, which may take letters along.
_PARTS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+|[0-9]|[!-&(-/:-@\[-`{-~]+")
#: First bytes of the combining marks that compose with ASCII letters.
_COMBINING = [b"\xcc", b"\xcd"]
#: The characters by which byte-level models name the bytes that do not print.
_BYTE_LEVEL = {b: 256 + n for n, b in enumerate([*range(33), *range(127, 161), 173])}


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of every row: its ids and the end id, cut only where longer than ``capacity``.

    A null or empty text is its end id alone. Repeated rows give repeated pieces; null ids stay.
    """

    def work(batch: pa.RecordBatch):
        if tokenizer_path not in _ENCODERS:
            _ENCODERS[tokenizer_path] = Encoder(tokenizer_path)
        encoder, rows, end = _ENCODERS[tokenizer_path], [], np.array([end_id], "<u4").tobytes()
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = encoder.encode(text.as_py() or "") + end
            for n, at in enumerate(range(0, len(data), 4 * capacity)):
                part = data[at : at + 4 * capacity]
                rows.append((doc_id, n, at // 4, len(part) // 4, zlib.crc32(part)))
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=[c.split()[0] for c in PIECES.split(", ")]
        )

    return map_rows(doc_columns(docs, "doc_id", "text"), work, PIECES)


def sweep(counts: dict[int, int], capacity: int) -> dict[int, np.ndarray]:
    """Moves of every length: rows (first rank, first sequence, offset), each a range of ranks onto a range of sequences."""
    gaps: dict[int, list[tuple[int, int]]] = {}
    values: list[int] = []
    moves: dict[int, list[tuple[int, int, int]]] = {}
    opened = 0

    def leave(gap: int, first: int, n: int) -> None:
        if n and gap:
            if gap not in gaps:
                gaps[gap] = []
                insort(values, gap)
            gaps[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank, out = counts[length], 0, []
        while left:
            at = bisect_left(values, length)
            if at == len(values):
                gap, n = capacity, -(-left // (capacity // length))
                first, opened = opened, opened + n
            else:
                gap = values[at]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], values[at]
            each = gap // length  # a gap that still holds the length is the smallest one again
            full, rest = min(n, left // each), 0
            if full < n:
                rest = left - full * each
            for k in range(each):
                if full:
                    out.append((rank, first, capacity - gap + k * length))
                    rank += full
            for k in range(rest):
                out.append((rank, first + full, capacity - gap + k * length))
                rank += 1
            left -= full * each + rest
            leave(gap - each * length, first, full)
            if rest:
                leave(gap - rest * length, first + full, 1)
            untouched = full + bool(rest)
            leave(gap, first + untouched, n - untouched)
        moves[length] = np.array(out, np.int64)
    return moves


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with their sequence and offset; sequences are filled from 0 without a gap. An empty table gives none."""
    cut = materialise(cut, "pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most ``capacity`` lengths
    if counts and not 1 <= min(counts) <= max(counts) <= capacity:
        raise ValueError("a piece is longer than a sequence")
    parts = max(MIN_PARTS, sum(counts.values()) // RANKED_ROWS)
    order = ["doc_id", "piece", "start", "ids_crc32"]
    dealt = cut.withColumn("part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("length", "part").agg(F.count("*").alias("n"))
    firsts = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = F.row_number().over(Window.partitionBy("length", "part").orderBy(*order)) - 1
    ranked = dealt.withColumn("inside", inside).join(firsts, ["length", "part"])
    moves = cut.sparkSession.sparkContext.broadcast(sweep(counts, capacity))

    def work(batch: pa.RecordBatch):
        lengths, ranks = batch.column(3).to_numpy(), batch.column(5).to_numpy()
        sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
        for length in np.unique(lengths).tolist():
            rows, table = np.flatnonzero(lengths == length), moves.value[length]
            at = np.searchsorted(table[:, 0], ranks[rows], "right") - 1
            sequence[rows] = table[at, 1] + ranks[rows] - table[at, 0]
            offset[rows] = table[at, 2]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=[c.split()[0] for c in PACKED.split(", ")]
        )

    names = [c.split()[0] for c in PIECES.split(", ")]
    return map_rows(ranked.select(*names, (F.col("first") + F.col("inside")).cast("long").alias("rank")), work, PACKED)
