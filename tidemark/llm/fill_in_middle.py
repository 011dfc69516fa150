"""Fill-in-middle transformation: texts cut at line ends that are found in 64-bit words of their UTF-8.

The bytes of a batch are viewed as words of eight. One word operation marks the bytes that end a unit, another the bytes
that continue a character; population counts of the marks, summed up, give the rank of any byte. The k-th unit end of a
text is looked up in the sums (its word) and then inside the word (its byte). No character is ever looked at alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows

SEED, RATE, SPM_RATE = 7, 100, 50
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes of text that are marked at a time, and of output that leave together; a longer text is one such part.
SLICE_BYTES, OUT_BYTES = 16 << 20, 4 << 20
OUTPUT = "id long, n long, form string, prefix_chars long, middle_chars long, output string"
_ONES = np.uint64(0x0101010101010101)
_HIGH, _LOW = _ONES * np.uint64(0x80), _ONES * np.uint64(0x7F)
_ONE = np.uint64(1)


class Marks:
    """Marked bytes of a buffer: the high bit of each marked byte in little-endian words, with counts before each word."""

    def __init__(self, words: np.ndarray):
        self.words = np.append(words, np.uint64(0))
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marked bytes before each position."""
        inside = (_ONE << (at & 7).astype(np.uint64) * np.uint64(8)) - _ONE
        return self.before[at >> 3] + np.bitwise_count(self.words[at >> 3] & inside)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Positions of the k-th marked bytes, from 1."""
        word = np.searchsorted(self.before, k, "left") - 1
        left, marks = k - self.before[word], self.words[word]
        for _ in range(7):  # a word has eight bytes: at most seven marks stand before the one asked for
            marks = np.where(left > 1, marks & (marks - _ONE), marks)
            left = left - 1
        return 8 * word + (np.bitwise_count((marks & (~marks + _ONE)) - _ONE) >> 3)


def as_words(data: np.ndarray) -> np.ndarray:
    """Bytes as little-endian 64-bit words, the last filled up with zeros."""
    return np.concatenate([data, np.zeros(-len(data) % 8, np.uint8)]).view("<u8")


def equal_bytes(words: np.ndarray, byte: int) -> Marks:
    """Marks of the bytes equal to ``byte``; the sum cannot carry from one byte to the next."""
    other = words ^ (_ONES * np.uint64(byte))
    return Marks(~(((other & _LOW) + _LOW) | other | _LOW))


def continuations(words: np.ndarray) -> Marks:
    """Marks of the bytes 10xxxxxx, which continue a character."""
    return Marks(words & _HIGH & ~(words << _ONE))


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column in a row, and the n + 1 places where they start and end; a null text is empty."""
    column = column.cast(pa.large_binary())
    _, places, data = column.buffers()
    ends = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]]
    return held, ends - ends[0]


def _parts(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about SLICE_BYTES."""
    at = 0
    while at < len(ends) - 1:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE_BYTES, "right")) - 1)
        yield at, to
        at = to


def _cut(part: pa.RecordBatch, rate: int, spm_rate: int) -> Iterator[pa.RecordBatch]:
    data, ends = _texts(part.column(1))
    starts, stops = ends[:-1], ends[1:]
    words = as_words(data)
    lines, inner = equal_bytes(words, 10), continuations(words)
    before = lines.rank(starts)
    empty = starts == stops
    open_end = ~empty & (data[np.maximum(stops - 1, 0)] != 10) if len(data) else ~empty
    n = lines.rank(stops) - before + open_end
    h = [part.column(2 + i).to_numpy() for i in range(4)]
    first, second = h[0] % (n + 1), h[1] % (n + 1)

    def end_of(k: np.ndarray) -> np.ndarray:
        out = np.where(k == 0, starts, stops)
        inside = np.flatnonzero((k > 0) & (k < n))
        out[inside] = lines.select(before[inside] + k[inside]) + 1
        return out

    a, b = end_of(np.minimum(first, second)), end_of(np.maximum(first, second))
    held = [pc.fill_null(pc.match_substring(part.column(1), m), False).to_numpy(zero_copy_only=False) for m in (PREFIX, SUFFIX, MIDDLE)]
    plain = empty | np.logical_or.reduce(held) | (h[2] % 100 >= rate)
    spm = ~plain & (h[3] % 100 < spm_rate)
    form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
    chars = [y - x - (inner.rank(y) - inner.rank(x)) for x, y in ((starts, a), (a, b))]
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    raw, out, size, sent = data.tobytes(), [], 0, 0

    def batch(to: int) -> pa.RecordBatch:
        rows = slice(sent, to)
        return pa.RecordBatch.from_arrays(
            [part.column(0).slice(sent, to - sent), pa.array(n[rows]), pa.array(form[rows], pa.string()),
             *(pa.array(c[rows], pa.int64(), mask=plain[rows]) for c in chars), pa.array(out, pa.binary()).cast(pa.string())],
            names=[c.split()[0] for c in OUTPUT.split(", ")],
        )

    for i, (x, y, u, v, kind) in enumerate(zip(starts.tolist(), stops.tolist(), a.tolist(), b.tolist(), form.tolist())):
        if kind == "plain":
            out.append(raw[x:y])
        elif kind == "psm":
            out.append(b"".join((p, raw[x:u], s, raw[v:y], m, raw[u:v])))
        else:
            out.append(b"".join((s, raw[v:y], p, raw[x:u], m, raw[u:v])))
        size += len(out[-1])
        if size >= OUT_BYTES:
            yield batch(i + 1)
            sent, out, size = i + 1, [], 0
    if out:
        yield batch(len(ends) - 1)


def transform(
    docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every row.

    A text is n lines, each with its line end. Four hashes of the seed and the id pick the two cuts, whether the row is
    transformed (``rate`` percent) and its form (``spm_rate`` percent suffix first). Empty and null texts, and texts that
    hold a marker, stay plain: their lengths are null and the output is the text. A null id hashes as the empty text. Rows
    that repeat give equal rows; an empty table gives none; other columns stay out; texts of any length are read whole.
    """
    key = F.col(f"`{id_col}`").cast("long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    rows = docs.select(key.alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), digest.alias("digest"))
    hashes = [F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]

    def work(batch: pa.RecordBatch):
        ends = _texts(batch.column(1))[1]
        for at, to in _parts(ends):
            yield from _cut(batch.slice(at, to - at), rate, spm_rate)

    return map_rows(rows.select("id", "text", *hashes), work, OUTPUT)


def restored(form: Column, output: Column) -> Column:
    """The text that ``output`` was made from; the markers stand in it once each."""
    p, s, m = (F.lit(x) for x in (PREFIX, SUFFIX, MIDDLE))
    before_m, middle = F.split_part(output, m, F.lit(1)), F.split_part(output, m, F.lit(2))
    psm = F.concat(F.split_part(F.split_part(before_m, p, F.lit(2)), s, F.lit(1)), middle, F.split_part(before_m, s, F.lit(2)))
    spm = F.concat(F.split_part(before_m, p, F.lit(2)), middle, F.split_part(F.split_part(before_m, s, F.lit(2)), p, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
