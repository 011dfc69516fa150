"""SentencePiece encoding that keeps offsets: longest-prefix normalisation with a record of where each character came from.

The compiled character map of a model is a double-array trie of prefixes and their replacements. The normaliser takes the
longest prefix that the map knows, writes its replacement and notes the source position for each character written; pieces
found in the normalised text are then projected to bytes of the source. Merging happens in units: stretches of the
normalised text over whose ends no piece of the vocabulary can reach. Units met before are remembered, within a bound.
"""

from __future__ import annotations

import codecs
import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import doc_columns, map_rows, text_slices, utf8

#: The sign that stands for a space in pieces, and the replacement of bytes that are no UTF-8.
SPACE, BROKEN = "▁", "�"
#: Fixed values of the model format: kinds of pieces.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
MEMORY_UNITS, SLICE_CHARS, SHORT = 400_000, 2_000_000, 48
CODED, DECODED = "id long, ids array<int>, starts array<int>, ends array<int>", "id long, ids array<int>, text string"
_FAR = 1 << 60

codecs.register_error("bytewise", lambda e: (BROKEN, e.start + 1))


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol-buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[at] & 0x7F) << shift
            shift, at = shift + 7, at + 1
            if data[at - 1] < 0x80:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        if key & 7 == 0:
            value, at = varint(at)
        else:
            size, at = (8, at) if key & 7 == 1 else (4, at) if key & 7 == 5 else varint(at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class CharacterMap:
    """Longest-prefix look-up in the compiled map: a double array over bytes, then replacements ended by zero bytes."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.replacements = blob[4 + size :]

    def longest(self, source: bytes, start: int) -> tuple[int, str] | None:
        """(bytes taken, replacement) of the longest known prefix of ``source`` from ``start`` on."""
        if not self.units:
            return None
        units, found = self.units, None
        node, at = _child(units[0]), start
        while at < len(source) and source[at]:
            node ^= source[at]
            unit = units[node]
            if unit & 0x800000FF != source[at]:
                break
            node, at = node ^ _child(unit), at + 1
            if unit >> 8 & 1:
                found = at - start, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        to = self.replacements.index(b"\0", found[1])
        return found[0], self.replacements[found[1] : to].decode()


def _child(unit: int) -> int:
    """Distance of a node's children; a flag says that it is counted in 256s."""
    return (unit >> 10) << ((unit & 0x200) >> 6)


class Model:
    """Pieces, scores and normalisation of a BPE model file. What it remembers between texts is bounded."""

    def __init__(self, blob: bytes):
        pieces, flags, kind = [], {}, 1
        charsmap = b""
        for field, value in _fields(blob):
            if field == 1:
                inner = dict(_fields(value))
                pieces.append((inner.get(1, b"").decode(), struct.unpack("<f", inner.get(2, bytes(4)))[0], inner.get(3, NORMAL)))
            elif field == 2:
                spec = dict(_fields(value))
                kind, self.suffix = spec.get(3, 1), bool(spec.get(24, 0))
                self.unknown_text = spec.get(44, b" \xe2\x81\x87 ").decode()
            elif field == 3:
                flags = dict(_fields(value))
                charsmap = flags.get(2, b"")
        if kind != 2:
            raise ValueError("not a BPE model")
        self.dummy, self.squeeze, self.escape = (bool(flags.get(k, 1)) for k in (3, 4, 5))
        self.map = CharacterMap(charsmap)
        self.pieces = [p for p, _, _ in pieces]
        self.kinds = [k for _, _, k in pieces]
        usable = {p: (-s, i) for i, (p, s, k) in enumerate(pieces) if k in (NORMAL, USER_DEFINED, UNUSED)}
        places = {s: n for n, s in enumerate(sorted({s for s, _ in usable.values()}))}
        #: Place of each piece in the order of merging (equal scores share one), and its id.
        self.place = {p: places[s] for p, (s, _) in usable.items()}
        self.ids = {p: i for p, (_, i) in usable.items()}
        self.unused = {p for p, _, k in pieces if k == UNUSED}
        self.frozen = sorted((p for p, _, k in pieces if k == USER_DEFINED), key=len, reverse=True)
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(pieces) if k == BYTE}
        self.unknown = self.kinds.index(UNKNOWN)
        self._prepare()

    def _prepare(self) -> None:
        """The unit pattern: cuts that no piece of the vocabulary reaches over."""
        pairs = {(a, b) for p in self.ids for a, b in zip(p, p[1:])}
        behind: dict[str, set[str]] = {}
        for a, b in pairs:
            behind.setdefault(b, set()).add(a)
        spaced, lined = behind.get(SPACE, set()) <= {SPACE}, not any("\n" in pair for pair in pairs)
        self.freeze = re.compile("|".join(map(re.escape, self.frozen))) if self.frozen else None
        if self.frozen or not spaced:
            self.unit = re.compile(r"(?s).+")
        else:
            self.unit = re.compile(rf"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n" if lined else rf"{SPACE}*[^{SPACE}]+|{SPACE}+")
        letters = set("abcdefghijklmnopqrstuvwxyz")
        self.marks = {m for m in ",.;:!?" if not self.frozen and not behind.get(m, set()) & letters}
        self.letters = letters
        #: Pieces that stand for themselves, as encode_unit writes them.
        self.written = {p: struct.pack("<2i", i, len(p)) for p, i in self.ids.items() if p not in self.unused}
        #: What each id stands for in a text, those that stand for nothing, and those that lose a leading space sign.
        plain = {CONTROL: lambda p: b"", UNKNOWN: lambda p: utf8(self.unknown_text), BYTE: lambda p: bytes([int(p[3:5], 16)])}
        spaced = lambda p: utf8(p.replace(SPACE, " "))
        self.tokens = pa.array([plain.get(k, spaced)(p) for p, k in zip(self.pieces, self.kinds)], pa.binary())
        self.silent = np.array([k == CONTROL for k in self.kinds])
        lead = self.dummy or self.squeeze
        self.drops = [lead and k not in plain and p.startswith(SPACE) for p, k in zip(self.pieces, self.kinds)]
        #: Units met lately, and those met before them.
        self.memory: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def __getstate__(self):
        made = ("memory", "older", "unit", "freeze", "written", "tokens", "silent", "drops")
        return {k: v for k, v in self.__dict__.items() if k not in made}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._prepare()

    def normalise(self, text: str) -> tuple[str, np.ndarray | None]:
        """The normalised text, and for each of its characters, and its end, the byte of the source that it comes from.

        Without a character map, and without squeezing spaces, characters stay what they are: then the second result is
        None, and character i comes from character i less the leading space sign.
        """
        if not text:
            return "", None
        space = SPACE if self.escape else " "
        ahead = self.dummy and not self.suffix
        if not (self.map.units or self.squeeze or self.freeze):
            plain = text.replace(" ", space)
            return (space + plain if ahead else plain + space if self.dummy else plain), None
        source, at, out, origin = utf8(text), 0, [], []

        def prefix(at: int) -> tuple[int, str]:
            if self.freeze and (m := self.freeze.match(source[at : at + 4 * len(self.frozen[0])].decode("utf-8", "ignore"))):
                return len(utf8(m[0])), m[0]
            known = self.map.longest(source, at)
            if known:
                return known
            size = 1 + (source[at] >= 0xC0) + (source[at] >= 0xE0) + (source[at] >= 0xF0)
            return size, source[at : at + size].decode()

        def write(text: str, at: int) -> None:
            out.append(text.replace(" ", space))
            origin.extend([at] * len(text))

        if self.squeeze:
            while at < len(source) and (p := prefix(at))[1] == " ":
                at += p[0]
        if at == len(source):
            return "", None
        if ahead:
            write(" ", at)
        after_space = self.squeeze
        while at < len(source):
            size, new = prefix(at)
            if after_space:
                new = new.lstrip(" ")
            if new:
                write(new, at)
                after_space = self.squeeze and new.endswith(" ")
            at += size
        normal = "".join(out)
        end = len(source)
        if self.squeeze:
            while normal.endswith(space):
                normal, end = normal[: -len(space)], origin[len(normal) - 1]
        origin = origin[: len(normal)]
        if self.dummy and self.suffix:
            normal += space
            origin.append(end)
        return normal, np.array([*origin, end], np.int64)

    def _merged(self, parts: list[str], free: list[bool] | None = None) -> list[str]:
        """Pieces of a unit: the pair with the best score first, the leftmost of equals."""
        if free is None and len(parts) <= SHORT:
            place = self.place.get
            found = [place(a + b, _FAR) for a, b in zip(parts, parts[1:])]
            while found and (best := min(found)) != _FAR:
                at = found.index(best)
                del found[at]
                parts[at] = new = parts[at] + parts.pop(at + 1)
                if at:
                    found[at - 1] = place(parts[at - 1] + new, _FAR)
                if at < len(found):
                    found[at] = place(new + parts[at + 1], _FAR)
            return parts
        place, n = self.place.get, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, str, str]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right < n and (free is None or free[left] and free[right]):
                rank = place(parts[left] + parts[right])
                if rank is not None:
                    heapq.heappush(heap, (rank, left, parts[left], parts[right]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, left, a, b = heapq.heappop(heap)
            right = after[left]
            if parts[left] != a or right >= n or parts[right] != b:
                continue
            parts[left], parts[right] = a + b, ""
            after[left] = after[right]
            if after[right] < n:
                before[after[right]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [p for p in parts if p]

    def _reused(self, piece: str) -> list[str]:
        """An unused piece as the pieces it was merged from."""
        if piece not in self.unused or len(piece) < 2:
            return [piece]
        halves = [(self.place.get(piece[:k], -1), piece[:k], piece[k:]) for k in range(1, len(piece))]
        _, a, b = self._last_merge(piece) or min(halves)
        return self._reused(a) + self._reused(b)

    def _last_merge(self, piece: str) -> tuple[int, str, str] | None:
        parts = list(piece)
        while len(parts) > 2:
            found = [self.place.get(a + b, _FAR) for a, b in zip(parts, parts[1:])]
            at = found.index(min(found))
            if found[at] == _FAR:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return (0, *parts) if len(parts) == 2 else None

    def encode_unit(self, unit: str) -> bytes:
        """(id, characters taken) of each piece, as pairs of 32-bit integers."""
        if unit[-1] in self.marks and len(unit) > 1 and unit[-2] in self.letters:
            return self._of(unit[:-1]) + self._of(unit[-1])
        if self.freeze:
            parts, free = [], []
            at = 0
            while at < len(unit):
                m = self.freeze.match(unit, at)
                parts.append(m[0] if m else unit[at])
                free.append(m is None)
                at += len(parts[-1])
        else:
            parts, free = list(unit), None
        merged = self._merged(parts, free)
        try:
            return b"".join(map(self.written.__getitem__, merged))
        except KeyError:  # an unused piece or a character without one
            pass
        out: list[int] = []
        for piece in merged:
            for one in self._reused(piece):
                number = self.ids.get(one)
                if number is not None:
                    out += (number, len(one))
                elif self.byte_ids:
                    data = utf8(one)
                    out += [v for b in data[:-1] for v in (self.byte_ids[b], 0)] + [self.byte_ids[data[-1]], len(one)]
                else:
                    out += (self.unknown, len(one))
        return struct.pack(f"<{len(out)}i", *out)

    def _of(self, unit: str) -> bytes:
        coded = self.memory.get(unit)
        if coded is None:
            coded = self.memory[unit] = self.encode_unit(unit)
        return coded

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a text, and the first and the end byte in the source that each covers.

        A character without a piece is one id per byte: all but the last cover nothing, the last covers the character.
        """
        normal, origin = self.normalise(text)
        memory, units = self.memory, self.unit.findall(normal)
        try:
            coded = b"".join(map(memory.__getitem__, units))
        except KeyError:
            if len(memory) > MEMORY_UNITS:
                self.older, self.memory = memory, (memory := {})
            older = self.older.get
            for unit in {u for u in units if u not in memory}:
                memory[unit] = older(unit) or self.encode_unit(unit)
            coded = b"".join(map(memory.__getitem__, units))
            if len(memory) > 2 * MEMORY_UNITS:  # one text with very many units
                memory.clear()
        pairs = np.frombuffer(coded, "<i4").reshape(-1, 2)
        if not self.byte_ids:  # neighbouring unknown characters are one
            first = np.flatnonzero(np.r_[True, (pairs[1:, 0] != self.unknown) | (pairs[:-1, 0] != self.unknown)][: len(pairs)])
            pairs = np.c_[pairs[first, 0], np.add.reduceat(pairs[:, 1], first)] if len(first) else pairs
        ends = np.cumsum(pairs[:, 1], dtype=np.int64)
        starts = np.r_[0, ends[:-1]][: len(ends)]
        if origin is None:
            data = np.frombuffer(utf8(text), np.uint8)
            chars = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
            shift = int(self.dummy and not self.suffix)
            starts, ends = (chars[np.clip(x - shift, 0, len(chars) - 1)] for x in (starts, ends))
        else:
            starts, ends = origin[starts], origin[ends]
        return pairs[:, 0], starts, ends


def share_model(spark: SparkSession, path: str) -> Broadcast:
    """The model of a file, once per executor; its size is that of the vocabulary."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(Model(file.read()))


def _coded(own: Model, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    for some, part in text_slices(keys, texts, SLICE_CHARS):
        coded = [own.encode(t or "") for t in part]
        ends = pa.array(np.cumsum([0, *(len(c[0]) for c in coded)]), pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([c[i] for c in coded]).astype(np.int32))) for i in range(3)]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), *lists], names=["id", "ids", "starts", "ends"])


def _decoded(own: Model, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, 256):
        part = batch.slice(at, 256)
        ids = pc.fill_null(part.column(1), pa.scalar([], part.column(1).type))
        flat = pc.list_flatten(ids)
        ends = np.cumsum(np.r_[0, pc.list_value_length(ids).to_numpy(zero_copy_only=False)])
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), own.tokens.take(flat)), b"").to_pylist()
        numbers, texts = flat.to_numpy(), []
        for row, data in enumerate(joined):
            for k in range(ends[row], ends[row + 1]):
                if own.silent[numbers[k]]:
                    continue
                if own.drops[numbers[k]]:
                    data = data[1:]
                    if own.squeeze and len(own.pieces[numbers[k]]) == 1:
                        continue  # nothing is written yet: the next piece is still the first
                break
            mine = numbers[ends[row] : ends[row + 1]]
            runs = _runs(own, mine, len(data)) if own.silent[mine].any() else [data]
            texts.append("".join(r.decode("utf-8", "bytewise") for r in runs))
        yield pa.RecordBatch.from_arrays([part.column(0), ids, pa.array(texts, pa.string())], names=["id", "ids", "text"])


def encode(docs: DataFrame, model: Broadcast, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, starts, ends) of every row: the library's ids without begin and end, and the source bytes of each.

    A null or empty text has no ids. Repeated rows and null keys stay as they are; other columns stay out; an empty table
    gives an empty result; a text is encoded whole, whatever its length.
    """
    return map_rows(doc_columns(docs, id_col, text_col), lambda batch: _coded(model.value, batch), CODED)


def decode(coded: DataFrame, model: Broadcast) -> DataFrame:
    """(id, ids, text): the text that the ids of a row stand for; null ids count as none.

    Bytes that are no UTF-8 become one replacement character each. The space sign put before a text is taken off again.
    """
    return map_rows(coded.select("id", "ids"), lambda batch: _decoded(model.value, batch), DECODED)


def round_trip(docs: DataFrame, model: Broadcast, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, text) of :func:`encode` and then :func:`decode`, in one pass over the rows."""

    def work(batch: pa.RecordBatch):
        for coded in _coded(model.value, batch):
            yield from _decoded(model.value, coded)

    return map_rows(doc_columns(docs, id_col, text_col), work, DECODED)


def _runs(own: Model, ids: np.ndarray, kept: int) -> list[bytes]:
    """Bytes of the stretches between control ids, over which no character reaches; ``kept`` bytes are left of them all."""
    parts = [b"".join(own.tokens.take(pa.array(p)).to_pylist()) for p in np.split(ids, np.flatnonzero(own.silent[ids]))]
    lost = sum(map(len, parts)) - kept
    for i, part in enumerate(parts):  # what was taken off stood at the start
        parts[i], lost = part[lost:], max(0, lost - len(part))
    return parts


def digests(decoded: DataFrame) -> DataFrame:
    """Counts and digests of ids and text, one row per row of :func:`decode`."""
    return decoded.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("text"), 256).alias("decoded_sha256"),
    )
