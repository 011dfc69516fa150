"""WARC records in ZIP packages: stored members, an index member, and reading by ranges without extraction.

Each record is a gzip member of its own, as web archives have it. Tasks write packages straight to the shared folder; a package counts only if its task's row reached the written
manifest, so files of lost or repeated tasks are never read. Reading goes manifest -> central directory (ZIP64 too) ->
index member -> byte ranges of records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, utf8
from tidemark.session import materialise, scratch

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"
#: A package is closed when it holds this many bytes; neighbouring records are read together up to READ_BYTES.
PACKAGE_BYTES, READ_BYTES = 128 << 20, 4 << 20
MANIFEST = "path string, n_records long, n_bytes long"
RECORDS = "path string, offset long, length long"
PAGES = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
#: Fixed values of the ZIP format: signatures and fixed parts of its structures.
END, END64, LOCATOR = struct.Struct("<4s4H2LH"), struct.Struct("<4sQ2H2L4Q"), struct.Struct("<4sLQL")
ENTRY, LOCAL = struct.Struct("<4s6H3L5H2L"), struct.Struct("<4s5H3L2H")
END_SIGN, END64_SIGN, LOCATOR_SIGN, ENTRY_SIGN, LOCAL_SIGN = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


def _at(source, offset: int, length: int) -> bytes:
    source.seek(offset)
    data = source.read(length)
    if len(data) != length:
        raise ValueError("truncated package")
    return data


def members(source, size: int) -> dict[str, tuple[int, int]]:
    """name -> (offset, length) of the bytes of every stored member, from the central directory."""
    tail_at = max(0, size - END.size - FULL16)
    tail = _at(source, tail_at, size - tail_at)
    at = tail.rfind(END_SIGN, 0, len(tail) - END.size + len(END_SIGN))
    while at >= 0 and at + END.size + END.unpack_from(tail, at)[-1] != len(tail):
        at = tail.rfind(END_SIGN, 0, at)
    if at < 0:
        raise ValueError("no end of central directory")
    _, _, _, _, n, length, start, _ = END.unpack_from(tail, at)
    if n == FULL16 or length == FULL32 or start == FULL32:
        sign, _, end64_at, _ = LOCATOR.unpack(_at(source, tail_at + at - LOCATOR.size, LOCATOR.size))
        if sign != LOCATOR_SIGN:
            raise ValueError("no ZIP64 locator")
        sign, *_, n, length, start = END64.unpack(_at(source, end64_at, END64.size))
        if sign != END64_SIGN:
            raise ValueError("no ZIP64 directory end")
    directory, out, at = _at(source, start, length), {}, 0
    for _ in range(n):
        sign, _, _, flags, method, _, _, _, packed, plain, n_name, n_extra, n_note, _, _, _, header = ENTRY.unpack_from(directory, at)
        if sign != ENTRY_SIGN:
            raise ValueError("bad directory entry")
        at += ENTRY.size
        name = directory[at : at + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = directory[at + n_name : at + n_name + n_extra]
        at += n_name + n_extra + n_note
        while len(extra) >= 4:
            kind, n_field = struct.unpack_from("<2H", extra)
            if kind == 1:
                wide = iter(struct.unpack_from(f"<{n_field // 8}Q", extra, 4))
                plain = next(wide) if plain == FULL32 else plain
                packed = next(wide) if packed == FULL32 else packed
                header = next(wide) if header == FULL32 else header
            extra = extra[4 + n_field :]
        if method == 0:
            local = LOCAL.unpack(_at(source, header, LOCAL.size))
            if local[0] != LOCAL_SIGN:
                raise ValueError("bad member header")
            out[name] = (header + LOCAL.size + local[-2] + local[-1], packed)
    return out


def record(page_id: int | None, url: str | None, payload: bytes, n_bytes: int, digest: str, refers_to: int | None) -> bytes:
    """One WARC record of a payload of ``n_bytes``; a revisit carries the HTTP head alone."""
    http = utf8(f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n")
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or ""),
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if refers_to is not None:
        head += [
            f"WARC-Refers-To: <urn:page:{refers_to}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return utf8("\r\n".join(head) + "\r\n\r\n") + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[int | None, int, str, str, int | None]:
    """(page, payload bytes, digest, type, refers to) of a record; a response's payload is measured and digested anew."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda name: None if (v := fields.get(name, "<urn:page:None>")[10:-1]) == "None" else int(v)
    if fields["WARC-Type"] == "response":
        digest = base32_sha1(payload)
        if f"sha1:{digest}" != fields["WARC-Payload-Digest"]:
            raise ValueError("payload does not match its digest")
        return number("WARC-Record-ID"), len(payload), digest, "response", None
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"][5:]
    return number("WARC-Record-ID"), size, digest, fields["WARC-Type"], number("WARC-Refers-To")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_references(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, sha1, n_bytes, refers_to): the smallest page of equal payloads, for the others of them.

    Payloads are told apart by digest and length, and only these meet by payload; the payload itself goes with its page,
    and not at all with a page that refers to another. Payloads under ``min_bytes`` refer to nothing. A null html is empty.
    Rows that repeat the smallest page_id are responses like it; a null page_id refers to a page that has one, if any.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumns({"sha1": F.sha1(F.encode("html", "UTF-8")), "n_bytes": F.octet_length("html").cast("long")})
    digests = rows.groupBy("sha1", "n_bytes", "page_id").agg(F.count("*").alias("n"))
    first = digests.groupBy("sha1", "n_bytes").agg(F.min("page_id").alias("first"), F.sum("n").alias("n"))
    # most payloads stand alone: only those that do not are looked up
    repeated = first.where("n > 1").select("sha1", "n_bytes", "first")
    other = (F.col("n_bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first"))
    refers = digests.join(repeated, ["sha1", "n_bytes"]).where(other).select("page_id", "sha1", "n_bytes", "first")
    refers = materialise(refers, "warc-refers").toDF("page_id", "sha1", "n_bytes", "refers_to")
    same = rows.page_id.eqNullSafe(refers.page_id) & (rows.sha1 == refers.sha1) & (rows.n_bytes == refers.n_bytes)
    payload = F.when(refers.refers_to.isNull(), F.col("html"))
    return rows.join(refers, same, "left").select(
        rows.page_id, "url", payload.alias("html"), rows.sha1, rows.n_bytes, "refers_to"
    )


def write_packages(pages: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Packages of the records of ``pages`` (as :func:`with_references` gives them) below ``folder``; returns their manifest.

    Each package is written by one task as a stream, member by member, a record at a time. An empty table writes none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")
        store.create_dir(root, recursive=True)
        name = raw = package = member = None
        index: list[str] = []
        offset = 0

        def close() -> pa.RecordBatch:
            member.close()
            with package.open(INDEX, "w", force_zip64=True) as out:
                out.write(utf8("\n".join(index)))
            package.close()
            raw.close()
            return pa.RecordBatch.from_pydict({"path": [name], "n_records": [len(index)], "n_bytes": [offset]})

        for batch in batches:
            for row in range(batch.num_rows):
                page_id, url, html, sha1, n_bytes, refers_to = (c[row].as_py() for c in batch.columns)
                if package is None:
                    name = f"{root}/{uuid.uuid4().hex}.zip"
                    raw = store.open_output_stream(name)
                    package = zipfile.ZipFile(_Stream(raw), "w", zipfile.ZIP_STORED)
                    member = package.open(ARCHIVE, "w", force_zip64=True)
                    index, offset = [], 0
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                data = gzip.compress(record(page_id, url, utf8(html or ""), n_bytes, digest, refers_to), mtime=0)
                member.write(data)
                index.append(json.dumps({"page": page_id, "offset": offset, "length": len(data)}))
                offset += len(data)
                if offset >= package_bytes:
                    yield close()
                    package = None
        if package is not None:
            yield close()

    columns = ["page_id", "url", "html", "sha1", "n_bytes", "refers_to"]
    return materialise(pages.select(*columns).mapInArrow(run, MANIFEST), "manifest")


class _Stream:
    """Write-only view of a store's stream, as the packager wants it."""

    def __init__(self, raw):
        self.raw = raw

    def write(self, data) -> int:
        self.raw.write(data)
        return len(data)

    def flush(self) -> None:
        self.raw.flush()


def _open(folder: str, path: str):
    store, _ = fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")
    return store.open_input_file(path)


def locate(manifest: DataFrame, folder: str) -> DataFrame:
    """(path, offset, length) of the byte range of every record, by the index of its package."""

    def work(batch: pa.RecordBatch):
        for path in batch.column(0).to_pylist():
            with _open(folder, path) as source:
                found = members(source, source.size())
                lines = _at(source, *found[INDEX]).split(b"\n")
                start, rows = found[ARCHIVE][0], [json.loads(line) for line in lines]
                for at in range(0, len(rows), 10_000):
                    part = rows[at : at + 10_000]
                    yield pa.RecordBatch.from_pydict({
                        "path": [path] * len(part),
                        "offset": [start + r["offset"] for r in part],
                        "length": [r["length"] for r in part],
                    })

    spread = manifest.repartition(max(1, manifest.count()))  # a package a task
    return map_rows(spread.select("path"), work, RECORDS)


def read_records(records: DataFrame, folder: str) -> DataFrame:
    """Parsed records of the byte ranges; ranges that touch are read in one go up to READ_BYTES."""

    def work(batch: pa.RecordBatch):
        rows = sorted(zip(*(c.to_pylist() for c in batch.columns)))
        at = 0
        while at < len(rows):
            with _open(folder, rows[at][0]) as source:
                path = rows[at][0]
                while at < len(rows) and rows[at][0] == path:
                    start, end, first = rows[at][1], sum(rows[at][1:]), at
                    at += 1
                    while at < len(rows) and rows[at][:2] == (path, end) and end + rows[at][2] - start <= READ_BYTES:
                        end += rows[at][2]
                        at += 1
                    data = _at(source, start, end - start)
                    parsed = [parse(gzip.decompress(data[o - start : o - start + n])) for _, o, n in rows[first:at]]
                    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), k) for c, k in zip(zip(*parsed), kinds)],
                        names=[c.split()[0] for c in PAGES.split(", ")],
                    )

    return map_rows(records, work, PAGES)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes ``pages`` as packages in the shared folder and reads every record back."""
    folder = scratch(pages.sparkSession, "warc")
    manifest = write_packages(with_references(pages, min_bytes), folder)
    return read_records(locate(manifest, folder), folder)
