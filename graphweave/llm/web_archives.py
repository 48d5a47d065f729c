"""Web archives packed as ZIP files: writing them, and reading records by byte ranges.

An archive is a ZIP file with stored members: ``archive/data.warc.gz`` (WARC records, each
its own gzip member), ``indexes/index.cdxj`` (one line per record with its offset and length in
that member) and ``datapackage.json``.

Reading never extracts an archive. From the end of the file the end record is located, with
its ZIP64 form where one stands, then the central directory is read and with it the place
of each stored member. The index gives the records; neighbouring records are read as one
range, in parallel over ranges. An archive without index is scanned in ranges.

Defined results: a null payload is empty; repeated rows each get a record; among records of
equal payload the smallest page id is the response and the others refer to it; if equal
rows share the smallest id, all of them are responses; null ids are never the response while
an id exists, and are all responses otherwise. A member that is compressed, a damaged
directory or record raises with the archive's name. No archives give no records.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphweave.session import scratch_dir

from .rangeio import RangeReader, new_file, open_output
from .written import written

RANGE_BYTES = 4 << 20
ARCHIVE_BYTES = 256 << 20  # payload after which a writer starts the next archive
ID_PREFIX = "urn:x-page:"
WRITTEN_AT = "2024-01-01T00:00:00Z"  # one fixed time: archives of equal rows are equal

# Signatures and sizes of the ZIP format.
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
LOCAL_SIZE, CENTRAL_SIZE, END_SIZE, END64_SIZE, LOCATOR64_SIZE = 30, 46, 22, 56, 20


# ---------------------------------------------------------------- ZIP directories


def zip_members(reader, name: str = "") -> list[tuple[str, int, int]]:
    """``(member, data offset, size)`` of all stored members, from the directories alone."""
    tail_size = min(reader.size, END_SIZE + 0xFFFF + LOCATOR64_SIZE)
    base = reader.size - tail_size
    tail = reader.read(base, tail_size)
    at = tail.rfind(END)
    while at >= 0:  # the comment may hold the signature: its length decides
        if at + END_SIZE <= len(tail) and at + END_SIZE + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError(f"{name}: no end of central directory")
    n, size, offset = struct.unpack_from("<HII", tail, at + 10)
    loc = at - LOCATOR64_SIZE
    if loc >= 0 and tail[loc : loc + 4] == LOCATOR64:
        (end64,) = struct.unpack_from("<Q", tail, loc + 8)
        rec = reader.read(end64, END64_SIZE)
        if rec[:4] != END64:
            raise ValueError(f"{name}: ZIP64 end record not where its locator says")
        n, size, offset = struct.unpack_from("<QQQ", rec, 32)
    directory = reader.read(offset, size)
    out, p = [], 0
    for _ in range(n):
        if directory[p : p + 4] != CENTRAL:
            raise ValueError(f"{name}: damaged central directory")
        method, packed, plain = struct.unpack_from("<H", directory, p + 10)[0], *struct.unpack_from("<II", directory, p + 20)
        n_name, n_extra, n_comment = struct.unpack_from("<HHH", directory, p + 28)
        (local,) = struct.unpack_from("<I", directory, p + 42)
        member = directory[p + CENTRAL_SIZE : p + CENTRAL_SIZE + n_name].decode("utf-8")
        extra = directory[p + CENTRAL_SIZE + n_name : p + CENTRAL_SIZE + n_name + n_extra]
        plain, packed, local = _wide(extra, plain, packed, local)
        p += CENTRAL_SIZE + n_name + n_extra + n_comment
        if method != 0 or plain != packed:
            raise ValueError(f"{name}: member {member} is not stored")
        head = reader.read(local, LOCAL_SIZE)
        if head[:4] != LOCAL:
            raise ValueError(f"{name}: no local header for {member}")
        l_name, l_extra = struct.unpack_from("<HH", head, 26)
        out.append((member, local + LOCAL_SIZE + l_name + l_extra, plain))
    return out


def _wide(extra: bytes, plain: int, packed: int, local: int) -> tuple[int, int, int]:
    """Sizes and offset from the ZIP64 extra field, for those that are all ones."""
    p = 0
    while p + 4 <= len(extra):
        tag, n = struct.unpack_from("<HH", extra, p)
        if tag == 1:
            q, vals = p + 4, []
            for v in (plain, packed, local):
                if v == 0xFFFFFFFF:
                    (v,) = struct.unpack_from("<Q", extra, q)
                    q += 8
                vals.append(v)
            return tuple(vals)
        p += 4 + n
    return plain, packed, local


# ---------------------------------------------------------------- WARC records


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One record; a revisit has the HTTP header only and names the record it repeats."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in (url or "")).strip()
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{ID_PREFIX}{'' if page_id is None else page_id}>", f"WARC-Date: {WRITTEN_AT}",
        f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <{ID_PREFIX}{refers_to}>",
        ]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and HTTP payload of one uncompressed record."""
    cut = raw.index(b"\r\n\r\n")
    lines = raw[:cut].decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = raw[cut + 4 : cut + 4 + int(head["content-length"])]
    if len(block) != int(head["content-length"]) or raw[cut + 4 + len(block) :] != b"\r\n\r\n":
        raise ValueError("record is cut short")
    return head, block[block.index(b"\r\n\r\n") + 4 :] if b"\r\n\r\n" in block else block


def _gunzip_members(raw: bytes) -> Iterator[tuple[int, bytes]]:
    """``(packed length, content)`` of the gzip members that stand end to end in ``raw``."""
    view, at, step = memoryview(raw), 0, 1 << 14
    while at < len(raw):
        z, parts, end = zlib.decompressobj(31), [], at
        while not z.eof and end < len(raw):  # small bites: what a bite holds beyond the member is copied
            parts.append(z.decompress(view[end : end + step]))
            end = min(end + step, len(raw))
        if not z.eof:
            return
        size = end - at - len(z.unused_data)
        yield size, b"".join(parts)
        at += size


# ---------------------------------------------------------------- writing


class _Archive:
    """One archive being written: records go out as they come, the index at the end."""

    def __init__(self, folder: str):
        self.name = new_file(folder, ".wacz")
        self.sink = open_output(self.name)
        self.buffer = io.BufferedWriter(_Raw(self.sink), 1 << 18)
        self.zip = zipfile.ZipFile(self.buffer, "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(zipfile.ZipInfo("archive/data.warc.gz"), "w", force_zip64=True)
        self.at, self.lines = 0, []

    def add(self, page_id, url, payload, digest, refers_to) -> None:
        z = zlib.compressobj(1, zlib.DEFLATED, 31)
        raw = z.compress(_record(page_id, url, payload, digest, refers_to)) + z.flush()
        self.data.write(raw)
        self.lines.append(json.dumps({"offset": self.at, "length": len(raw), "filename": "data.warc.gz", "url": url, "digest": f"sha1:{digest}"}))
        self.at += len(raw)

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        n = len(self.lines)
        index = "".join(f"{k:012d} {WRITTEN_AT} {x}\n" for k, x in enumerate(self.lines))
        self.zip.writestr(zipfile.ZipInfo("indexes/index.cdxj"), index.encode())
        package = {"profile": "data-package", "resources": [{"name": "data.warc.gz", "path": "archive/data.warc.gz", "records": n}]}
        self.zip.writestr(zipfile.ZipInfo("datapackage.json"), json.dumps(package))
        self.zip.close()
        self.buffer.close()  # closes the sink; frees the buffer now, not when cycles are collected
        name, size = self.name, self.at
        self.__dict__.clear()
        return name, n, size


class _Raw(io.RawIOBase):
    """A store's output stream as a plain, unseekable writer for ``zipfile``."""

    def __init__(self, sink):
        self.sink, self.n = sink, 0

    def writable(self):
        return True

    def write(self, b):
        self.sink.write(bytes(b))
        self.n += len(b)
        return len(b)

    def tell(self):
        return self.n

    def close(self):
        if not self.closed:
            super().close()
            self.sink.close()


def _rows(batch: pa.RecordBatch, step: int = 64):
    """Rows of a batch as Python values, a few at a time."""
    for k in range(0, batch.num_rows, step):
        yield from zip(*(c.to_pylist() for c in batch.slice(k, step).columns))


def write_archives(
    pages: DataFrame, folder: str, min_revisit_bytes: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Write a record per row of ``pages`` into archives below ``folder``. Lazy: one row per
    archive, ``archive, n_records, n_bytes``; write that table before use.

    Equal payloads are found by one aggregate over digests; the pages then meet
    the smallest id of their payload in a join that Spark splits where a payload is hot,
    and are written where they meet, so the payloads cross the network once."""
    p = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        F.encode(F.coalesce(F.col(html).cast("string"), F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    size = F.length("payload")
    firsts = p.filter(size >= min_revisit_bytes).groupBy("digest").agg(
        F.min("page_id").alias("first_id")
    )
    # hashed on the small side: the payloads are streamed, not sorted
    p = p.join(firsts.hint("shuffle_hash"), "digest", "left").select("page_id", "url", "payload", "first_id")

    def run(batches):
        archive, size = None, 0

        def row():
            name, n, size = archive.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([n], pa.int64()), pa.array([size], pa.int64())], names=["archive", "n_records", "n_bytes"]
            )

        for i, u, payload, first in (r for batch in batches for r in _rows(batch)):
            archive = archive or _Archive(folder)
            archive.add(i, u, payload, payload_digest(payload), first if first is not None and first != i else None)
            size += len(payload)
            if size >= ARCHIVE_BYTES:
                yield row()
                archive, size = None, 0
        if archive is not None:
            yield row()

    return p.mapInArrow(run, "archive string, n_records long, n_bytes long")


# ---------------------------------------------------------------- reading

_RECORD = pa.schema([
    ("archive", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()),
    ("target_uri", pa.string()), ("payload_digest", pa.string()), ("refers_to", pa.string()),
    ("payload_bytes", pa.int64()), ("payload", pa.binary()),
])


def record_ranges(archives: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``archives(archive)`` to ``archive, offset, length``: ranges of whole neighbouring
    records, from the directories and indexes alone."""

    def run(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with RangeReader(name) as r:
                    found = _locate(r, name, range_bytes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(found), pa.string()), pa.array([x for x, _ in found], pa.int64()),
                     pa.array([y for _, y in found], pa.int64())], names=["archive", "offset", "length"],
                )

    return archives.select("archive").mapInArrow(run, "archive string, offset long, length long")


def _locate(reader, name: str, range_bytes: int) -> list[tuple[int, int]]:
    members = zip_members(reader, name)
    warcs = {m.removeprefix("archive/"): (o, n) for m, o, n in members if m.startswith("archive/") and n}
    spots: list[tuple[int, int]] = []
    indexed = set()
    for m, o, n in members:
        if m.startswith("indexes/"):
            for line in reader.read(o, n).decode("utf-8").splitlines():
                entry = json.loads(line[line.index("{") :])
                base, size = warcs[entry["filename"]]
                if entry["offset"] + entry["length"] > size:
                    raise ValueError(f"{name}: index entry beyond {entry['filename']}")
                spots.append((base + int(entry["offset"]), int(entry["length"])))
                indexed.add(entry["filename"])
    for file, (base, size) in warcs.items():
        if file not in indexed:
            spots += _scan(reader, base, size, range_bytes)
    return _join(sorted(spots), range_bytes)


def _scan(reader, base: int, size: int, step: int) -> list[tuple[int, int]]:
    """Record places of a member without index: its gzip members, found range by range."""
    spots, at, window = [], 0, step
    while at < size:
        got = list(_gunzip_members(reader.read(base + at, min(window, size - at))))
        if not got:
            if at + window >= size:
                raise ValueError("record is cut short")
            window *= 2  # a record larger than the range
            continue
        for n, _ in got:
            spots.append((base + at, n))
            at += n
        window = step
    return spots


def _join(spots: list[tuple[int, int]], range_bytes: int) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for o, n in spots:
        if out and out[-1][0] + out[-1][1] == o and out[-1][1] + n <= range_bytes:
            out[-1][1] += n
        else:
            out.append([o, n])
    return [(o, n) for o, n in out]


def read_records(archives: DataFrame, range_bytes: int = RANGE_BYTES, payloads: bool = True) -> DataFrame:
    """All records of ``archives(archive, n_bytes)``. Payload digests are computed anew and
    compared with the records' own; a revisit has no payload, and with ``payloads=False`` no
    record has, only its ``payload_bytes``.

    Ranges are dealt over a number of tasks that follows the archives' bytes: their rows
    are few and small, so that nothing else would tell Spark how much there is to read."""
    total = archives.agg(F.sum("n_bytes")).first()[0] or 0
    n_tasks = max(1, -(-int(total) // (2 * max(range_bytes, 1 << 16))), min(archives.sparkSession.sparkContext.defaultParallelism, int(total) // 65536))
    ranges = record_ranges(archives, range_bytes).repartition(n_tasks, "archive", "offset")

    def run(batches):
        for batch in batches:
            for name, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                out = []
                with RangeReader(name) as r:
                    raw = r.read(offset, length)
                at = offset
                for n, content in _gunzip_members(raw):
                    head, payload = parse_record(content)
                    kind = head["warc-type"]
                    digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
                    if kind == "response" and payload_digest(payload) != digest:
                        raise ValueError(f"{name}: payload at {at} does not match its digest")
                    bare = lambda key: head.get(key, "").strip("<>") or None
                    out.append((name, at, kind, bare("warc-record-id"), head.get("warc-target-uri") or None, digest,
                                bare("warc-refers-to"), len(payload) if kind == "response" else None,
                                payload if payloads and kind == "response" else None))
                    at += n
                if at != offset + length:
                    raise ValueError(f"{name}: damaged record at {at}")
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _RECORD)], schema=_RECORD)

    return ranges.mapInArrow(
        run, "archive string, offset long, record_type string, record_id string, target_uri string, "
        "payload_digest string, refers_to string, payload_bytes long, payload binary",
    )


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to``: a revisit has the
    length of the response it refers to."""
    number = lambda c: F.nullif(F.substring_index(c, ":", -1), F.lit("")).cast("long")
    r = records.select(
        number(F.col("record_id")).alias("page_id"), F.col("payload_bytes").alias("own"), "payload_digest",
        "record_type", number(F.col("refers_to")).alias("refers_to"),
    )
    responses = r.filter("record_type = 'response' and page_id is not null").groupBy("page_id", "payload_digest").agg(
        F.max("own").alias("theirs")
    )
    responses = responses.select(F.col("page_id").alias("refers_to"), F.col("payload_digest"), "theirs")
    # the archives' names are a small table, which says nothing of their records: no broadcast
    j = r.join(responses.hint("shuffle_hash"), ["refers_to", "payload_digest"], "left")
    return j.select("page_id", F.coalesce("own", "theirs").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


def archive_round_trip(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives in the shared scratch folder and read them back."""
    folder = scratch_dir(pages.sparkSession, "archives")
    archives = written(write_archives(pages, folder, min_revisit_bytes), "archive-names")
    return resolve_revisits(read_records(archives, payloads=False))
