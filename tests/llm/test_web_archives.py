import base64
import hashlib
import io
import random
import struct
import zipfile

import pytest

from graphweave.llm import web_archives as A
from graphweave.llm.rangeio import RangeReader

SCHEMA = "page_id long, url string, html string, payload string"


def digest(t):
    return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


def brute(rows, least=0):
    out = []
    for i, _, t, _ in rows:
        ids = [j for j, _, u, _ in rows if (u or "") == (t or "") and j is not None]
        again = len((t or "").encode()) >= least and ids and min(ids) != i
        out.append((i, len((t or "").encode()), digest(t), "revisit" if again else "response", min(ids) if again else None))
    return sorted(out, key=repr)


def pages(seed):
    rnd = random.Random(seed)
    body = ["", None, "a\r\n\r\nb", "é" * 50, "x" * 100_000, "<html>\n</html>"]
    rows = [(1000 - i, rnd.choice(["http://a/\r\nX: y", "", None, "http://b/é"]), rnd.choice(body + [f"p{rnd.randrange(30)}"]), "q")
            for i in range(80)]
    return rows + [rows[0], (None, "u", "alone"[:5], "q"), (None, "u", "p1", "q")]


def test_round_trip(spark):
    for least in (0, 5):
        rows = pages(least)
        got = A.archive_round_trip(spark.createDataFrame(rows, SCHEMA), least).collect()
        assert sorted((tuple(r) for r in got), key=repr) == brute(rows, least)
    assert A.archive_round_trip(spark.createDataFrame([], SCHEMA)).collect() == []


def test_payloads_come_back_by_small_ranges(spark, tmp_path):
    rows = pages(3)
    archives = A.write_archives(spark.createDataFrame(rows, SCHEMA), str(tmp_path)).collect()
    table = spark.createDataFrame(archives, "archive string, n_records long, n_bytes long")
    for size in (1, 700, 1 << 22):
        got = A.read_records(table, range_bytes=size).collect()
        assert len(got) == len(rows)
        want = {str(i): (t or "").encode() for i, _, t, _ in rows if i is not None}
        for r in got:
            key = r.record_id.split(":")[-1]
            if r.record_type == "response" and key:
                assert bytes(r.payload) == want[key]


def test_archive_without_index_is_scanned(spark, tmp_path):
    table = A.write_archives(spark.createDataFrame(pages(4), SCHEMA).coalesce(1), str(tmp_path)).collect()
    name = max(table, key=lambda r: r.n_records).archive
    bare = str(tmp_path / "bare.wacz")
    with zipfile.ZipFile(name) as z, zipfile.ZipFile(bare, "w") as out:
        out.writestr("archive/data.warc.gz", z.read("archive/data.warc.gz"))
    for size in (50, 1 << 20):
        with RangeReader(name) as a, RangeReader(bare) as b:
            assert sum(n for _, n in A._locate(a, name, size)) == sum(n for _, n in A._locate(b, bare, size))


class Memory(io.BytesIO):
    @property
    def size(self):
        return len(self.getvalue())

    def read(self, offset, length):  # noqa: A003
        return self.getvalue()[offset : offset + length]


def test_directories_plain_zip64_and_comment(monkeypatch):
    for limit, comment in [(None, b""), (10, b"a comment with PK\x05\x06 inside" + b"x" * 40)]:
        raw = io.BytesIO()
        if limit:
            monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
            monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
        with zipfile.ZipFile(raw, "w") as z:
            z.comment = comment
            for k in range(3):
                with z.open(f"archive/é{k}.bin", "w", force_zip64=bool(limit)) as f:
                    f.write(b"%d" % k * (20 + k))
        monkeypatch.undo()
        m = Memory(raw.getvalue())
        got = {n: m.read(o, s) for n, o, s in A.zip_members(m)}
        assert got == {f"archive/é{k}.bin": b"%d" % k * (20 + k) for k in range(3)}
        assert (b"PK\x06\x06" in raw.getvalue()) == bool(limit)


def test_damage_is_reported(spark, tmp_path):
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/a", "aaaa" * 100)
    with pytest.raises(ValueError, match="not stored"):
        A.zip_members(Memory(raw.getvalue()), "n")
    with pytest.raises(ValueError, match="no end of central"):
        A.zip_members(Memory(b"PK" * 50), "n")
    name = A.write_archives(spark.createDataFrame(pages(5)[:20], SCHEMA).coalesce(1), str(tmp_path)).collect()[0].archive
    with RangeReader(name) as r:
        data = bytearray(r.read(0, r.size))
        (_, offset, size), = [m for m in A.zip_members(r) if m[0].startswith("archive/")]
    data[offset + size // 2] ^= 0xFF
    (tmp_path / "bad.wacz").write_bytes(bytes(data))
    with pytest.raises(Exception):
        A.read_records(spark.createDataFrame([(str(tmp_path / "bad.wacz"), 9)], "archive string, n_bytes long")).collect()


def test_record_parser():
    raw = A._record(5, "u", "pä".encode(), "D", None)
    head, payload = A.parse_record(raw)
    assert payload == "pä".encode() and head["warc-record-id"] == "<urn:x-page:5>"
    with pytest.raises(ValueError):
        A.parse_record(raw[:-3])
    with pytest.raises(ValueError):
        A.parse_record(b"HTTP/1.1\r\n\r\n")
    assert struct.calcsize("<QQQ") == 24
