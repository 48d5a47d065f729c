"""Files (S1/S3-S6), increments (S2/J1/I2), store (K1/S7/J2/I4), streaming."""

import io
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from graphweave.sources import files, manifest, store


def _write(root, rel, data: bytes):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "wb") as f:
        f.write(data)


def _docx(paragraphs):
    ns = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    body = "".join(f"<w:p><w:r><w:t>{p}</w:t></w:r></w:p>" for p in paragraphs)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("word/document.xml", f"<w:document {ns}><w:body>{body}</w:body></w:document>")
    return buf.getvalue()


def test_discover_and_read(spark, tmpdir_path):
    r = tmpdir_path
    _write(r, "a.TXT", b"Alpha text")
    _write(r, "b.md", b"# Beta\r\nline\rend")
    _write(r, "c.html", b"<p>x</p>")
    _write(r, "sub/d.txt", b"Delta")
    _write(r, "bad.txt", b"ok\xff")
    _write(r, "empty.txt", b"")
    _write(r, "x y%20.txt", b"spaces")
    _write(r, "e.docx", _docx(["One", "Two"]))
    found = files.discover(spark, r)
    names = sorted(x.document_name for x in found.collect())
    # an empty file is listed, read and recorded; it has no chunk
    assert names == ["a", "b", "bad", "d", "e", "empty", "x y%20"]
    assert "content" not in found.columns
    docs = {x.document_name: (x.text, x.error) for x in files.read_text(files.load_content(spark, found, r)).collect()}
    assert docs["b"] == ("# Beta\nline\nend", None)
    assert docs["bad"][0] is None and docs["bad"][1] == "invalid UTF-8"
    assert docs["e"] == ("One\nTwo\n", None) and docs["empty"] == ("", None)
    from graphweave.operators import chunking

    ch = chunking.chunk(files.read_text(files.load_content(spark, found, r)).where("error is null"))
    assert ch.where(F.col("document_name") == "a").count() == 1
    assert ch.where(F.col("document_name") == "empty").count() == 0


def test_increments(spark):
    f1 = spark.createDataFrame([("p1", "h1"), ("p2", "h2")], "path string, content_md5 string")
    m = spark.createDataFrame(
        [("p1", "d", "h1", "r", "ok", None, 1, None), ("p2", "d", "old", "r", "ok", None, 1, None)], manifest.schemas.MANIFEST
    )
    f2 = f1.unionByName(spark.createDataFrame([("p3", "h3")], "path string, content_md5 string"))
    assert sorted(r.path for r in manifest.pending(f2, m, "path").collect()) == ["p3"]
    assert sorted(r.path for r in manifest.pending(f2, m, "content").collect()) == ["p2", "p3"]


def test_corrupt_record_quarantined(spark, tmpdir_path):
    rec = {"document_name": "d", "extraction_time": "2024-01-01T00:00:00", "total_chunks": 1,
           "entities": [{"type": "Person", "properties": {"name": "Ann", "age": 3}}],
           "relationships": [{"source": "Ann", "target": "d", "type": "KNOWS", "properties": {}}]}
    _write(tmpdir_path, "good.json", json.dumps(rec, indent=2).encode())
    _write(tmpdir_path, "bad.json", b"{bad")
    good, bad = store.read_records(spark, tmpdir_path)
    assert good.count() == 1 and bad.count() == 1
    e, r = store.record_rows(good)
    assert e.first().name == "Ann" and r.count() == 1


def test_cache_split_and_latest(spark):
    docs = spark.createDataFrame([("a", "1"), ("b", "2")], "document_name string, content_md5 string")
    st = spark.createDataFrame(
        [("a", "1", "2024-01-01"), ("b", "0", "2024-01-01"), ("b", "2", "2024-02-01")],
        "document_name string, content_md5 string, t string",
    ).withColumn("extraction_time", F.col("t").cast("timestamp"))
    hits, misses = store.split_cached(docs, st.where(F.col("content_md5") != "2"))
    assert [r.document_name for r in hits.collect()] == ["a"] and [r.document_name for r in misses.collect()] == ["b"]
    latest = sorted((r.document_name, r.content_md5) for r in store.latest_only(st).collect())
    assert latest == [("a", "1"), ("b", "2")]


def test_stream_ingest_resumes(spark, tmpdir_path):
    from graphweave.streaming.ingest import merged_graph, read_output, stream_ingest

    src = os.path.join(tmpdir_path, "in")
    _write(src, "one.txt", b"Alpha Beta Gamma")
    out, ck = os.path.join(tmpdir_path, "out"), os.path.join(tmpdir_path, "ck")
    stream_ingest(spark, src, out, ck)
    assert read_output(spark, out, "files").count() == 1
    _write(src, "two.txt", b"Delta Epsilon")
    stream_ingest(spark, src, out, ck)
    assert sorted(r.document_name for r in read_output(spark, out, "files").collect()) == ["one", "two"]
    rows = sorted((r.document_name, r.run_id, r.status, r.n_chunks) for r in read_output(spark, out, "manifest").collect())
    assert rows == [("one", "batch-0", "ok", 1), ("two", "batch-1", "ok", 1)]
    nodes, _ = merged_graph(spark, out)
    assert {"Alpha", "Delta", "one", "two"} <= {r.name for r in nodes.collect()}


def test_run_batch_increments(spark, tmpdir_path):
    from graphweave.plans.build import run_batch
    from graphweave.sources import manifest as msrc

    src = os.path.join(tmpdir_path, "in")
    _write(src, "a.txt", b"Alpha Beta Gamma")
    _write(src, "b.md", b"Delta Epsilon")
    for mode in ("path", "content"):
        work = os.path.join(tmpdir_path, "work-" + mode)
        r1 = run_batch(spark, src, work, "r1", incremental=mode)
        assert r1["nodes"].where(F.col("type") == "Concept").count() == 5
        _write(src, "c.txt", b"Zeta")
        _write(src, "a.txt", b"Alpha Beta Gamma Theta")
        r2 = run_batch(spark, src, work, "r2", incremental=mode)
        got = sorted(os.path.basename(r.path) for r in r2["documents"].collect())
        assert got == (["c.txt"] if mode == "path" else ["a.txt", "c.txt"])
        m = msrc.read(spark, os.path.join(work, "manifest"))
        assert m.where(F.col("run_id") == "r1").count() == 2
        # restore the inputs for the next mode
        os.remove(os.path.join(src, "c.txt"))
        _write(src, "a.txt", b"Alpha Beta Gamma")


def test_run_batch_reuses_cached_extraction(spark, tmpdir_path):
    from graphweave.plans.build import run_batch

    src = os.path.join(tmpdir_path, "in")
    _write(src, "a/doc.txt", b"Alpha Beta Gamma")
    work = os.path.join(tmpdir_path, "work")
    calls = []

    def extractor(batch):
        calls.append(len(batch))
        return [json.dumps({"entities": [{"type": "Concept", "name": "Alpha"}], "relationships": []})] * len(batch)

    run_batch(spark, src, work, "r1", extractor=extractor)
    # same stem and bytes under a new path: a cache hit, nothing is extracted
    _write(src, "b/doc.txt", b"Alpha Beta Gamma")
    r2 = run_batch(spark, src, work, "r2", extractor=extractor)
    nodes = r2["nodes"]
    assert nodes.where(F.col("type") == "Concept").count() == 1
    assert r2["store"].where(F.col("path").endswith("b/doc.txt")).count() == 1
    assert r2["store"].where(F.col("path").endswith("a/doc.txt")).count() == 0
    summary = r2["summary"].first()
    assert (summary.files, summary.cache_hits, summary.failed_files) == (1, 1, 0)


def test_a_run_id_used_again_keeps_what_it_stored(spark, tmpdir_path):
    from graphweave.plans.build import run_batch
    from graphweave.sources import manifest as msrc
    from graphweave.sources import store as ssrc

    src, work = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "work")
    _write(src, "a.txt", b"Alpha Beta")
    _write(src, "b.txt", b"Gamma")
    run_batch(spark, src, work, "r1")
    _write(src, "c.txt", b"Delta")
    out = run_batch(spark, src, work, "r1")
    names = lambda df: sorted(r.document_name for r in df.select("document_name").collect())
    assert names(ssrc.read_store(spark, f"{work}/store")) == ["a", "b", "c"]
    assert names(msrc.read(spark, f"{work}/manifest").where("status = 'ok'")) == ["a", "b", "c"]
    assert {"Alpha", "Gamma", "Delta"} <= {r.name for r in out["nodes"].collect()}


def test_a_retried_write_replaces_its_files_alone(spark, tmpdir_path):
    from graphweave.sources import store as ssrc

    path = os.path.join(tmpdir_path, "store")
    row = "path string, document_name string, content_md5 string, chunk_number int, error string"
    ssrc.write_store(spark.createDataFrame([("a", "a", "1", 0, "x"), ("a", "a", "1", 1, "x"), ("b", "b", "1", 0, None)], row), path, "r")
    ssrc.write_store(spark.createDataFrame([("z", "z", "1", 0, None)], row), path, "other")
    ssrc.write_store(spark.createDataFrame([("a", "a", "2", 0, None)], row), path, "r")
    got = sorted((r.run_id, r.path, r.content_md5, r.chunk_number, r.error) for r in ssrc.read_store(spark, path).collect())
    assert got == [("other", "z", "1", 0, None), ("r", "a", "2", 0, None), ("r", "b", "1", 0, None)]


def test_exactly_the_pending_files_are_opened(spark, tmpdir_path, monkeypatch):
    from graphweave.sources import files as fsrc

    src = os.path.join(tmpdir_path, "in")
    names = ["old.txt", "new.txt", "a b.txt", "x[1].txt", "q{u,v}.md", "100%25.txt", "sub/deep.md", "ü.txt"]
    for n in names:
        _write(src, n, n.encode())
    _write(src, "empty.txt", b"")
    found = fsrc.discover(spark, src)
    assert sorted(os.path.basename(r.path) for r in found.where("length = 0").collect()) == ["empty.txt"]
    assert found.count() == len(names) + 1
    for limit in (10_000, 0):  # named to the reader, and by a scan of the folder
        monkeypatch.setattr(fsrc, "NAMED_FILES", limit)
        got = {os.path.basename(r.path): bytes(r.content) for r in fsrc.load_content(spark, found, src).collect()}
        assert got == {"empty.txt": b""} | {os.path.basename(n): n.encode() for n in names}
    monkeypatch.setattr(fsrc, "NAMED_FILES", 10_000)
    picked = found.where(F.col("path").endswith("old.txt") | F.col("path").endswith("].txt"))
    opened = fsrc.load_content(spark, picked, src).inputFiles()
    assert len(opened) >= 2 and {os.path.basename(fsrc._plain(p)) for p in opened} >= {"old.txt", "x[1].txt"}
    scan = spark.read.format("binaryFile").load([fsrc._literal(r.path) for r in picked.collect()])
    assert len(scan.inputFiles()) == 2


def test_empty_files_get_a_manifest_row(spark, tmpdir_path):
    from graphweave.plans.build import run_batch
    from graphweave.sources import manifest as msrc

    src, work = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "work")
    _write(src, "a.txt", b"Alpha Beta")
    _write(src, "none.txt", b"")
    for run in ("r1", "r2"):
        run_batch(spark, src, work, run)
    rows = sorted((r.document_name, r.run_id, r.status) for r in msrc.read(spark, f"{work}/manifest").collect())
    assert rows == [("a", "r1", "ok"), ("none", "r1", "ok")]


def test_jobs_of_a_micro_batch_run_side_by_side(spark):
    import threading

    from graphweave.streaming.ingest import together

    both = threading.Barrier(2, timeout=20)  # one after the other, neither would pass
    spark.sparkContext.setLocalProperty("graphweave.test", "kept")
    seen = []

    def job():
        both.wait()
        seen.append((spark.sparkContext.getLocalProperty("graphweave.test"), spark.range(3).count()))

    together(spark, job, job)
    assert seen == [("kept", 3)] * 2

    def fails():
        raise ValueError("no")

    with pytest.raises(ValueError):
        together(spark, fails, lambda: None)
