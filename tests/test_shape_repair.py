"""Completion (P6-P12), repairs (J3/J4/P19/P20) on hand-written rows."""

import json

from pyspark.sql import functions as F

from rows import entity_rows
from graphweave.operators import extract, merge, repair, shape


def _results(spark, responses):
    """responses: list of (document_name, chunk_number, text, response_json or None)."""
    df = spark.createDataFrame(
        [("p/" + d + ".txt", d, n, t, r) for d, n, t, r in responses],
        "path string, document_name string, chunk_number int, text string, response string",
    )
    df = df.withColumn("error", F.when(F.col("response").isNull(), F.lit("call failed")))
    return extract.parse_results(df, "response")


def _resp(entities=(), relationships=()):
    return json.dumps({"entities": list(entities), "relationships": list(relationships)})


def test_completion_rules(spark):
    res = _results(spark, [
        ("d", 0, "t0", _resp([{"type": "Person", "name": "x", "properties": {"name": "y"}},
                              {"type": "Person", "name": "Ann"}, {"type": "Person", "name": "Ann"}])),
        ("d", 1, "t1", _resp([{"type": "Document", "name": "unknown"}])),
        ("d", 2, "t2", _resp([{"type": "Document", "name": "Other"}, {"type": "Chunk", "name": "d_chunk_2"}],
                             [{"source": "d", "target": "d_chunk_2", "type": "CONTAINS"}])),
        ("d", 3, "t3", None),
        ("d", 4, "t4", '{"entities": [{"type": "X"}], "relationships": []}'),
    ])
    e, r = shape.complete(res)
    ents = {(x.chunk_number, x.pos): (x.type, x.name) for x in e.collect()}
    rels = sorted((x.chunk_number, x.pos, x.source, x.target, x.type) for x in r.collect())
    # name property overrides the field; Document + Chunk appended
    assert ents[(0, 0)] == ("Person", "y")
    assert ents[(0, 3)] == ("Document", "d") and ents[(0, 4)] == ("Chunk", "d_chunk_0")
    # repeated entity: two MENTIONS rows
    assert [x for x in rels if x[0] == 0 and x[4] == "MENTIONS"] == [
        (0, 1, "d_chunk_0", "y", "MENTIONS"), (0, 2, "d_chunk_0", "Ann", "MENTIONS"), (0, 3, "d_chunk_0", "Ann", "MENTIONS")]
    # Document named unknown is renamed; no second Document added
    assert ents[(1, 0)] == ("Document", "d") and (1, 2) not in ents
    # foreign Document returned: no node for the real one; returned Chunk kept, no second
    assert ents[(2, 0)] == ("Document", "Other") and ents[(2, 1)] == ("Chunk", "d_chunk_2") and (2, 2) not in ents
    # CONTAINS link present: no BELONGS_TO
    assert not [x for x in rels if x[0] == 2 and x[4] == "BELONGS_TO"]
    # failure fallback: Chunk, Document, BELONGS_TO only
    assert ents[(3, 0)] == ("Chunk", "d_chunk_3") and ents[(3, 1)] == ("Document", "d")
    assert [x for x in rels if x[0] == 3] == [(3, 0, "d_chunk_3", "d", "BELONGS_TO")]
    # invalid response (entity without name) is a failure too
    err = {x.chunk_number: x.extraction_error for x in e.collect()}
    assert err[4] == "invalid response" and err[3] == "call failed" and err[0] is None


def chunk_row(path, doc, num_json, text, name, i=0):
    p = {"name": name}
    if text is not None:
        p["text"] = text
    if num_json is not None:
        p["chunk_number"] = num_json
    return (path, doc, 0, i, "Chunk", json.dumps(p))


def test_pre_merge_repair(spark):
    rows = entity_rows(spark, [
        chunk_row("a", "d", 3, "", "d_chunk_3"),
        chunk_row("b", "d", 3, "full", "d_chunk_3"),
        chunk_row("c", "d", "3", "", "d_chunk_3s"),  # string number: different key
        chunk_row("e", "d", 7, "", "d_chunk_7"),
    ])
    out = {r.path: (r.repaired, r.t) for r in repair.pre_merge(rows).select(
        "path", "repaired", F.try_variant_get(F.col("props")["text"], "$", "string").alias("t")).collect()}
    assert out["a"] == (True, "full")
    assert out["c"] == (False, "")
    assert out["e"] == (False, "")


def test_post_merge_repair_and_placeholder(spark):
    rows = entity_rows(spark, [
        chunk_row("a", "d", 3, "", "d_chunk_3"),
        chunk_row("b", "d", 3, "later", "other_name"),
        chunk_row("c", "a_chunk_b", 3, "x", "a_chunk_b_chunk_3"),
        chunk_row("f", "q", None, None, "q_chunk_7"),
    ])
    good, _ = merge.prepare(rows)
    nodes = repair.post_merge(merge.merge_entities(good, prepared=True), good)
    got = {r.name: r.t for r in nodes.select("name", F.try_variant_get(F.col("props")["text"], "$", "string").alias("t")).collect()}
    assert got["d_chunk_3"] == "later"
    fixed = repair.placeholder(repair.chunk_number(nodes))
    p = {r.name: json.loads(r.p) for r in fixed.select("name", F.to_json("props").alias("p")).collect()}
    assert p["q_chunk_7"] == {"name": "q_chunk_7", "chunk_number": 7, "text": "Text for chunk 7 (needs repair)"}
