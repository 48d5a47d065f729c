"""Edges (J5/J6/A4/A5/A6), literals and statements (P16-P24), script files."""

import json

from pyspark.sql import functions as F

from rows import entity_rows, rel_rows
from graphweave.functions.literals import literal, string_literal
from graphweave.operators import edges, export, graph, merge


def _nodes(spark):
    return merge.merge_entities(entity_rows(spark, [
        ("f", "d", 0, 0, "Person", json.dumps({"name": "Apple"})),
        ("f", "d", 0, 1, "Organization", json.dumps({"name": "Apple"})),
        ("f", "d", 0, 2, "Person", json.dumps({"name": "A"})),
        ("f", "d", 0, 3, "Person", json.dumps({"name": "B"})),
    ]))


def test_fanout_self_loop_and_direction(spark):
    nodes = _nodes(spark)
    rels = rel_rows(spark, [
        ("f", "d", 0, 0, "Apple", "Apple", "KNOWS"),
        ("f", "d", 0, 1, "A", "B", "KNOWS"),
        ("f", "d", 0, 2, "B", "A", "LEADS"),
        ("f", "d", 0, 3, "A", "b", "KNOWS"),
        ("f", "d", 0, 4, "A", "", "KNOWS"),
    ])
    assert edges.resolve(nodes, rels).where(F.col("source") == "Apple").count() == 4
    assert graph.name_nodes(nodes).count() == 3
    und = {(r.u, r.v): r.type for r in graph.undirected_edges(nodes, rels).collect()}
    assert und == {("Apple", "Apple"): "KNOWS", ("A", "B"): "LEADS"}
    assert edges.strict(nodes, rels).where(F.col("target") == "b").count() == 0
    assert edges.resolve(nodes, rels, endpoint_mode="normalized").where(F.col("target") == "b").count() == 1
    assert edges.resolve(nodes, rels).where(F.col("target") == "").count() == 0


def test_dedupe_repeated_mentions(spark):
    nodes = _nodes(spark)
    rels = rel_rows(spark, [("f", "d", 0, 0, "A", "B", "KNOWS"), ("f", "d", 0, 1, "A", "B", "KNOWS")])
    assert edges.dedupe(edges.resolve(nodes, rels)).count() == 1


def test_literals(spark):
    vals = ["null", "true", "3", "2.5", "[1,2]", "[true]", '["a",null]', '"it\'s"', '"a\\\\b"', '"\\"q\\""', "[[1,\"x\"],2]"]
    df = spark.createDataFrame([(v,) for v in vals], "j string").select("j", literal(F.parse_json("j")).alias("l"))
    got = dict(df.collect())
    assert got["null"] == "null" and got["true"] == "true" and got["3"] == "3" and got["2.5"] == "2.5"
    assert got["[1,2]"] == "[1, 2]" and got["[true]"] == "[true]"
    assert got['["a",null]'] == "['a', null]"
    assert got['"it\'s"'] == "'it\\'s'"
    assert got['"a\\\\b"'] == "'a\\\\b'"
    assert got['"\\"q\\""'] == "'\\\"q\\\"'"
    assert got["[[1,\"x\"],2]"] == "[[1, 'x'], 2]"


def test_long_text_cut_after_escaping(spark):
    df = spark.createDataFrame([("a" * 32001,), ("'" * 20000,)], "t string").select(string_literal("t", 32000).alias("l"))
    a, b = [r.l for r in df.collect()]
    assert a == "'" + "a" * 32000 + "...'"
    assert b == "'" + "\\'" * 16000 + "...'"


def test_statements_and_script_roundtrip(spark, tmpdir_path):
    nodes = merge.merge_entities(entity_rows(spark, [
        ("f", "d", 0, 0, "Person", json.dumps({"name": "x;y", "blank": "  ", "none": None, "n": 3})),
        ("f", "d", 0, 1, "Person", json.dumps({"name": "Bob"})),
    ]))
    ns = export.node_statements(nodes)
    st = sorted(r.statement for r in ns.collect())
    assert st == ["MERGE (n:Person {name: 'Bob'})", "MERGE (n:Person {name: 'x;y', n: 3})"]
    rels = rel_rows(spark, [("f", "d", 0, 0, "Bob", "x;y", "KNOWS")])
    es = [r.statement for r in export.edge_statements(rels).collect()]
    assert es == ["MATCH (a {name: 'Bob'})\n            MATCH (b {name: 'x;y'})\n            MERGE (a)-[r:KNOWS]->(b)"]
    root = export.write_script(ns, export.edge_statements(rels), export.index_statements(nodes), tmpdir_path)
    naive = [r.statement for r in export.load_statements(spark, root, "naive").collect()]
    whole = [r.statement for r in export.load_statements(spark, root, "rows").collect()]
    assert len(whole) == 3 and len(naive) == 3  # 'x;y' is cut: one broken piece replaces two
    assert any(s.startswith("MERGE (n:Person {name: 'x") and s.endswith("'x") for s in naive)
    res = export.apply_statements(export.load_statements(spark, root, "rows"))
    assert res.where("ok").count() == 3
    assert export.latest_script(spark, tmpdir_path).first().script.endswith(root.split("/")[-1])


def test_statement_filter(spark, tmpdir_path):
    p = tmpdir_path + "/s.txt"
    with open(p, "w") as f:
        f.write("merge (a);\n// note;\nWITHIN x;\n  ")
    got = [r.statement for r in export.load_statements(spark, p, "naive").collect()]
    assert got == ["merge (a)", "WITHIN x"]


def test_index_statements(spark):
    nodes = merge.merge_entities(entity_rows(spark, [
        ("f", "d", 0, 0, "Chunk", json.dumps({"name": "c", "embedding": [0.1, 0.2]})),
        ("f", "d", 0, 1, "Person", json.dumps({"name": "p", "embedding": []})),
    ]))
    st = [r.statement for r in export.index_statements(nodes, dims=2).collect()]
    assert len(st) == 1 and st[0].startswith("CREATE VECTOR INDEX chunk_embeddings IF NOT EXISTS\n")
    assert "`vector.dimensions`: 2," in st[0]
    assert export.index_statements(nodes, enabled=False).count() == 0
