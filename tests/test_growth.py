"""Steps that decide how the time of a query grows: each is done once, and the results stay."""

import json
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from rows import entity_rows, rel_rows
from graphweave.operators import edges, extract, graph, merge, script_scan, vectors
from graphweave.functions import text
from graphweave.plans import catalog, views

TEXTS = ["Apache License of Ann at a@b.com1@c.com, 10.0.0.1", "x" * 3000, "Zoe wrote to x.y+z@a-b.co.uk", "", None]


@pytest.fixture
def sf(spark, tmpdir_path):
    docs = [(i, "src", "en", t) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(docs, "doc_id long, source string, lang string, text string").write.parquet(f"{tmpdir_path}/documents.parquet")
    events = [(i, i % 3, "click", json.dumps({"k": i % 2})) for i in range(12)]
    spark.createDataFrame(events, "event_id long, user_id long, event_type string, props string").write.parquet(f"{tmpdir_path}/events.parquet")
    return tmpdir_path


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_mail_addresses_are_found_in_one_pass(spark):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("ab.@@-_%1 é,") for _ in range(60)) for _ in range(400)]
    texts += ["a@b.com1@c.com", "a" * 150_000 + " License @ " + "b" * 150_000, "MIT License x@y.org", "none", None]
    hits = extract.rule_hits(F.col("text"))
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    begun = time.time()
    got = {r.i: (r.e, r.c) for r in df.select("i", hits["__emails"].alias("e"), hits["__licences"].alias("c")).collect()}
    assert time.time() - begun < 20
    for i, t in enumerate(texts):
        if t is None:
            assert got[i] == (None, None)
        elif len(t) < 1000:
            assert got[i][0] == list(dict.fromkeys(re.findall(extract.EMAIL_RE, t)))
            assert got[i][1] == list(dict.fromkeys(re.findall(extract.LICENSE_RE, t)))
        else:
            assert got[i] == ([], [])


def test_rows_without_large_properties_take_one_lane(spark):
    data = [("f", "d", 0, 0, "Chunk", '{"name": "a", "n": 0}'), ("f", "d", 0, 1, "Chunk", '{"name": "a", "text": "t", "n": 2}'),
            ("f", "d", 0, 2, "Person", '{"name": "p", "x": "false"}'), ("f", "d", 0, 3, "Person", '{"x": "", "name": "p"}')]
    rows = merge.prepare(entity_rows(spark, data))[0]
    assert [r.entity_key for r in merge._large(merge._keyed(rows, merge.DEFAULT_ORD)).collect()] == ["Chunk_a"]
    want = {"Chunk_a": ({"name": "a", "text": "t", "n": 2}, 0), "Person_p": ({"name": "p", "x": "false"}, 2)}
    for nodes in (merge.merge_entities(rows, prepared=True), merge.render(merge.fold(rows))):
        got = {r.entity_key: (json.loads(r.p), r.first_ord.pos) for r in nodes.withColumn("p", F.to_json("props")).collect()}
        assert got == want


@pytest.mark.parametrize("value", [
    "0", "0.0", "-0.0", "1", "0.5", "-3", "1e-300", '""', '"0"', '"f"', '"false"', '"[]"', '"{}"', '" "', '"é"', '"x"',
    "true", "false", "null", "[]", "[0]", "{}", '{"a": 0}',
])
def test_truth_of_a_value(spark, value):
    df = spark.sql("select 1 as i").select(F.parse_json(F.lit(value)).alias("value"))
    assert merge._judged(df).select("good").first()[0] == bool(json.loads(value))


def test_concepts_are_extracted_once(spark, sf):
    """merge_entities: both lanes of the merge read the written rows."""
    nodes = catalog.QUERIES["merge_entities"](spark, sf)
    assert "regexp_extract_all" not in plan(nodes)
    assert sorted(r.entity_key for r in nodes.collect()) == ["Concept_apache", "Concept_license"]


def test_chunks_are_embedded_once(spark, sf, monkeypatch):
    """chunk_embedding_index: both lanes of the merge read the written chunk rows."""
    seen, write = [], catalog.materialize
    monkeypatch.setattr(catalog, "materialize", lambda df, name: seen.append((name, plan(df))) or write(df, name))
    assert [r.type for r in catalog.QUERIES["chunk_embedding_index"](spark, sf).collect()] == ["Chunk"]
    assert [n for n, p in seen if "regexp_extract_all" in p] == ["chunk-rows"]


def test_events_are_dealt_and_prepared_once(spark, sf):
    """merge_state: a file of one row group does not make one task; batches read the prepared rows."""
    assert "Rebalance" in plan(views.event_rows(spark, sf))
    state = {(r.entity_key, r.prop, r.value_json) for r in catalog.QUERIES["merge_state"](spark, sf).collect()}
    whole = {(r.entity_key, r.prop, r.value_json) for r in catalog.QUERIES["merge_first_truthy"](spark, sf).collect()}
    assert state == whole and len(state) == 6


def test_script_pieces_are_read_as_functions_once(spark, tmpdir_path):
    with open(f"{tmpdir_path}/s.txt", "w") as f:
        f.write("MERGE (a {t: 'x;y'}); // no; end\nMERGE (b);\n/* ; */ MERGE (c);")
    got = script_scan.statements(spark, tmpdir_path, tile=2)
    assert any("graphweave-moves" in f for f in got.inputFiles())
    assert sorted(r.statement.strip() for r in got.collect())[-3:] == ["MERGE (a {t: 'x;y'})", "MERGE (b)", "MERGE (c)"]


def test_repeated_keys_are_counted_before_the_join(spark):
    """star_nodes: the join with the repeated hashes is planned by their own size; rows alone are not shuffled."""
    data = [("f", "d", 0, i, "Person", json.dumps({"name": f"p{i % 40}"})) for i in range(42)]
    rows = entity_rows(spark, data)
    got = merge.merge_entities(rows, mostly_unique=True)
    assert any("graphweave-repeated" in f for f in got.inputFiles())
    assert sorted(r.entity_key for r in got.collect()) == sorted(r.entity_key for r in merge.merge_entities(rows).collect())


@pytest.mark.parametrize("name", ["a", " a", "a ", "\u00a0a\n", "a\u2003", "\x1f", "", " ", "é", "é ", "a b", None])
def test_names_are_stripped_without_a_search(spark, name):
    row = spark.createDataFrame([(name,)], "n string").select(text.ustrip("n").alias("s"), text.is_all_space("n").alias("e")).first()
    assert tuple(row) == ((None, None) if name is None else (name.strip(), not name.strip()))


def test_a_pair_is_folded_where_its_first_name_is_looked_up(spark):
    """undirected_edges: one shuffle of the rows for fold and first name, one for the second; hub pairs fold before."""
    data = [("f", "d", 0, i, "a", "hub", "NEAR") for i in range(900)]
    data += [("f", "d", 1, i, f"n{i % 7}", f"n{i % 5}", "KNOWS") for i in range(70)] + [("f", "d", 2, 0, "hub", "a", "LAST")]
    data += [("f", "d", 3, 0, "a", "gone", "NEAR"), ("f", "d", 3, 1, None, "a", "NEAR")]
    nodes = merge.merge_entities(entity_rows(spark, [
        ("f", "d", 0, i, "Person", json.dumps({"name": n})) for i, n in enumerate(["a", "hub"] + [f"n{i}" for i in range(7)])]))
    want = {}
    for _, _, c, i, s, t, k in data:
        if None not in (s, t) and "gone" not in (s, t):
            want[min(s, t), max(s, t)] = max(want.get((min(s, t), max(s, t)), (-1,)), (c, i, k, s, t))
    got = graph.undirected_edges(nodes, rel_rows(spark, data))
    assert {(r.u, r.v): (r.type, r.source, r.target) for r in got.collect()} == {k: v[2:] for k, v in want.items()}
    assert got.count() == len(want) and "REPARTITION_BY_COL" in got._jdf.queryExecution().executedPlan().toString()


def test_edges_are_sorted_by_a_hash(spark):
    """dedupe, resolve: long names that begin alike are not what the sorts compare first."""
    nodes = merge.merge_entities(entity_rows(spark, [
        ("f", "d", 0, i, "Person", json.dumps({"name": n})) for i, n in enumerate(["a", "b"])]))
    rels = rel_rows(spark, [("f", "d", 0, i, "a", "b", "KNOWS") for i in range(3)] + [("f", "d", 0, 4, "b", "a", "KNOWS")])
    resolved = edges.resolve(nodes, rels)
    got = edges.dedupe(resolved)
    assert got.columns == [*resolved.columns, "props_json"] and re.search(r"Aggregate \[_groupingexpression", plan(got))
    assert sorted((r.src_key, r.dst_key) for r in got.collect()) == [("Person_a", "Person_b"), ("Person_b", "Person_a")]


def test_the_reach_of_a_query_bounds_its_tiles(spark, monkeypatch):
    """vector_top_k: after the home cell only vectors within the reach leave a tile."""
    rnd = random.Random(5)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(6)]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    seen, tiles = [], vectors.PivotIndex.tiles

    def kept(self, *a):
        found = tiles(self, *a)
        seen.append(found)
        return found

    monkeypatch.setattr(vectors.PivotIndex, "tiles", kept)
    got = vectors.top_k(df, df, 5, exclude_self=True, pivots=8, block_rows=32)
    assert got.count() == 1500
    worst = {r.query_id: r.sim for r in seen[0].groupBy("query_id").agg(F.sort_array(F.collect_list("sim"), False).alias("s"))
             .where(F.size("s") >= 5).select("query_id", F.col("s")[4].alias("sim")).collect()}
    assert all(r.sim >= worst[r.query_id] - 2e-6 for r in seen[1].collect() if r.query_id in worst)
