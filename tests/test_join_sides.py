"""Tables that grow with the data are not broadcast through the driver, however small they are planned."""

import pytest
from pyspark.sql import functions as F

from graphweave.operators import edges, graph, merge
from graphweave.plans import views
from rows import entity_rows, rel_rows


@pytest.fixture()
def tables(spark, tmp_path):
    ents = [("f", "d", 0, i, t, f'{{"name": "{n}"}}') for i, (t, n) in enumerate(
        [("Person", "Ann"), ("Person", "Bob"), ("Location", "Rome"), ("Location", "Europe")])]
    rels = [("f", "d", 0, i, s, t, "NEAR") for i, (s, t) in enumerate(
        [("Ann", "Bob"), ("Bob", "Ann"), ("Bob", "Rome"), ("Rome", "Europe"), ("Rome", "nobody")])]
    merge.merge_entities(entity_rows(spark, ents)).write.parquet(f"{tmp_path}/nodes")
    rel_rows(spark, rels).write.parquet(f"{tmp_path}/rels")
    return spark.read.parquet(f"{tmp_path}/nodes"), spark.read.parquet(f"{tmp_path}/rels")


def broadcasts(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange")


def test_node_names_are_not_broadcast(spark, tables):
    n, r = tables
    resolved = edges.resolve(n, r)
    for df, rows in ((edges.strict(n, r), 4), (resolved, 4), (graph.undirected_edges(n, r), 3), (edges.dedupe(resolved), 4),
                     (graph.match(resolved, "Person", "NEAR", "Location"), 1)):
        assert df.count() == rows
        assert broadcasts(df) == 0


@pytest.mark.parametrize("few", [0, 100_000])
def test_large_frontiers_are_not_broadcast(spark, tables, monkeypatch, few):
    monkeypatch.setattr(graph, "FEW", few, raising=False)
    n, r = tables
    found = graph.paths(n, edges.resolve(n, r), seed="Ann", dst_type="Location", max_hops=3)
    assert {x.path for x in found.collect()} == {"Ann|Bob|Rome", "Ann|Bob|Rome|Europe"}
    if few == 0:
        assert broadcasts(found) == 0


def test_customers_are_not_broadcast(spark, tmp_path):
    made = {
        "customer": "select id as c_custkey, 'c' || id as c_name, 0 as c_nationkey, 1.0D as c_acctbal, 's' as c_mktsegment from range(5)",
        "supplier": "select id as s_suppkey, 's' || id as s_name, 0 as s_nationkey from range(2)",
        "orders": "select id as o_orderkey, id % 6 as o_custkey from range(12)",
        "lineitem": "select id % 12 as l_orderkey, id as l_partkey, 1 as l_linenumber from range(20)",
        "nation": "select 0 as n_nationkey, 'n' as n_name, 0 as n_regionkey",
        "region": "select 0 as r_regionkey, 'r' as r_name",
    }
    for t, sql in made.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{t}.parquet")
    rels = views.star_rels(spark, str(tmp_path)).where(F.col("type") == "PARTICIPATES_IN")
    assert rels.count() == 10
    assert broadcasts(rels) == 0
