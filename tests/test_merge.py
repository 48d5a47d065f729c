"""Entity key and property fold (P14/P15/A1) on hand-written rows."""

import json

from pyspark.sql import functions as F

from rows import entity_rows
from graphweave.operators import merge


def _merged(spark, rows):
    n = merge.merge_entities(entity_rows(spark, rows))
    out = {}
    for r in n.select("entity_key", "type", F.to_json("props").alias("p")).collect():
        out[r.entity_key] = (r.type, json.loads(r.p), list(json.loads(r.p)))
    return out


def row(i, type_, props, path="f"):
    return (path, "doc", 0, i, type_, json.dumps(props))


def test_first_truthy_else_last(spark):
    m = _merged(spark, [
        row(0, "T", {"name": "a", "p": ""}), row(1, "T", {"name": "a", "p": "x"}), row(2, "T", {"name": "a", "p": "y"}),
        row(3, "U", {"name": "b", "p": ""}), row(4, "U", {"name": "b", "p": 0}),
        row(5, "V", {"name": "c", "p": "  "}), row(6, "V", {"name": "c", "p": "x"}),
        row(7, "W", {"name": "d", "p": "0"}), row(8, "W", {"name": "d", "p": "x"}),
        row(9, "X", {"name": "e", "p": []}), row(10, "X", {"name": "e", "p": {}}), row(11, "X", {"name": "e", "p": False}),
    ])
    assert m["T_a"][1]["p"] == "x"
    assert m["U_b"][1]["p"] == 0
    assert m["V_c"][1]["p"] == "  "
    assert m["W_d"][1]["p"] == "0"
    assert m["X_e"][1]["p"] is False


def test_key_variants_and_case(spark):
    m = _merged(spark, [
        row(0, "Location", {"name": "New York"}), row(1, "Location", {"name": " new york"}),
        row(2, "Location", {"name": "New_York"}), row(3, "Location", {"name": "New\tYork"}),
        row(4, "Person", {"name": "Ann"}), row(5, "person", {"name": "Ann"}),
        row(6, "A_b", {"name": "c"}), row(7, "A", {"name": "b_c"}),
    ])
    assert m["Location_new_york"][1]["name"] == "New York"
    assert "Location_new\tyork" in m
    assert "Person_ann" in m and "person_ann" in m
    assert m["A_b_c"][0] == "A_b"  # joined-key clash: one node, first row's type


def test_unicode_strip_and_document_names(spark):
    m = _merged(spark, [
        row(0, "Document", {"name": " Report "}), row(1, "Concept", {"name": " Idea "}),
    ])
    assert m["Document_report"][1]["name"] == "Report"
    assert m["Concept_idea"][1]["name"] == " Idea "  # only Document names are rewritten


def test_property_order_and_chunk_text(spark):
    m = _merged(spark, [
        row(0, "Chunk", {"name": "d_chunk_0", "chunk_number": 0}),
        row(1, "Chunk", {"name": "d_chunk_0", "extra": 1, "text": "hello"}),
        row(2, "T", {"name": "a", "x": 1, "y": 2}), row(3, "T", {"name": "a", "z": 3, "text": "t"}),
    ])
    assert m["Chunk_d_chunk_0"][2] == ["name", "chunk_number", "text", "extra"]
    assert m["T_a"][2] == ["name", "x", "y", "z", "text"]


def test_quarantine(spark):
    rows = entity_rows(spark, [row(0, None, {"name": "a"}), row(1, "T", {"name": 5}), row(2, "T", {"name": "ok"})])
    good, bad = merge.prepare(rows)
    assert good.count() == 1
    assert sorted(r.reason for r in bad.collect()) == ["missing type", "name is not a string"]


def test_partitioning_does_not_change_result(spark):
    rows = [row(i, "T", {"name": "k%d" % (i % 3), "p": ["", "x", 0, "y"][i % 4]}) for i in range(40)]
    df = entity_rows(spark, rows)
    a = merge.merge_entities(df).select("entity_key", F.to_json("props").alias("p")).collect()
    b = merge.merge_entities(df.repartition(7)).select("entity_key", F.to_json("props").alias("p")).collect()
    assert sorted(a) == sorted(b)


def test_hot_key_is_pre_aggregated_before_the_shuffle(spark):
    # one key holds a third of all rows; the fold must combine map-side
    rows = [row(i, "T", {"name": "hub" if i % 3 == 0 else f"k{i}", "p": i}) for i in range(300)]
    df = entity_rows(spark, rows).repartition(6)
    merged = merge.merge_entities(df)
    merged.write.format("noop").mode("overwrite").save()
    plan = merged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    first_exchange = plan.rfind("Exchange hashpartitioning(entity_key")
    assert first_exchange != -1
    below = plan[first_exchange:]
    assert "partial_min_by" in below and "partial_max_by" in below
    hub = merged.where(F.col("entity_key") == "T_hub").select(F.to_json("props").alias("p")).first().p
    assert json.loads(hub) == {"name": "hub", "p": 3}  # 0 is falsy: first truthy value wins


def test_mostly_unique_keys_give_the_same_nodes(spark):
    rows = [row(k, "Topic", {"z": k, "name": f"n{k}", "a": ""}) for k in range(40)]
    rows += [row(90, "Empty", {}), row(91, "Chunk", {"chunk_number": 1, "name": "c", "text": None})]
    rows += [row(100 + k, "Topic", {"name": f" N{k}", "b": k, "z": 0}) for k in range(0, 40, 7)]  # second rows of a key
    rows += [row(0, "Topic", {"name": "n3", "c": 1}), (None, None, None, None, "Topic", '{"name": "lone"}')]
    ents = entity_rows(spark, rows)

    def nodes(mostly_unique):
        n = merge.merge_entities(ents, mostly_unique=mostly_unique)
        return n.columns, sorted(
            map(str, n.select("entity_key", "type", "name", F.to_json("props"), F.map_keys("props"), "first_ord").collect()))

    assert nodes(True) == nodes(False)
    assert len(nodes(True)[1]) == 43


def test_star_nodes_are_mostly_alone_with_their_key(spark, tmpdir_path):
    from graphweave.plans import views

    tables = {
        "customer": [(k, f"C{k}", 0, 1.0, "S") for k in range(30)], "supplier": [(1, "Sup", 2.0)],
        "part": [(1, "B", 3, 4.0)], "orders": [(k, "F", 1.0, "P", k) for k in range(30)],
        "nation": [(0, "N")], "region": [(0, "R")],
    }
    columns = {
        "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        "supplier": "s_suppkey long, s_name string, s_acctbal double",
        "part": "p_partkey long, p_brand string, p_size int, p_retailprice double",
        "orders": "o_orderkey long, o_orderstatus string, o_totalprice double, o_orderpriority string, o_custkey long",
        "nation": "n_nationkey int, n_name string", "region": "r_regionkey int, r_name string",
    }
    for name, rows in tables.items():
        spark.createDataFrame(rows, columns[name]).write.parquet(f"{tmpdir_path}/{name}.parquet")
    nodes = views.star_nodes(spark, tmpdir_path)
    assert "LeftAnti" in nodes._jdf.queryExecution().optimizedPlan().toString()  # no shuffle of whole rows for these
    assert nodes.count() == 30 + 1 + 1 + 30 + 2 + 2

    from graphweave.plans import catalog

    # the labels need no relationships: there is no lineitem table here
    got = {r.type: r.n for r in catalog.dedup_nodes(spark, tmpdir_path).collect()}
    assert got == {"Person": 30, "Organization": 1, "Product": 1, "Event": 30, "Location": 3, "Topic": 1}
