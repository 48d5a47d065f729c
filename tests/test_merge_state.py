"""Mergeable merge state: batches in any order, repeated and compacted, equal one merge of all rows."""

import json
import random

import pytest
from pyspark.sql import functions as F

from rows import entity_rows
from graphweave.operators import merge


def made(seed, n=120):
    rnd = random.Random(seed)
    values = ["", "x", "y", 0, 7, None, [], [1], {}, False, True, "  "]
    rows = []
    for i in range(n):
        type_ = rnd.choice(["Chunk", "Person", "Document"])
        props = {"name": rnd.choice(["a", "b", " a ", "A", "c_chunk_1"])}
        for p in rnd.sample(["text", "embedding", "p", "q"], rnd.randrange(5)):
            props[p] = rnd.choice(values) if p != "embedding" else rnd.choice([[], [0.5, 1.0]])
        if rnd.random() < 0.3:
            props = dict(sorted(props.items(), key=lambda _: rnd.random()))
        rows.append((f"f{i % 7}", "doc", i % 5, i, type_, json.dumps(props)))
    return rows


def model(rows):
    """The fold in plain Python: first truthy value, else the last."""
    nodes = {}
    for path, _d, chunk, pos, type_, props in sorted(rows, key=lambda r: (r[0], r[2], r[3])):
        props = json.loads(props)
        if type_ == "Document":
            props["name"] = props["name"].strip()
        key = f"{type_}_" + props["name"].strip().lower().replace(" ", "_")
        node = nodes.setdefault(key, {})
        for p, v in props.items():
            if p not in node or not node[p]:
                node[p] = v
    return nodes


def got(nodes):
    return sorted((r.entity_key, r.type, r.name, r.p, str(r.first_ord)) for r in nodes.withColumn("p", F.to_json("props")).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_states_of_parts_equal_one_merge(spark, tmpdir_path, seed):
    data = made(seed)
    rows = merge.prepare(entity_rows(spark, data))[0]
    want = got(merge.merge_entities(rows, prepared=True))
    assert {k: json.loads(p) for k, _t, _n, p, _o in want} == model(data)
    state = merge.MergeState(spark, tmpdir_path + "/state")
    assert state.nodes() is None and state.compact() is None
    order = [2, 0, 0, 1] if seed == 1 else [1, 2, 0, 2]
    for turn, batch in enumerate(order):
        state.add(rows.where(F.col("pos") % 3 == batch), f"{batch}")
        if turn in (1, 2):
            state.compact()
    assert got(state.nodes()) == want
    state.add(rows.where(F.col("pos") % 3 == 1), "1")  # retried after everything
    assert got(state.nodes()) == want
    state.compact()
    assert got(state.nodes()) == want


def test_rows_without_properties_and_hot_key(spark):
    data = [("f", "d", 0, i, "T", json.dumps({"name": "hub", "text": f"t{i}" if i == 40 else "", f"p{i % 3}": i})) for i in range(200)]
    rows = merge.prepare(entity_rows(spark, data + [("f", "d", 0, 999, "U", "{}")]))[0]
    out = {r.entity_key: json.loads(r.p) for r in merge.merge_entities(rows, prepared=True).withColumn("p", F.to_json("props")).collect()}
    assert out["T_hub"] == {"name": "hub", "text": "t40", "p0": 3, "p1": 1, "p2": 2} and out["U_unknown"] == {}
    assert got(merge.render(merge.fold(rows))) == got(merge.merge_entities(rows, prepared=True))


def test_large_values_cross_one_shuffle(spark, tmpdir_path):
    """The exploded lane does not carry chunk texts."""
    rows = merge.prepare(entity_rows(spark, made(3)))[0]
    rows.write.parquet(tmpdir_path + "/rows")
    m = merge.merge_entities(spark.read.parquet(tmpdir_path + "/rows"), prepared=True)
    plan = m._jdf.queryExecution().optimizedPlan().toString()
    assert "NOT prop" in plan and "text" in plan
    # text: by key once; small properties: by (key, property), then by key
    assert m._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(") == 3
