"""Paths against a search in plain Python, with a hub, parallel edges, self loops and repeated rows."""

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from graphweave.operators import edges, graph, merge
from rows import entity_rows, rel_rows


def search(kinds, rows, seeds, label, hops):
    number = {e: i for i, e in enumerate(sorted(set(rows)))}
    found = []

    def walk(seed, cur, names, used):
        if used and kinds[cur] == label:
            found.append((seed, cur, len(used), "|".join(names)))
        if len(used) == hops:
            return
        for (s, t, _), n in number.items():
            if n in used:
                continue
            for here, there in {(s, t), (t, s)}:
                if here == cur:
                    walk(seed, there, names + [there], used | {n})

    for s in seeds:
        walk(s, s, [s], frozenset())
    return sorted(found)


@pytest.mark.parametrize("hops,seed", itertools.product([1, 2, 3], [["p0"], None]))
def test_paths(spark, hops, seed):
    rnd = random.Random(hops)
    kinds = {f"p{i}": "Person" for i in range(7)} | {"l0": "Location", "l1": "Location", "hub": "Location"}
    names = sorted(kinds)
    rows = [(rnd.choice(names), rnd.choice(names), rnd.choice(["KNOWS", "NEAR"])) for _ in range(9)]
    rows += [("hub", n, "NEAR") for n in names[:4]] + [("p0", "p0", "KNOWS"), ("p0", "p1", "KNOWS"), ("p1", "p0", "KNOWS")]
    rows += rows[:4]  # repeated
    nodes = merge.merge_entities(entity_rows(spark, [
        ("f", "d", 0, i, kinds[n], json.dumps({"name": n})) for i, n in enumerate(names)]))
    rels = rel_rows(spark, [("f", "d", 0, i, *r) for i, r in enumerate(rows)])
    got = graph.paths(nodes, edges.resolve(nodes, rels), seed=seed, dst_type="Location", max_hops=hops)
    got = sorted((r.seed_key.split("_", 1)[1], r.dst_key.split("_", 1)[1], r.hops, r.path) for r in got.collect())
    assert got == search(kinds, rows, seed or names, "Location", hops)
    assert all(g[3].endswith("|" + g[1]) for g in got)


def test_no_seed_no_edges(spark):
    nodes = merge.merge_entities(entity_rows(spark, [("f", "d", 0, 0, "Location", json.dumps({"name": "x"}))]))
    rels = rel_rows(spark, [("f", "d", 0, 0, "x", "y", "NEAR")])
    assert graph.paths(nodes, edges.resolve(nodes, rels)).count() == 0
    assert graph.paths(nodes, edges.resolve(nodes, rels), seed_nodes=nodes.where(F.lit(False))).count() == 0
