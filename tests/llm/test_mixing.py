import math
import random

import duckdb
import pytest

from graphweave.llm import mixing as M

SCHEMA = "doc_id long, text string, source string, weight string, epoch long"


def corpus(spark, seed=3):
    rnd = random.Random(seed)
    rows = []
    for k, (s, n) in enumerate([("hot", 500), ("a", 60), ("b", 40), (None, 20), ("empty", 5)]):
        for i in range(n):
            words = 0 if s == "empty" else rnd.randrange(0, 30)
            text = None if i % 19 == 7 else rnd.choice([" ", "\t\n "]).join(["w"] * words)
            rows.append((k * 1000 + i, text, s, "x", 7))
    rows += [rows[0], rows[0], (None, "n u l l", "a", "x", 7)]
    return spark.createDataFrame(rows, SCHEMA)


def reference(totals, entropy, repeat, budget):
    """Exponent by plain scanning of a fine grid."""
    all_ = sum(totals.values())
    p = [t / all_ for t in totals.values() if t]

    def weights(x):
        z = sum(q**x for q in p)
        return [q**x / z for q in p]

    def ent(x):
        return -sum(w * math.log(w) for w in weights(x))

    def most(x):
        return max(w / q for w, q in zip(weights(x), p)) * budget

    grid = [k / 20000 for k in range(20001)]
    x = max(g for g in grid if ent(g) >= entropy * math.log(len(p)))
    if most(x) > repeat:
        x = min(g for g in grid if most(g) <= repeat)
    return x


@pytest.mark.parametrize("entropy,repeat", [(0.95, 4.0), (0.95, 1.5), (0.5, 4.0), (1.0, 100.0)])
def test_weights(spark, entropy, repeat):
    d = corpus(spark).withColumn("n", M.count_words(M.F.col("text")))
    totals = M.source_totals(d, "source", "n")
    got = {r.source: r for r in M.mixing_weights(totals, entropy, repeat, 1.0).collect()}
    x = reference({k: r.tokens for k, r in got.items()}, entropy, repeat, 1.0)
    assert abs(got["hot"].exponent - x) < 1e-4
    assert abs(sum(r.weight for r in got.values()) - 1) < 1e-9 and got["empty"].weight == 0


def test_budget_blocks_and_order(spark):
    d = corpus(spark)
    m = M.mix_sources(d, entropy=0.99, repeat=3.0, budget=1.5)
    rows = [r.asDict(recursive=True) for r in m.collect()]
    w = {r.source: r for r in M.mixing_weights(
        M.source_totals(d.withColumn("n", M.count_words(M.F.col("text"))), "source", "n"), 0.99, 3.0, 1.5).collect()}
    for s, r in w.items():
        mine = [x for x in rows if x["row"]["source"] == s]
        used = sum(x["n_tokens"] for x in mine)
        # the document that crosses the budget is read whole
        assert used >= r.budget and used - r.budget < 30
        whole = r.budget // r.tokens if r.tokens else 1
        for e in range(whole):
            assert len([x for x in mine if x["epoch"] == e]) == r.n_docs
        for e in {x["epoch"] for x in mine}:  # token ranges lie end to end
            spans = sorted((x["start"], x["start"] + x["n_tokens"]) for x in mine if x["epoch"] == e)
            assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_equals_sql(spark):
    d = corpus(spark)
    con = duckdb.connect()
    con.register("documents", d.toPandas()[["doc_id", "text", "source"]].astype({"doc_id": "Int64"}))
    got = sorted((tuple(r) for r in M.mixture(d).collect()), key=repr)
    cur = con.execute(M.MIXTURE_SQL)
    assert [c[0] for c in cur.description] == M.mixture(d).columns
    want = sorted(cur.fetchall(), key=repr)
    clean = lambda rows: [tuple(None if x != x else round(x, 9) if isinstance(x, float) else x for x in r) for r in rows]
    assert clean(got) == clean(want)


def test_mix_documents_keeps_all(spark):
    d = corpus(spark)
    m = M.mix_documents(d)
    assert m.columns == d.columns
    rows = m.collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in d.collect()}
    count = {}
    for r in rows:
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    assert max(v for k, v in count.items() if k) <= 2 * 3


def test_empty_and_tokenless(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert M.mixture(none).collect() == [] and M.mix_documents(none).collect() == []
    bare = spark.createDataFrame([(1, None, "a", "x", 1), (2, "", None, "x", 1)], SCHEMA)
    assert sorted((r.doc_id, r.n_tokens, r.epoch) for r in M.mixture(bare).collect()) == [(1, 0, 0), (2, 0, 0)]


def test_a_source_of_one_long_document_is_read(spark):
    """The share of a source is smaller than its only document: it is read once, not never."""
    d = spark.createDataFrame([(1, "w " * 5000, "big"), *[(10 + i, "a b", "small") for i in range(6)]],
                              "doc_id long, text string, source string")
    m = M.mix_sources(d, budget=0.3)
    w = {r.source: r.budget for r in M.mixing_weights(
        M.source_totals(d.withColumn("n", M.count_words(M.F.col("text"))), "source", "n"), 0.95, 4.0, 0.3).collect()}
    used = {r["source"]: r["n"] for r in m.groupBy("row.source").agg(M.F.sum("n_tokens").alias("n")).collect()}
    assert used["big"] == 5000 and 0 < w["big"] <= 5000
    assert w["small"] <= used["small"] < w["small"] + 2


def test_hot_and_null_ids(spark):
    """Rows under one id or none share a block, which is cut into epochs like any other."""
    d = spark.createDataFrame([(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"word {i}", f"s{i % 2}") for i in range(300)],
                              "doc_id long, text string, source string")
    rows = M.mix_sources(d, budget=None, repeat=1.0).collect()
    assert sorted(r.row.text for r in rows if r.epoch == 0) == sorted(f"word {i}" for i in range(300))
