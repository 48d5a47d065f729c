import numpy as np
import pytest

from graphweave.llm import learned_partitions as L

SCHEMA = "vec_id long, embedding array<float>, label int, part int"


def table(spark, x, ids=None):
    rows = [(int(i), [float(c) for c in r], 0, 1) for i, r in zip(range(len(x)) if ids is None else ids, x)]
    return spark.createDataFrame(rows, SCHEMA)


def brute(x, ids, k=20):
    out = {}
    for i, q in zip(ids, x):
        if i % 20 == 0:
            s = (x * q).sum(axis=1)
            best = sorted((-t, j) for t, j in zip(s, ids) if j != i)[:k]
            out[i] = [(j, -t) for t, j in best]
    return out


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_recall_and_scores(spark):
    rnd = np.random.default_rng(0)
    x = (rnd.normal(size=(40, 16))[rnd.integers(0, 40, 3000)] + 0.4 * rnd.normal(size=(3000, 16))).astype(np.float32).astype(float)
    res = got(L.nearest(table(spark, x), lambda i: i % 20 == 0, 20, sample=1000, part_rows=300))
    want = brute(x, list(range(3000)))
    assert set(res) == set(want)
    hit = sum(len({j for j, _ in res[q]} & {j for j, _ in want[q]}) for q in want)
    assert hit >= 0.9 * 20 * len(want)
    for q, best in res.items():
        assert len(best) == 20
        for j, s in best:
            assert abs(s - float((x[q] * x[j]).sum())) < 1e-12


def test_exact_in_one_part_with_ties_and_odd_rows(spark):
    rnd = np.random.default_rng(1)
    x = rnd.integers(-2, 3, (90, 4)).astype(float)
    x[30:70] = [1, 1, 0, 0]  # one hot vector
    x[~x.any(axis=1)] = 1
    odd = [(200, None), (220, []), (240, [0.0] * 4), (260, [1.0, None, 0.0, 0.0]), (280, [float("nan")] * 4),
           (300, [float("inf"), 0, 0, 0]), (320, [1.0]), (None, [1.0] * 4)]
    rows = spark.createDataFrame([(i, v and [None if c is None else float(c) for c in v], 0, 0) for i, v in odd], SCHEMA)
    df = table(spark, x).unionByName(rows)
    res, want = got(L.nearest(df, lambda i: i % 20 == 0)), brute(x, list(range(90)))
    assert res == want
    assert L.nearest(rows.filter("vec_id != 320"), lambda i: i % 20 == 0).collect() == []


def test_hot_part_in_cells(spark, monkeypatch):
    monkeypatch.setattr(L, "CELL_ROWS", 16)
    rnd = np.random.default_rng(2)
    x = rnd.integers(-8, 9, (120, 4)) / 4.0
    x[40:100] = x[40]
    assert got(L.nearest(table(spark, x), lambda i: i % 20 == 0)) == brute(x, list(range(120)))


def test_repeated_query_ids(spark, monkeypatch):
    monkeypatch.setattr(L, "CELL_ROWS", 16)
    rnd = np.random.default_rng(4)
    x, other = rnd.normal(size=(90, 4)), rnd.normal(size=4)
    ids = list(range(90))
    x2, ids2 = np.concatenate([x, [x[20]] * 3, [other] * 2]), ids + [20] * 3 + [40] * 2
    rows = L.nearest(table(spark, x2, ids2), lambda i: i % 20 == 0).collect()

    def best(i, q):  # every candidate row, those of the query's own id excepted
        return sorted((-(y * q).sum(), j) for y, j in zip(x2, ids2) if j != i)[:20]

    want = [(i, place + 1, j) for i, q in [*((i, x[i]) for i in range(0, 90, 20)), (40, other)]
            for place, (_, j) in enumerate(best(i, q))]
    assert sorted((r.query_id, r.rank, r.vec_id) for r in rows) == sorted(want)


def test_fewer_candidates_than_wanted(spark):
    x = np.eye(4)
    assert got(L.nearest(table(spark, x), lambda i: i % 20 == 0)) == {0: [(1, 0.0), (2, 0.0), (3, 0.0)]}


@pytest.mark.parametrize("n_parts", [2, 5])
def test_parts_are_balanced_and_cut_few_edges(n_parts):
    rnd = np.random.default_rng(3)
    centre = rnd.integers(0, n_parts, 500)
    x = 5 * np.eye(8)[centre] + 0.1 * rnd.normal(size=(500, 8))
    g = L.neighbour_graph(x, 8)
    part = L.balanced_parts(g, n_parts)
    size = -(-500 // n_parts)
    assert np.bincount(part, minlength=n_parts).max() <= size * 1.05 + 1
    rand = rnd.permutation(500) % n_parts
    assert (part[g] != part[:, None]).mean() < 0.3 * (rand[g] != rand[:, None]).mean()


def test_finite_extremes_lose_no_candidate(spark):
    for big in (1e30, 1e-30):
        rows = [(0, [big, big]), (1, [big, 0.0]), (2, [0.0, 2 * big]), (3, [-big, 0.0]), (5, [1.0, 1.0])]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = sorted((r.rank, r.vec_id, r.score) for r in L.nearest(df, lambda i: i == 0, 20).collect())
        want = sorted(((i, sum(a * b for a, b in zip(v, rows[0][1]))) for i, v in rows[1:]), key=lambda x: (-x[1], x[0]))
        assert got == [(k + 1, i, s) for k, (i, s) in enumerate(want)]
