import random
import re

import numpy as np
import pyarrow as pa
import pytest

from graphweave.llm import set_sketch as S
from graphweave.llm.jaccard_join import text_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(t):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    if not w:
        return set()
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)}


def brute(rows, percent=80):
    """All pairs, then a flood fill."""
    sets = [shingles(t) for _, t in rows]
    n = len(rows)
    near = [[j for j in range(n) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
            for i in range(n)]
    out, seen = [None] * n, set()
    for i in range(n):
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in group:
                    group.add(j)
                    todo.append(j)
        seen |= group
        ids = [rows[j][0] for j in group if rows[j][0] is not None]
        for j in group:
            out[j] = min(ids) if ids else None
    return sorted(((rows[i][0], len(sets[i]), out[i], rows[i][0] == out[i]) for i in range(n)), key=str)


def corpus(seed, n=150):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    rows, texts = [], []
    for i in range(n):
        if texts and rnd.random() < 0.7:
            words = rnd.choice(texts)[:]
            for _ in range(rnd.choice([0, 1, 1, 2, 5])):
                if words:
                    k = rnd.randrange(len(words))
                    words[k : k + rnd.randrange(2)] = [rnd.choice(vocab)] * rnd.randrange(3)
        else:
            words = [rnd.choice(vocab) for _ in range(rnd.choice([0, 1, 3, 4, 5, 6, 30, 90, 200]))]
        texts.append(words)
        text = rnd.choice([" ", "\n"]).join(words)
        rows.append((1000 - 7 * i, text.upper() if rnd.random() < 0.1 else text))
    return rows


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


@pytest.mark.parametrize("seed,task", [(1, S.TASK_SHINGLES), (2, S.TASK_SHINGLES), (3, 300)])
def test_matches_all_pairs(make_docs, seed, task):
    rows = corpus(seed)
    assert got(S.near_duplicates(make_docs(rows), task_shingles=task)) == brute(rows)


def test_odd_rows(make_docs):
    long = " ".join(f"x{i % 5000}" for i in range(60000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One word"), (4, "one WORD"), (9, "one word"), (5, long), (6, long + " more"),
            (None, long), (None, "alone here"), (None, "alone here"), (7, "ä b c d e"), (7, "Ä b c d e")]
    assert got(S.near_duplicates(make_docs(rows))) == brute(rows)


def test_empty_table_and_clashing_columns(spark, make_docs):
    assert S.near_duplicates(make_docs([])).count() == 0
    d = make_docs([(1, "a b c d e f"), (2, "a b c d e f")]).selectExpr(
        "*", "1 as component", "2 as node", "'x' as sketch", "3 as kept", "4 as text_hash")
    assert got(S.near_duplicates(d)) == [(1, 3, 1, True), (2, 3, 1, False)]


def star(n, rnd):
    """Copies that are each similar to one base but not to each other."""
    base = [f"b{i}" for i in range(203)]
    out = []
    for i in range(n):
        w = base[:]
        for k in range(4):
            w[4 + 50 * k + rnd.randrange(40)] = f"c{i}-{k}"
        out.append((i, " ".join(w)))
    return out + [(n, " ".join(base))]


@pytest.mark.parametrize("task", [S.TASK_SHINGLES, 4000])
def test_copies_that_meet_in_their_base_alone(make_docs, task):
    rows = star(60, random.Random(5))
    assert got(S.near_duplicates(make_docs(rows), task_shingles=task)) == brute(rows)


def test_hot_group_under_one_id_and_null(make_docs):
    rnd = random.Random(8)
    words = [f"h{i}" for i in range(120)]
    rows = []
    for i in range(120):
        w = words[:]
        w[rnd.randrange(120)] = f"z{i}"
        rows.append((rnd.choice([None, 77, 77, 500 + i]), " ".join(w)))
    rows += corpus(11, 40)
    for task in (S.TASK_SHINGLES, 2000):
        assert got(S.near_duplicates(make_docs(rows), task_shingles=task)) == brute(rows)


def test_sketches_merge_whatever_the_batch(spark):
    texts = [t for _, t in corpus(4, 60)]
    val, off = text_sets(pa.array(texts), 4)
    all_at_once = S.sketches(val.copy(), off)
    for i in range(len(texts)):
        one = S.sketches(val[off[i] : off[i + 1]].copy(), np.array([0, off[i + 1] - off[i]]))
        assert (one[0] == all_at_once[i]).all()
    for i in range(0, 40, 2):
        a, b = val[off[i] : off[i + 1]], val[off[i + 1] : off[i + 2]]
        both = np.union1d(a, b)
        if len(a) and len(b):
            s = S.sketches(both.copy(), np.array([0, len(both)]))[0]
            assert (s == S.merged(all_at_once[i], all_at_once[i + 1])).all()


def test_likelihood_finds_the_similarity():
    rnd = np.random.default_rng(3)
    for n, share in [(400, 0.9), (400, 0.6), (3000, 0.8), (50, 0.5)]:
        err = []
        for _ in range(12):
            both = rnd.integers(0, 2**63, int(n * share)).astype(np.uint64)
            a, b = (np.unique(np.concatenate([both, rnd.integers(0, 2**63, n - len(both)).astype(np.uint64)])) for _ in range(2))
            s = S.sketches(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
            true = len(both) / (len(a) + len(b) - len(both))
            more, less = np.array([float((s[0] > s[1]).sum())]), np.array([float((s[0] < s[1]).sum())])
            err.append(S.most_likely(more, less, S.REGISTERS - more - less, len(a), len(b))[0] - true)
        assert abs(np.mean(err)) < 0.025 and np.max(np.abs(err)) < 0.12
