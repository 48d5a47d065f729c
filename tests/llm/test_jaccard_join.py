import random
import re

import numpy as np

from graphweave.llm import jaccard_join as J
from graphweave.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(t):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    w = WORD.findall(t)
    if not w:
        return set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


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
        for j in group:
            out[j] = min(rows[k][0] for k in group)
    return sorted((rows[i][0], len(sets[i]), out[i]) for i in range(n))


def corpus(seed, n=120):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    common = [rnd.choice(vocab) for _ in range(12)]
    rows, texts = [], []
    for i in range(n):
        if texts and rnd.random() < 0.6:
            words = rnd.choice(texts)[:]
            for _ in range(rnd.choice([0, 1, 1, 2, 5])):
                if words:
                    k = rnd.randrange(len(words))
                    words[k : k + rnd.randrange(2)] = [rnd.choice(vocab)] * rnd.randrange(3)
        else:
            words = [rnd.choice(vocab) for _ in range(rnd.choice([0, 1, 3, 4, 5, 6, 30, 90, 200]))]
            if rnd.random() < 0.5:
                words += common
        texts.append(words)
        text = rnd.choice([" ", "\n"]).join(words)
        rows.append((1000 - 7 * i, text.upper() if rnd.random() < 0.1 else text))
    return rows + [(5000, None), (5001, ""), (5002, " \n")]


def got(res):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in res.collect())


def test_equals_brute_force(make_docs):
    rows = corpus(1)
    assert got(J.near_duplicates(make_docs(rows))) == brute(rows)


def test_split_components_and_many_blocks(make_docs, monkeypatch):
    monkeypatch.setattr(J, "block_count", lambda docs, text: 7)
    rows = corpus(2)
    assert got(J.near_duplicates(make_docs(rows), task_shingles=300)) == brute(rows)


def test_join_sets_finds_every_component():
    for seed in range(30):
        rnd = random.Random(seed)
        base = [rnd.sample(range(400), rnd.randrange(1, 60)) for _ in range(4)]
        sets = []
        for _ in range(rnd.randrange(2, 40)):
            s = set(rnd.choice(base))
            s = {x for x in s if rnd.random() > 0.08} | {rnd.randrange(400) for _ in range(rnd.randrange(3))}
            sets.append(np.array(sorted(s or {1}), np.uint64))
        links = J.join_sets(sets, 80)
        root = list(range(len(sets)))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in links:
            root[find(a)] = find(b)
        for i in range(len(sets)):
            for j in range(i):
                x, y = set(sets[i].tolist()), set(sets[j].tolist())
                if 100 * len(x & y) >= 80 * len(x | y):
                    assert find(i) == find(j)
        for a, b in links:
            x, y = set(sets[a].tolist()), set(sets[b].tolist())
            assert 100 * len(x & y) >= 80 * len(x | y)


def test_null_and_repeated_ids_empty_table(make_docs):
    t = " ".join(f"x{i}" for i in range(20))
    other = " ".join(f"y{i}" for i in range(20))
    res = J.near_duplicates(make_docs([(None, t), (3, t), (4, t + " z"), (7, other), (7, other), (8, "a"), (9, "a"), (9, "b")]))
    key = lambda r: repr(r)
    assert sorted((tuple(r) for r in res.collect()), key=key) == sorted(
        [(None, 16, None), (3, 16, None), (4, 17, None), (7, 16, 7), (7, 16, 7), (8, 1, 8), (9, 1, 8), (9, 1, 9)], key=key
    )
    assert J.near_duplicates(make_docs([])).collect() == []


def test_keep_one_per_group(make_docs):
    t = " ".join(f"x{i}" for i in range(40))
    docs = make_docs([(2, t), (5, t + " end"), (6, "other text of five words"), (6, "other text of five words"), (9, None)])
    docs = docs.withColumn("component", docs.doc_id)
    res = J.keep_one_per_group(docs)
    assert res.columns == docs.columns
    assert sorted(r.doc_id for r in res.collect()) == [2, 6, 9]


def test_one_id_on_several_texts(make_docs):
    t, u, other = (" ".join(f"{c}{i}" for i in range(40)) for c in "xuy")
    rows = [(3, t), (4, t + " z"), (4, other), (8, "a"), (9, "a"), (9, "b"), (9, "B"), (9, "b"), (11, u), (11, u + " z"),
            (13, " "), (13, "\n"), (14, None), (14, "")]
    assert got(J.near_duplicates(make_docs(rows))) == sorted(
        [(3, 36, 3), (4, 37, 3), (4, 36, 4), (8, 1, 8), (9, 1, 8), (9, 1, 9), (9, 1, 9), (9, 1, 9), (11, 36, 11), (11, 37, 11)]
        + [(13, 0, 13)] * 2 + [(14, 0, 14)] * 2
    )
    kept = [(r.doc_id, r.text or "") for r in J.keep_one_per_group(make_docs(rows)).collect()]
    assert sorted(k for k in kept if k[0] != 11) == [(3, t), (4, other), (8, "a"), (9, "b"), (13, "\n"), (13, " "), (14, "")]
    assert sum(k[0] == 11 for k in kept) == 1


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(139, 200), (5, 5), (None, 7)]
    got_ = {r.node: r.component for r in components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()}
    assert got_ == {i: 0 for i in range(41)} | {i: 100 for i in [*range(100, 140), 200]}


def test_null_and_repeated_ids_are_spread_over_blocks(make_docs):
    from graphweave.llm.textblocks import to_blocks

    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text {i}") for i in range(3000)]
    sizes = [r["count"] for r in to_blocks(make_docs(rows), 100, by_text=True).groupBy("block").count().collect()]
    assert max(sizes) <= 2 * 3000 / 100


def test_many_parts_have_numbers_of_their_own(spark):
    members = spark.range(40).selectExpr("id as rep", "id as set_a", "id as set_b", "7000000000L as n", "1L as component")
    groups = J._task_groups(members, 80, 100_000)  # millions of parts: numbers pass 32 bits
    one = groups.filter("group_c is not null").select("group_c").limit(50).collect()
    assert len(one) == 50 and max(r.group_c for r in one) > 2**31


def test_stage_with_a_clashing_column(make_docs):
    docs = make_docs([(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "other words stand in this one")]).selectExpr("*", "'x' as _md5", "1 as _stay")
    got = J.keep_one_per_group(docs)
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == [1, 3]
