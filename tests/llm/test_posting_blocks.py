import math
import random
import re
from collections import Counter

import numpy as np

from graphweave.llm import posting_blocks as P

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(t):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, k=10):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    N, L = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        q, scored = Counter(terms(text)), []
        for doc, c, n in held:
            s = sum(m * math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * (25 + 75 * n * N // L)))
                    for t, m in q.items() if t in c)
            if s > 0:
                scored.append((-s, math.inf if doc is None else doc))
        out += [(item, r + 1, None if d == math.inf else d, -s) for r, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def corpus(seed, n):
    rnd = random.Random(seed)
    vocab = [f"{rnd.choice(['Wort', 'ça', 'x', 'é'])}{i}" for i in range(400)]
    return [(i, rnd.choice([" ", ", ", "\n"]).join(vocab[min(399, int(rnd.expovariate(0.02)))] for _ in range(rnd.choice([1, 5, 30, 120]))))
            for i in range(n)], vocab


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_matches_scoring_everything(spark, make_docs):
    rows, vocab = corpus(3, 500)
    rnd = random.Random(4)
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([1, 3, 12])))) for i in range(25)]
    items += [(90, rows[7][1]), (91, "no-such-term 0x"), (92, None), (93, "")]
    want = brute(rows, items)
    for entries in (P.SHARD_ENTRIES, 700):
        assert got(P.rank(make_docs(rows), items_of(spark, items), shard_entries=entries)) == want
    assert got(P.rank(make_docs(rows), items_of(spark, items), item_bytes=200)) == want  # several passes
    assert got(P.rank(make_docs(rows), items_of(spark, items), k=3)) == brute(rows, items, 3)


def test_odd_rows(spark, make_docs):
    long = "alpha " * 70000 + "beta"
    rows = [(5, "alpha beta"), (5, "alpha beta"), (None, "ALPHA gamma"), (3, "alpha beta"), (4, None), (6, ""), (7, "--- !"), (8, long),
            (9, "bêta ÄLPHA"), (10, "x\x00alpha\x00y")]
    items = [(1, "Alpha beta Alpha"), (2, "ÄLPHA"), (2, "bêta"), (None, "gamma")]
    assert got(P.rank(make_docs(rows), items_of(spark, items))) == brute(rows, items)


def test_empty_tables_and_clashing_columns(spark, make_docs):
    d = make_docs([(1, "a b"), (2, "a c")])
    assert P.rank(make_docs([]), items_of(spark, [(1, "a")])).count() == 0
    assert P.rank(d, items_of(spark, [])).count() == 0
    d2 = d.selectExpr("*", "1 as item", "2 as score", "3 as rank", "4 as n", "5 as terms", "6 as item_id")
    i2 = items_of(spark, [(1, "a c")]).selectExpr("*", "1 as item", "7 as doc_id", "8 as rank")
    assert got(P.rank(d2, i2)) == brute([(1, "a b"), (2, "a c")], [(1, "a c")])


def test_hot_term_and_hot_id(spark, make_docs):
    rows = [(77 if i % 3 == 0 else None if i % 3 == 1 else i, f"the common line t{i % 40} {'the ' * (i % 5)}") for i in range(600)]
    items = [(1, "the common"), (2, "common t7 t8"), (3, "line the the t39")]
    assert got(P.rank(make_docs(rows), items_of(spark, items))) == brute(rows, items)


def test_blocks_bound_their_documents_and_are_skipped():
    rnd = np.random.default_rng(1)
    n_docs, n_terms = 2000, 300
    dense = np.where(rnd.random((n_docs, n_terms)) < 0.06, rnd.integers(1, 1000, (n_docs, n_terms)), 0)
    dense[:, 0] = rnd.integers(1, 50, n_docs)
    doc, term = np.nonzero(dense)
    shard = P.Shard(np.arange(n_docs), np.searchsorted(doc, np.arange(n_docs + 1)), term, dense[doc, term], n_terms)
    for t in (0, 5):
        docs, ends, s_term, s_top, s_ends = shard.blocks_of(t)
        assert sorted(docs) == np.flatnonzero(dense[:, t]).tolist()
        for b in range(len(ends)):
            part = docs[(ends[b - 1] if b else 0) : ends[b]]
            top = np.zeros(n_terms, np.int64)
            at = slice(s_ends[b - 1] if b else 0, s_ends[b])
            top[s_term[at]] = s_top[at]
            assert (top == dense[part].max(axis=0)).all()
    q = np.array([0, 5, 9, 33])
    assert best_of(shard, q) == brute_best(dense, q)


def best_of(shard, q, k=10):
    scores, ids = shard.search(q, np.ones(len(q), np.int64), (np.zeros(0, np.int64),) * 2, k)
    return scores.tolist(), ids.tolist()


def brute_best(dense, q, k=10):
    full = dense[:, q].sum(axis=1)
    order = np.lexsort((np.arange(len(dense)), -full))[:k]
    return full[order].tolist(), order.tolist()


def test_blocks_of_other_topics_are_skipped():
    n_docs, topics = 2000, 20
    dense = np.zeros((n_docs, 1 + topics * 5), np.int64)
    dense[:, 0] = 500  # one term in every document: its list is the first to be visited
    topic = np.random.default_rng(2).integers(0, topics, n_docs)
    for j in range(5):
        dense[np.arange(n_docs), 1 + topic * 5 + j] = 90 + j
    doc, term = np.nonzero(dense)
    shard = P.Shard(np.arange(n_docs), np.searchsorted(doc, np.arange(n_docs + 1)), term, dense[doc, term], dense.shape[1])
    q = np.array([0, 1 + 3 * 5])
    assert best_of(shard, q) == brute_best(dense, q)
    assert shard.skipped > 4 * shard.visited
