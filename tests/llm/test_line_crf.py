import itertools
import random
import re

import numpy as np
import pyarrow as pa

from graphweave.llm import line_crf as C

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(t):
    t = t or ""
    words = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            hit.update(range(i, i + 5))
    symbols = sum(c in "#*$%&|<>" for c in t)
    return len(words), sum(map(len, words)), symbols, dup, len(hit), len(words) < 10 or 100 * len(hit) > 20 * len(words)


def texts(seed):
    rnd = random.Random(seed)
    piece = ["a", "é漢", "b.", "#*", "||", "\n", "\n\n", " ", "\t", "c d e f g", "x y\r", "<b>", "\x0b", "🙂!"]
    out = ["".join(rnd.choice(piece) + rnd.choice(["", " "]) for _ in range(rnd.randrange(60))) for _ in range(60)]
    return out + ["", None, "\n", "one", "w " * 40, "same line of words\n" * 12, "a\n" * 300, "\n\nend"]


def field():
    rnd = np.random.default_rng(0)
    return C.Field(rnd.normal(size=C.N_FEATURES), rnd.normal(size=2), rnd.normal(size=(2, 2)))


def test_base_columns_equal_brute_force(make_docs):
    rows = list(enumerate(texts(1))) + [(None, "x y z"), (3, "again"), (3, "again")]
    got = C.label_lines(make_docs(rows).withColumn("kept", C.F.lit("clash")), field()).collect()
    want = sorted(((i, *base(t)) for i, t in rows), key=repr)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got), key=repr) == want
    for r in got:
        assert not (r.base_failed and r.kept) and (r.base_failed or r.kept == (2 * r.content_words >= r.n_words))
    by_id = {r.doc_id: r for r in got}
    for i, t in rows[:60]:
        lines = t.split("\n") if t else []
        assert by_id[i].content_words == sum(len(WORD.findall(lines[k])) for k in by_id[i].content_lines)
    assert C.label_lines(make_docs([]), field()).collect() == []


def score(f, x, labels):
    s = f.scores(x)
    total = f.start[labels[0]] + sum(s[i, y] for i, y in enumerate(labels))
    return total + sum(f.move[a, b] for a, b in zip(labels, labels[1:]))


def test_viterbi_and_likelihood_by_enumeration():
    rnd = np.random.default_rng(1)
    f = field()
    sizes = [3, 0, 1, 6, 2]
    x = rnd.normal(size=(sum(sizes), C.N_FEATURES))
    edge = np.cumsum([0, *sizes])
    got = C.viterbi(f, f.scores(x), edge)
    gold = rnd.integers(0, 2, len(x))
    total = 0.0
    for a, b in zip(edge[:-1], edge[1:]):
        if b > a:
            ways = {w: score(f, x[a:b], w) for w in itertools.product((0, 1), repeat=int(b - a))}
            assert tuple(got[a:b]) == max(ways, key=ways.get)
            total += ways[tuple(gold[a:b])] - np.log(sum(np.exp(v) for v in ways.values()))
    value, grad = C.likelihood(f, x, edge, gold)
    assert abs(value * len(x) - total) < 1e-9
    for k, part in enumerate((f.weights, f.start, f.move)):
        for i in np.ndindex(part.shape):
            old = part[i]
            part[i] = old + 1e-6
            up = C.likelihood(f, x, edge, gold)[0]
            part[i] = old - 1e-6
            down = C.likelihood(f, x, edge, gold)[0]
            part[i] = old
            assert abs((up - down) / 2e-6 - grad[k][i]) < 1e-6


def test_held_out_documents(spark):
    t = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    train, test = labels.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 1")
    f = C.train_on(t, train)
    got = C.label_lines(t, f).join(test, "doc_id").filter("not base_failed").collect()
    good, bad = [r for r in got if r.quality == 1], [r for r in got if r.quality == 0]
    assert sum(not r.kept for r in good) <= 0.01 * len(good)
    assert sum(r.kept for r in bad) <= 0.25 * max(4, len(bad))


def test_without_both_kinds_every_line_is_content(make_docs, spark):
    docs = make_docs([(1, "one two three four five six seven eight nine ten\n### &&&"), (2, None)])
    none = spark.createDataFrame([(9, 1), (None, 0), (1, None)], "doc_id long, quality int")
    f = C.train_on(docs, none)
    r = C.label_lines(docs, f).filter("doc_id = 1").first()
    assert r.kept and r.content_words == 12
    assert C.train(np.zeros((2, C.N_FEATURES)), np.array([0, 1, 2]), np.array([1, 1])).weights.shape == (C.N_FEATURES,)
    assert C.judge([None], pa.array([None], pa.string()), f, 0.5).column("kept").to_pylist() == [False]
