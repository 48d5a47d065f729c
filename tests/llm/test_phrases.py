import random
import re
from collections import Counter, defaultdict

import pytest

from graphweave.llm import phrases as P


def brute(rows, least, top=2000):
    f = defaultdict(Counter)
    n = Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        often = {p: a for p, a in c.items() if a >= least}
        longer = Counter()
        for p, a in often.items():
            if len(p) > 2:
                for i in range(len(p)):
                    for j in range(i + 2, len(p) + 1):
                        if j - i < len(p):
                            longer[p[i:j]] = max(longer[p[i:j]], a)
        got = []
        for p, a in often.items():
            if len(p) > 1 and not longer[p] >= a:
                s, k = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                got.append((-s, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for r, (s, a, p, x, y) in enumerate(sorted(got)[:top]):
            out.append((lang, r + 1, p.decode(), -a, x, y, n[lang], -s))
    return sorted(out)


def corpus(seed, n=300):
    rnd = random.Random(seed)
    vocab = ["der", "die", "Ünd", "a-b", "x", "New", "york", "city", "of", "the", *(f"w{i}" for i in range(60))]
    fixed = [["New", "york", "city"], ["of", "the", "x", "of", "the"], ["w1", "w2", "w3", "w4", "w5", "w6"]]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rnd.choice([0, 3, 20, 60])):
            words += rnd.choice(fixed) if rnd.random() < 0.2 else [rnd.choice(vocab)]
            if rnd.random() < 0.1:
                words[-1] += rnd.choice([".", ",", "!", "\n", "\x0b", ":"])
        rows.append((rnd.choice([" ", "  ", "\t"]).join(words), rnd.choice(["en", "de", None, "en"])))
    return rows


def frame(spark, rows, ids=lambda i: i):
    return spark.createDataFrame([(ids(i), t, g) for i, (t, g) in enumerate(rows)], "doc_id long, text string, lang string")


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("seed,least,top", [(1, 20, 2000), (2, 8, 7)])
def test_matches_counting_everything(spark, seed, least, top):
    rows = corpus(seed)
    assert got(P.collocations(frame(spark, rows), least, top)) == brute(rows, least, top)


def test_whatever_the_sample_proposes(spark, monkeypatch):
    """A sample of nothing leaves every length to an expansion pass of its own."""
    rows = corpus(5)
    want = brute(rows, 15)
    monkeypatch.setattr(P, "SAMPLE", 10**9)
    assert got(P.collocations(frame(spark, rows), 15)) == want


def test_odd_rows(spark):
    long = "very long text of the " * 15000
    rows = [(None, "en"), ("", "en"), (" .\n", None), (long, "en"), ("a b. a b", None), ("A B", "und"), ("a\x00b \x00", "fr")] * 3
    assert got(P.collocations(frame(spark, rows, lambda i: None if i % 2 else 7), 3)) == brute(rows, 3)


def test_empty_and_clashing_columns(spark):
    assert P.collocations(frame(spark, [])).count() == 0
    rows = [("one two three", "en")] * 9
    d = frame(spark, rows).selectExpr("*", "1 as salt", "2 as key", "3 as phrase", "4 as n", "5 as pick", "6 as count")
    assert got(P.collocations(d, 5)) == brute(rows, 5)


def test_score_passes_64_bits(spark):
    """The products are decimals: counts near 2^40 would overflow longs."""
    from pyspark.sql import functions as F

    r = spark.createDataFrame([(2**40, 2**41, 2**42, 2**60)], "a long, l long, r long, n long")
    wide = {c: F.col(c).cast("decimal(19,0)") for c in "alrn"}
    r = r.withColumn("above", wide["a"] * wide["n"] * F.lit(1000)).withColumn("below", wide["l"] * wide["r"])
    assert r.select(F.expr("above div below")).first()[0] == 1000 * 2**40 * 2**60 // (2**41 * 2**42)
