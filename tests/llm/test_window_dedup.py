import hashlib
import random
import re

from graphweave.llm import window_dedup as W

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    """Every window of every document in order, with a set of those met before."""
    met, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        words = WORD.findall(t or "")
        gone = set()
        for k in range(len(words) - window + 1):
            key = tuple(words[k : k + window])
            if key in met:
                gone.update(range(k, k + window))
            met.add(key)
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def digest(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def corpus(seed, n=60):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["é", "ß.", " x"]
    passage = [[rnd.choice(vocab) for _ in range(rnd.choice([19, 20, 21, 40, 90]))] for _ in range(6)]
    rows = []
    for i in range(n):
        words = [rnd.choice(vocab) for _ in range(rnd.randrange(0, 60))]
        for _ in range(rnd.randrange(3)):
            words += rnd.choice(passage) + [rnd.choice(vocab)]
        rows.append((rnd.randrange(10_000), rnd.choice([" ", "\n", "  \t"]).join(words)))
    rows += [(20_000 + k, rows[0][1]) for k in range(3)]  # exact copies
    rows += [(30_000, "a " * 300), (30_001, "a b " * 90), (30_002, ""), (30_003, None), (30_004, "\n \t")]
    rows += [(None, rows[5][1]), (rows[1][0], rows[1][1]), (rows[1][0], rows[2][1])]  # null and repeated ids
    return rows


def test_equals_brute_force(make_docs):
    for seed in range(2):
        rows = corpus(seed)
        assert digest(W.repeated_windows_digest(make_docs(rows))) == brute(rows, 20)


def test_other_lengths_and_many_blocks(make_docs, monkeypatch):
    monkeypatch.setattr(W, "block_count", lambda docs, text: 7)
    rows = corpus(7)
    for window, levels in [(1, 3), (3, 3), (7, 2), (25, 4)]:
        res = W.remove_repeated_windows(make_docs(rows), window, levels)
        got = sorted(((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest())
                      for r in res.collect()), key=repr)
        assert got == brute(rows, window)


def test_empty_table_and_lengths(make_docs):
    assert W.repeated_windows_digest(make_docs([])).collect() == []
    assert W.level_lengths(20) == [5, 10, 20]
    assert W.level_lengths(1) == [1]


def test_cut_documents_keeps_columns_layout_and_rows(spark, make_docs):
    shared = " ".join(f"p{i}" for i in range(30))
    docs = make_docs([(1, f"start\n{shared}\nend"), (2, f"other,\n\n{shared} tail\n"), (3, shared), (4, None), (5, "")])
    docs = docs.withColumn("block", docs.doc_id * 0).withColumn("row", docs.lang)  # clashing names
    got = {r.doc_id: r for r in W.cut_documents(docs).collect()}
    assert W.cut_documents(docs).columns == docs.columns
    assert got[1].text == f"start\n{shared}\nend"
    assert got[2].text == "other,\n\ntail\n" and got[2].n_chars == len("other,\n\ntail\n")
    assert 3 not in got  # nothing of it is left
    assert got[4].text is None and got[5].text == "" and got[5].source == "s1"
