import numpy as np
import pyarrow as pa

from graphweave.llm import weak_labels as Q


def test_label_model_recovers_accuracies():
    rnd = np.random.default_rng(0)
    n, hit = 20_000, np.array([0.9, 0.6, 0.7, 0.5])
    bad = rnd.random(n) < 0.2
    votes = np.where(bad[:, None], rnd.random((n, 4)) < hit, rnd.random((n, 4)) < 0.002)
    votes = np.where(votes, Q.BAD, Q.GOOD).astype(np.int8)
    votes[rnd.random((n, 4)) < 0.1] = Q.ABSTAIN
    pat, inv, cnt = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    post, table = Q.label_model(pat, cnt.astype(float))
    assert ((post[inv.reshape(-1)] < 0.5) == bad).mean() > 0.98
    assert np.abs(table[:, 0, Q.BAD] - hit).max() < 0.05
    silent, _ = Q.label_model(np.full((1, 4), Q.ABSTAIN, np.int8), np.array([5.0]))
    assert silent[0] > 0.5


def test_scorer_separates_and_is_a_mean_over_words():
    good, bad = "plain words stand here, and more of them.", "BUY!! NOW!! BUY!! NOW!!"
    texts = pa.array([good, bad] * 50 + [None, "", " "])
    target = np.array([0.99, 0.01] * 50 + [0.5] * 3)
    w, b = Q.fit_scorer(texts, target)
    s = Q.Batch(texts).scores(w, b)
    assert s[0] > 0.9 and s[1] < 0.1 and (s[-3:] == 0).all()
    f = Q.Batch(texts).features()[: len(good.split())]
    z = w[f].sum(axis=1).mean() + b
    assert abs(1 / (1 + np.exp(-z)) - s[0]) < 1e-9


def test_votes_by_hand():
    prose = "The quick brown fox jumps over the lazy dog. Then it sleeps, and all is well again."
    rows = ["", None, "a b", prose, "BUY!! NOW!! IT!! IS!! GOOD!! HERE!!", "x x x x x x x y y y y y y y", "a | b | c | d | e | f | g"]
    v = dict(zip(range(len(rows)), Q.Batch(pa.array(rows)).votes()))
    name = Q.LABELLERS.index
    assert (v[0] == Q.ABSTAIN).all() and (v[1] == Q.ABSTAIN).all() and (v[2] == Q.ABSTAIN).all()
    assert Q.BAD not in v[3]
    assert v[4][name("shouting")] == Q.BAD and v[4][name("capitals")] == Q.BAD
    assert v[5][name("stutter")] == Q.BAD and v[6][name("pipes")] == Q.BAD


def test_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")  # only to judge: no label trains
    got = Q.classify(docs).select("row.doc_id", "kept").join(labels, "doc_id").collect()
    good, bad = [r for r in got if r.quality == 1], [r for r in got if r.quality == 0]
    assert sum(not r.kept for r in good) <= 0.005 * len(good)
    assert sum(r.kept for r in bad) <= 0.1 * len(bad)


def test_odd_rows(make_docs):
    prose = "The quick brown fox jumps over the lazy dog. Then it sleeps, and all is well again."
    docs = make_docs([(1, prose), (None, prose), (2, None), (3, ""), (4, prose), (4, prose)])
    docs = docs.withColumn("row", docs.lang).withColumn("score", docs.source).withColumn("kept", docs.lang)
    got = Q.keep_good(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got.collect()) == [(False, 1), (False, 4), (False, 4), (True, 0)]
    assert Q.classify(make_docs([])).collect() == []
    assert Q.classify(make_docs([(None, prose)])).first().score >= 0  # nothing to train on


def test_texts_under_one_id_meet_their_own_votes(make_docs):
    good = "This is a plain sentence about the weather, and it reads well. Another one follows it here. "
    rows = [(7, good * (1 + i % 9) + f"Note {i}.") for i in range(60)] + [(7, "$$ ## || " * (1 + i)) for i in range(60)]
    rows += [(7, rows[0][1])] * 30 + [(100 + i, good + str(i)) for i in range(40)]
    docs = make_docs(rows)
    votes = Q.heuristic_votes(docs)
    assert votes.distinct().count() == 160  # one row per text, whatever the id
    found = Q.training_rows(docs, votes, 1000).collect()
    own = {r.text: r.votes for r in found}
    assert len(found) == len(own) == 160
    texts = list(own)
    marks = (Q.Batch(pa.array(texts)).votes() + 48).astype(np.uint8)
    assert [own[t] for t in texts] == [m.tobytes().decode() for m in marks]
    assert Q.training_rows(docs, votes, 20).count() == 20
    assert Q.train(docs, sample=50) is not None
