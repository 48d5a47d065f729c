import pytest

import __spark_entry__ as entry
import corpus_pipeline as P
from graphweave.llm import jaccard_join, packing, queries, weak_labels

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
PROSE = "Plain prose stands in {0} and tells of {0} how things went, one after another, until the day of {0} was over."


@pytest.fixture()
def docs(make_docs):
    topics = ["spring", "the river", "a house", "old friends", "the harbour", "winter light", "a long road", "bread", "the hill", "music"]
    rows = []
    for k, t in enumerate(topics * 3):
        words = PROSE.format(t).split()
        rows.append((k, " ".join(words[i % len(words)] + f"{t[-1]}{k}{i}" for i in range(60)) + "."))
    shared = " ".join(f"quoted{i}" for i in range(30))
    rows += [(100, rows[4][1]), (101, rows[5][1] + " tail"), (102, rows[6][1] + "\n" + shared), (103, shared + "\n" + rows[7][1][::-1])]
    rows += [(200 + i, "BUY!! NOW!! THE!! BEST!! OF!! ALL!! DEALS!! HERE!!") for i in range(4)] + [(300, None), (301, "")]
    return make_docs(rows)


def test_stages_work_on_what_their_predecessor_kept(spark, docs):
    assert [n for n, _ in P.STAGES] == ["quality classifier", "n-gram Jaccard join", "substring dedup", "mixing sources", "best-fit packing"]
    d = docs
    kept = []
    for _, stage in P.STAGES[:-1]:
        d = spark.createDataFrame(stage(spark, d, "").collect(), docs.schema)
        assert d.columns == COLUMNS
        kept.append({r.doc_id: r.text for r in d.collect()})
    good, one, cut, mixed = kept
    clean = set(range(30))
    assert clean <= set(good) and not set(good) & {200, 201, 202, 203, 300, 301}
    assert set(good) - set(one) == {100, 101}
    assert set(cut) == set(one) and cut[102].startswith("quoted0 ") and cut[103] != one[103] and cut[6] == one[6]
    assert sum("quoted7 " in (t or "") for t in cut.values()) == 1
    assert set(mixed) == set(cut) and mixed == cut
    pieces = P.STAGES[-1][1](spark, d, "").collect()
    assert {p.doc_id for p in pieces} == set(mixed)
    assert all(p.length == len(p.ids) for p in pieces)


def test_registered_queries():
    q = entry.queries()
    ours = [n for n in q if n.startswith("op")]
    assert [n.split("_")[0] for n in ours] == [f"op{i}" for i in range(1, 14)] and "pipeline" in q
    assert set(queries.SQL) <= set(ours)
    assert all(m.__doc__ for m in (jaccard_join, packing, weak_labels, P))


def test_empty_documents(spark, make_docs):
    d = make_docs([])
    for _, stage in P.STAGES[:-1]:
        d = stage(spark, d, "")
        assert d.columns == COLUMNS and d.collect() == []
    assert P.STAGES[-1][1](spark, d, "").collect() == []
