"""Plan shape checks and a few registered queries against DuckDB at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from graphweave.plans import views as V

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.limit(5).collect()
    assert df.columns == ["entity_key", "entity_name", "entity_type", "n_documents"]
    assert rows and rows[0].n_documents >= rows[-1].n_documents


def test_no_cartesian_products(spark):
    for name in ["merge_entities", "resolved_edges", "undirected_edges", "document_mentions", "vector_top_k", "run_summary"]:
        p = _plan(E.queries()[name](spark, SF))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_discovery_prunes_content(spark, tmpdir_path):
    from graphweave.sources import files

    open(tmpdir_path + "/a.txt", "w").write("x")
    p = files.discover(spark, tmpdir_path)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in p.split("ReadSchema:")[-1].split("\n")[0]


def test_extraction_runs_once_per_chunk(spark):
    # the size filter Spark infers for a plain explode must not drag the
    # extraction below the repartition (it would run twice)
    from graphweave.operators.extract import CONCEPT_RE, EMAIL_RE, IPV4_RE, LICENSE_RE

    e, _ = V.doc_graph(spark, SF)
    p = _plan(e).split("== Initial Plan ==")[0]
    for pattern in (CONCEPT_RE, LICENSE_RE, EMAIL_RE, IPV4_RE):
        assert p.count(pattern) == 1, pattern


@pytest.mark.parametrize("name", ["chunk_fixed", "extract_entities", "merge_entities", "repair_post_merge",
                                  "placeholder_text", "resolved_edges", "paths_1_3", "node_statements", "vector_top_k"])
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)

    def norm(cols, rows):
        idx = sorted(range(len(cols)), key=lambda i: cols[i])
        return sorted((tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in idx) for r in rows), key=repr)

    assert norm(df.columns, [tuple(r) for r in df.collect()]) == norm(ocols, orows)


def test_no_single_partition_exchange_in_merge_and_edges(spark):
    for name in ["merge_entities", "strict_edges", "resolved_edges", "name_nodes"]:
        df = E.queries()[name](spark, SF)
        df.write.format("noop").mode("overwrite").save()
        assert "SinglePartition" not in _plan(df), name
