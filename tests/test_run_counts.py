"""Counts of a run: from chunk counts in one pass, equal to the counts of the exploded tables."""

from pyspark.sql import functions as F

from graphweave.operators import extract, merge, shape, stats

ROWS = [
    ("p/a.txt", "a", 0, "Ann works for Acme Corp in Berlin.", None),
    ("p/a.txt", "a", 1, "", None),
    ("p/b.txt", "b", 0, "Bob works for Acme Corp.", None),
    ("p/b.txt", "b", 0, "Bob works for Acme Corp.", None),  # a repeated chunk
    ("q/a.txt", "a", 0, "Ann knows Bob.", None),  # same stem elsewhere
    ("p/c.txt", "c", 0, None, None),
]


def results(spark, rows):
    df = spark.createDataFrame(rows, "path string, document_name string, chunk_number int, text string, content_md5 string")
    return extract.extract(df.withColumn("chunk_name", F.concat_ws("_chunk_", "document_name", F.col("chunk_number").cast("string"))))


def as_set(df):
    return sorted(tuple(sorted(r.asDict().items())) for r in df.collect())


def test_counts_equal_those_of_the_tables(spark):
    res = results(spark, ROWS)
    ents, rels = shape.complete(res)
    counts = shape.chunk_counts(res)
    assert as_set(stats.per_document_counts(counts)) == as_set(stats.per_document(ents, rels))
    nodes = merge.merge_entities(ents)
    assert as_set(stats.run_counts(counts, nodes)) == as_set(stats.run_summary(res, ents, rels, nodes))


def test_empty_run_counts_zero(spark):
    res = results(spark, ROWS).where("false")
    counts = shape.chunk_counts(res)
    assert stats.per_document_counts(counts).collect() == []
    got = stats.run_counts(counts, merge.merge_entities(shape.complete(res)[0])).first().asDict()
    assert got == {"files": 0, "chunks": 0, "entity_rows": 0, "nodes": 0, "relationships": 0}


def test_extraction_is_in_the_plan_once(spark):
    plan = stats.per_document_counts(shape.chunk_counts(results(spark, ROWS)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ExistingRDD") + plan.count("LocalTableScan") == 1
