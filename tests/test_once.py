"""Columns of a micro-batch are built once, whatever number of batches takes them."""

from pyspark.sql import functions as F

from graphweave.functions.once import once
from graphweave.operators import chunking, extract, merge, shape
from rows import entity_rows


def test_once_calls_for_each_argument(spark):
    calls = []

    @once
    def named(name):
        calls.append(name)
        return F.col(name)

    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert [df.select(named(n)).first()[0] for n in "aba"] == [1, 2, 1]
    assert calls == ["a", "b"]


def test_a_batch_builds_no_expression_again(spark, monkeypatch):
    docs = spark.createDataFrame([("f", "d", "m", "Anna Smith met Bob Brown. anna@x.org 10.0.0.1")],
                                 "path string, document_name string, content_md5 string, text string")

    def state():
        ents, rels = shape.complete(extract.extract(chunking.chunk(docs, 20, 5)))
        rows, _ = merge.prepare(ents)
        folded = merge.fold(rows).select("entity_key", "prop", F.to_json("t_value").alias("v"))
        return sorted(folded.collect(), key=str), rels.count()

    first = state()
    calls = []
    for name in ("transform", "when", "create_map", "min_by", "schema_of_variant"):
        f = getattr(F, name)
        monkeypatch.setattr(F, name, lambda *a, _f=f, _n=name, **k: (calls.append(_n), _f(*a, **k))[1])
    assert state() == first and first[1] > 0
    assert calls == []


def test_folds_of_other_orders_keep_their_types(spark):
    rows = merge.prepare(entity_rows(spark, [("f", "d", 0, 0, "Chunk", '{"name": "c", "text": "x"}')]))[0]
    one = merge.fold(rows)
    two = merge.fold(rows.withColumn("seq", F.lit(7).cast("bigint")), ("seq", "pos"))
    assert two.schema["t_ord"].dataType.names == ["seq", "pos"] and one.schema["t_ord"].dataType.names == list(merge.DEFAULT_ORD)
    assert merge.render(two).first().first_ord.seq == 7
