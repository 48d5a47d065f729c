"""Small entity and relationship tables for tests."""

from pyspark.sql import functions as F


def entity_rows(spark, rows):
    """rows: (path, document_name, chunk_number, pos, type, props_json)."""
    df = spark.createDataFrame(
        rows, "path string, document_name string, chunk_number int, pos int, type string, j string"
    )
    props = F.from_json("j", "map<string,variant>")
    return df.select(
        "path", "document_name", "chunk_number", "pos", "type",
        F.try_variant_get(F.try_element_at(props, F.lit("name")), "$", "string").alias("name"),
        props.alias("props"),
    )


def rel_rows(spark, rows):
    """rows: (path, document_name, chunk_number, pos, source, target, type)."""
    df = spark.createDataFrame(
        rows, "path string, document_name string, chunk_number int, pos int, source string, target string, type string"
    )
    return df.withColumn("props", F.expr("cast(map() as map<string,variant>)"))
