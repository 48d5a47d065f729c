"""The extraction store.

Our store is a Parquet table of per-chunk results keyed ``(document_name,
content_md5, chunk_number)``; writing it is the durability boundary of a run
(extraction is costly and may be non-deterministic, so nothing downstream
recomputes it). Appends are idempotent because readers keep one row per key.

``read_records`` reads the per-document JSON records of the original cache format
(``{document_name, entities, relationships, extraction_time, total_chunks}``);
unreadable files become quarantine rows instead of stopping the run.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphweave import schemas

UNKNOWN_DOCUMENT = "unknown"  # a record without a document name
KEY = ["document_name", "content_md5", "chunk_number"]


def read_if_exists(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """A Parquet table, or None if its path does not exist. Spark is asked, so any store
    and a scheme-less path on a cluster's default store work; other faults are raised."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back."""
    from graphweave.session import scratch_dir

    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_store(results: DataFrame, store_path: str, run_id: str | None = None) -> None:
    """Write per-chunk results (``result`` struct + ``error``) with a timestamp.

    With a ``run_id`` the rows go to partition ``run_id=<id>`` with dynamic
    partition overwrite. Rows that the run stored before (it was retried, or its id is
    used again) stay, but for those of the same file, which the new ones replace: keys
    stay unique by construction and readers need no de-duplicating shuffle."""
    spark = results.sparkSession
    out = results.withColumn("extraction_time", F.current_timestamp())
    if run_id is None:
        out.write.mode("append").parquet(store_path)
        return
    earlier = read_if_exists(spark, store_path)
    if earlier is not None and "run_id" in earlier.columns:
        earlier = earlier.where(F.col("run_id").cast("string") == run_id).drop("run_id")
        if not earlier.isEmpty():
            # extraction is costly: it is written once, then compared; a partition that is
            # being replaced cannot be read at the same time, so what stays is written aside too
            out = written(out, "new-results")
            file = ["path"] if "path" in out.columns else [c for c in KEY if c in out.columns]
            out = out.unionByName(written(earlier.join(out.select(*file).distinct(), file, "left_anti"), "kept-results"),
                                  allowMissingColumns=True)
    (
        out.withColumn("run_id", F.lit(run_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(store_path)
    )


def read_store(spark: SparkSession, store_path: str, run_id: str | None = None, dedupe: bool = False) -> DataFrame:
    """Stored results. ``run_id`` reads one run (partition pruning, no shuffle);
    ``dedupe`` keeps one row per key across runs (latest write wins; one shuffle)."""
    s = spark.read.parquet(store_path)
    if run_id is not None:
        s = s.where(F.col("run_id") == run_id)
    if not dedupe:
        return s
    return (
        s.groupBy(*KEY)
        .agg(F.max_by(F.struct(*[c for c in s.columns if c not in KEY]), "extraction_time").alias("r"))
        .select(*KEY, "r.*")
    )


def read_records(spark: SparkSession, path: str, multiline: bool = True) -> tuple[DataFrame, DataFrame]:
    """JSON records (one object per file) → ``(entities, relationships,)`` long
    rows plus ``quarantine`` of corrupt files. Returns ``(records, quarantine)``."""
    raw = (
        spark.read.schema(schemas.RECORD)
        .option("multiLine", "true" if multiline else "false")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(path)
        .withColumn("source_file", F.input_file_name())
    )
    # Spark refuses to read the corrupt column alone, so a second column is looked at
    readable = F.coalesce(F.length("document_name"), F.lit(0)) >= 0
    bad = raw.where(F.col("_corrupt_record").isNotNull() & readable)
    good = raw.where(F.col("_corrupt_record").isNull() & readable).drop("_corrupt_record")
    good = good.withColumn("document_name", F.coalesce("document_name", F.lit(UNKNOWN_DOCUMENT)))
    return good, bad.select("source_file", "_corrupt_record")


def record_rows(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Long entity / relationship rows of JSON records; ``path`` = source file, the
    chunk number of an entity is unknown in this format (NULL), ``pos`` is the
    position in the record."""
    ents = records.select(
        F.col("source_file").alias("path"),
        "document_name",
        F.lit(None).cast("int").alias("chunk_number"),
        F.posexplode_outer("entities").alias("pos", "e"),
    ).where(F.col("pos").isNotNull())
    ents = ents.select(
        "path", "document_name", "chunk_number", F.col("pos").cast("int").alias("pos"),
        F.col("e.type").alias("type"),
        F.try_variant_get(F.try_element_at(F.col("e.properties"), F.lit("name")), "$", "string").alias("name"),
        F.coalesce(F.col("e.properties"), F.expr(f"cast(map() as {schemas.PROPS})")).alias("props"),
        F.lit(None).cast("string").alias("extraction_error"),
    )
    rels = records.select(
        F.col("source_file").alias("path"),
        "document_name",
        F.lit(None).cast("int").alias("chunk_number"),
        F.posexplode_outer("relationships").alias("pos", "r"),
    ).where(F.col("pos").isNotNull())
    rels = rels.select(
        "path", "document_name", "chunk_number", F.col("pos").cast("int").alias("pos"),
        "r.source", "r.target", "r.type",
        F.coalesce(F.col("r.properties"), F.expr(f"cast(map() as {schemas.PROPS})")).alias("props"),
    )
    return ents, rels


def split_cached(documents: DataFrame, store: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(hits, misses)`` of documents against stored ``(document_name,
    content_md5)``; hits reuse the stored extraction, misses are extracted."""
    keys = store.where(F.col("document_name").isNotNull()).select("document_name", "content_md5").distinct()
    return (
        documents.join(keys, ["document_name", "content_md5"], "left_semi"),
        documents.join(keys, ["document_name", "content_md5"], "left_anti"),
    )


def latest_only(
    store: DataFrame, time_col: str = "extraction_time", by: str = "document_name", version: str = "content_md5"
) -> DataFrame:
    """I4: keep only the newest version of every document (or path, with ``by``). Of versions
    with equal times the one that sorts last stays, so a rerun keeps the same."""
    newest = store.groupBy(by).agg(F.max_by(version, F.struct(time_col, version)).alias(version))
    return store.join(newest, [by, version], "left_semi")


def envelope(results: DataFrame) -> DataFrame:
    """Per-document record envelope of a run: ``document_name, path,
    content_md5, total_chunks, failed_chunks, entities, relationships,
    extraction_time`` (rows stay long; this is an aggregate over them)."""
    ents = F.coalesce(F.size("result.entities"), F.lit(0))
    rels = F.coalesce(F.size("result.relationships"), F.lit(0))
    cols = results.columns
    t = F.col("extraction_time") if "extraction_time" in cols else F.current_timestamp()
    return results.groupBy("document_name", "path", *(["content_md5"] if "content_md5" in cols else [])).agg(
        F.count("*").cast("bigint").alias("total_chunks"),
        F.count_if(F.col("error").isNotNull()).cast("bigint").alias("failed_chunks"),
        F.sum(ents).cast("bigint").alias("entities"),
        F.sum(rels).cast("bigint").alias("relationships"),
        F.max(t).alias("extraction_time"),
    )
