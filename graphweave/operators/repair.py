"""Filling chunk text that went missing.

* ``pre_merge`` (J3): a Chunk row with a chunk number and no truthy text takes the
  last truthy text of a Chunk row with the same record ``document_name`` and the
  same chunk number value (``3`` and ``"3"`` are different numbers).
* ``post_merge`` (J4): a merged Chunk node without truthy text whose name splits on
  ``_chunk_`` into exactly two pieces looks up ``(piece 0, int(piece 1))`` among
  Chunk rows that *have* a ``text`` key (even empty); the last such row wins.
* ``chunk_number`` (P19) and ``placeholder`` (P20) run when statements are rendered.

Both repairs are an aggregate (shuffle on document and number) joined to the
rows that need it; rows that need nothing skip the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphweave.functions.truth import truthy, variant_kind
from graphweave.operators.merge import DEFAULT_ORD, _ord
from graphweave.operators.shape import set_prop

# Fixed value: placeholder for chunks that still have no text.
PLACEHOLDER = "Text for chunk {n} (needs repair)"


def _prop(name: str) -> Column:
    return F.try_element_at(F.col("props"), F.lit(name))


def _number_key(v: Column) -> Column:
    """Lookup key of a chunk-number value: JSON text, so 3 and "3" differ."""
    return F.when(v.isNotNull() & ~F.is_variant_null(v), F.to_json(v))


def pre_merge(entities: DataFrame, ord_cols=DEFAULT_ORD) -> DataFrame:
    """Entities with missing Chunk texts filled; adds ``repaired`` (BOOLEAN)."""
    o = _ord(ord_cols)
    is_chunk = F.col("type") == "Chunk"
    nkey = _number_key(_prop("chunk_number"))
    text_ok = truthy(_prop("text"))
    needs = is_chunk & nkey.isNotNull() & ~text_ok
    fine = entities.where(~needs).withColumn("repaired", F.lit(False))
    todo = entities.where(needs).withColumn("__nkey", nkey)
    wanted = todo.select("document_name", "__nkey").distinct()
    # only chunk rows whose key is wanted feed the aggregate: with few rows to
    # repair AQE broadcasts ``wanted`` and no chunk text is shuffled at all
    lookup = (
        entities.where(is_chunk & nkey.isNotNull() & text_ok)
        .select("document_name", nkey.alias("__nkey"), o.alias("__ord"), _prop("text").alias("__text"))
        .join(wanted, ["document_name", "__nkey"], "left_semi")
        .groupBy("document_name", "__nkey")
        .agg(F.max_by("__text", "__ord").alias("__fill"))
    )
    todo = todo.join(lookup, ["document_name", "__nkey"], "left")
    fixed = (
        todo.withColumn("repaired", F.col("__fill").isNotNull())
        .withColumn(
            "props", F.when(F.col("__fill").isNotNull(), set_prop(F.col("props"), "text", F.col("__fill"))).otherwise(F.col("props"))
        )
        .drop("__nkey", "__fill")
    )
    return fine.unionByName(fixed)


def post_merge(nodes: DataFrame, entities: DataFrame, ord_cols=DEFAULT_ORD) -> DataFrame:
    """Merged nodes with Chunk texts recovered by name; adds ``repaired``."""
    o = _ord(ord_cols)
    cn = _prop("chunk_number")
    lookup_rows = (
        entities.where(
            (F.col("type") == "Chunk")
            & cn.isNotNull()
            & ~F.is_variant_null(cn)
            & (variant_kind(cn) == "number")
            & F.map_contains_key(F.col("props"), F.lit("text"))
        )
        .select(
            F.col("document_name").alias("__doc"),
            F.to_json(cn).alias("__num"),
            o.alias("__ord"),
            _prop("text").alias("__text"),
        )
    )
    parts = F.split(F.col("name"), "_chunk_", -1)
    num = F.try_element_at(parts, F.lit(2)).try_cast("int")
    needs = (
        (F.col("type") == "Chunk")
        & ~truthy(_prop("text"))
        & F.coalesce(F.col("name").contains("_chunk_"), F.lit(False))
        & (F.size(parts) == 2)
        & num.isNotNull()
    )
    fine = nodes.where(~F.coalesce(needs, F.lit(False))).withColumn("repaired", F.lit(False))
    todo = nodes.where(F.coalesce(needs, F.lit(False))).select(
        "*", F.try_element_at(parts, F.lit(1)).alias("__doc"), num.cast("string").alias("__num")
    )
    wanted = todo.select("__doc", "__num").distinct()
    lookup = (
        lookup_rows.join(wanted, ["__doc", "__num"], "left_semi")
        .groupBy("__doc", "__num")
        .agg(F.max_by("__text", "__ord").alias("__fill"))
    )
    fixed = (
        todo.join(lookup, ["__doc", "__num"], "left")
        .withColumn("repaired", F.col("__fill").isNotNull())
        .withColumn(
            "props", F.when(F.col("__fill").isNotNull(), set_prop(F.col("props"), "text", F.col("__fill"))).otherwise(F.col("props"))
        )
        .drop("__doc", "__num", "__fill")
    )
    return fine.unionByName(fixed)


def chunk_number(nodes: DataFrame) -> DataFrame:
    """A Chunk node without a chunk number gets ``int(name.split('_chunk_')[1])``
    when that parses (any number of pieces; only the second one is read)."""
    cn = _prop("chunk_number")
    missing = cn.isNull() | F.is_variant_null(cn)
    parsed = F.try_element_at(F.split(F.col("name"), "_chunk_", -1), F.lit(2)).try_cast("int")
    cond = (F.col("type") == "Chunk") & missing & F.col("name").contains("_chunk_") & parsed.isNotNull()
    return nodes.withColumn(
        "props", F.when(F.coalesce(cond, F.lit(False)), set_prop(F.col("props"), "chunk_number", parsed.cast("variant"))).otherwise(F.col("props"))
    )


def _python_str(v: Column) -> Column:
    kind = variant_kind(v)
    return (
        F.when(kind == "null", F.lit("None"))
        .when(kind == "string", F.try_variant_get(v, "$", "string"))
        .when(kind == "bool", F.initcap(v.cast("string")))
        .otherwise(v.cast("string"))
    )


def placeholder(nodes: DataFrame) -> DataFrame:
    """P20: a Chunk node still without truthy text gets the placeholder text."""
    pre, post = PLACEHOLDER.split("{n}")
    text = F.concat(F.lit(pre), _python_str(_prop("chunk_number")), F.lit(post))
    cond = (F.col("type") == "Chunk") & ~truthy(_prop("text"))
    return nodes.withColumn(
        "props", F.when(cond, set_prop(F.col("props"), "text", text.cast("variant"))).otherwise(F.col("props"))
    )
