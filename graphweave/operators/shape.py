"""Shape extractor results and complete the structure of every chunk.

Works on the unexploded per-chunk row with array functions (no shuffle), then
explodes to the long ``entities`` / ``relationships`` tables. Per chunk:

* entity properties become ``{name: <name>, **properties}`` – a ``name`` property
  overrides the field and ``name`` is always the first key;
* a Document entity whose name is falsy or ``unknown`` is renamed to the document;
* a Document node is added unless any Document-typed entity was returned;
* a Chunk node (name, text, chunk_number, embedding when non-empty) is added unless
  a returned Chunk entity's *field* name equals the chunk name;
* ``chunk BELONGS_TO document`` is added unless that link or
  ``document CONTAINS chunk`` was returned;
* ``chunk MENTIONS entity`` (property ``chunk_number``) for every entity not typed
  Chunk/Document, without de-duplication;
* a failed chunk yields only Chunk, Document and BELONGS_TO; ``extraction_error``
  keeps the reason so a retry is a filter.

Position order inside a chunk: extracted entities, Document, Chunk; relationships:
extracted, BELONGS_TO, MENTIONS in entity order (fallback: Chunk then Document).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphweave import schemas
from graphweave.functions.once import once
from graphweave.functions.text import chunk_name as _chunk_name
from graphweave.functions.truth import truthy

def empty_props() -> Column:
    return F.expr(f"cast(map() as {schemas.PROPS})")


def _v(c: Column) -> Column:
    return c.cast("variant")


def set_prop(props: Column, key: str, value: Column) -> Column:
    """``props[key] = value`` keeping the key's position; new keys go last."""
    from graphweave.functions.truth import let

    def upd(p):
        return F.when(
            F.map_contains_key(p, F.lit(key)),
            F.transform_values(p, lambda k, v: F.when(k == F.lit(key), value).otherwise(v)),
        ).otherwise(F.map_concat(p, F.create_map(F.lit(key), value)))

    return let(props, upd)


def shape_properties(name: Column, properties: Column) -> Column:
    """``{"name": name, **properties}`` where a ``name`` property wins."""
    props = F.coalesce(properties, empty_props())
    given = F.map_contains_key(props, F.lit("name"))
    first = F.when(given, F.try_element_at(props, F.lit("name"))).otherwise(_v(name))
    return F.map_concat(F.create_map(F.lit("name"), first), F.map_filter(props, lambda k, v: k != F.lit("name")))


def _one_if(item: Column, cond: Column) -> Column:
    """``[item]`` when ``cond`` else ``[]`` with the same element type."""
    return F.filter(F.array(item), lambda _: cond)


def complete(
    results: DataFrame,
    embedding_col: str | None = None,
    name_col: str = "document_name",
) -> tuple[DataFrame, DataFrame]:
    """Long ``(entities, relationships)`` tables from per-chunk results.

    ``results`` needs ``path, document_name, chunk_number, text, result, error``."""
    return _exploded(_completed(results, embedding_col, name_col))


def chunk_counts(results: DataFrame, name_col: str = "document_name") -> DataFrame:
    """One row per chunk: ``path, document_name, chunk_number, n_entities, n_relationships`` of the
    completed lists. Both numbers come from one pass over ``results``, without a shuffle; the
    counts of a run (``stats``) are sums of them."""
    return _completed(results, None, name_col).select(
        "path", "document_name", "chunk_number",
        *[F.coalesce(F.size(c), F.lit(0)).cast("bigint").alias(n)
          for c, n in (("__ents", "n_entities"), ("__rels", "n_relationships"))],
    )


def _completed(results: DataFrame, embedding_col: str | None, name_col: str) -> DataFrame:
    """One row per chunk with its completed lists ``__ents`` and ``__rels``."""
    for stage in _stages(embedding_col, name_col):
        results = results.select(*stage)
    return results


@once
def _stages(embedding_col: str | None, name_col: str) -> tuple[list, list, list]:
    """The columns of three projections, each over the one before."""
    doc = F.col(name_col)
    cnum = F.col("chunk_number")
    cname = _chunk_name(doc, cnum)
    failed = F.col("error").isNotNull() | F.col("result").isNull()

    def ent(type_: Column, fname: Column, props: Column) -> Column:
        return F.struct(type_.alias("type"), fname.alias("fname"), props.alias("props"))

    def rel(s: Column, t: Column, type_: Column, props: Column) -> Column:
        return F.struct(s.alias("source"), t.alias("target"), type_.alias("type"), props.alias("props"))

    chunk_props = F.create_map(
        F.lit("name"), _v(cname), F.lit("text"), _v(F.col("text")), F.lit("chunk_number"), _v(cnum)
    )
    if embedding_col:
        emb = F.col(embedding_col)
        chunk_props = F.when(
            F.coalesce(F.size(emb) > 0, F.lit(False)),
            F.map_concat(chunk_props, F.create_map(F.lit("embedding"), _v(emb))),
        ).otherwise(chunk_props)
    doc_node = ent(F.lit("Document"), doc, F.create_map(F.lit("name"), _v(doc)))
    chunk_node = ent(F.lit("Chunk"), cname, chunk_props)

    def rename_document(e: Column) -> Column:
        nm = F.try_element_at(e["props"], F.lit("name"))
        bad = (e["type"] == "Document") & (
            ~truthy(nm) | F.coalesce(F.try_variant_get(nm, "$", "string") == "unknown", F.lit(False))
        )
        return F.when(bad, ent(e["type"], e["fname"], set_prop(e["props"], "name", _v(doc)))).otherwise(e)

    # Stage 1: shape the returned lists once (later steps read the columns; Spark
    # does not inline an expensive projection that is referenced several times).
    s1 = [
        "path",
        doc.alias("document_name"),
        cnum.cast("int").alias("chunk_number"),
        cname.alias("__cname"),
        failed.alias("__failed"),
        F.col("error"),
        chunk_node.alias("__chunk_node"),
        doc_node.alias("__doc_node"),
        F.transform(
            F.col("result.entities"),
            lambda e: rename_document(ent(e["type"], e["name"], shape_properties(e["name"], e["properties"]))),
        ).alias("__x"),
        F.transform(
            F.col("result.relationships"),
            lambda r: rel(r["source"], r["target"], r["type"], F.coalesce(r["properties"], empty_props())),
        ).alias("__gr"),
    ]
    cname1, doc1 = F.col("__cname"), F.col("document_name")
    x = F.col("__x")
    has_doc = F.exists(x, lambda e: e["type"] == "Document")
    has_chunk = F.exists(x, lambda e: (e["type"] == "Chunk") & (e["fname"] == cname1))
    has_link = F.exists(
        F.col("__gr"),
        lambda r: ((r["source"] == cname1) & (r["target"] == doc1) & (r["type"] == "BELONGS_TO"))
        | ((r["source"] == doc1) & (r["target"] == cname1) & (r["type"] == "CONTAINS")),
    )
    belongs = rel(cname1, doc1, F.lit("BELONGS_TO"), empty_props())
    # Stage 2: the completed entity list.
    s2 = [
        "path", "document_name", "chunk_number", "__cname", "__failed", "error", "__gr",
        F.when(F.col("__failed"), F.array(F.col("__chunk_node"), F.col("__doc_node")))
        .otherwise(F.concat(x, _one_if(F.col("__doc_node"), ~has_doc), _one_if(F.col("__chunk_node"), ~has_chunk)))
        .alias("__ents"),
        F.when(F.col("__failed"), F.array(belongs))
        .otherwise(F.concat(F.col("__gr"), _one_if(belongs, ~F.coalesce(has_link, F.lit(False)))))
        .alias("__rels0"),
    ]
    mentions = F.transform(
        F.filter(F.col("__ents"), lambda e: ~e["type"].isin("Chunk", "Document")),
        lambda e: rel(
            F.col("__cname"),
            F.try_variant_get(F.try_element_at(e["props"], F.lit("name")), "$", "string"),
            F.lit("MENTIONS"),
            F.create_map(F.lit("chunk_number"), _v(F.col("chunk_number"))),
        ),
    )
    s3 = [
        "path",
        "document_name",
        "chunk_number",
        "__ents",
        F.when(F.col("__failed"), F.col("__rels0")).otherwise(F.concat(F.col("__rels0"), mentions)).alias("__rels"),
        F.when(F.col("__failed"), F.coalesce(F.col("error"), F.lit("no result"))).alias("extraction_error"),
    ]
    return s1, s2, s3


def _exploded(staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    (ents, ent), (rels, rel), some = _explosion()
    # posexplode_outer: a plain posexplode makes Spark infer ``size(array) > 0`` and
    # push it below the projections, evaluating the whole extraction twice.
    return staged.select(*ents).where(some).select(*ent), staged.select(*rels).where(some).select(*rel)


@once
def _explosion() -> tuple[tuple[list, list], tuple[list, list], Column]:
    ents = ["path", "document_name", "chunk_number", "extraction_error", F.posexplode_outer("__ents").alias("pos", "e")]
    ent = [
        "path",
        "document_name",
        "chunk_number",
        F.col("pos").cast("int").alias("pos"),
        F.col("e.type").alias("type"),
        F.try_variant_get(F.try_element_at(F.col("e.props"), F.lit("name")), "$", "string").alias("name"),
        F.col("e.props").alias("props"),
        "extraction_error",
    ]
    rels = ["path", "document_name", "chunk_number", F.posexplode_outer("__rels").alias("pos", "r")]
    rel = [
        "path",
        "document_name",
        "chunk_number",
        F.col("pos").cast("int").alias("pos"),
        F.col("r.source").alias("source"),
        F.col("r.target").alias("target"),
        F.col("r.type").alias("type"),
        F.col("r.props").alias("props"),
    ]
    return (ents, ent), (rels, rel), F.col("pos").isNotNull()
