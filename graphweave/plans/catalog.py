"""Registered queries: one Spark plan per operator of the blueprint, each paired
with an equivalent DuckDB SQL text when one exists.

Every query reads the driver tables (or data Spark derives from them) in full.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphweave.functions.literals import MAX_LITERAL_CHARS, literal, string_literal
from graphweave.operators import edges, export, extract, graph, merge, repair, shape
from graphweave.plans import oracle as O
from graphweave.plans import views as V
from graphweave.plans.build import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return deco


def _md5(c) -> F.Column:
    return F.md5(c)


# ---------------------------------------------------------------------------
# P1/P2 chunking
# ---------------------------------------------------------------------------


@register(
    "chunk_fixed",
    O.with_(O.DOC_FILES, O.DOC_CHUNKS)
    + "SELECT document_name, chunk_number, chunk_name, length(text)::BIGINT AS chunk_chars, md5(text) AS chunk_md5 FROM doc_chunks",
)
def chunk_fixed(spark, sf):
    c = V.doc_chunks(spark, sf)
    return c.select(
        "document_name", "chunk_number", "chunk_name",
        F.char_length("text").cast("bigint").alias("chunk_chars"), _md5("text").alias("chunk_md5"),
    )


@register(
    "chunk_names",
    O.with_(O.DOC_FILES, O.DOC_CHUNKS)
    + "SELECT document_name, count(*)::BIGINT AS n_chunks, arg_max(chunk_name, chunk_number) AS last_chunk "
    "FROM doc_chunks GROUP BY document_name",
)
def chunk_names(spark, sf):
    c = V.doc_chunks(spark, sf)
    return c.groupBy("document_name").agg(
        F.count("*").cast("bigint").alias("n_chunks"), F.max_by("chunk_name", "chunk_number").alias("last_chunk")
    )


# ---------------------------------------------------------------------------
# P4-P6 extraction
# ---------------------------------------------------------------------------


def _doc_entities(spark, sf):
    return V.doc_graph(spark, sf)[0]


def _doc_rels(spark, sf):
    return V.doc_graph(spark, sf)[1]


@register(
    "extract_entities",
    O.with_(O.DOC_FILES, O.DOC_CHUNKS, O.hits("doc_chunks"))
    + "SELECT chunk_name, pos, type, name, prop_keys FROM ents",
)
def extract_entities(spark, sf):
    e = _doc_entities(spark, sf).where(~F.col("type").isin("Chunk", "Document"))
    return e.select(
        F.concat(F.col("document_name"), F.lit("_chunk_"), F.col("chunk_number")).alias("chunk_name"),
        "pos", "type", "name", F.array_join(F.map_keys("props"), ",").alias("prop_keys"),
    )


@register(
    "extract_relationships",
    O.with_(O.DOC_FILES, O.DOC_CHUNKS, O.hits("doc_chunks"))
    + "SELECT chunk_name, pos, source, target, type FROM rule_rels",
)
def extract_relationships(spark, sf):
    r = _doc_rels(spark, sf).where(F.col("type").isin("RELATED_TO", "WORKS_FOR"))
    return r.select(
        F.concat(F.col("document_name"), F.lit("_chunk_"), F.col("chunk_number")).alias("chunk_name"),
        "pos", "source", "target", "type",
    )


# ---------------------------------------------------------------------------
# P7-P12 completion (conversations: conv = document, turn = chunk number)
# ---------------------------------------------------------------------------

_CONV_ENTS = (
    O.with_(O.CONV_CHUNKS, O.hits("(SELECT * FROM conv_chunks WHERE role <> 'system')"))
    + """, all_ents AS (
  SELECT c.document_name, c.chunk_number, e.pos, e.type, e.name, e.prop_keys, NULL AS extraction_error
  FROM ents e JOIN conv_chunks c USING (chunk_name)
  UNION ALL
  SELECT c.document_name, c.chunk_number, coalesce(n.ne, 0)::INTEGER, 'Document', c.document_name, 'name', NULL
  FROM conv_chunks c LEFT JOIN nents n USING (chunk_name) WHERE c.role <> 'system'
  UNION ALL
  SELECT c.document_name, c.chunk_number, (coalesce(n.ne, 0) + 1)::INTEGER, 'Chunk', c.chunk_name, 'name,text,chunk_number', NULL
  FROM conv_chunks c LEFT JOIN nents n USING (chunk_name) WHERE c.role <> 'system'
  UNION ALL
  SELECT document_name, chunk_number, 0, 'Chunk', chunk_name, 'name,text,chunk_number', 'extractor unavailable'
  FROM conv_chunks WHERE role = 'system'
  UNION ALL
  SELECT document_name, chunk_number, 1, 'Document', document_name, 'name', 'extractor unavailable'
  FROM conv_chunks WHERE role = 'system')
"""
)


def _conv_graph(spark, sf):
    return shape.complete(V.conv_results(spark, sf))


@register("complete_chunks_entities", _CONV_ENTS + "SELECT document_name, chunk_number, pos, type, name, prop_keys FROM all_ents")
def complete_chunks_entities(spark, sf):
    e = _conv_graph(spark, sf)[0]
    return e.select(
        "document_name", "chunk_number", "pos", "type", "name",
        F.array_join(F.map_keys("props"), ",").alias("prop_keys"),
    )


@register(
    "fallback_rows",
    _CONV_ENTS + "SELECT document_name, chunk_number, pos, type, name, extraction_error FROM all_ents WHERE extraction_error IS NOT NULL",
)
def fallback_rows(spark, sf):
    e = _conv_graph(spark, sf)[0]
    return e.where(F.col("extraction_error").isNotNull()).select(
        "document_name", "chunk_number", "pos", "type", "name", "extraction_error"
    )


@register(
    "complete_chunks_edges",
    O.with_(O.CONV_CHUNKS, O.hits("(SELECT * FROM conv_chunks WHERE role <> 'system')"))
    + """
SELECT c.document_name, c.chunk_number, r.pos, r.source, r.target, r.type
FROM rule_rels r JOIN conv_chunks c USING (chunk_name)
UNION ALL
SELECT c.document_name, c.chunk_number, CASE WHEN c.role = 'system' THEN 0 ELSE coalesce(n.nr, 0) END::INTEGER,
       c.chunk_name, c.document_name, 'BELONGS_TO'
FROM conv_chunks c LEFT JOIN nrels n USING (chunk_name)
UNION ALL
SELECT c.document_name, c.chunk_number, (coalesce(n.nr, 0) + 1 + e.pos)::INTEGER, c.chunk_name, e.name, 'MENTIONS'
FROM ents e JOIN conv_chunks c USING (chunk_name) LEFT JOIN nrels n USING (chunk_name)
""",
)
def complete_chunks_edges(spark, sf):
    r = _conv_graph(spark, sf)[1]
    return r.select("document_name", "chunk_number", "pos", "source", "target", "type")


@register(
    "enforce_types",
    O.with_(O.DOC_FILES, O.DOC_CHUNKS, O.hits("doc_chunks"))
    + """
SELECT type, count(*)::BIGINT AS n FROM (
  SELECT type FROM ents WHERE type IN ('Person', 'Organization', 'Location')
  UNION ALL SELECT 'Chunk' FROM doc_chunks
  UNION ALL SELECT 'Document' FROM doc_chunks) GROUP BY type
""",
)
def enforce_types(spark, sf):
    e = extract.enforce_types(_doc_entities(spark, sf), ["Person", "Organization", "Location"], mode="drop")
    return e.groupBy("type").agg(F.count("*").cast("bigint").alias("n"))


# ---------------------------------------------------------------------------
# P14/P15/A1 merge
# ---------------------------------------------------------------------------

_CONCEPTS = (
    O.with_(O.DOC_FILES, O.DOC_CHUNKS, O.hits("doc_chunks"))
    + """, concept_rows AS (
  SELECT c.path, c.chunk_number, e.pos, c.document_name,
         CASE c.doc_id % 3 WHEN 0 THEN replace(upper(replace(e.name, 'ß', '¤')), '¤', 'ß') WHEN 1 THEN lower(e.name) ELSE e.name END AS name
  FROM ents e JOIN doc_chunks c USING (chunk_name) WHERE e.type = 'Concept'),
keyed AS (SELECT *, """
    + O.key("'Concept'", "name")
    + """ AS entity_key FROM concept_rows)
"""
)


@register(
    "entity_keys",
    _CONCEPTS + "SELECT entity_key, count(*)::BIGINT AS n_rows, count(DISTINCT document_name)::BIGINT AS n_documents FROM keyed GROUP BY entity_key",
)
def entity_keys(spark, sf):
    rows, _ = merge.prepare(V.concept_rows(spark, sf))
    return rows.groupBy("entity_key").agg(
        F.count("*").cast("bigint").alias("n_rows"), F.countDistinct("document_name").cast("bigint").alias("n_documents")
    )


@register(
    "merge_entities",
    _CONCEPTS
    + "SELECT entity_key, 'Concept' AS type, first(name ORDER BY path, chunk_number, pos) AS name, 1::BIGINT AS n_props "
    "FROM keyed GROUP BY entity_key",
)
def merge_entities_q(spark, sf):
    rows = materialize(V.concept_rows(spark, sf), "concepts")  # extracted once; both lanes of the merge read the table
    n = merge.merge_entities(rows)
    return n.select("entity_key", "type", "name", F.size("props").cast("bigint").alias("n_props"))


@register(
    "merge_first_truthy",
    """WITH ev AS (
  SELECT event_id, event_type || ' ' || user_id AS name,
         json_extract(props, '$.k')::BIGINT AS k,
         CASE WHEN event_id % 4 = 0 THEN '""' ELSE json_extract(props, '$.k')::BIGINT::VARCHAR END AS v
  FROM events),
keyed AS (SELECT *, """
    + O.key("'Account'", "name")
    + """ AS entity_key FROM ev)
SELECT entity_key, 'k' AS prop,
       coalesce(arg_min(v, event_id) FILTER (WHERE event_id % 4 <> 0 AND k <> 0), arg_max(v, event_id)) AS value_json
FROM keyed GROUP BY entity_key
UNION ALL
SELECT entity_key, 'name', '"' || first(name ORDER BY event_id) || '"' FROM keyed GROUP BY entity_key
""",
)
def merge_first_truthy(spark, sf):
    n = merge.merge_entities(V.event_rows(spark, sf), ord_cols=("path", "seq", "pos"))
    return n.select("entity_key", F.explode("props").alias("prop", "v")).select(
        "entity_key", "prop", F.to_json("v").alias("value_json")
    )


@register("merge_state", SQL["merge_first_truthy"])
def merge_state(spark, sf):
    """A1 in batches: three states folded from a third of the rows each, the second one retried and the
    first two compacted, give what one merge of all rows gives."""
    from graphweave.session import scratch_dir

    rows = materialize(merge.prepare(V.event_rows(spark, sf))[0], "event-rows")  # every batch reads them
    rows = rows.withColumn("third", F.pmod(F.xxhash64("path", "seq", "pos"), F.lit(3)))
    state = merge.MergeState(spark, scratch_dir(spark, "merge-state"))
    for batch in (0, 1, 1):
        state.add(rows.where(F.col("third") == batch).drop("third"), f"b{batch}", ("path", "seq", "pos"))
    state.compact()
    for batch in (2, 1):
        state.add(rows.where(F.col("third") == batch).drop("third"), f"b{batch}", ("path", "seq", "pos"))
    return state.nodes().select("entity_key", F.explode("props").alias("prop", "v")).select(
        "entity_key", "prop", F.to_json("v").alias("value_json")
    )


# ---------------------------------------------------------------------------
# J3/J4/P19/P20 repair
# ---------------------------------------------------------------------------

_DUP = """WITH dup AS (
  SELECT 'copy0/conv_' || conv_id || '.txt' AS path, 'conv_' || conv_id AS document_name, turn::INTEGER AS chunk_number,
         'conv_' || conv_id || '_chunk_' || turn AS name, CASE WHEN turn % 3 <> 0 THEN '' ELSE text END AS text
  FROM conversations
  UNION ALL
  SELECT 'copy1/conv_' || conv_id || '.txt', 'conv_' || conv_id, turn::INTEGER,
         'conv_' || conv_id || '_part_' || turn, CASE WHEN turn % 3 = 2 THEN '' ELSE text END
  FROM conversations)
"""


@register(
    "repair_pre_merge",
    _DUP
    + """, fill AS (
  SELECT document_name, chunk_number, arg_max(text, path) FILTER (WHERE text <> '') AS fill FROM dup GROUP BY ALL)
SELECT d.path, d.chunk_number, (d.text = '' AND f.fill IS NOT NULL) AS repaired,
       md5(CASE WHEN d.text = '' AND f.fill IS NOT NULL THEN f.fill ELSE d.text END) AS text_md5
FROM dup d LEFT JOIN fill f USING (document_name, chunk_number)
""",
)
def repair_pre_merge(spark, sf):
    r = repair.pre_merge(V.conv_dup_rows(spark, sf))
    return r.select(
        "path", "chunk_number", "repaired",
        _md5(F.try_variant_get(F.try_element_at("props", F.lit("text")), "$", "string")).alias("text_md5"),
    )


_POST = (
    _DUP
    + """, fill AS (SELECT document_name, chunk_number, arg_max(text, path) AS fill FROM dup GROUP BY ALL),
nodes AS (
  SELECT 'Chunk_' || lower(d.name) AS entity_key, d.name, d.chunk_number,
         (d.text = '' AND d.name LIKE '%\\_chunk\\_%' ESCAPE '\\') AS needs, d.text, f.fill
  FROM dup d LEFT JOIN fill f USING (document_name, chunk_number)),
fixed AS (
  SELECT entity_key, name, chunk_number, (needs AND fill IS NOT NULL) AS repaired,
         CASE WHEN needs AND fill IS NOT NULL THEN fill ELSE text END AS text FROM nodes)
"""
)


def _post_nodes(spark, sf):
    rows = V.conv_dup_rows(spark, sf)
    nodes = materialize(merge.merge_entities(rows), "merged")  # the repair reads it three times
    return repair.post_merge(nodes, rows)


@register("repair_post_merge", _POST + "SELECT entity_key, name, repaired, md5(text) AS text_md5 FROM fixed")
def repair_post_merge(spark, sf):
    n = _post_nodes(spark, sf)
    return n.select(
        "entity_key", "name", "repaired",
        _md5(F.try_variant_get(F.try_element_at("props", F.lit("text")), "$", "string")).alias("text_md5"),
    )


@register(
    "placeholder_text",
    _POST
    + "SELECT entity_key, 'MERGE (n:Chunk {name: ''' || "
    + O.esc("name")
    + " || ''', text: ''' || "
    + O.esc("CASE WHEN text = '' THEN 'Text for chunk ' || chunk_number || ' (needs repair)' ELSE text END")
    + " || ''', chunk_number: ' || chunk_number || '})' AS statement FROM fixed",
)
def placeholder_text(spark, sf):
    s = export.node_statements(_post_nodes(spark, sf))
    return s.select("entity_key", "statement")


# ---------------------------------------------------------------------------
# J5/J6/A4/A5/A6 edges over the star schema as a graph
# ---------------------------------------------------------------------------

STAR_ORD = ("path", "seq", "pos")


def _star(spark, sf):
    # graph tables (K5) as a downstream user reads them: written once, then scanned
    return materialize(V.star_nodes(spark, sf), "star-nodes"), materialize(V.star_rels_dirty(spark, sf), "star-rels")


def _star_resolved(spark, sf):
    n, r = _star(spark, sf)
    return edges.resolve(n, r)


_STAR = O.with_(O.STAR_ROWS, O.STAR_RELS)


@register(
    "strict_edges",
    _STAR + "SELECT source, target, type FROM star_rels_dirty "
    "WHERE source IN (SELECT name FROM star_nodes) AND target IN (SELECT name FROM star_nodes)",
)
def strict_edges(spark, sf):
    n, r = _star(spark, sf)
    return edges.strict(n, r).select("source", "target", "type")


@register("resolved_edges", _STAR + "SELECT src_key, src_type, dst_key, dst_type, type, source, target FROM star_resolved")
def resolved_edges(spark, sf):
    return _star_resolved(spark, sf).select("src_key", "src_type", "dst_key", "dst_type", "type", "source", "target")


@register("dedup_edges", _STAR + "SELECT DISTINCT src_key, dst_key, type FROM star_resolved")
def dedup_edges(spark, sf):
    return edges.dedupe(_star_resolved(spark, sf)).select("src_key", "dst_key", "type")


@register(
    "name_nodes",
    _STAR + "SELECT name AS node_id, arg_max(type, path || '|' || lpad(seq::VARCHAR, 20, '0')) AS type FROM star_nodes GROUP BY name",
)
def name_nodes_q(spark, sf):
    return graph.name_nodes(V.star_nodes(spark, sf)).select("node_id", "type")


@register(
    "undirected_edges",
    _STAR
    + """SELECT u, v, type, source, target FROM (
  SELECT least(source, target) AS u, greatest(source, target) AS v, type, source, target,
         row_number() OVER (PARTITION BY least(source, target), greatest(source, target)
                            ORDER BY path DESC, seq DESC, pos DESC) AS rn
  FROM star_rels_dirty
  WHERE source IN (SELECT name FROM star_nodes) AND target IN (SELECT name FROM star_nodes)) WHERE rn = 1""",
)
def undirected_edges_q(spark, sf):
    n, r = _star(spark, sf)
    return graph.undirected_edges(n, r, ord_cols=STAR_ORD).select("u", "v", "type", "source", "target")


# ---------------------------------------------------------------------------
# J7/J8/J9 pattern queries
# ---------------------------------------------------------------------------


@register(
    "match_typed",
    _STAR + "SELECT source AS src_name, type, target AS dst_name FROM star_resolved "
    "WHERE src_type = 'Person' AND type = 'PARTICIPATES_IN' AND dst_type = 'Event'",
)
def match_typed(spark, sf):
    m = graph.match(_star_resolved(spark, sf), "Person", "PARTICIPATES_IN", "Event")
    return m.select(F.col("source").alias("src_name"), "type", F.col("target").alias("dst_name"))


@register(
    "document_mentions",
    O.with_(O.DOC_FILES, O.DOC_CHUNKS, O.hits("doc_chunks"))
    + "SELECT DISTINCT c.document_name, "
    + O.key("e.type", "e.name")
    + " AS entity_key, e.name AS entity_name, e.type AS entity_type FROM ents e JOIN doc_chunks c USING (chunk_name)",
)
def document_mentions_q(spark, sf):
    from graphweave.plans.build import build_graph
    from graphweave.session import scratch_dir
    from graphweave.sources import store

    path = scratch_dir(spark, "store")  # extraction written once (durability boundary)
    store.write_store(V.doc_results(spark, sf), path)
    nodes, rels = build_graph(spark.read.parquet(path))
    m = graph.document_mentions(edges.resolve(nodes, rels))
    return m.select("document_name", "entity_key", "entity_name", "entity_type")


_PATHS = (
    _STAR
    + """, e AS (SELECT DISTINCT src_key, dst_key, src_key || '|' || type || '|' || dst_key || '|{}' AS eid FROM star_resolved),
adj AS (
  SELECT e.src_key AS a, e.dst_key AS b, e.eid, n.name AS b_name, n.type AS b_type FROM e JOIN star_nodes n ON n.entity_key = e.dst_key
  UNION ALL
  SELECT e.dst_key, e.src_key, e.eid, n.name, n.type FROM e JOIN star_nodes n ON n.entity_key = e.src_key WHERE e.src_key <> e.dst_key),
seeds AS (SELECT entity_key AS seed_key, name FROM star_nodes WHERE path = 'region'),
h1 AS (SELECT s.seed_key, a1.b AS cur, s.name || '|' || a1.b_name AS path, a1.eid AS e1, a1.b_type AS t FROM seeds s JOIN adj a1 ON a1.a = s.seed_key),
h2 AS (SELECT h.seed_key, a2.b AS cur, h.path || '|' || a2.b_name AS path, h.e1, a2.eid AS e2, a2.b_type AS t
       FROM h1 h JOIN adj a2 ON a2.a = h.cur WHERE a2.eid <> h.e1),
h3 AS (SELECT h.seed_key, a3.b AS cur, h.path || '|' || a3.b_name AS path, a3.b_type AS t
       FROM h2 h JOIN adj a3 ON a3.a = h.cur WHERE a3.eid <> h.e1 AND a3.eid <> h.e2)
"""
)


@register(
    "paths_1_3",
    _PATHS
    + """SELECT seed_key, cur AS dst_key, 1 AS hops, path FROM h1 WHERE t = 'Location'
UNION ALL SELECT seed_key, cur, 2, path FROM h2 WHERE t = 'Location'
UNION ALL SELECT seed_key, cur, 3, path FROM h3 WHERE t = 'Location'""",
)
def paths_1_3(spark, sf):
    n, r = _star(spark, sf)
    res = edges.resolve(n, r)
    p = graph.paths(n, res, seed_nodes=n.where(F.col("first_ord.path") == "region"), dst_type="Location", max_hops=3)
    return p.select("seed_key", "dst_key", F.col("hops").cast("int").alias("hops"), "path")


# ---------------------------------------------------------------------------
# P16-P24 statements
# ---------------------------------------------------------------------------


@register("node_statements", _STAR + "SELECT entity_key, 'MERGE (n:' || type || ' {' || body || '})' AS statement FROM star_nodes")
def node_statements_q(spark, sf):
    return export.node_statements(V.star_nodes(spark, sf)).select("entity_key", "statement")


@register(
    "edge_statements",
    _STAR
    + "SELECT 'MATCH (a {name: ''' || "
    + O.esc("source")
    + " || '''})' || chr(10) || '            MATCH (b {name: ''' || "
    + O.esc("target")
    + " || '''})' || chr(10) || '            MERGE (a)-[r:' || type || ']->(b)' AS statement "
    "FROM star_rels_dirty WHERE source <> '' AND target <> ''",
)
def edge_statements_q(spark, sf):
    return export.edge_statements(V.star_rels_dirty(spark, sf)).select("statement")


_VEC_NODES = """WITH vec AS (
  SELECT 'Cluster' || label AS type, CASE WHEN vec_id % 10 = 0 THEN [] ELSE embedding END AS emb FROM embeddings)
"""


@register(
    "index_statements",
    _VEC_NODES
    + "SELECT DISTINCT type, 'CREATE VECTOR INDEX ' || lower(type) || '_embeddings IF NOT EXISTS' || chr(10) || "
    "'                FOR (n:' || type || ') ON n.embedding' || chr(10) || '                OPTIONS {' || chr(10) || "
    "'                    indexConfig: {' || chr(10) || '                        `vector.dimensions`: ' || len(emb) || ',' || chr(10) || "
    "'                        `vector.similarity_function`: ''cosine''' || chr(10) || '                    }' || chr(10) || "
    "'                }' AS statement FROM vec WHERE len(emb) > 0",
)
def index_statements_q(spark, sf):
    e = V.table(spark, sf, "embeddings")
    emb = F.when(F.col("vec_id") % 10 == 0, F.array().cast("array<float>")).otherwise(F.col("embedding"))
    rows = e.select(
        F.lit("embeddings").alias("path"), F.col("vec_id").alias("seq"), F.lit(0).alias("pos"),
        F.concat(F.lit("Cluster"), F.col("label")).alias("type"),
        F.concat(F.lit("vec_"), F.col("vec_id")).alias("name"),
        F.create_map(
            F.lit("name"), F.concat(F.lit("vec_"), F.col("vec_id")).cast("variant"), F.lit("embedding"), emb.cast("variant")
        ).alias("props"),
        F.lit("embeddings").alias("document_name"),
    )
    nodes = merge.merge_entities(rows, ord_cols=STAR_ORD)
    return export.index_statements(nodes, enabled=True, dims=None, sim="cosine")


@register(
    "escape_literals",
    "SELECT doc_id, md5('''' || " + O.esc("text") + " || '''') AS literal_md5, "
    "length('''' || " + O.esc("text") + " || '''')::BIGINT AS literal_chars FROM documents",
)
def escape_literals(spark, sf):
    d = V.table(spark, sf, "documents")
    lit_ = string_literal(F.col("text"), MAX_LITERAL_CHARS)
    return d.select("doc_id", F.md5(lit_).alias("literal_md5"), F.char_length(lit_).cast("bigint").alias("literal_chars"))


@register(
    "variant_literals",
    "SELECT event_id, 'name: ''' || event_type || ''', k: ' || json_extract(props, '$.k')::BIGINT || ', tags: [' || "
    "json_extract(props, '$.k')::BIGINT || ', ' || user_id || '], labels: [''' || event_type || ''', null]' AS rendered FROM events",
)
def variant_literals(spark, sf):
    e = V.table(spark, sf, "events")
    k = F.try_element_at(F.from_json("props", "map<string,variant>"), F.lit("k"))
    props = F.create_map(
        F.lit("name"), F.col("event_type").cast("variant"),
        F.lit("k"), k,
        F.lit("tags"), F.array(k, F.col("user_id").cast("variant")).cast("variant"),
        F.lit("labels"), F.parse_json(F.concat(F.lit('["'), F.col("event_type"), F.lit('", null]'))),
        F.lit("blank"), F.lit("  ").cast("variant"),
        F.lit("none"), F.parse_json(F.lit("null")),
    )
    return e.select("event_id", export.render_body(props).alias("rendered"))


# ---------------------------------------------------------------------------
# S2/J1/J2/I2/I4 increments and the store
# ---------------------------------------------------------------------------

_MANIFEST = O.with_(O.DOC_FILES) + """, manifest AS (
  SELECT path, document_name,
         CASE WHEN doc_id % 9 = 0 THEN md5(text || ' ') ELSE content_md5 END AS content_md5,
         CASE WHEN doc_id % 3 = 0 THEN 'ok' ELSE 'failed' END AS status, doc_id
  FROM doc_files)
"""


@register("content_hash", O.with_(O.DOC_FILES) + "SELECT document_name, path, content_md5 FROM doc_files")
def content_hash(spark, sf):
    return V.doc_files(spark, sf).select("document_name", "path", "content_md5")


@register(
    "pending_path",
    _MANIFEST + "SELECT f.path FROM doc_files f WHERE f.path NOT IN (SELECT path FROM manifest WHERE status = 'ok')",
)
def pending_path(spark, sf):
    from graphweave.sources import manifest

    return manifest.pending(V.doc_files(spark, sf), V.doc_manifest(spark, sf), "path").select("path")


@register(
    "pending_content",
    _MANIFEST + "SELECT f.path FROM doc_files f ANTI JOIN (SELECT * FROM manifest WHERE status = 'ok') m "
    "ON f.path = m.path AND f.content_md5 = m.content_md5",
)
def pending_content(spark, sf):
    from graphweave.sources import manifest

    return manifest.pending(V.doc_files(spark, sf), V.doc_manifest(spark, sf), "content").select("path")


@register(
    "cache_split",
    _MANIFEST + "SELECT f.document_name, CASE WHEN m.document_name IS NULL THEN 'miss' ELSE 'hit' END AS cache "
    "FROM doc_files f LEFT JOIN (SELECT DISTINCT document_name, content_md5 FROM manifest WHERE status = 'ok') m "
    "ON f.document_name = m.document_name AND f.content_md5 = m.content_md5",
)
def cache_split(spark, sf):
    from graphweave.sources import store

    stored = V.doc_manifest(spark, sf).where(F.col("status") == "ok")
    hits, misses = store.split_cached(V.doc_files(spark, sf), stored)
    return hits.select("document_name", F.lit("hit").alias("cache")).unionByName(
        misses.select("document_name", F.lit("miss").alias("cache"))
    )


@register(
    "latest_only",
    _MANIFEST + """, versions AS (
  SELECT document_name, content_md5, TIMESTAMP '2024-01-01 00:00:00' AS extraction_time FROM manifest
  UNION ALL
  SELECT document_name, content_md5, TIMESTAMP '2024-02-01 00:00:00' FROM doc_files WHERE doc_id % 2 = 0)
SELECT document_name, arg_max(content_md5, extraction_time) AS content_md5 FROM versions GROUP BY document_name""",
)
def latest_only_q(spark, sf):
    from graphweave.sources import store

    m = V.doc_manifest(spark, sf).select("document_name", "content_md5", F.col("finished_at").alias("extraction_time"))
    f = V.doc_files(spark, sf).where(F.col("doc_id") % 2 == 0).select(
        "document_name", "content_md5", F.lit("2024-02-01 00:00:00").cast("timestamp").alias("extraction_time")
    )
    return store.latest_only(m.unionByName(f)).select("document_name", "content_md5").distinct()


# ---------------------------------------------------------------------------
# S3 text validity, custom reader
# ---------------------------------------------------------------------------


@register(
    "text_validity",
    "SELECT 'doc_' || doc_id AS item, doc_id % 7 <> 0 AS valid, "
    "CASE WHEN doc_id % 7 <> 0 THEN length(text) END::BIGINT AS n_chars FROM documents "
    "UNION ALL SELECT 'bench_' || item_id, item_id % 7 <> 0, CASE WHEN item_id % 7 <> 0 THEN length(text) END::BIGINT FROM benchmark",
)
def text_validity(spark, sf):
    from graphweave.sources.files import read_text

    def files(df, prefix, idc):
        # CRLF line ends when id % 5 = 0, a stray 0xFF byte when id % 7 = 0
        t = F.when(F.col(idc) % 5 == 0, F.replace(F.col("text"), F.lit("\n"), F.lit("\r\n"))).otherwise(F.col("text"))
        b = F.encode(t, "UTF-8")
        b = F.when(F.col(idc) % 7 == 0, F.concat(b, F.unhex(F.lit("FF")))).otherwise(b)
        return df.select(F.concat(F.lit(prefix), F.col(idc), F.lit(".txt")).alias("path"), b.alias("content"))

    c = files(V.table(spark, sf, "documents"), "doc_", "doc_id").unionByName(
        files(V.table(spark, sf, "benchmark"), "bench_", "item_id")
    )
    return read_text(c).select(
        F.col("document_name").alias("item"), F.col("error").isNull().alias("valid"), F.char_length("text").cast("bigint").alias("n_chars")
    )


_HTML = r"""SELECT page_id, md5(t) AS text_md5, length(t)::BIGINT AS text_chars FROM (
  SELECT page_id, trim(regexp_replace(
    replace(replace(replace(replace(replace(
      regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', ' ', 'g'),
        '(?is)<script(\s[^>]*)?>.*?</script\s*>|<style(\s[^>]*)?>.*?</style\s*>|<head(\s[^>]*)?>.*?</head\s*>', ' ', 'g'),
        '(?s)<[^>]*>', ' ', 'g'),
      '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'),
    '[ \t\r\n]+', ' ', 'g'), ' ') AS t FROM pages)"""


@register("custom_reader_html", _HTML)
def custom_reader_html(spark, sf):
    from graphweave.sources.files import html_text, jvm_reader, read_text

    p = V.table(spark, sf, "pages")
    files = p.select(F.concat(F.lit("p"), F.col("page_id"), F.lit(".html")).alias("path"), F.encode("html", "UTF-8").alias("content"))
    got = read_text(files, {".html": jvm_reader(html_text)})
    return got.select(
        F.substring("document_name", 2, 20).cast("bigint").alias("page_id"), F.md5("text").alias("text_md5"),
        F.char_length("text").cast("bigint").alias("text_chars"),
    )


# ---------------------------------------------------------------------------
# V1/V2 vectors
# ---------------------------------------------------------------------------


@register(
    "vector_top_k",
    """SELECT query_id, rank, base_id, sim FROM (
  SELECT q.vec_id AS query_id, b.vec_id AS base_id,
         round(list_cosine_similarity(q.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS sim,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(q.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) DESC, b.vec_id)::INTEGER AS rank
  FROM embeddings q, embeddings b WHERE q.vec_id <> b.vec_id) WHERE rank <= 5""",
)
def vector_top_k(spark, sf):
    from graphweave.operators import vectors

    e = V.table(spark, sf, "embeddings")
    return vectors.top_k(e, e, k=5, exclude_self=True)


@register(
    "similar_pairs",
    """SELECT a.vec_id AS a_id, b.vec_id AS b_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS sim
FROM embeddings a, embeddings b
WHERE a.vec_id < b.vec_id AND list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.35""",
)
def similar_pairs(spark, sf):
    from graphweave.operators import vectors

    return vectors.similar_pairs(V.table(spark, sf, "embeddings"), threshold=0.35)


@register(
    "embed_chunks",
    O.with_(O.DOC_FILES, O.DOC_CHUNKS) + "SELECT chunk_name, 256::BIGINT AS dims, 1.0::DOUBLE AS norm FROM doc_chunks",
)
def embed_chunks(spark, sf):
    """V1 default embedding: every chunk gets a unit vector of the requested size."""
    from graphweave.operators import vectors

    c = V.doc_chunks(spark, sf)
    e = vectors.embed(c, "text", dims=256)
    norm = F.sqrt(F.aggregate(F.col("embedding"), F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double") * x.cast("double")))
    return e.select("chunk_name", F.size("embedding").cast("bigint").alias("dims"), F.round(norm, 6).alias("norm"))


# ---------------------------------------------------------------------------
# P3 requests
# ---------------------------------------------------------------------------


def _requests_sql() -> str:
    from graphweave.operators.prompts import request_parts

    head, ctx = request_parts(domain="general")
    lit_ = "'" + (head + ctx + "Document: ").replace("'", "''") + "'"
    req = f"({lit_} || document_name || chr(10) || 'Chunk number: ' || chunk_number || chr(10) || 'Text:' || chr(10) || text)"
    return O.with_(O.DOC_FILES, O.DOC_CHUNKS) + f"SELECT chunk_name, length({req})::BIGINT AS request_chars, md5({req}) AS request_md5 FROM doc_chunks"


@register("build_requests", _requests_sql())
def build_requests(spark, sf):
    from graphweave.operators.prompts import build_requests as br

    r = br(V.doc_chunks(spark, sf), domain="general")
    return r.select("chunk_name", F.char_length("request").cast("bigint").alias("request_chars"), F.md5("request").alias("request_md5"))


# ---------------------------------------------------------------------------
# A8-A12 statistics
# ---------------------------------------------------------------------------

_DOC_STATS = (
    O.with_(O.DOC_FILES, O.DOC_CHUNKS, O.hits("doc_chunks"))
    + """, per_chunk AS (
  SELECT c.document_name, c.chunk_name, c.path, coalesce(e.ne, 0) AS ne, coalesce(r.nr, 0) AS nr
  FROM doc_chunks c LEFT JOIN nents e USING (chunk_name) LEFT JOIN nrels r USING (chunk_name)),
keys AS (
  SELECT """
    + O.key("type", "name")
    + """ AS k FROM ents
  UNION SELECT 'Document_' || lower(document_name) FROM doc_chunks
  UNION SELECT 'Chunk_' || lower(chunk_name) FROM doc_chunks)
"""
)


@register(
    "per_document_stats",
    _DOC_STATS
    + "SELECT document_name, count(*)::BIGINT AS n_chunks, sum(ne + 2)::BIGINT AS n_entities, "
    "sum(nr + 1 + ne)::BIGINT AS n_relationships FROM per_chunk GROUP BY document_name",
)
def per_document_stats(spark, sf):
    from graphweave.operators import stats

    return stats.per_document_counts(shape.chunk_counts(V.doc_results(spark, sf)))


@register(
    "run_summary",
    _DOC_STATS
    + "SELECT count(DISTINCT path)::BIGINT AS files, count(*)::BIGINT AS chunks, sum(ne + 2)::BIGINT AS entity_rows, "
    "(SELECT count(*) FROM keys)::BIGINT AS nodes, sum(nr + 1 + ne)::BIGINT AS relationships FROM per_chunk",
)
def run_summary(spark, sf):
    from graphweave.operators import stats

    results = materialize(V.doc_results(spark, sf), "results")  # extracted once; counts and merge read the table
    nodes = merge.merge_entities(shape.complete(results)[0])
    return stats.run_counts(shape.chunk_counts(results), nodes)


@register(
    "progress",
    _MANIFEST + "SELECT count(*) FILTER (WHERE status = 'ok')::BIGINT AS processed, count(*)::BIGINT AS total, "
    "round((100.0 * count(*) FILTER (WHERE status = 'ok') / count(*))::DOUBLE, 1) AS progress_pct FROM manifest",
)
def progress(spark, sf):
    from graphweave.operators import stats

    return stats.progress(V.doc_manifest(spark, sf))


def _pipeline_sql() -> str:
    from graphweave.operators.extract import ENTITY_TYPES, RELATIONSHIP_TYPES

    return (
        _MANIFEST.replace("WITH ", "WITH " + O.STAR_ROWS + ",\n" + O.STAR_RELS + ",\n", 1)
        + """, und AS (
  SELECT DISTINCT least(source, target) AS u, greatest(source, target) AS v FROM star_rels_dirty
  WHERE source IN (SELECT name FROM star_nodes) AND target IN (SELECT name FROM star_nodes))
SELECT count(*) FILTER (WHERE status = 'ok')::BIGINT AS processed_files,
       count(*) FILTER (WHERE status = 'failed')::BIGINT AS failed_files,
       0::BIGINT AS total_chunks_processed, count(DISTINCT path)::BIGINT AS total_files,
       '2024-01-01 00:00:00' AS last_execution,
       (SELECT count(DISTINCT name) FROM star_nodes)::BIGINT AS graph_nodes,
       (SELECT count(*) FROM und)::BIGINT AS graph_edges,
       'txt,pdf,docx,md' AS supported_formats, """
        + f"'{','.join(ENTITY_TYPES)}' AS entity_types, '{','.join(RELATIONSHIP_TYPES)}' AS relationship_types FROM manifest"
    )


@register("pipeline_stats", _pipeline_sql())
def pipeline_stats(spark, sf):
    from graphweave.operators import stats
    from graphweave.operators.extract import ENTITY_TYPES, RELATIONSHIP_TYPES

    n, r = _star(spark, sf)
    s = stats.pipeline_stats(
        V.doc_manifest(spark, sf), graph.name_nodes(n), graph.undirected_edges(n, r, ord_cols=STAR_ORD),
        ("txt", "pdf", "docx", "md"), ENTITY_TYPES, RELATIONSHIP_TYPES,
    )
    return s.withColumn("last_execution", F.date_format("last_execution", "yyyy-MM-dd HH:mm:ss"))


# ---------------------------------------------------------------------------
# Files, scripts, store records, streaming (written under the shared scratch
# folder; checked by row count only)
# ---------------------------------------------------------------------------


def _write_doc_files(spark, sf) -> str:
    """Write the documents as text files under scratch, one per language and 250 ids:
    the texts by id, a newline after each. Their number grows with the table."""
    from graphweave.session import scratch_dir

    root = scratch_dir(spark, "docs")
    d = V.table(spark, sf, "documents")
    d = d.select("lang", F.floor(F.col("doc_id") / 250).alias("part"), "doc_id", "text")
    d = d.repartition("lang", "part").sortWithinPartitions("lang", "part", "doc_id").drop("doc_id")
    d.write.partitionBy("lang", "part").text(root)
    return root


# the same files in SQL, and their chunks (named by the hash of the file)
_TEXT_FILES = r"""text_files AS (
  SELECT md5(t) AS content_md5, regexp_replace(t, '\r\n?', chr(10), 'g') AS text FROM (
    SELECT string_agg(text, chr(10) ORDER BY doc_id) || chr(10) AS t FROM documents GROUP BY lang, doc_id // 250)),
file_sizes AS (SELECT *, greatest(1, ceil((length(text) - 500) / 1000.0))::INTEGER AS n_chunks FROM text_files),
file_chunks AS (
  SELECT content_md5, i::INTEGER AS chunk_number, content_md5 || '_chunk_' || i AS chunk_name,
         substr(text, (i * 1000 + 1)::INTEGER, 1500) AS text
  FROM (SELECT *, unnest(range(n_chunks)) AS i FROM file_sizes))"""


def _star_script(spark, sf) -> str:
    from graphweave.session import scratch_dir

    n, r = _star(spark, sf)
    out = scratch_dir(spark, "scripts")
    return export.write_script(
        export.node_statements(n), export.edge_statements(r), export.index_statements(n, enabled=False), out
    )


def _load_statements_sql() -> str:
    node = "SELECT 'MERGE (n:' || type || ' {' || body || '})' AS statement FROM star_nodes"
    edge = SQL["edge_statements"].split(_STAR, 1)[1]
    return _STAR + node + "\nUNION ALL\n" + edge


@register("load_statements", _load_statements_sql())
def load_statements(spark, sf):
    return export.load_statements(spark, _star_script(spark, sf), mode="naive")


@register(
    "apply_statements",
    _STAR + "SELECT true AS ok, ((SELECT count(*) FROM star_nodes) + "
    "(SELECT count(*) FROM star_rels_dirty WHERE source <> '' AND target <> ''))::BIGINT AS n",
)
def apply_statements(spark, sf):
    stmts = export.load_statements(spark, _star_script(spark, sf), mode="rows")
    res = export.apply_statements(stmts)
    return res.groupBy("ok").agg(F.count("*").cast("bigint").alias("n"))


@register("latest_script")
def latest_script(spark, sf):
    import datetime as dt

    from graphweave.session import scratch_dir

    out = scratch_dir(spark, "scripts")
    n, r = _star(spark, sf)
    empty_idx = export.index_statements(n, enabled=False)
    export.write_script(export.node_statements(n), export.edge_statements(r), empty_idx, out, dt.datetime(2024, 1, 1))
    export.write_script(export.node_statements(n), export.edge_statements(r), empty_idx, out, dt.datetime(2024, 1, 2))
    return export.latest_script(spark, out)


@register(
    "file_run",
    O.with_(_TEXT_FILES) + "SELECT 'run-1' AS run_id, content_md5, 'ok' AS status, n_chunks FROM file_sizes",
)
def file_run(spark, sf):
    """E1 over files written from the documents table: the manifest after two runs, of which
    the second finds nothing new in path mode and so adds no row."""
    from graphweave.plans.build import run_batch
    from graphweave.session import scratch_dir

    root = _write_doc_files(spark, sf)
    work = scratch_dir(spark, "work")
    run_batch(spark, root, work, "run-1")
    run_batch(spark, root, work, "run-2", write_outputs=False)
    from graphweave.sources import manifest as msrc

    return msrc.read(spark, f"{work}/manifest").select("run_id", "content_md5", "status", "n_chunks")


def _by_pos(arr):
    k = lambda z: F.struct(z["chunk_number"], z["pos"])
    return F.array_sort(arr, lambda a, b: F.when(k(a) < k(b), -1).when(k(a) > k(b), 1).otherwise(0))


@register(
    "rebuild_from_records",
    _CONV_ENTS + "SELECT DISTINCT " + O.key("type", "name") + " AS entity_key, type, name FROM all_ents",
)
def rebuild_from_records(spark, sf):
    """E2 over extraction records written (JSON lines) from the conversations."""
    from graphweave.plans.build import rebuild_from_store
    from graphweave.session import scratch_dir

    e, r = _conv_graph(spark, sf)
    ents = e.groupBy("document_name").agg(
        _by_pos(F.collect_list(F.struct("chunk_number", "pos", F.struct("type", F.col("props").alias("properties")).alias("x")))).alias("l")
    )
    rels = r.groupBy("document_name").agg(
        _by_pos(F.collect_list(F.struct("chunk_number", "pos", F.struct("source", "target", "type", F.col("props").alias("properties")).alias("x")))).alias("l")
    )
    rec = ents.join(rels, "document_name").select(
        "document_name",
        F.transform(ents["l"], lambda z: z["x"]).alias("entities"),
        F.transform(rels["l"], lambda z: z["x"]).alias("relationships"),
        F.lit("2024-01-01T00:00:00").alias("extraction_time"),
    )
    path = scratch_dir(spark, "records")
    rec.write.json(path)
    nodes, _rels, _bad = rebuild_from_store(spark, path, multiline=False)
    return nodes.select("entity_key", "type", "name")


@register(
    "stream_ingest",
    O.with_(_TEXT_FILES, O.hits("file_chunks"))
    + "SELECT c.content_md5, c.chunk_number, e.pos, e.type, e.name FROM ents e JOIN file_chunks c USING (chunk_name)",
)
def stream_ingest_q(spark, sf):
    """I1 over the same files: what the extractor found, by the hash of the file."""
    from graphweave.session import scratch_dir
    from graphweave.streaming.ingest import read_output, stream_ingest

    root = _write_doc_files(spark, sf)
    out, ck = scratch_dir(spark, "stream-out"), scratch_dir(spark, "stream-ckpt")
    stream_ingest(spark, root, out, ck, max_files_per_trigger=8)
    found = read_output(spark, out, "entities").where(~F.col("type").isin("Chunk", "Document"))
    files = read_output(spark, out, "files").select("path", "content_md5")
    return found.join(files, "path").select("content_md5", "chunk_number", "pos", "type", "name")


@register(
    "stream_merge",
    O.with_(_TEXT_FILES, O.hits("file_chunks"))
    + "SELECT DISTINCT " + O.key("e.type", "e.name") + " AS entity_key, e.type FROM ents e JOIN file_chunks c USING (chunk_name)",
)
def stream_merge(spark, sf):
    """I1 with its merge: micro-batches fold into the state, the stream ends and starts again in the
    middle, the state is compacted; the graph's extracted nodes."""
    from graphweave.session import scratch_dir
    from graphweave.streaming.ingest import merged_graph, stream_ingest

    root = _write_doc_files(spark, sf)
    out, ck = scratch_dir(spark, "stream-out"), scratch_dir(spark, "stream-ckpt")
    stream_ingest(spark, f"{root}/lang=[a-d]*", out, ck, max_files_per_trigger=3)
    merged_graph(spark, out, compact=True)
    stream_ingest(spark, f"{root}/lang=*", out, ck, max_files_per_trigger=6)
    nodes, _rels = merged_graph(spark, out)
    return nodes.where(~F.col("type").isin("Chunk", "Document")).select("entity_key", "type")


# ---------------------------------------------------------------------------
# A11 / P13 / P4 slot / P1 recursive
# ---------------------------------------------------------------------------


@register(
    "repair_counts",
    "SELECT (2 * count(*))::BIGINT AS rows, count(*) FILTER (WHERE turn % 3 = 1)::BIGINT AS repaired FROM conversations",
)
def repair_counts(spark, sf):
    from graphweave.operators import stats

    return stats.repair_counts(repair.pre_merge(V.conv_dup_rows(spark, sf)))


@register(
    "record_envelope",
    O.with_(O.DOC_FILES, O.DOC_CHUNKS, O.hits("doc_chunks"))
    + """SELECT c.document_name, c.path, count(*)::BIGINT AS total_chunks, 0::BIGINT AS failed_chunks,
       sum(coalesce(e.ne, 0))::BIGINT AS entities, sum(coalesce(r.nr, 0))::BIGINT AS relationships
FROM doc_chunks c LEFT JOIN nents e USING (chunk_name) LEFT JOIN nrels r USING (chunk_name)
GROUP BY c.document_name, c.path""",
)
def record_envelope(spark, sf):
    from graphweave.sources import store

    return store.envelope(V.doc_results(spark, sf)).drop("extraction_time")


def concept_extractor(batch):
    """A user extractor for the P4 slot: capitalised words of 4+ letters as Concept
    entities (distinct, in order), consecutive ones RELATED_TO. Returns JSON text."""
    import json

    import regex

    out = []
    for text in batch["text"]:
        words = list(dict.fromkeys(regex.findall(r"(?:^|[^\p{L}])(\p{Lu}\p{Ll}+\p{L}{2,})", text or "")))
        out.append(json.dumps({
            "entities": [{"type": "Concept", "name": w} for w in words],
            "relationships": [{"source": a, "target": b, "type": "RELATED_TO"} for a, b in zip(words, words[1:])],
        }))
    return out


@register(
    "python_extractor",
    O.with_(O.DOC_FILES, O.DOC_CHUNKS, O.hits("doc_chunks"))
    + "SELECT chunk_name, pos, type, name FROM ents WHERE grp = 0",
)
def python_extractor(spark, sf):
    chunks = V.doc_chunks(spark, sf).drop("content_md5")
    res = extract.extract(chunks, fn=concept_extractor)
    e, _ = shape.complete(res)
    return e.where(~F.col("type").isin("Chunk", "Document")).select(
        F.concat(F.col("document_name"), F.lit("_chunk_"), F.col("chunk_number")).alias("chunk_name"), "pos", "type", "name"
    )


def _cut_sql(source: str, separator: str, keys: str) -> str:
    """``p`` of ``source`` cut before each ``separator``, numbered by ``i``."""
    return (
        f"(SELECT {keys}, i, CASE WHEN i = 1 THEN p ELSE {separator} || p END AS p FROM (SELECT {keys}, "
        f"unnest(string_split(p, {separator})) AS p, generate_subscripts(string_split(p, {separator}), 1) AS i FROM {source}))"
    )


# Pieces by nested cuts; every piece knows the next start if a chunk began with it (two ASOF
# joins over positions); the chunks of a group of pieces are then a chain of such starts.
_RECURSIVE_CHUNKS = (
    O.with_(O.DOC_FILES).replace("WITH ", "WITH RECURSIVE ", 1)
    + ", whole AS (SELECT document_name, text AS p FROM doc_files), paras AS (SELECT document_name, i AS c1, p FROM "
    + _cut_sql("whole", "chr(10) || chr(10)", "document_name")
    + " WHERE p <> ''), lines AS (SELECT document_name, c1, i AS c2, p FROM "
    + _cut_sql("(SELECT * FROM paras WHERE length(p) > 1500)", "chr(10)", "document_name, c1")
    + " WHERE p <> ''), words AS (SELECT document_name, c1, c2, i AS c3, p FROM "
    + _cut_sql("(SELECT * FROM lines WHERE length(p) > 1500)", "' '", "document_name, c1, c2")
    + """ WHERE p <> ''), pieces AS (
  SELECT document_name, c1, 0 AS c2, 0 AS c3, 0 AS c4, '0' AS cut, length(p) AS len FROM paras WHERE length(p) <= 1500
  UNION ALL SELECT document_name, c1, c2, 0, 0, c1::VARCHAR, length(p) FROM lines WHERE length(p) <= 1500
  UNION ALL SELECT document_name, c1, c2, c3, 0, c1 || '/' || c2, length(p) FROM words WHERE length(p) <= 1500
  UNION ALL SELECT document_name, c1, c2, c3, unnest(generate_series(1, length(p))), c1 || '/' || c2 || '/' || c3, 1
    FROM words WHERE length(p) > 1500),
ordered AS (
  SELECT document_name, row_number() OVER w AS n, sum(len) OVER w AS upto, len, cut,
         CASE WHEN cut IS DISTINCT FROM lag(cut) OVER w THEN 1 ELSE 0 END AS opens
  FROM pieces WINDOW w AS (PARTITION BY document_name ORDER BY c1, c2, c3, c4)),
spans AS MATERIALIZED (
  SELECT document_name, n, opens, (upto - len)::BIGINT AS a, upto::BIGINT AS b,
         sum(opens) OVER (PARTITION BY document_name ORDER BY n)::BIGINT AS grp FROM ordered),
ends AS MATERIALIZED (
  SELECT s.document_name, s.grp, s.n, s.a, s.opens, e.n AS last_n, e.b AS until
  FROM (SELECT *, a + 1500 AS reach FROM spans) s
  ASOF JOIN spans e ON s.document_name = e.document_name AND s.grp = e.grp AND s.reach >= e.b),
following AS (
  SELECT d.*, greatest(d.until - 500, f.b - 1500) AS from_a
  FROM ends d JOIN spans f ON f.document_name = d.document_name AND f.grp = d.grp AND f.n = d.last_n + 1),
jumps AS MATERIALIZED (
  SELECT f.document_name, f.n, t.n AS next_n
  FROM following f ASOF JOIN spans t ON f.document_name = t.document_name AND f.grp = t.grp AND f.from_a <= t.a),
starts AS (
  SELECT document_name, n FROM spans WHERE opens = 1
  UNION ALL SELECT j.document_name, j.next_n FROM starts s JOIN jumps j ON j.document_name = s.document_name AND j.n = s.n),
numbered AS (
  SELECT document_name, a, until, row_number() OVER (PARTITION BY document_name ORDER BY n) - 1 AS i
  FROM starts JOIN ends USING (document_name, n))
SELECT document_name, i::INTEGER AS chunk_number, document_name || '_chunk_' || i AS chunk_name,
       (until - a)::BIGINT AS chunk_chars, md5(substring(text, a + 1, until - a)) AS chunk_md5
FROM numbered JOIN doc_files USING (document_name)"""
)


@register("chunk_recursive", _RECURSIVE_CHUNKS)
def chunk_recursive(spark, sf):
    from graphweave.operators import chunking

    c = chunking.chunk(V.doc_files(spark, sf), 1500, 500, mode="recursive")
    return c.select("document_name", "chunk_number", "chunk_name", F.char_length("text").cast("bigint").alias("chunk_chars"),
                    F.md5("text").alias("chunk_md5"))


@register(
    "chunk_embedding_index",
    "SELECT 'Chunk' AS type, 'CREATE VECTOR INDEX chunk_embeddings IF NOT EXISTS' || chr(10) || "
    "'                FOR (n:Chunk) ON n.embedding' || chr(10) || '                OPTIONS {' || chr(10) || "
    "'                    indexConfig: {' || chr(10) || '                        `vector.dimensions`: 64,' || chr(10) || "
    "'                        `vector.similarity_function`: ''cosine''' || chr(10) || '                    }' || chr(10) || "
    "'                }' AS statement",
)
def chunk_embedding_index(spark, sf):
    """V1 → P9 → P24: chunk embeddings ride on the Chunk nodes into the index statements."""
    from graphweave.operators import vectors
    res = V.doc_results(spark, sf)
    res = vectors.embed(res, "text", dims=64)
    e, _ = shape.complete(res, embedding_col="embedding")
    rows = materialize(e.where(F.col("type") == "Chunk"), "chunk-rows")  # embedded once; both lanes of the merge read the table
    nodes = materialize(merge.merge_entities(rows), "chunk-nodes")
    return export.index_statements(nodes, enabled=True, dims=None)


@register(
    "labels_progress",
    O.with_(O.DOC_FILES)
    + """SELECT count(*) FILTER (WHERE l.quality = 1)::BIGINT AS processed, count(*)::BIGINT AS total,
       round((100.0 * count(*) FILTER (WHERE l.quality = 1) / count(*))::DOUBLE, 1) AS progress_pct
FROM doc_files f LEFT JOIN labels l ON f.doc_id = l.doc_id""",
)
def labels_progress(spark, sf):
    """A12 over a manifest taken from ``labels``: a labelled document counts as
    processed when its quality flag is 1; others, unlabelled ones included, are not."""
    from graphweave.operators import stats

    f = V.doc_files(spark, sf)
    lab = V.table(spark, sf, "labels")
    m = f.join(lab, "doc_id", "left").select(
        "path", F.when(F.col("quality") == 1, F.lit("ok")).otherwise(F.lit("failed")).alias("status")
    )
    return stats.progress(m)


@register(
    "stem_collisions",
    O.with_(O.DOC_FILES)
    + """, named AS (
  SELECT source || '/' || lang || '/' || lower(regexp_extract(text, '[A-Za-z]+', 0)) || '.txt' AS path,
         lower(regexp_extract(text, '[A-Za-z]+', 0)) AS document_name FROM documents)
SELECT document_name, count(DISTINCT path)::BIGINT AS n_paths, min(path) AS first_path
FROM named GROUP BY document_name HAVING count(DISTINCT path) > 1""",
)
def stem_collisions(spark, sf):
    """Files named by their first word: the same stem in several folders is one
    document for the pipeline; this reports such stems."""
    from graphweave.operators import stats

    d = V.table(spark, sf, "documents")
    stem = F.lower(F.regexp_extract("text", "[A-Za-z]+", 0))
    files = d.select(
        F.concat_ws("/", "source", "lang", F.concat(stem, F.lit(".txt"))).alias("path"), stem.alias("document_name")
    )
    return stats.stem_collisions(files)


@register(
    "dedup_nodes",
    _STAR + "SELECT type, count(DISTINCT body)::BIGINT AS n FROM star_nodes GROUP BY type",
)
def dedup_nodes(spark, sf):
    """A4 (nodes): what a MERGE on label + all properties keeps, counted per label."""
    n = materialize(V.star_nodes(spark, sf), "star-nodes")
    return edges.dedupe_nodes(n).groupBy("type").agg(F.count("*").cast("bigint").alias("n"))


# ---------------------------------------------------------------------------
# P21 depth and doubles, S8 rows, S6 dispatch, P15, P19
# ---------------------------------------------------------------------------


@register(
    "nested_literals",
    "SELECT event_id, '[[[[[' || user_id || ', ''' || event_type || ''']]], ''{\\\"k\\\":' || (event_id % 7) || '}''], null, []]' AS literal "
    "FROM events",
)
def nested_literals(spark, sf):
    """Lists five deep, an object inside, rendered by the literal rules."""
    e = V.table(spark, sf, "events")
    j = F.concat(
        F.lit("[[[[["), F.col("user_id"), F.lit(',"'), F.col("event_type"), F.lit('"]]],{"k":'), F.col("event_id") % 7, F.lit("}],null,[]]")
    )
    return e.select("event_id", literal(F.parse_json(j)).alias("literal"))


@register(
    "double_literals",
    "SELECT o_orderkey, (((o_orderkey % 1000 + 0.5)::VARCHAR || 'e' || (o_orderkey % 25 - 8))::DOUBLE)::VARCHAR AS literal FROM orders",
)
def double_literals(spark, sf):
    """Doubles from 1e-8 to 1e19: exponents below 1e-4 and from 1e16 only."""
    o = V.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    v = F.concat(k % 1000, F.lit(".5e"), k % 25 - 8).cast("double")
    return o.select("o_orderkey", literal(v.cast("variant")).alias("literal"))


@register(
    "script_rows_roundtrip",
    "SELECT md5('MERGE (n:Doc {text: ''' || replace(replace(replace(replace(text, chr(10), ';' || chr(10) || chr(10)), '\\', '\\\\'), "
    "'''', '\\'''), '\"', '\\\"') || '''})') AS statement_md5, count(*)::BIGINT AS n FROM documents GROUP BY ALL",
)
def script_rows_roundtrip(spark, sf):
    """Statements that hold the script's own separator come back whole from the text alone."""
    import datetime as dt

    from graphweave.session import scratch_dir

    d = V.table(spark, sf, "documents")
    text = F.replace(F.col("text"), F.lit("\n"), F.lit(";\n\n"))
    stmts = d.select(F.concat(F.lit("MERGE (n:Doc {text: "), string_literal(text), F.lit("})")).alias("statement"))
    root = export.write_script(stmts, stmts.limit(0), stmts.limit(0), scratch_dir(spark, "script"), dt.datetime(2024, 1, 1))
    got = export.load_statements(spark, root, mode="quoted")
    return got.groupBy(F.md5("statement").alias("statement_md5")).agg(F.count("*").cast("bigint").alias("n"))


@register(
    "reader_dispatch",
    """SELECT page_id, CASE page_id % 4 WHEN 3 THEN 'unsupported file format: .bin' END AS error,
       CASE page_id % 4 WHEN 0 THEN length(regexp_replace(html, '\\r\\n?', chr(10), 'g'))
            WHEN 1 THEN length(regexp_replace(html, '\\r\\n?', chr(10), 'g')) WHEN 2 THEN length(html) END::BIGINT AS n_chars FROM pages""",
)
def reader_dispatch(spark, sf):
    """S6 and the reader slot: text, Markdown, a registered Python reader, an unknown suffix."""
    from graphweave.sources.files import read_text

    p = V.table(spark, sf, "pages")
    suffix = F.element_at(F.array(*[F.lit(x) for x in ("TXT", "md", "raw", "bin")]), (F.col("page_id") % 4 + 1).cast("int"))
    files = p.select(F.concat(F.lit("a/p"), F.col("page_id"), F.lit("."), suffix).alias("path"), F.encode("html", "UTF-8").alias("content"))
    got = read_text(files, {".raw": lambda data: data.decode("utf-8")})
    return got.select(
        F.regexp_extract("path", "p([0-9]+)", 1).cast("bigint").alias("page_id"), "error",
        F.char_length("text").cast("bigint").alias("n_chars"),
    )


@register(
    "document_names_stripped",
    "SELECT 'Document_doc_' || (doc_id % 50) AS entity_key, arg_min('Doc ' || (doc_id % 50), doc_id) AS name, count(*)::BIGINT AS n "
    "FROM documents GROUP BY doc_id % 50",
)
def document_names_stripped(spark, sf):
    """Document names are stripped (Unicode white space) before they are keyed."""
    d = V.table(spark, sf, "documents")
    name = F.concat(F.lit(" \t"), F.lit("Doc "), F.col("doc_id") % 50, F.lit("  \n"))
    rows = d.select(
        F.lit("f").alias("path"), F.lit("d").alias("document_name"), F.lit(0).alias("chunk_number"), F.col("doc_id").cast("int").alias("pos"),
        F.lit("Document").alias("type"), name.alias("name"), F.create_map(F.lit("name"), name.cast("variant")).alias("props"),
    )
    good, _ = merge.prepare(rows)
    counts = good.groupBy("entity_key").agg(F.count("*").cast("bigint").alias("n"))
    return merge.merge_entities(good, prepared=True).join(counts, "entity_key").select("entity_key", "name", "n")


@register(
    "numbers_from_names",
    """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN doc_id WHEN 1 THEN NULL WHEN 2 THEN 7 ELSE -1 END::BIGINT AS chunk_number FROM documents""",
)
def numbers_from_names(spark, sf):
    """A chunk number is read from the chunk's name where the node has none."""
    d = V.table(spark, sf, "documents")
    name = F.element_at(
        F.array(F.concat(F.lit("a_chunk_"), F.col("doc_id")), F.lit("a_chunk_x"), F.lit("b_chunk_7_chunk_9"), F.lit("c_chunk_5")),
        (F.col("doc_id") % 4 + 1).cast("int"),
    )
    own = F.create_map(F.lit("chunk_number"), F.lit(-1).cast("variant"))
    props = F.when(F.col("doc_id") % 4 == 3, own).otherwise(extract.empty_props())
    got = repair.chunk_number(d.select("doc_id", F.lit("Chunk").alias("type"), name.alias("name"), props.alias("props")))
    return got.select(
        "doc_id", F.try_variant_get(F.try_element_at("props", F.lit("chunk_number")), "$", "bigint").alias("chunk_number")
    )
