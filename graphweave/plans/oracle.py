"""DuckDB SQL building blocks for the oracle side of every registered query.

They restate the view definitions of ``plans.views`` and the default extraction
rules in plain SQL over the driver's tables; no Spark code is involved.
"""

from graphweave.operators.extract import EMAIL_RE, IPV4_RE, LICENSE_RE

# spelled here on its own: words of four letters or more, a capital and a small letter first
CONCEPT_SQL = r"(?:^|[^\p{L}])(\p{Lu}\p{Ll}+\p{L}{2,})"

DOC_FILES = """doc_files AS (
  SELECT doc_id, source || '/' || lang || '/doc_' || doc_id || '.txt' AS path,
         'doc_' || doc_id AS document_name, md5(text) AS content_md5, text
  FROM documents)"""

DOC_CHUNKS = """doc_chunks AS (
  SELECT doc_id, path, document_name, content_md5, i::INTEGER AS chunk_number,
         document_name || '_chunk_' || i AS chunk_name,
         substring(text, i * 1000 + 1, 1500) AS text
  FROM (SELECT *, unnest(range(0, CASE WHEN length(text) = 0 THEN 0
                    ELSE greatest(1, (length(text) - 500 + 999) // 1000) END)) AS i
        FROM doc_files))"""

CONV_CHUNKS = """conv_chunks AS (
  SELECT 'conversations/conv_' || conv_id || '.txt' AS path, 'conv_' || conv_id AS document_name,
         turn::INTEGER AS chunk_number, 'conv_' || conv_id || '_chunk_' || turn AS chunk_name, role, text
  FROM conversations)"""


def hits(src: str) -> str:
    """Rule entities of chunk table ``src`` (needs chunk_name, text): ``ents`` with
    chunk_name, grp, type, name, o (first offset), pos; plus ``rule_rels``."""

    def part(grp: int, type_: str, pattern: str, group: int = 0) -> str:
        return (
            f"SELECT chunk_name, {grp} AS grp, '{type_}' AS type, unnest(l) AS name, unnest(range(len(l))) AS o "
            f"FROM (SELECT chunk_name, regexp_extract_all(text, '{pattern}', {group}) AS l FROM {src})"
        )

    return f"""raw_hits AS (
  {part(0, 'Concept', CONCEPT_SQL, 1)}
  UNION ALL {part(1, 'Technology', LICENSE_RE)}
  UNION ALL {part(2, 'Person', EMAIL_RE)}
  UNION ALL {part(4, 'Location', IPV4_RE)}),
hits0 AS (SELECT chunk_name, grp, type, name, min(o) AS o FROM raw_hits GROUP BY ALL),
hits1 AS (
  SELECT * FROM hits0
  UNION ALL
  SELECT chunk_name, 3 AS grp, 'Organization' AS type, lower(split_part(name, '@', 2)) AS name, min(o) AS o
  FROM hits0 WHERE grp = 2 GROUP BY ALL),
ents AS (
  SELECT chunk_name, grp, type, name, o,
         (row_number() OVER (PARTITION BY chunk_name ORDER BY grp, o) - 1)::INTEGER AS pos,
         CASE type WHEN 'Concept' THEN 'name' WHEN 'Technology' THEN 'name,category'
                   WHEN 'Person' THEN 'name,email' WHEN 'Organization' THEN 'name,domain'
                   ELSE 'name,kind' END AS prop_keys
  FROM hits1),
conc AS (SELECT chunk_name, name, pos FROM ents WHERE grp = 0),
nconc AS (SELECT chunk_name, count(*) AS nc FROM conc GROUP BY ALL),
mails AS (SELECT chunk_name, name, (row_number() OVER (PARTITION BY chunk_name ORDER BY o) - 1) AS rk FROM ents WHERE grp = 2),
rule_rels AS (
  SELECT a.chunk_name, a.pos::INTEGER AS pos, a.name AS source, b.name AS target, 'RELATED_TO' AS type
  FROM conc a JOIN conc b ON a.chunk_name = b.chunk_name AND b.pos = a.pos + 1
  UNION ALL
  SELECT m.chunk_name, (coalesce(greatest(n.nc - 1, 0), 0) + m.rk)::INTEGER AS pos, m.name AS source,
         lower(split_part(m.name, '@', 2)) AS target, 'WORKS_FOR' AS type
  FROM mails m LEFT JOIN nconc n ON m.chunk_name = n.chunk_name),
nrels AS (SELECT chunk_name, count(*) AS nr FROM rule_rels GROUP BY ALL),
nents AS (SELECT chunk_name, count(*) AS ne FROM ents GROUP BY ALL)"""


def esc(x: str) -> str:
    """Escaped, cut literal body (no quotes) of SQL expression ``x``."""
    e = f"replace(replace(replace({x}, '\\', '\\\\'), '''', '\\'''), '\"', '\\\"')"
    return f"(CASE WHEN length({e}) > 32000 THEN substring({e}, 1, 32000) || '...' ELSE {e} END)"


def key(type_sql: str, name_sql: str) -> str:
    return f"({type_sql} || '_' || replace(lower(trim({name_sql})), ' ', '_'))"


STAR_ROWS = """star_rows AS (
  SELECT 'customer' AS path, c_custkey AS seq, 'Person' AS type, c_name AS name,
         'name: ''' || c_name || ''', acctbal: ' || c_acctbal::VARCHAR || ', segment: ''' || c_mktsegment || '''' AS body
  FROM customer
  UNION ALL SELECT 'supplier', s_suppkey, 'Organization', s_name, 'name: ''' || s_name || ''', acctbal: ' || s_acctbal::VARCHAR FROM supplier
  UNION ALL SELECT 'part', p_partkey, 'Product', 'part_' || p_partkey,
         'name: ''part_' || p_partkey || ''', brand: ''' || p_brand || ''', size: ' || p_size || ', retailprice: ' || p_retailprice::VARCHAR FROM part
  UNION ALL SELECT 'orders', o_orderkey, 'Event', 'order_' || o_orderkey,
         'name: ''order_' || o_orderkey || ''', status: ''' || o_orderstatus || ''', totalprice: ' || o_totalprice::VARCHAR || ', priority: ''' || o_orderpriority || '''' FROM orders
  UNION ALL SELECT 'nation', n_nationkey, 'Location', n_name, 'name: ''' || n_name || '''' FROM nation
  UNION ALL SELECT 'region', r_regionkey, 'Location', r_name, 'name: ''' || r_name || '''' FROM region
  UNION ALL SELECT DISTINCT 'segment_a', 0, 'Location', c_mktsegment, 'name: ''' || c_mktsegment || '''' FROM customer
  UNION ALL SELECT DISTINCT 'segment_b', 0, 'Topic', c_mktsegment, 'name: ''' || c_mktsegment || '''' FROM customer),
star_nodes AS (
  SELECT """ + key("type", "name") + """ AS entity_key, type, name, path, seq, body FROM star_rows)"""

STAR_RELS = """star_rels AS (
  SELECT 'r1_customer_nation' AS path, c_custkey AS seq, 0 AS pos, c_name AS source, n_name AS target, 'LOCATED_IN' AS type
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL SELECT 'r2_supplier_nation', s_suppkey, 0, s_name, n_name, 'LOCATED_IN' FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT 'r3_nation_region', n_nationkey, 0, n_name, r_name, 'PART_OF' FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT 'r4_customer_order', o_orderkey, 0, c_name, 'order_' || o_orderkey, 'PARTICIPATES_IN' FROM orders JOIN customer ON o_custkey = c_custkey
  UNION ALL SELECT 'r5_order_part', l_orderkey, l_linenumber, 'order_' || l_orderkey, 'part_' || l_partkey, 'CONTAINS' FROM lineitem
  UNION ALL SELECT 'r6_customer_segment', c_custkey, 0, c_name, c_mktsegment, 'RELATED_TO' FROM customer),
star_rels_dirty AS (
  SELECT * FROM star_rels
  UNION ALL
  SELECT 'r7_dirty', c_custkey, 0, c_name,
         CASE c_custkey % 10 WHEN 1 THEN lower(n_name) WHEN 2 THEN NULL ELSE '' END, 'LOCATED_IN'
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 10 IN (1, 2, 3)),
star_resolved AS (
  SELECT r.*, a.entity_key AS src_key, a.type AS src_type, b.entity_key AS dst_key, b.type AS dst_type
  FROM star_rels_dirty r JOIN star_nodes a ON a.name = r.source JOIN star_nodes b ON b.name = r.target
  WHERE r.source <> '' AND r.target <> '')"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
