"""Derived views over the driver tables (same definitions as the DuckDB oracle SQL).

Each view is a function ``(spark, sf_dir) -> DataFrame`` over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphweave.operators import chunking, extract, merge, shape

SIZE, OVERLAP = 1500, 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def doc_files(spark, sf_dir) -> DataFrame:
    """Documents as files: ``source/lang/doc_<id>.txt``, stem, content MD5."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        "doc_id",
        F.concat_ws("/", "source", "lang", F.concat(F.lit("doc_"), F.col("doc_id"), F.lit(".txt"))).alias("path"),
        F.concat(F.lit("doc_"), F.col("doc_id")).alias("document_name"),
        F.md5(F.col("text")).alias("content_md5"),
        "text",
    )


def doc_chunks(spark, sf_dir) -> DataFrame:
    return chunking.chunk(doc_files(spark, sf_dir), SIZE, OVERLAP)


def doc_results(spark, sf_dir) -> DataFrame:
    return extract.extract(doc_chunks(spark, sf_dir).drop("content_md5"))


def doc_graph(spark, sf_dir):
    """(entities, relationships) of the documents with the default rules."""
    return shape.complete(doc_results(spark, sf_dir))


def conv_chunks(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.select(
        F.concat(F.lit("conversations/conv_"), F.col("conv_id"), F.lit(".txt")).alias("path"),
        F.concat(F.lit("conv_"), F.col("conv_id")).alias("document_name"),
        F.col("turn").cast("int").alias("chunk_number"),
        "role",
        "text",
    )


def conv_results(spark, sf_dir) -> DataFrame:
    """Rules on conversation turns; ``system`` turns stand for failed extractions."""
    r = extract.extract(conv_chunks(spark, sf_dir), partitions=0)
    failed = F.col("role") == "system"
    return r.withColumn("result", F.when(~failed, F.col("result"))).withColumn(
        "error", F.when(failed, F.lit("extractor unavailable"))
    )


def concept_rows(spark, sf_dir) -> DataFrame:
    """Concept entity rows of the document chunks with injected case variants:
    upper case when ``doc_id % 3 = 0``, lower case when ``doc_id % 3 = 1``. ``ß`` stays, as
    engines differ on its capital."""
    ents, _ = doc_graph(spark, sf_dir)
    doc_id = F.regexp_extract(F.col("document_name"), r"^doc_([0-9]+)$", 1).cast("bigint")
    upper = F.replace(F.upper(F.replace(F.col("name"), F.lit("ß"), F.lit("¤"))), F.lit("¤"), F.lit("ß"))
    name = (
        F.when(doc_id % 3 == 0, upper).when(doc_id % 3 == 1, F.lower("name")).otherwise(F.col("name"))
    )
    c = ents.where(F.col("type") == "Concept").withColumn("name", name)
    return c.withColumn("props", shape.set_prop(F.col("props"), "name", F.col("name").cast("variant")))


def event_rows(spark, sf_dir) -> DataFrame:
    """Events as entity rows keyed by (event_type, user_id); property ``k`` from the
    JSON ``props`` with ``""`` injected when ``event_id % 4 = 0``; order = event_id."""
    # dealt first: a file of few row groups is read by few tasks, and the rows are parsed and merged after
    e = table(spark, sf_dir, "events").hint("rebalance", "event_id")
    k = F.when(F.col("event_id") % 4 == 0, F.lit("").cast("variant")).otherwise(
        F.try_element_at(F.from_json("props", "map<string,variant>"), F.lit("k"))
    )
    name = F.concat_ws(" ", "event_type", F.col("user_id").cast("string"))
    return e.select(
        F.lit("events").alias("path"),
        F.col("event_id").alias("seq"),
        F.lit(0).alias("pos"),
        F.lit("Account").alias("type"),
        name.alias("name"),
        F.create_map(F.lit("name"), name.cast("variant"), F.lit("k"), k).alias("props"),
        F.lit("events").alias("document_name"),
    )


def conv_dup_rows(spark, sf_dir) -> DataFrame:
    """Chunk rows of the conversations in two copies with texts blanked by rule.

    Copy 0 names the chunk ``conv_<id>_chunk_<turn>`` and blanks the text when
    ``turn % 3`` is 1 or 2; copy 1 names it ``conv_<id>_part_<turn>`` (another node)
    and blanks the text when ``turn % 3 = 2``. Both copies carry the record's
    document name and chunk number, which is what the repairs look up."""
    c = table(spark, sf_dir, "conversations")
    rows = []
    for copy, label, blank in ((0, "chunk", F.col("turn") % 3 != 0), (1, "part", F.col("turn") % 3 == 2)):
        doc = F.concat(F.lit("conv_"), F.col("conv_id"))
        nm = F.concat(doc, F.lit(f"_{label}_"), F.col("turn"))
        text = F.when(blank, F.lit("")).otherwise(F.col("text"))
        rows.append(
            c.select(
                F.concat(F.lit(f"copy{copy}/conv_"), F.col("conv_id"), F.lit(".txt")).alias("path"),
                doc.alias("document_name"),
                F.col("turn").cast("int").alias("chunk_number"),
                F.lit(0).alias("pos"),
                F.lit("Chunk").alias("type"),
                nm.alias("name"),
                F.create_map(
                    F.lit("name"), nm.cast("variant"),
                    F.lit("text"), text.cast("variant"),
                    F.lit("chunk_number"), F.col("turn").cast("int").cast("variant"),
                ).alias("props"),
            )
        )
    return rows[0].unionByName(rows[1])


# ---------------------------------------------------------------------------
# star schema as a property graph
# ---------------------------------------------------------------------------


def _node(df: DataFrame, path: str, seq, type_: str, name, **props) -> DataFrame:
    kv = [F.lit("name"), name.cast("variant")]
    for k, v in props.items():
        kv += [F.lit(k), v.cast("variant")]
    return df.select(
        F.lit(path).alias("path"),
        seq.cast("bigint").alias("seq"),
        F.lit(0).alias("pos"),
        F.lit(type_).alias("type"),
        name.alias("name"),
        F.create_map(*kv).alias("props"),
        F.lit(path).alias("document_name"),
    )


def star_rows(spark, sf_dir) -> DataFrame:
    """Entity rows: Person=customer, Organization=supplier, Product=part,
    Event=order, Location=nation/region and market segments; segments also as Topic
    (same name, two labels)."""
    t = lambda n: table(spark, sf_dir, n)
    c, s, p, o = t("customer"), t("supplier"), t("part"), t("orders")
    n, r = t("nation"), t("region")
    seg = c.select("c_mktsegment").distinct()
    parts = [
        _node(c, "customer", F.col("c_custkey"), "Person", F.col("c_name"),
              acctbal=F.col("c_acctbal"), segment=F.col("c_mktsegment")),
        _node(s, "supplier", F.col("s_suppkey"), "Organization", F.col("s_name"), acctbal=F.col("s_acctbal")),
        _node(p, "part", F.col("p_partkey"), "Product", F.concat(F.lit("part_"), F.col("p_partkey")),
              brand=F.col("p_brand"), size=F.col("p_size"), retailprice=F.col("p_retailprice")),
        _node(o, "orders", F.col("o_orderkey"), "Event", F.concat(F.lit("order_"), F.col("o_orderkey")),
              status=F.col("o_orderstatus"), totalprice=F.col("o_totalprice"), priority=F.col("o_orderpriority")),
        _node(n, "nation", F.col("n_nationkey"), "Location", F.col("n_name")),
        _node(r, "region", F.col("r_regionkey"), "Location", F.col("r_name")),
        _node(seg, "segment_a", F.lit(0), "Location", F.col("c_mktsegment")),
        _node(seg, "segment_b", F.lit(0), "Topic", F.col("c_mktsegment")),
    ]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def star_nodes(spark, sf_dir) -> DataFrame:
    # a key per row of a table, as a rule; where not, the rows are merged as ever
    return merge.merge_entities(star_rows(spark, sf_dir), ord_cols=("path", "seq", "pos"), mostly_unique=True)


def _rel(df: DataFrame, path: str, seq, pos, source, target, type_: str) -> DataFrame:
    return df.select(
        F.lit(path).alias("path"),
        seq.cast("bigint").alias("seq"),
        pos.cast("int").alias("pos"),
        source.alias("source"),
        target.alias("target"),
        F.lit(type_).alias("type"),
        F.expr("cast(map() as map<string,variant>)").alias("props"),
    )


def star_rels(spark, sf_dir) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    c, s, o, li = t("customer"), t("supplier"), t("orders"), t("lineitem")
    n, r = t("nation"), t("region")
    cn = c.join(n, c.c_nationkey == n.n_nationkey)
    sn = s.join(n, s.s_nationkey == n.n_nationkey)
    nr = n.join(r, n.n_regionkey == r.r_regionkey)
    co = o.join(c.hint("merge"), o.o_custkey == c.c_custkey)  # packed files of names look small; no broadcast of them
    parts = [
        _rel(cn, "r1_customer_nation", F.col("c_custkey"), F.lit(0), F.col("c_name"), F.col("n_name"), "LOCATED_IN"),
        _rel(sn, "r2_supplier_nation", F.col("s_suppkey"), F.lit(0), F.col("s_name"), F.col("n_name"), "LOCATED_IN"),
        _rel(nr, "r3_nation_region", F.col("n_nationkey"), F.lit(0), F.col("n_name"), F.col("r_name"), "PART_OF"),
        _rel(co, "r4_customer_order", F.col("o_orderkey"), F.lit(0), F.col("c_name"),
             F.concat(F.lit("order_"), F.col("o_orderkey")), "PARTICIPATES_IN"),
        _rel(li, "r5_order_part", F.col("l_orderkey"), F.col("l_linenumber"),
             F.concat(F.lit("order_"), F.col("l_orderkey")), F.concat(F.lit("part_"), F.col("l_partkey")), "CONTAINS"),
        _rel(c, "r6_customer_segment", F.col("c_custkey"), F.lit(0), F.col("c_name"), F.col("c_mktsegment"), "RELATED_TO"),
    ]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def star_rels_dirty(spark, sf_dir) -> DataFrame:
    """``star_rels`` plus customer rows whose target is a case variant
    (lower-cased, ``c_custkey % 10 = 1``), missing (``= 2``) or empty (``= 3``)."""
    t = lambda n: table(spark, sf_dir, n)
    c, n = t("customer"), t("nation")
    cn = c.join(n, c.c_nationkey == n.n_nationkey)
    k = F.col("c_custkey") % 10
    tgt = F.when(k == 1, F.lower(F.col("n_name"))).when(k == 2, F.lit(None).cast("string")).otherwise(F.lit(""))
    dirty = _rel(cn.where(k.isin(1, 2, 3)), "r7_dirty", F.col("c_custkey"), F.lit(0), F.col("c_name"), tgt, "LOCATED_IN")
    return star_rels(spark, sf_dir).unionByName(dirty)


def doc_manifest(spark, sf_dir) -> DataFrame:
    """Synthetic manifest: status ``ok`` when ``doc_id % 3 = 0`` else ``failed``;
    the recorded MD5 is stale (altered) when ``doc_id % 9 = 0``."""
    f = doc_files(spark, sf_dir)
    md5 = F.when(F.col("doc_id") % 9 == 0, F.md5(F.concat(F.col("text"), F.lit(" ")))).otherwise(F.col("content_md5"))
    return f.select(
        "path",
        "document_name",
        md5.alias("content_md5"),
        F.lit("run-1").alias("run_id"),
        F.when(F.col("doc_id") % 3 == 0, F.lit("ok")).otherwise(F.lit("failed")).alias("status"),
        F.when(F.col("doc_id") % 3 != 0, F.lit("extraction failed")).alias("error"),
        F.lit(None).cast("int").alias("n_chunks"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("finished_at"),
    )
