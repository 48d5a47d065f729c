"""The analysis graph and the pattern queries it serves.

* ``name_nodes`` (A5): one node per exact name (``unknown_<type>`` when the node has
  no name); a later node of the same name overwrites type and properties.
* ``undirected_edges`` (A6): strict relationships as a simple undirected graph, one
  edge per unordered pair, the later relationship wins, self loops kept.
* ``match`` (J7): ``(a:src_type)-[:rel_type]->(b:dst_type)`` over resolved edges.
* ``document_mentions`` (J8): documents whose chunks mention an entity
  (MENTIONS ⋈ BELONGS_TO on the chunk node).
* ``paths`` (J9): undirected paths of 1..max_hops edges from seed nodes to nodes of a
  label, no edge used twice in a path; built hop by hop with equi-joins on edges of the
  nodes reached; the numbered edges and each frontier are written once under the shared checkpoint
  folder and read back, so no hop recomputes the lineage before it. A frontier of more than ``FEW`` rows
  and the names of nodes are joined by sort and merge, never broadcast through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphweave.operators.edges import at_known, dealt, hub_hashes, is_hub, known_names
from graphweave.session import scratch_dir

FEW = 100_000  # a frontier of so many rows may be broadcast


def name_nodes(nodes: DataFrame) -> DataFrame:
    """A5: ``node_id, type, props`` – last node (by merge order) per name wins."""
    has = F.map_contains_key(F.col("props"), F.lit("name"))
    node_id = F.when(has, F.col("name")).otherwise(F.concat(F.lit("unknown_"), F.col("type")))
    return (
        nodes.select(node_id.alias("node_id"), "type", "props", "first_ord")
        .where(F.col("node_id").isNotNull())
        .groupBy("node_id")
        .agg(F.max_by(F.struct("type", "props"), "first_ord").alias("n"))
        .select("node_id", "n.type", "n.props")
    )


def undirected_edges(nodes: DataFrame, rels: DataFrame, ord_cols=("path", "chunk_number", "pos")) -> DataFrame:
    """``u, v, type, source, target, props`` with ``u <= v``.

    Whether both names exist is the same for all relationships of a pair, so the pair is folded first, where
    its smaller name is looked up: one shuffle by ``u`` serves both, a second by ``v`` the other name. Only
    a pair of two hubs can hold a large part of all rows; such pairs are folded before they are dealt."""
    hot = hub_hashes(rels)
    rows = rels.where(F.col("source").isNotNull() & F.col("target").isNotNull()).select(
        F.least("source", "target").alias("u"),
        F.greatest("source", "target").alias("v"),
        F.struct(*[F.col(c) for c in ord_cols]).alias("o"),
        F.struct("type", "source", "target", "props").alias("r"),
    )
    if hot:
        two = is_hub("u", hot) & is_hub("v", hot)
        few = rows.where(two).groupBy("u", "v").agg(F.max("o").alias("o"), F.max_by("r", "o").alias("r"))
        rows = rows.where(~two).unionByName(few)
    pair = F.xxhash64("u", "v")
    rows = dealt(dealt(rows, hot, "u", "__us", pair), hot, "v", "__vs", pair).withColumn("__us_hash", F.xxhash64("u"))
    at = ["__us_hash", "u", "__us"]
    folded = rows.repartition(*at).groupBy(*at, "v", "__vs").agg(F.max_by("r", "o").alias("r"))
    names = known_names(nodes, hot)
    kept = at_known(at_known(folded, names, "u", "__us"), names, "v", "__vs")
    return kept.select("u", "v", "r.type", "r.source", "r.target", "r.props")


def match(resolved: DataFrame, src_type: str | None, rel_type: str | None, dst_type: str | None) -> DataFrame:
    """Typed one-hop pattern over resolved edges (J6 output)."""
    cond = F.lit(True)
    if src_type:
        cond = cond & (F.col("src_type") == src_type)
    if rel_type:
        cond = cond & (F.col("type") == rel_type)
    if dst_type:
        cond = cond & (F.col("dst_type") == dst_type)
    return resolved.where(cond)


def document_mentions(resolved: DataFrame, name: str | None = None, entity_type: str | None = None) -> DataFrame:
    """Distinct ``(document_key, entity_key)`` where a chunk of the document
    MENTIONS the entity. Optional filters on the entity name and type."""
    m = resolved.where(F.col("type") == "MENTIONS").select(
        F.col("src_key").alias("chunk_key"), F.col("dst_key").alias("entity_key"), F.col("dst_name").alias("entity_name"),
        F.col("dst_type").alias("entity_type"),
    )
    if name is not None:
        m = m.where(F.col("entity_name") == name)
    if entity_type is not None:
        m = m.where(F.col("entity_type") == entity_type)
    b = resolved.where((F.col("type") == "BELONGS_TO") & (F.col("dst_type") == "Document")).select(
        F.col("src_key").alias("chunk_key"), F.col("dst_key").alias("document_key"), F.col("dst_name").alias("document_name")
    )
    return m.join(b, "chunk_key").select("document_key", "document_name", "entity_key", "entity_name", "entity_type").distinct()


def edge_id(resolved: DataFrame) -> DataFrame:
    """Deduplicated resolved edges with an id: the digest of their fields as JSON, which keeps
    fields apart whatever characters they hold."""
    return resolved.select(
        "src_key", "dst_key", "type", F.to_json("props").alias("props_json")
    ).distinct().withColumn(
        "eid", F.md5(F.to_json(F.struct("src_key", "type", "dst_key", "props_json")))
    )


def edge_numbers(resolved: DataFrame) -> DataFrame:
    """``src_key, src_type, dst_key, dst_type, e1, e2``: every resolved edge with two 64-bit numbers.

    They are hashes of all its fields under different leading values, 128 bits together, so equal edges
    have equal numbers and no shuffle is needed to give them out. The fields are hashed as one JSON text,
    which keeps them apart whatever characters they hold."""
    whole = F.to_json(F.struct("src_key", "type", "dst_key", F.to_json("props").alias("props")))
    return resolved.select(
        "src_key", "src_type", "dst_key", "dst_type",
        F.xxhash64(F.lit(1), whole).alias("e1"), F.xxhash64(F.lit(2), whole).alias("e2"),
    )


def _touching(links: DataFrame, at: DataFrame, label: str | None) -> DataFrame:
    """``a, b, e1, e2``: distinct edges with one end in ``at`` (column ``a``), from that end; with
    ``label`` only those whose other end bears it."""
    out = links.select(F.col("src_key").alias("a"), F.col("dst_key").alias("b"), "e1", "e2", F.col("dst_type").alias("t"))
    back = links.where(F.col("src_key") != F.col("dst_key")).select(
        F.col("dst_key").alias("a"), F.col("src_key").alias("b"), "e1", "e2", F.col("src_type").alias("t")
    )
    both = out.unionByName(back)
    if label is not None:
        both = both.where(F.col("t") == label)
    return both.join(at, "a", "left_semi").select("a", "b", "e1", "e2").distinct()


def paths(
    nodes: DataFrame,
    resolved: DataFrame,
    seed: str | list[str] | None = None,
    dst_type: str = "Location",
    max_hops: int = 3,
    checkpoint: bool = True,
    seed_nodes: DataFrame | None = None,
) -> DataFrame:
    """``seed_key, dst_key, dst_name, hops, path`` (node names joined by ``|``).

    Seeds: ``seed_nodes`` (a node DataFrame), else ``seed`` as a node name or list
    of names, else every node. Each path is a sequence of distinct edges; nodes may
    repeat. A hop touches only edges at nodes that were reached, and only these are
    de-duplicated; the last hop starts from the label: edges whose far end does not bear
    it are left out before anything is joined. The result grows with the graph: hubs make
    it large by nature, and the hop joins are skew-split by AQE rather than capped."""
    spark = nodes.sparkSession
    scratch = scratch_dir(spark, "paths") if checkpoint else None

    def cut(df: DataFrame, name: str) -> DataFrame:
        # lineage cut: a table written once to the shared checkpoint folder
        if scratch is None:
            return df
        df.write.mode("overwrite").parquet(f"{scratch}/{name}")
        return spark.read.parquet(f"{scratch}/{name}")

    links = cut(edge_numbers(resolved), "links")
    info = nodes.select(F.col("entity_key").alias("b"), F.col("name").alias("b_name"), F.col("type").alias("b_type"))
    start = seed_nodes if seed_nodes is not None else nodes
    if seed_nodes is None and seed is not None:
        seeds = [seed] if isinstance(seed, str) else list(seed)
        start = start.where(F.col("name").isin(*seeds))
    frontier = start.select(
        F.col("entity_key").alias("seed_key"),
        F.col("entity_key").alias("cur"),
        F.array(F.col("name")).alias("names"),
        F.array().cast("array<struct<e1:bigint,e2:bigint>>").alias("eids"),
    )
    frontier, found = cut(frontier, "seeds"), []
    for hop in range(1, max_hops + 1):
        many = scratch is None or frontier.count() > FEW
        at = frontier.select(F.col("cur").alias("a")).distinct()
        if many:
            frontier, at = frontier.hint("merge"), at.hint("merge")
        near = _touching(links, at, dst_type if hop == max_hops else None)
        edge = F.struct("e1", "e2")
        step = (
            frontier.join(near, frontier["cur"] == near["a"])
            .where(~F.array_contains(F.col("eids"), edge))
            .join(info.hint("merge"), "b")
            .select(
                "seed_key",
                F.col("b").alias("cur"),
                F.concat(F.col("names"), F.array(F.col("b_name"))).alias("names"),
                F.concat(F.col("eids"), F.array(edge)).alias("eids"),
                "b_type",
            )
        )
        if hop < max_hops:
            step = cut(step, f"hop{hop}")
        found.append(
            step.where(F.col("b_type") == dst_type).select(
                "seed_key",
                F.col("cur").alias("dst_key"),
                F.try_element_at(F.col("names"), F.lit(-1)).alias("dst_name"),
                F.lit(hop).alias("hops"),
                F.array_join(F.col("names"), "|").alias("path"),
            )
        )
        frontier = step.drop("b_type")
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out
