"""End-to-end plans.

* ``flagship``: documents table → chunks → rules → completion → merge → resolve →
  entities ranked by the number of distinct documents mentioning them.
* ``build_graph``: the full batch build over any chunk table (E1 without files).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphweave.operators import edges, graph, merge, repair, shape
from graphweave.plans import views as V


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    Used for the merged node table, which several joins read: every reader scans
    the table instead of recomputing the merge (and its shuffles)."""
    from graphweave.session import scratch_dir

    path = scratch_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def build_graph(
    results: DataFrame, pre_repair: bool = False, persist_nodes: bool = True, embedding_col: str | None = None
):
    """From per-chunk extraction results to ``(nodes, relationships)``. ``embedding_col``: a
    column of ``results`` whose vectors become the ``embedding`` property of the chunk nodes.

    ``nodes`` are merged and text-repaired (and, by default, written once so the
    joins that follow read a table); relationships are the bag union."""
    ents, rels = shape.complete(results, embedding_col=embedding_col)
    if pre_repair:
        ents = repair.pre_merge(ents).drop("repaired")
    rows, _quarantine = merge.prepare(ents)
    nodes = merge.merge_entities(rows, prepared=True)
    if persist_nodes:  # the repair reads the merged nodes three times
        nodes = materialize(nodes, "merged")
    nodes = repair.post_merge(nodes, rows).drop("repaired")
    if persist_nodes:
        nodes = materialize(nodes, "nodes")
    return nodes, merge.merge_relationships(rels)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    from graphweave.session import scratch_dir
    from graphweave.sources import store

    # extraction results are the durability boundary: written once, read back
    path = scratch_dir(spark, "store")
    store.write_store(V.doc_results(spark, sf_dir), path)
    nodes, rels = build_graph(spark.read.parquet(path))
    resolved = edges.resolve(nodes, rels)
    mentions = graph.document_mentions(resolved)
    return (
        mentions.groupBy("entity_key", "entity_name", "entity_type")
        .agg(F.countDistinct("document_key").cast("bigint").alias("n_documents"))
        .orderBy(F.col("n_documents").desc(), F.col("entity_key"))
    )


def run_batch(
    spark: SparkSession,
    input_dir: str,
    work_dir: str,
    run_id: str,
    formats=("txt", "pdf", "docx", "md"),
    incremental: str = "path",
    size: int = 1500,
    overlap: int = 500,
    extractor=None,
    readers=None,
    write_outputs: bool = True,
    extractor_factory=None,
    request: dict | None = None,
    entity_types=None,
    relationship_types=None,
    embed: bool = False,
    embedding_fn=None,
    embedding_dims: int = 1536,
    max_literal_chars: int | None = None,
):
    """One batch run over the files of ``input_dir``.

    discover → pending (manifest anti-join) → read text → chunk → extract → **write
    store, read back** → complete → merge → repair → statements → script; manifest
    rows for every file (ok or failed). Returns a dict of DataFrames.

    ``extractor`` / ``extractor_factory``: see ``extract.extract``; ``request`` (arguments of
    ``prompts.build_requests``, ``{}`` for its defaults) gives it the text of the request
    with each chunk, which names the vocabularies below unless it names its own. ``entity_types`` /
    ``relationship_types`` restrict the graph to these. ``embed`` adds chunk embeddings
    (``embedding_fn`` or the built-in hashing) of ``embedding_dims`` dimensions and the index
    statements. ``max_literal_chars`` cuts long strings in statements (none by default)."""
    from graphweave.operators import chunking, export, extract, prompts, vectors
    from graphweave.sources import files as fsrc
    from graphweave.sources import manifest as msrc
    from graphweave.sources import store as ssrc

    man_path, store_path = f"{work_dir}/manifest", f"{work_dir}/store"
    done = msrc.read(spark, man_path)
    found = fsrc.discover(spark, input_dir, formats)
    if incremental == "path":  # skip before any byte is read
        found = msrc.pending(found, done, "path")
    found = materialize(found, "found")  # one listing
    with_bytes = fsrc.load_content(spark, found, input_dir, formats)
    # read once: everything below sees the texts and hashes of this one pass over the bytes
    docs = materialize(fsrc.read_text(with_bytes.drop("document_name"), readers), "documents")
    todo = docs if incremental == "path" else msrc.pending(docs, done, incremental)
    ok_docs = todo.where(F.col("error").isNull())
    previous = _read_store_or_none(spark, store_path, exclude_run=run_id)
    if previous is not None:  # I3: reuse stored extractions of (stem, content) pairs
        hits, misses = ssrc.split_cached(ok_docs, previous)
    else:
        hits, misses = None, ok_docs
    chunks = chunking.chunk(misses.select("path", "document_name", "content_md5", "text"), size, overlap)
    if request is not None:
        words = {"entity_types": entity_types, "relationship_types": relationship_types}
        chunks = prompts.build_requests(chunks, **({k: v for k, v in words.items() if v is not None} | request))
    results = extract.extract(chunks, fn=extractor, factory=extractor_factory)
    ssrc.write_store(results.drop("request"), store_path, run_id)
    stored = ssrc.read_store(spark, store_path, run_id=run_id).drop("run_id")
    counts = stored.groupBy("path").agg(F.count("*").cast("int").alias("n_chunks"))  # newly extracted ones
    if hits is not None:
        reused = (
            previous.join(hits.select("document_name", "content_md5").distinct(), ["document_name", "content_md5"], "left_semi")
            .groupBy("document_name", "content_md5", "chunk_number")
            .agg(F.max_by(F.struct(*[c for c in stored.columns if c not in ("document_name", "content_md5", "chunk_number")]),
                          "extraction_time").alias("r"))
            .select("document_name", "content_md5", "chunk_number", "r.*")
            # the reused rows belong to this run's file path
            .drop("path")
            .join(hits.select("document_name", "content_md5", "path"), ["document_name", "content_md5"])
        )
        stored = stored.unionByName(reused)
    shown = extract.restrict_results(stored, entity_types, relationship_types)
    if embed:  # the store keeps texts; embeddings are made once per run and read back
        shown = materialize(vectors.embed(shown, "text", embedding_fn, embedding_dims), "embedded")
    nodes, rels = build_graph(shown, embedding_col="embedding" if embed else None)
    rels = materialize(rels, "relationships")  # tables, statements and the summary read it
    if write_outputs:
        export.write_graph(nodes, rels, f"{work_dir}/graph")
        export.write_script(
            export.node_statements(nodes, max_literal_chars), export.edge_statements(rels, max_literal_chars),
            export.index_statements(nodes, enabled=embed, dims=embedding_dims), f"{work_dir}/output",
        )
    msrc.append(msrc.rows_for(todo, counts, run_id), man_path)
    from graphweave.operators import stats

    summary = stats.batch_summary(todo, hits, nodes, rels)
    return {"nodes": nodes, "relationships": rels, "documents": todo, "store": stored, "summary": summary}


def _read_store_or_none(spark: SparkSession, store_path: str, exclude_run: str | None = None):
    from graphweave.sources.store import read_if_exists

    s = read_if_exists(spark, store_path)
    if s is not None and exclude_run is not None and "run_id" in s.columns:
        s = s.where(F.col("run_id") != exclude_run)
    return s.drop("run_id") if s is not None and "run_id" in s.columns else s


def rebuild_from_store(spark: SparkSession, records_path: str, latest: bool = False, multiline: bool = True):
    """JSON extraction records → pre-merge repair → merge → in-merge repair.

    Returns ``(nodes, relationships, quarantine)``."""
    from graphweave.sources import store as ssrc

    records, bad = ssrc.read_records(spark, records_path, multiline)
    if latest:  # a record file is a version of its document
        records = ssrc.latest_only(records, version="source_file")
    ents, rels = ssrc.record_rows(records)
    ents = repair.pre_merge(ents).drop("repaired")
    rows, quarantine = merge.prepare(ents)
    nodes = materialize(merge.merge_entities(rows, prepared=True), "merged")  # the repair reads it three times
    nodes = repair.post_merge(nodes, rows).drop("repaired")
    return nodes, rels, quarantine.select("path", "document_name", "reason").unionByName(
        bad.select(F.col("source_file").alias("path"), F.lit(None).cast("string").alias("document_name"),
                   F.lit("corrupt record").alias("reason"))
    )


def rebuild_run(
    spark: SparkSession,
    store_path: str,
    out_dir: str,
    latest: bool = True,
    entity_types=None,
    relationship_types=None,
    max_literal_chars: int | None = None,
):
    """E2 over the Parquet store of batch runs: no file is read and no extractor called.

    Of rows stored again under one key (document, content, chunk) the last written one counts;
    ``latest`` also keeps only the content of each document that was extracted last. Pre-merge repair, merge and
    in-merge repair follow, then the outputs of a run: graph tables under ``<out_dir>/graph`` and a load
    script under ``<out_dir>/output``. Returns a dict as ``run_batch`` does, with the ``script`` folder.

    Two shuffles of the stored rows (by key; versions by document), then those of the merge. Null
    documents or contents are keys like others."""
    from graphweave.operators import export, extract, stats
    from graphweave.sources import store as ssrc

    stored = ssrc.read_store(spark, store_path, dedupe=True)
    if latest:
        version = stored.groupBy("document_name").agg(
            F.max_by(F.struct("content_md5"), F.struct("extraction_time", "content_md5")).alias("v"))
        version = version.select(F.col("document_name").alias("__doc"), F.col("v.content_md5").alias("__md5"))
        stored = stored.join(
            version, F.col("document_name").eqNullSafe(F.col("__doc")) & F.col("content_md5").eqNullSafe(F.col("__md5")), "left_semi")
    stored = materialize(extract.restrict_results(stored, entity_types, relationship_types), "rebuilt")
    nodes, rels = build_graph(stored, pre_repair=True)
    rels = materialize(rels, "relationships")
    export.write_graph(nodes, rels, f"{out_dir}/graph")
    script = export.write_script(
        export.node_statements(nodes, max_literal_chars), export.edge_statements(rels, max_literal_chars),
        export.index_statements(nodes, dims=None), f"{out_dir}/output",
    )
    documents = stored.groupBy("path").agg(F.max("error").alias("error"))
    return {"nodes": nodes, "relationships": rels, "store": stored, "script": script,
            "summary": stats.batch_summary(documents, None, nodes, rels)}
