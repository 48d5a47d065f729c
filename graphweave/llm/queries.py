"""Registered queries of this subpackage: ``opN_<name>`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    jaccard_join,
    learned_partitions,
    line_crf,
    mixing,
    packing,
    phrases,
    posting_blocks,
    set_sketch,
    suffix_dedup,
    token_files,
    weak_labels,
    web_archives,
    window_dedup,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """The lower-casing word vocabulary; a file every executor has at the same place."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


END_OF_DOCUMENT = 49407  # <|endoftext|> of that vocabulary


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web_archives.archive_round_trip(_table(spark, sf_dir, "pages"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), vocabulary(), with_ids=False)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_bytes_digest(_table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.document_token_counts(_table(spark, sf_dir, "documents"), vocabulary(), END_OF_DOCUMENT)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_dedup.repeated_windows_digest(_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    field = line_crf.train_on(docs, _table(spark, sf_dir, "labels"))
    return line_crf.label_lines(docs, field).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_words"
    )


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_labels.classify(_table(spark, sf_dir, "documents")).select("row.doc_id", "score", "kept")


def op9_approximate_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learned_partitions.nearest(_table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0, 20)


def op10_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(_table(spark, sf_dir, "documents"))


def op11_phrase_collocation_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_sketch.near_duplicates(_table(spark, sf_dir, "documents"))


def op13_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_blocks.rank(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_warc,
        op2_best_fit_packing,
        op3_suffix_dedup,
        op4_token_counts,
        op5_substring_dedup,
        op6_quality_rules,
        op7_ngram_jaccard_join,
        op8_quality_classifier,
        op9_approximate_nearest_neighbours,
        op10_mixing_sources,
        op11_phrase_collocation_mining,
        op12_minhash_near_dedup,
        op13_ranked_lexical_search,
    )
}

WORDS_SQL = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"


def near_duplicates_sql(k: int, columns: str) -> str:
    """All pairs that share a shingle of ``k`` words, and what links reach."""
    words = WORDS_SQL.replace("text,", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),")
    return f"""
with recursive worded as (select doc_id, {words} as ws from documents),
shingles as materialized (
    select distinct doc_id, unnest(case when len(ws) >= {k}
        then list_transform(range(1, len(ws) - {k} + 2), lambda i: array_to_string(ws[i:i + {k - 1}], ' '))
        when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as s
    from worded
),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
pairs as (
    select a.doc_id as x, b.doc_id as y, count(*) as c from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id
    group by all
),
links as materialized (
    select x, y from pairs join sizes a on a.doc_id = x join sizes b on b.doc_id = y
    where 100 * c >= 80 * (a.n + b.n - c)
),
edges as (select x, y from links union all select y, x from links),
reach as (select x, y from edges union select reach.x, edges.y from reach join edges on reach.y = edges.x),
low as (select x, min(y) as y from reach group by x),
found as (
    select d.doc_id, coalesce(n, 0)::bigint as n_shingles, least(d.doc_id, coalesce(low.y, d.doc_id)) as component_id
    from documents d left join sizes using (doc_id) left join low on low.x = d.doc_id
)
select {columns} from found
"""


# The others cannot be expressed in SQL or take it too long on whole tables; they are
# tested against brute force, round trips or held-out labels.
SQL: dict[str, str] = {
    "op5_substring_dedup": window_dedup.REPEATED_WINDOWS_SQL,
    "op7_ngram_jaccard_join": near_duplicates_sql(5, "*"),
    "op10_mixing_sources": mixing.MIXTURE_SQL,
    "op11_phrase_collocation_mining": phrases.COLLOCATIONS_SQL,
    "op12_minhash_near_dedup": near_duplicates_sql(4, "*, doc_id = component_id as kept"),
    "op13_ranked_lexical_search": posting_blocks.RANK_SQL,
}
