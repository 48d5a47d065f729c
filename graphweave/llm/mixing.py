"""Mixing sources to target weights by temperature, with DataFrame operations only.

Method. The token share of each source is raised to an exponent between 0 (all sources
equal) and 1 (as they are) and normalised to weights. The exponent is found by bisection:
the largest one whose weights have the wanted entropy (a fraction of the entropy of equal
weights), but not below the one at which some source would have to be repeated more often
than allowed. Four halvings are made per pass over the source table: all 15 exponents that
they could ask for are evaluated in one aggregate.

The weights are then realised within a token budget as permutations of blocks: in every
epoch the blocks of a source come in a new pseudo-random order, and the documents of a
block too; a source is read epoch by epoch until its share of the budget is used; the
document that crosses it is read whole, so no source with a weight stays empty. Running sums are taken over blocks
first and then within blocks, so a source with a third of all rows is no task of its own.

Orders come from MD5 of the seed, epoch and id, so they are the same on every engine.

Defined results: a null text has no tokens; null sources are one source; documents without
tokens follow their block and cost nothing; a source without any tokens has weight 0 and,
as nothing of it costs budget, is read once; null ids and repeated rows are read like
others (repeated rows one after the other); no documents give no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .written import written

BLOCK_DOCUMENTS = 4096
_SECTIONS = 16  # four halvings per pass
_PASSES = 9  # 36 halvings: far below the 9 decimals that are kept


def count_words(text) -> F.Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, as its tokens; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_totals(docs: DataFrame, source: str, tokens: str) -> DataFrame:
    """``source, tokens, n_docs`` and the ``share`` of all tokens."""
    t = docs.groupBy(F.col(source).alias("source")).agg(
        F.sum(tokens).cast("long").alias("tokens"), F.count(F.lit(1)).alias("n_docs")
    )
    t = written(t, "source-totals")
    total = t.agg(F.sum("tokens")).first()[0] or 0
    return t.withColumn("all_tokens", F.lit(total).cast("long")).withColumn(
        "share", F.col("tokens") / F.greatest(F.col("all_tokens"), F.lit(1))
    )


def _evaluate(totals: DataFrame, exponents: list[float]) -> dict[float, tuple[float, float]]:
    """Per exponent the entropy of the weights and the largest of share^exponent / share
    over the sum, which times the relative budget is the largest repetition."""
    at = totals.filter("tokens > 0").select("share", F.explode(F.array(*[F.lit(float(x)) for x in exponents])).alias("x"))
    p = F.pow("share", F.col("x"))
    got = at.groupBy("x").agg(
        F.sum(p).alias("z"), F.sum(p * F.log("share")).alias("e"), F.max(p / F.col("share")).alias("r"),
        F.max(F.col("share") / p).alias("s"),
    )
    return {r["x"]: (math.log(r["z"]) - r["x"] * r["e"] / r["z"], r["r"] / r["z"], r["s"] * r["z"]) for r in got.collect()}


def _bisect(totals: DataFrame, fits) -> tuple[float, float]:
    """Around the end of ``fits`` (true from 0 up to some exponent) in [0, 1]: the largest
    exponent found to fit, and the smallest found not to."""
    lo, hi = 0.0, 1.0
    if fits(_evaluate(totals, [hi])[hi]):
        return hi, hi
    for _ in range(_PASSES):
        inner = [lo + (hi - lo) * k / _SECTIONS for k in range(1, _SECTIONS)]
        got = _evaluate(totals, inner)
        good = [x for x in inner if fits(got[x])]
        cut = max(good) if good else lo
        lo, hi = cut, min([x for x in inner if x > cut], default=hi)
    return lo, hi


def mixing_weights(
    totals: DataFrame, entropy: float | None = 0.95, repeat: float | None = 4.0, budget: float | None = 1.0
) -> DataFrame:
    """``totals`` with ``exponent, weight`` and ``budget`` (tokens of the source).

    ``entropy``: the wanted part of the entropy of equal weights. ``repeat``: how often a source
    may be read at most; it goes before the entropy. ``budget``: tokens in all, as a
    multiple of the corpus, or None for the least budget that reads every source whole."""
    n = totals.filter("tokens > 0").count()
    if not n:
        return totals.select("*", F.lit(None).cast("double").alias("exponent"), F.lit(0.0).alias("weight"),
                             F.lit(0).cast("long").alias("budget"))
    x = 1.0
    if entropy is not None:
        x = _bisect(totals, lambda v: v[0] >= entropy * math.log(n))[0]
    if repeat is not None:  # repetition falls with the exponent: the end of "too often"
        most = lambda v: v[1] * (budget if budget is not None else v[2])
        if most(_evaluate(totals, [x])[x]) > repeat:
            x = max(x, _bisect(totals, lambda v: most(v) > repeat)[1])
    x = round(x, 9)
    at = _evaluate(totals, [x])[x]
    power = F.when(F.col("tokens") > 0, F.pow("share", F.lit(x))).otherwise(0.0)
    z = totals.agg(F.sum(power)).first()[0]
    w = totals.withColumn("weight", F.round(power / F.lit(z), 12))
    size = F.lit(budget if budget is not None else round(at[2], 12))
    tokens = F.floor(F.col("weight") * size * F.col("all_tokens"))
    if budget is None:
        tokens = F.greatest(tokens, F.col("tokens"))
    return w.withColumn("exponent", F.lit(x)).withColumn("budget", tokens.cast("long"))


def _dice(*parts) -> F.Column:
    return F.md5(F.concat_ws("/", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def mix_sources(
    docs: DataFrame, entropy: float | None = 0.95, repeat: float | None = 4.0, budget: float | None = 1.0,
    seed: int = 0, doc_id: str = "doc_id", text: str = "text", source: str = "source", tokens: str | None = None,
) -> DataFrame:
    """All rows of ``docs`` that the mixture reads, once per reading, as ``row`` (a struct of
    their columns) with ``n_tokens, exponent, weight, epoch, block`` (its number),
    ``block_rank`` (the block's place in the epoch) and ``start`` (tokens of the source read
    before in the epoch). ``tokens`` names a column with token counts; otherwise words count."""
    n = F.coalesce(F.col(tokens).cast("long"), F.lit(0)) if tokens else count_words(F.col(text))
    d = docs.select(
        F.struct(*docs.columns).alias("row"), F.col(doc_id).alias("id"), F.col(source).alias("source"), n.alias("n_tokens")
    )
    w = mixing_weights(source_totals(d, "source", "n_tokens"), entropy, repeat, budget)
    # whole epochs, and the budget that is left for the last one
    w = w.select(
        F.col("source").alias("s"), "exponent", "weight", F.ceil(F.col("n_docs") / BLOCK_DOCUMENTS).cast("long").alias("n_blocks"),
        F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(F.lit(1)).alias("whole"),
        F.when(F.col("tokens") > 0, F.col("budget") % F.col("tokens")).otherwise(F.lit(0)).alias("rest"),
    )
    block = F.conv(F.substring(_dice(F.lit(seed), F.col("id")), 1, 8), 16, 10).cast("long") % F.col("n_blocks")

    def with_epochs(rows: DataFrame) -> DataFrame:
        last = F.when(F.col("rest") > 0, F.col("whole")).otherwise(F.col("whole") - 1)
        return rows.filter(last >= 0).withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), last)))

    keyed = d.join(w, d["source"].eqNullSafe(w["s"])).drop("s").withColumn("block", block)
    sums = keyed.groupBy("source", "block", "whole", "rest").agg(F.sum("n_tokens").alias("n"))
    per_epoch = Window.partitionBy("source", "epoch").orderBy("dice", "block")
    blocks = with_epochs(sums).withColumn("dice", _dice(F.lit(seed), F.col("epoch"), F.col("source"), F.col("block")))
    blocks = blocks.select(
        F.col("source").alias("s"), F.col("block").alias("b"), F.col("epoch").alias("e"),
        F.row_number().over(per_epoch).cast("long").alias("block_rank"),
        (F.sum("n").over(per_epoch.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"),
    )
    within = Window.partitionBy("source", "block", "epoch").orderBy("dice", "id", "n_tokens")
    read = with_epochs(keyed).withColumn("dice", _dice(F.lit(seed), F.col("epoch"), F.col("id")))
    read = read.withColumn("up_to", F.sum("n_tokens").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    read = read.join(
        blocks, read["source"].eqNullSafe(blocks["s"]) & (read["block"] == blocks["b"]) & (read["epoch"] == blocks["e"])
    )
    end = F.col("before") + F.col("up_to")
    read = read.filter((F.col("epoch") < F.col("whole")) | (end - F.col("n_tokens") < F.col("rest")))
    return read.select(
        "row", "n_tokens", "exponent", "weight", "epoch", "block", "block_rank", (end - F.col("n_tokens")).alias("start")
    )


def mixture(docs: DataFrame) -> DataFrame:
    """The rows of the query: which document is read when, at production parameters."""
    m = mix_sources(docs.select("doc_id", "source", count_words(F.col("text")).alias("words")), tokens="words")
    return m.select("row.doc_id", "row.source", "n_tokens", "weight", "epoch", "block_rank", "start")


def mix_documents(docs: DataFrame, entropy: float = 0.9, repeat: float = 1.25) -> DataFrame:
    """``docs`` mixed without losing a row: the least budget that reads every source whole,
    and so every document once and those of small sources up to ``repeat`` times."""
    m = mix_sources(docs, entropy, repeat, budget=None)
    return m.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

# The same in SQL: bisection as a recursive query, one halving per step.
MIXTURE_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, {_WORDS}::BIGINT AS n FROM documents),
t AS (SELECT source, sum(n)::BIGINT AS tokens, count(*) AS n_docs FROM d GROUP BY source),
a AS (SELECT sum(tokens) AS all_tokens, count(*) FILTER (tokens > 0) AS k FROM t),
p AS (SELECT source, tokens, n_docs, tokens / all_tokens::DOUBLE AS share, all_tokens, k FROM t, a),
q AS (SELECT source, share, k FROM p WHERE tokens > 0),
bis(i, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN ok THEN (lo + hi) / 2 ELSE lo END, CASE WHEN ok THEN hi ELSE (lo + hi) / 2 END
  FROM (SELECT i, lo, hi, (SELECT ln(sum(pow(share, (lo + hi) / 2)))
          - (lo + hi) / 2 * sum(pow(share, (lo + hi) / 2) * ln(share)) / sum(pow(share, (lo + hi) / 2))
          >= 0.95 * ln(max(k)) FROM q) AS ok FROM bis WHERE i < 40)
),
x AS (SELECT CASE WHEN (SELECT ln(sum(share)) - sum(share * ln(share)) / sum(share) >= 0.95 * ln(max(k)) FROM q)
             THEN 1.0 ELSE (SELECT lo FROM bis ORDER BY i DESC LIMIT 1) END AS e0),
rep(i, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN ok THEN (lo + hi) / 2 ELSE lo END, CASE WHEN ok THEN hi ELSE (lo + hi) / 2 END
  FROM (SELECT i, lo, hi, (SELECT max(pow(share, (lo + hi) / 2) / share) / sum(pow(share, (lo + hi) / 2)) > 4.0
          FROM q) AS ok FROM rep WHERE i < 40)
),
y AS (SELECT round(CASE WHEN (SELECT max(pow(share, e0) / share) / sum(pow(share, e0)) FROM q) > 4.0
             THEN greatest(e0, (SELECT hi FROM rep ORDER BY i DESC LIMIT 1)) ELSE e0 END, 9) AS e FROM x),
w AS (SELECT source, tokens, n_docs, all_tokens,
        round(CASE WHEN tokens > 0 THEN pow(share, e) ELSE 0 END
              / sum(CASE WHEN tokens > 0 THEN pow(share, e) ELSE 0 END) OVER (), 12) AS weight FROM p, y),
b AS (SELECT *, floor(weight * 1.0 * all_tokens)::BIGINT AS budget, ceil(n_docs / {BLOCK_DOCUMENTS}.0)::BIGINT AS blocks FROM w),
c AS (SELECT source, weight, blocks, CASE WHEN tokens > 0 THEN budget // tokens ELSE 1 END AS whole,
        CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest FROM b),
e AS (SELECT d.*, weight, whole, rest, ('0x' || substr(md5('0/' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % blocks AS block,
        unnest(range(CASE WHEN rest > 0 THEN whole + 1 ELSE whole END)) AS epoch
      FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source),
s AS (SELECT source, block, epoch, sum(n) AS bn FROM e GROUP BY ALL),
r AS (SELECT *, row_number() OVER o AS block_rank, sum(bn) OVER (o ROWS UNBOUNDED PRECEDING) - bn AS before FROM s
      WINDOW o AS (PARTITION BY source, epoch ORDER BY md5('0/' || epoch || '/' || coalesce(source, '') || '/' || block), block)),
u AS (SELECT *, sum(n) OVER (PARTITION BY source, block, epoch
        ORDER BY md5('0/' || epoch || '/' || coalesce(doc_id::VARCHAR, '')), doc_id, n ROWS UNBOUNDED PRECEDING) AS up_to FROM e)
SELECT u.doc_id, u.source, u.n AS n_tokens, u.weight, u.epoch, r.block_rank, (before + up_to - u.n)::BIGINT AS start
FROM u JOIN r ON u.source IS NOT DISTINCT FROM r.source AND u.block = r.block AND u.epoch = r.epoch
WHERE u.epoch < whole OR before + up_to - u.n < rest
"""
