"""Quality classifier from weak labels.

Method. Overlapping heuristic labellers vote good, bad or abstain on every document. An
expectation-maximisation over the votes estimates how often each labeller says what about
good and bad documents, without any given label (labellers are taken to be independent
given the truth), and so the posterior of every vote pattern. The posteriors then train a
hashed linear scorer on features of words and their neighbours, which judges all documents,
those on which every labeller abstains included.

Distribution. Votes are made in one pass over all whole texts. EM needs only the number of
documents per vote pattern, a table bounded by the number of labellers (at most 3^9
patterns), counted over all rows. The scorer is fitted in one task on a sample that is
bounded by ``SAMPLE_DOCUMENTS`` (in the order of a hash of the ids, whole texts); its weights
are ``2 ** HASH_BITS`` numbers. Scoring is a second pass over all rows.

Defined results: null, empty and wordless texts have score 0 and are rejected; null ids and
repeated rows are judged by their text; if the votes show one kind of document only, or no
document, the scorer is what the posteriors say, without a second class; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .line_crf import _DIGIT, _END, _FIRST, _LETTER, _MARK, _SYMBOL, _UPPER, Lines, _flags_of, stretches
from .textblocks import mix, utf8
from .written import written

SAMPLE_DOCUMENTS = 8000
HASH_BITS = 14
GOOD, BAD, ABSTAIN = 1, 0, 2
LABELLERS = ("symbols", "shouting", "capitals", "stutter", "repeats", "pipes", "sentences", "variety", "word_size")
FALSE_ALARM, PRIOR_WEIGHT = 0.001, 5.0
_LEAST_WORDS = 5  # below, every labeller abstains


class Batch:
    """Counts per document, and hashed features per word."""

    def __init__(self, text: pa.Array):
        self.lines = lines = Lines(*utf8(text))
        self.w = w = lines.words
        self.n = w.n_words
        self.doc = w.doc_of()
        same = np.zeros(len(w.start), dtype=bool)
        if len(same):
            same[1:] = (w.hash[1:] == w.hash[:-1]) & (self.doc[1:] == self.doc[:-1])
        self.same = same

    def per_word(self, flags: np.ndarray) -> np.ndarray:
        """Share of words for which the flag of each word holds."""
        sums = np.concatenate([[0], np.cumsum(flags)])
        return (sums[self.w.edge[1:]] - sums[self.w.edge[:-1]]) / np.maximum(self.n, 1)

    def votes(self) -> np.ndarray:
        """One row per document, one column per labeller."""
        lines, w, n = self.lines, self.w, np.maximum(self.n, 1)
        a, b = lines.offsets[:-1], lines.offsets[1:]
        letters = np.maximum(lines.count(_LETTER, a, b), 1)
        with_symbol = self.per_word(lines.count(_SYMBOL, w.start, w.end) > 0)
        shouts = lines.count(_flags_of("!"), a, b) / n
        upper = lines.count(_UPPER, a, b) / letters
        stutter, repeats = self.per_word(self.same), lines.repeated_words() / n
        pipes = lines.count(_flags_of("|"), a, b) / n
        tail = lines.buf[w.end - 1] if len(w.end) else np.zeros(0, np.uint8)
        stops = self.per_word(_END[tail] | _MARK[tail])
        order = np.lexsort((w.hash, self.doc))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (w.hash[order][1:] != w.hash[order][:-1]) | (self.doc[order][1:] != self.doc[order][:-1])
        variety = np.bincount(self.doc[order][new], minlength=len(self.n)) / n
        size = lines.count(_FIRST, a, b) / n

        def vote(bad, good):
            return np.where(bad, BAD, np.where(good, GOOD, ABSTAIN))

        out = np.stack([
            vote(with_symbol > 0.2, with_symbol < 0.02), vote(shouts > 0.2, shouts < 0.05), vote(upper > 0.5, upper < 0.2),
            vote(stutter > 0.2, stutter < 0.03), vote(repeats > 0.9, repeats < 0.1), vote(pipes > 0.1, pipes == 0),
            vote((stops < 0.005) & (n >= 40), (stops > 0.02) & (stops < 0.4)),
            vote((variety < 0.15) & (n >= 50) & (n < 2000), variety > 0.4), vote((size < 2.5) | (size > 16), (size > 3.5) & (size < 12)),
        ], axis=1).astype(np.int8)
        out[self.n < _LEAST_WORDS] = ABSTAIN
        return out

    def features(self) -> np.ndarray:
        """Three hashed features of each word: its shape, its shape after that of the word
        before, and its last two bytes with its length class."""
        buf, w = self.lines.buf, self.w
        if not len(w.start):
            return np.zeros((0, 3), np.int64)
        kind = np.zeros(256, np.uint64)
        for k, flags in enumerate((_LETTER, _UPPER, _DIGIT, _END, _MARK, _SYMBOL, _flags_of("!")), 1):
            kind[flags] = k
        size = np.searchsorted([2, 3, 4, 7, 11, 16], w.end - w.start, side="right").astype(np.uint64)
        head, tail = buf[w.start], buf[w.end - 1]
        before = buf[np.maximum(w.end - 2, w.start)]
        capitals = (self.lines.count(_UPPER, w.start, w.end) * 2 > w.end - w.start).astype(np.uint64)
        shape = ((kind[head] * np.uint64(8) + kind[tail]) * np.uint64(8) + size) * np.uint64(4) + self.same.astype(np.uint64) * np.uint64(2) + capitals
        last = np.roll(shape, 1)
        first = w.edge[:-1][self.n > 0]
        last[first] = 1 << 20
        ends = (before.astype(np.uint64) << np.uint64(8) | tail) * np.uint64(8) + size
        cols = [shape + np.uint64(1 << 40), shape * np.uint64(1 << 21) + last + np.uint64(2 << 50), ends + np.uint64(3 << 40)]
        return np.stack([(mix(c) >> np.uint64(64 - HASH_BITS)).astype(np.int64) for c in cols], axis=1)

    def scores(self, weights: np.ndarray, bias: float) -> np.ndarray:
        """Probability of good; 0 without words."""
        f = self.features()
        sums = np.concatenate([[0.0], np.cumsum(weights[f].sum(axis=1))])
        z = (sums[self.w.edge[1:]] - sums[self.w.edge[:-1]]) / np.maximum(self.n, 1) + bias
        return np.where(self.n > 0, 1 / (1 + np.exp(-np.clip(z, -500, 500))), 0.0)


# ---------------------------------------------------------------- label model


def label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """EM over vote patterns: the posterior of good per pattern, and what each labeller
    votes on bad and good documents (labeller, truth, vote) where it votes at all.

    A labeller looks for one fault, so it calls most bad documents good, and several faults
    that never meet would make EM take the rarer ones for noise of good documents. Against
    that stands a prior: labellers rarely accuse a good document (``FALSE_ALARM``, as if seen
    on ``PRIOR_WEIGHT`` times the corpus). An abstention says nothing."""
    one_hot = np.eye(3)[patterns][:, :, :2]  # pattern, labeller, vote
    post = 0.95 * 0.1 ** (patterns == BAD).sum(axis=1)
    for _ in range(rounds):
        weight = np.stack([counts * (1 - post), counts * post])  # truth, pattern
        table = np.einsum("tp,plv->ltv", weight, one_hot) + 0.5
        table[:, 1] += PRIOR_WEIGHT * counts.sum() * np.array([FALSE_ALARM, 1 - FALSE_ALARM])
        table /= table.sum(axis=2, keepdims=True)
        prior = (weight.sum(axis=1) + 1) / (counts.sum() + 2)
        score = np.log(prior) + np.einsum("plv,ltv->pt", one_hot, np.log(table))
        new = 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -500, 500)))
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    return post, table


def fit_scorer(texts: pa.Array, target: np.ndarray, rounds: int = 200, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on word-feature frequencies with soft targets, by Adam steps."""
    size = 1 << HASH_BITS
    rows, cols, shares, used = [], [], [], []
    for lo, hi in stretches(texts):  # only the frequencies of a stretch are kept
        b = Batch(texts.slice(lo, hi - lo))
        code, count = np.unique(np.repeat(b.doc, 3) * size + b.features().reshape(-1), return_counts=True)
        rows.append(code // size + lo)
        cols.append(code % size)
        shares.append(count / np.maximum(b.n, 1)[code // size])
        used.append(b.n > 0)
    row, col, share, use = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, cols, shares, used))
    weights, bias = np.zeros(size), 0.0
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    n = max(1, int(use.sum()))
    for k in range(1, rounds + 1):
        z = np.bincount(row, weights=share * weights[col], minlength=len(target)) + bias
        miss = np.where(use, target - 1 / (1 + np.exp(-np.clip(z, -500, 500))), 0.0) / n
        g, gb = np.bincount(col, weights=share * miss[row], minlength=size) - decay * weights / n, miss.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        weights = weights + 0.3 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-10)
        bias += 0.3 * (mb / (1 - 0.9**k)) / (np.sqrt(vb / (1 - 0.999**k)) + 1e-10)
    return weights, bias


# ---------------------------------------------------------------- the operator


def heuristic_votes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_hash, votes``: one digit per labeller (0 bad, 1 good, 2 abstain)."""

    def run(batches):
        for batch in batches:
            for lo, hi in stretches(batch.column(1)):
                votes = Batch(batch.column(1).slice(lo, hi - lo)).votes()
                text_votes = (votes + 48).astype(np.uint8).tobytes().decode()
                k = votes.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo),
                     pa.array([text_votes[i * k : i * k + k] for i in range(hi - lo)])],
                    names=["doc_id", "text_hash", "votes"],
                )

    return _texts(docs, doc_id, text).mapInArrow(run, "doc_id long, text_hash long, votes string")


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    t = F.col(text).cast("string")
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), t.alias("text"), F.xxhash64(t).alias("text_hash"))


def training_rows(docs: DataFrame, votes: DataFrame, sample: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """At most ``sample`` rows ``doc_id, votes, text``. An id may stand on many texts: each text meets
    its own votes, and is taken once."""
    picked = votes.filter("doc_id is not null").distinct()
    picked = F.broadcast(picked.orderBy(F.xxhash64("doc_id"), "doc_id", "votes", "text_hash").limit(sample))
    rows = _texts(docs, doc_id, text).join(picked, ["doc_id", "text_hash"])
    return rows.groupBy("doc_id", "text_hash", "votes").agg(F.min("text").alias("text")).drop("text_hash")


def train(docs: DataFrame, sample: int = SAMPLE_DOCUMENTS, doc_id: str = "doc_id", text: str = "text"):
    """``(weights, bias, accuracy)`` of the scorer, and the accuracy that the label model
    gives each labeller where it votes; None without documents."""
    votes = written(heuristic_votes(docs, doc_id, text), "votes")
    seen = votes.groupBy("votes").count().collect()  # at most 3^labellers rows
    if not seen:
        return None
    seen.sort(key=lambda r: r["votes"])
    patterns = np.array([[int(c) for c in r["votes"]] for r in seen], np.int8)
    post, table = label_model(patterns, np.array([r["count"] for r in seen], np.float64))
    accuracy = (table[:, 1, GOOD] + table[:, 0, BAD]) / 2  # on good and bad documents alike
    belief = {r["votes"]: float(p) for r, p in zip(seen, post)}

    rows = training_rows(docs, votes, sample, doc_id, text)

    def fit(table: pa.Table) -> pa.Table:
        order = np.lexsort((table.column("votes").to_numpy(), table.column("doc_id").to_numpy()))
        table = table.take(pa.array(order))
        texts = table.column("text").combine_chunks()
        texts = pa.concat_arrays(texts.chunks) if isinstance(texts, pa.ChunkedArray) else texts
        weights, bias = fit_scorer(texts, np.array([belief[v] for v in table.column("votes").to_pylist()]))
        return pa.table({"weights": pa.array([weights]), "bias": pa.array([float(bias)])})

    got = rows.withColumn("fit", F.lit(0)).groupBy("fit").applyInArrow(fit, "weights array<double>, bias double").collect()
    if not got:
        return None
    return np.array(got[0]["weights"]), got[0]["bias"], dict(zip(LABELLERS, accuracy.tolist()))


def score(docs: DataFrame, weights: np.ndarray, bias: float, text: str = "text") -> DataFrame:
    """All columns of ``docs`` in a struct ``row``, with the ``score`` of each text. Only texts go
    to Python and only scores come back."""

    def run(column: pa.Array) -> pa.Array:
        parts = [Batch(column.slice(lo, hi - lo)).scores(weights, bias) for lo, hi in stretches(column)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    scored = F.arrow_udf(run, "double")(F.col(text).cast("string"))
    return docs.select(F.struct(*docs.columns).alias("row"), scored.alias("score"))


def classify(docs: DataFrame, threshold: float = 0.5, sample: int = SAMPLE_DOCUMENTS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Train on ``docs`` and judge them: ``row`` (all columns), ``score`` and ``kept``."""
    model = train(docs, sample, doc_id, text)
    weights, bias, _ = model or (np.zeros(1 << HASH_BITS), 0.0, {})
    return score(docs, weights, bias, text).withColumn("kept", F.col("score") >= threshold)


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the classifier keeps, columns as they were."""
    kept = classify(docs).filter("kept")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
