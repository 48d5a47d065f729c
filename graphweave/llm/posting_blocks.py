"""Ranked lexical search over blocked posting lists with exact bounds.

Terms are the maximal runs of ASCII letters, digits and non-ASCII characters, only A-Z
lower-cased. A document that holds a term has an integer *impact* for it (see ``impacts``); its
score for an item is the sum of impacts over the item's terms, repeats included: an inner
product of two sparse vectors. Each item gets its ``k`` highest-scoring documents.

Method. A shard is a bounded stretch of documents with a posting list per term. A list is cut into
blocks of documents that are alike: centres drawn from the list, each document goes to the one
its vector is closest to (in a random projection). A block's summary is the largest impact of
each term over its documents, so the product of an item with the summary bounds the score
of every document in the block. An item visits the lists of its terms, those with the greatest
possible share first, and in each the blocks by falling bound; a block is skipped only if its
bound is below the item's k-th best score so far. Documents of a visited block are scored
exactly on their whole vectors. A list is left out if it and all lists not visited yet
together cannot reach that score (the largest impact of a list is the summary of its one block).
No bound is estimated, so results are those of scoring everything.

Distribution. The items' terms are the coordinates (``ITEM_BYTES`` of item text at a time, more
items are searched in further passes). One pass over the documents leaves each one's length and
its counts of these terms, written to the shared folder; document frequencies are counted per
task and added up. Each task then indexes its shards in memory, at most ``SHARD_ENTRIES`` counts
at once, and answers all items with scores carried from shard to shard, so a task returns at
most ``k`` rows for an item. Frequent terms are no hot keys: their lists are split over shards.
Terms are told apart by 64-bit hashes.

Defined results: null and empty texts hold no term and rank nowhere; so do items without terms
that a document holds. Repeated rows are ranked each; equal scores by rising ``doc_id``, null ids
last. Items are distinct ``(item id, text)`` rows. Empty tables give no rows; other columns are
ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .line_crf import stretches
from .textblocks import Words, mix, utf8
from .written import written

ITEM_BYTES = 4 << 20  # item text of one pass: bounds the coordinates and what tasks are sent
SHARD_ENTRIES = 1 << 20
BLOCK_DOCUMENTS = 32
DIMENSIONS = 32
LAST_ID = np.iinfo(np.int64).max  # a null id sorts last and stands for itself
BETWEEN = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])


def terms_of(text: pa.Array) -> Words:
    return Words(*utf8(text), lower=True, space=BETWEEN)


class Items:
    """The items of a pass: coordinates of their terms and how often each holds them."""

    def __init__(self, keys: list[int], texts: pa.Array):
        words = terms_of(texts)
        self.keys = keys
        self.terms, at = np.unique(words.hash, return_inverse=True)
        self.vectors = []
        for i in range(len(keys)):
            self.vectors.append(np.unique(at[words.edge[i] : words.edge[i + 1]], return_counts=True))


def _counts(terms: np.ndarray):
    """Length and counts of the wanted terms of each document."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tf", pa.list_(pa.int32()))])

    def run(batches):
        for batch in batches:
            for lo, hi in stretches(batch.column(1)):
                words = terms_of(batch.column(1).slice(lo, hi - lo))
                at = np.minimum(np.searchsorted(terms, words.hash), len(terms) - 1)
                hit = terms[at] == words.hash
                code, tf = np.unique(words.doc_of()[hit] * len(terms) + at[hit], return_counts=True)
                doc = code // len(terms)
                cut = pa.array(np.searchsorted(doc, np.arange(hi - lo + 1)), pa.int32())
                cols = [pa.array((code % len(terms)).astype(np.int32)), pa.array(tf.astype(np.int32))]
                lists = [pa.ListArray.from_arrays(cut, c) for c in cols]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(words.n_words.astype(np.int64)), *lists], schema=schema)

    return run


def _frequencies(n_terms: int):
    """One row per task and term: documents that hold it."""

    def run(batches):
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=n_terms)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["term", "df"])

    return run


def term_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)


def impacts(weight: np.ndarray, tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term adds to a document's score; ``n`` is the document's length. Integers."""
    if len(n) and int(n.max()) * n_docs * 75 >= 1 << 63:
        part = np.array([75 * int(x) * n_docs // n_terms for x in n], np.int64)
    else:
        part = 75 * n * n_docs // n_terms
    tf = tf.astype(np.int64)
    return weight * (1_000_000_000 * tf // (1000 * tf + 8 * (25 + part)))


class Shard:
    """Posting lists over some documents; blocks of a list are made when it is first visited."""

    def __init__(self, ids: np.ndarray, off: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int):
        self.ids, self.off, self.term, self.impact, self.n_terms = ids, off, term, impact, n_terms
        doc = np.repeat(np.arange(len(ids)), np.diff(off))
        order = np.argsort(term, kind="stable")
        self.doc_of, self.list_off = doc[order], np.searchsorted(term[order], np.arange(n_terms + 1))
        self.most = np.zeros(n_terms, np.int64)
        held = np.flatnonzero(np.diff(self.list_off))
        if len(held):
            self.most[held] = np.maximum.reduceat(impact[order], self.list_off[held])
        self.points = None
        self.blocks: dict[int, tuple] = {}
        self.visited = self.skipped = 0

    def _entries(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the entries of documents, and where each document's begin."""
        size = self.off[docs + 1] - self.off[docs]
        cut = np.cumsum(size) - size
        return np.arange(int(size.sum())) + np.repeat(self.off[docs] - cut, size), cut

    def _project(self) -> np.ndarray:
        """Unit vectors in which near documents stay near: signs by term, summed by impact."""
        bits = mix(np.arange(self.n_terms, dtype=np.uint64) + np.uint64(77))
        sign = ((bits[:, None] >> np.arange(DIMENSIONS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32) * 2 - 1
        out = np.zeros((len(self.ids), DIMENSIONS), np.float32)
        full = np.flatnonzero(np.diff(self.off))
        for a in range(0, len(full), 512):
            docs = full[a : a + 512]
            at, cut = self._entries(docs)
            out[docs] = np.add.reduceat(sign[self.term[at]] * self.impact[at, None].astype(np.float32), cut, axis=0)
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    def blocks_of(self, t: int) -> tuple:
        """``(documents, block ends, summary terms, summary impacts, summary ends)`` of a list."""
        if t in self.blocks:
            return self.blocks[t]
        docs = self.doc_of[self.list_off[t] : self.list_off[t + 1]]
        n_blocks = -(-len(docs) // BLOCK_DOCUMENTS)
        own = np.zeros(len(docs), np.int64)
        if n_blocks > 1:
            if self.points is None:
                self.points = self._project()
            centre = docs[np.argsort(mix(docs.astype(np.uint64) + np.uint64(t)), kind="stable")[:n_blocks]]
            own = np.argmax(self.points[docs] @ self.points[centre].T, axis=1)
        order = np.argsort(own, kind="stable")
        docs, own = docs[order], own[order]
        at, _ = self._entries(docs)
        code = np.repeat(own, self.off[docs + 1] - self.off[docs]) * self.n_terms + self.term[at]
        by = np.argsort(code, kind="stable")
        code = code[by]
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        top = np.maximum.reduceat(self.impact[at][by], first)
        present, start = np.unique(own, return_index=True)
        of = code[first] // self.n_terms
        ends = np.searchsorted(of, present, side="right")
        self.blocks[t] = docs, np.append(start[1:], len(docs)), code[first] % self.n_terms, top, ends
        return self.blocks[t]

    def search(self, terms: np.ndarray, times: np.ndarray, best: tuple[np.ndarray, np.ndarray], k: int):
        """``best`` (scores and ids, falling) improved by this shard's documents."""
        scores, ids = best
        share = times * self.most[terms]
        order = np.argsort(share, kind="stable")  # rising: rest[i] is what lists up to i can add
        terms, times = terms[order], times[order]
        rest = np.cumsum(share[order])
        weight = np.zeros(self.n_terms, np.int64)
        weight[terms] = times
        seen = np.zeros(len(self.ids), dtype=bool)
        for i in range(len(terms) - 1, -1, -1):
            least = max(1, int(scores[k - 1])) if len(scores) >= k else 1
            if rest[i] < least:
                break
            docs, ends, s_term, s_top, s_ends = self.blocks_of(int(terms[i]))
            bound = np.add.reduceat(weight[s_term] * s_top, np.append(0, s_ends[:-1]))
            by = np.argsort(-bound, kind="stable")
            at, step = 0, 1
            while at < len(by):
                least = max(1, int(scores[k - 1])) if len(scores) >= k else 1
                go = by[at : at + step]
                go = go[bound[go] >= least]
                if not len(go):
                    break
                at, step = at + step, step * 2
                self.visited += len(go)
                begin = np.where(go > 0, ends[go - 1], 0)
                size = ends[go] - begin
                pick = docs[np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size)]
                pick = pick[~seen[pick]]
                if not len(pick):
                    continue
                seen[pick] = True
                e, cut = self._entries(pick)
                got = np.add.reduceat(weight[self.term[e]] * self.impact[e], cut)
                on = got >= least
                scores, ids = np.concatenate([scores, got[on]]), np.concatenate([ids, self.ids[pick[on]]])
                top = np.lexsort((ids, -scores))[:k]
                scores, ids = scores[top], ids[top]
            self.skipped += max(0, len(by) - at)
        return scores, ids


def _search(items: Items, weight: np.ndarray, n_docs: int, n_terms: int, k: int, shard_entries: int):
    schema = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
    empty = np.zeros(0, np.int64)

    def shards(batches):
        parts, held = [], 0
        for batch in batches:
            off = np.asarray(batch.column(2).offsets, np.int64)
            lo = 0
            while lo < batch.num_rows:
                hi = int(np.searchsorted(off, off[lo] + shard_entries - held, side="right")) - 1
                hi = min(batch.num_rows, max(hi, lo + (0 if parts else 1)))
                if hi > lo:
                    parts.append(batch.slice(lo, hi - lo))
                    held += int(off[hi] - off[lo])
                if hi < batch.num_rows:
                    yield parts
                    parts, held = [], 0
                lo = hi
        if parts:
            yield parts

    def run(batches):
        best = [(empty, empty) for _ in items.keys]
        for parts in shards(batches):
            t = pa.Table.from_batches(parts).combine_chunks().to_batches()
            if not t:
                continue
            ids = t[0].column(0).fill_null(int(LAST_ID)).to_numpy()
            size = np.diff(np.asarray(t[0].column(2).offsets, np.int64))
            term, tf = (t[0].column(c).flatten().to_numpy() for c in (2, 3))
            n = np.repeat(t[0].column(1).to_numpy(), size)
            impact = impacts(weight[term], tf, n, n_docs, n_terms)
            some = impact > 0
            doc = np.repeat(np.arange(len(ids)), size)[some]
            shard = Shard(ids, np.searchsorted(doc, np.arange(len(ids) + 1)), term[some], impact[some], len(weight))
            for i, (terms, times) in enumerate(items.vectors):
                best[i] = shard.search(terms, times, best[i], k)
        for i, (scores, ids) in enumerate(best):
            if len(scores):
                cols = [np.full(len(scores), items.keys[i]), ids, scores]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return run


def _rank_pass(docs: DataFrame, items: Items, k: int, shard_entries: int) -> DataFrame | None:
    """``(item, doc_id, score)``: each task's best documents of each item."""
    if not len(items.terms):
        return None
    counts = docs.mapInArrow(_counts(items.terms), "doc_id long, n long, terms array<int>, tf array<int>")
    counts = written(counts.filter("n > 0"), "term-counts")
    n_docs, n_terms = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs:
        return None
    df = np.zeros(len(items.terms), np.int64)
    tasks = counts.select("terms").mapInArrow(_frequencies(len(df)), "term long, df long")
    for row in tasks.groupBy("term").agg(F.sum("df").alias("df")).collect():  # at most one row per coordinate
        df[row["term"]] = row["df"]
    weight = term_weights(df, n_docs)
    return counts.filter(F.size("terms") > 0).mapInArrow(
        _search(items, weight, n_docs, int(n_terms), k, shard_entries), "item long, doc_id long, score long")


def rank(
    docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", item_bytes: int = ITEM_BYTES, shard_entries: int = SHARD_ENTRIES,
) -> DataFrame:
    """``item_id, rank`` (from 1), ``doc_id, score``: the ``k`` highest-scoring documents of each item."""
    spark = docs.sparkSession
    it = items.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("item_text")).distinct()
    it = written(it.withColumn("item", F.xxhash64("item_id", "item_text")), "items")
    total = it.agg(F.sum(F.octet_length("item_text"))).first()[0]
    passes = max(1, -(-int(total or 0) // item_bytes))
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = None
    for p in range(passes):  # the items of a pass are bounded by bytes and go to every task
        mine = it.filter(F.pmod("item", F.lit(passes)) == p).select("item", "item_text").toArrow()
        got = _rank_pass(d, Items(mine.column(0).to_pylist(), mine.column(1).combine_chunks()), k, shard_entries)
        if got is not None:
            found = got if found is None else found.unionByName(got)
    if found is None:
        found = spark.createDataFrame([], "item long, doc_id long, score long")
    best = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    found = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return found.join(it, "item").select(
        "item_id", F.col("rank").cast("int").alias("rank"), F.nullif("doc_id", F.lit(int(LAST_ID))).alias("doc_id"), "score")


_TERMS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
RANK_SQL = f"""
with d as (select doc_id, {_TERMS} as ts from documents),
held as (select row_number() over () as r, doc_id, ts, len(ts)::bigint as n from d where len(ts) > 0),
total as (select count(*)::bigint as nd, sum(n)::bigint as nl from held),
tf as (select r, t, count(*)::bigint as tf from (select r, unnest(ts) as t from held) group by all),
df as (select t, count(*)::bigint as df from tf group by t),
q as (select item_id, t, count(*)::bigint as c from (select item_id, unnest({_TERMS}) as t from benchmark) group by all),
part as (
    select q.item_id, held.doc_id, held.r,
        sum(c * floor(1000 * ln((2 * nd + 2)::double / (2 * df + 1)::double))::bigint
            * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nd) // nl))))::bigint as score
    from q join df using (t) join tf using (t) join held using (r), total
    group by all
),
ranked as (
    select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as "rank", doc_id, score
    from part where score > 0
)
select item_id, "rank", doc_id, score from ranked where "rank" <= 10
"""
