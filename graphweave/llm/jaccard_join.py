"""Near-duplicate documents by word shingles: an exact Jaccard join over prefix trees.

A document's set holds its distinct 5-word shingles (A-Z lower-cased, words
``[^\\x20\\x09-\\x0D]+``); with fewer words the whole sequence is its one shingle. Documents link
when ``100 * intersection >= threshold * union``.

Method. Sets that may be similar are put in one order of shingles and stored in a trie, so
that what many sets share at the front is stored and counted once. A set is joined by one
walk through the trie: the overlap with a node is the overlap with its parent plus the
shingles on the edge, and a subtree is left as soon as the shingles that remain in the set
and in its longest member cannot make up the overlap that its shortest member needs.

Distribution.

1. *Samples.* Of each set the shingles with the smallest hashes are its sample, long enough
   that two similar sets share at least ``need`` of their samples (the prefix-filter lemma
   with a margin). Blocks send each sampled shingle once; buckets answer with the number of
   documents that sampled it. A set with fewer than ``need`` shared shingles links with
   nothing and leaves here; others keep as keys all but the ``need - 1`` most frequent ones,
   so a passage that the whole corpus quotes rarely becomes a key.
2. *Equal sets* are collapsed to the one with the smallest id.
3. *Candidates.* Sets with a common key are joined to the smallest of that key (a star, not
   pairs), and connected components of these stars bound which sets can meet.
4. *Tries.* Components are dealt to tasks and joined there; a component heavier than
   ``TASK_SHINGLES`` is split by set size (similar sets differ by at most a quarter) and then
   into parts of which each pair meets in one task. Within a task a set that is already in the
   component of the walk is not compared again, so a group of copies costs one walk each,
   and a task returns a spanning forest, not pairs.
5. *Components* of the links are the result.

All counts run over all documents; nothing is capped or sampled away. Shingles are compared by
64-bit hashes, equal sets by 128 bits.

Defined results: null or wordless texts have an empty set and link with nothing; a null id
sorts before all others; rows that repeat an id are judged each by its own text; other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .textblocks import (
    ANSWER_ARROW,
    ASK,
    ASK_ARROW,
    NULL_ID,
    REPLY,
    Block,
    Words,
    alone,
    ask_buckets,
    block_count,
    concat,
    home,
    mix,
    notes,
    pack,
    rows,
    split_by,
    to_blocks,
    unpack,
    utf8,
)
from .written import written

SHINGLE_WORDS = 5
TASK_SHINGLES = 500_000
_A = np.uint64(0x9E3779B97F4A7C15)


def _ceil_percent(n, percent: int):
    return -(-n * percent // 100)


def sample_size(n, threshold: int):
    """How many of ``n`` shingles are sampled."""
    return np.minimum(n, n - _ceil_percent(n, threshold) + np.maximum(1, _ceil_percent(n, 10)))


def shared_need(n, threshold: int):
    """At least so many sampled shingles a set of ``n`` shares with any similar set: the
    margin of the smallest set that can be similar to it."""
    return np.maximum(1, _ceil_percent(_ceil_percent(n, threshold), 10))


# ---------------------------------------------------------------- shingle sets


def text_sets(text: pa.Array, k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts end to end, and the n + 1 offsets."""
    return shingle_sets(*utf8(text), k)


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    words = Words(buf, offsets, lower=True)
    n_docs = len(offsets) - 1
    h = words.hash
    for step in range(1, k):
        h = mix(h[: max(0, len(words.hash) - step)] * _A + words.hash[step:])
    n = np.maximum(words.n_words - k + 1, 0)
    at = np.arange(int(n.sum())) + np.repeat(words.edge[:-1] - (np.cumsum(n) - n), n)
    doc, val = np.repeat(np.arange(n_docs), n), h[at]
    short = np.flatnonzero((words.n_words > 0) & (words.n_words < k))
    extra = []
    for i in short:
        x = np.uint64(words.n_words[i])
        for w in words.hash[words.edge[i] : words.edge[i + 1]]:
            x = mix(np.array([x], np.uint64) * _A + w)[0]
        extra.append(x)
    doc, val = np.concatenate([doc, short]), np.concatenate([val, np.array(extra, np.uint64)])
    order = np.lexsort((val, doc))
    doc, val = doc[order], val[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (val[1:] != val[:-1])
    doc, val = doc[new], val[new]
    return val, np.searchsorted(doc, np.arange(n_docs + 1))


def _samples(offsets: np.ndarray, threshold: int):
    """Indexes of the sampled shingles (the smallest hashes) and their documents."""
    n = np.diff(offsets)
    t = sample_size(n, threshold)
    at = np.arange(int(t.sum())) + np.repeat(offsets[:-1] - (np.cumsum(t) - t), t)
    return at, np.repeat(np.arange(len(n)), t)


def _short(vals: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each shingle and the 32 bits that name it there. A rare clash counts two
    shingles as one: both then look more frequent to all, which loses no link."""
    return (vals % np.uint64(n_buckets)).astype(np.int64), (vals >> np.uint64(32)).astype(np.uint32)


def _ask_samples(threshold: int, n_buckets: int):
    def run(docs: pa.Table, _msgs) -> pa.Table:
        out = []
        if docs.num_rows:
            no, b = docs.column("block")[0].as_py(), Block(docs)
            val, off = shingle_sets(b.buf, b.offsets)
            vals, cnt = np.unique(val[_samples(off, threshold)[0]], return_counts=True)
            bucket, short = _short(vals, n_buckets)
            for bk, (v, c) in split_by(bucket, short, cnt.astype(np.int32)):
                out.append((bk, no, pack(v, c)))
        return rows(out, ASK_ARROW)

    return run


def _count_documents(table: pa.Table) -> pa.Table:
    """In a bucket: tell each block how many documents sampled its shingles, if others did."""
    blocks, vals, counts, out = [], [], [], []
    raws = table.column("payload")
    bucket = table.column("bucket")[0].as_py() if table.num_rows else 0
    for i, no in enumerate(table.column("block").to_pylist()):
        v, c = unpack(raws[i].as_py())
        blocks.append(np.full(len(v), no, np.int64))
        vals.append(v)
        counts.append(c)
    if vals:
        blk, v, c = np.concatenate(blocks), np.concatenate(vals), np.concatenate(counts)
        _, inv = np.unique(v, return_inverse=True)
        total = np.bincount(inv, weights=c).astype(np.int64)[inv]
        tell = total > 1
        for no, (x, n) in split_by(blk[tell], v[tell], total[tell]):
            out.append((no, REPLY, pack(np.array([bucket]), x, np.minimum(n, 2**31 - 1).astype(np.int32))))
    return rows(out, ANSWER_ARROW)


def _name(bucket, short: np.ndarray) -> np.ndarray:
    return (np.asarray(bucket).astype(np.uint64) << np.uint64(32)) | short.astype(np.uint64)


_SET = "doc_id long, n_shingles long, set_a long, set_b long, text_md5 binary, keys array<long>, text string"
_SET_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()),
    ("text_md5", pa.binary()), ("keys", pa.list_(pa.int64())), ("text", pa.string()),
])


def _choose_keys(threshold: int, n_buckets: int):
    """Per document the digests of its set and text; if it may link also the keys under which it can
    meet others and its text, which is smaller than its shingles."""

    def run(docs: pa.Table, msgs: pa.Table) -> pa.Table:
        out = []
        if docs.num_rows:
            b = Block(docs)
            val, off = shingle_sets(b.buf, b.offsets)
            at, doc = _samples(off, threshold)
            got = notes(msgs, REPLY)
            v = concat([_name(k[0], x) for k, x, _ in got], np.uint64)
            c = concat([n for _, _, n in got], np.int32)
            o = np.argsort(v)
            v, c = v[o], c[o]
            mine = val[at]
            df = np.ones(len(at), np.int64)
            if len(v):
                name = _name(*_short(mine, n_buckets))
                k = np.minimum(np.searchsorted(v, name), len(v) - 1)
                df = np.where(v[k] == name, c[k], 1).astype(np.int64)
            n = np.diff(off)
            need, size = shared_need(n, threshold), sample_size(n, threshold)
            shared = np.bincount(doc, weights=df > 1, minlength=b.n)
            order = np.lexsort((mine, df, doc))
            place = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
            key = (df[order] > 1) & (place <= (size - need)[doc[order]]) & (shared >= need)[doc[order]]
            keys, key_doc = mine[order][key].view(np.int64), doc[order][key]
            cut = np.searchsorted(key_doc, np.arange(b.n + 1))
            data = b.buf.tobytes()
            for i in range(b.n):
                s = val[off[i] : off[i + 1]]
                some = cut[i + 1] > cut[i]
                x = mix(s).sum(dtype=np.uint64), mix(s ^ _A).sum(dtype=np.uint64)
                x = [int(np.array(y, np.uint64).view(np.int64)) for y in x]
                raw = data[b.offsets[i] : b.offsets[i + 1]]
                out.append((int(b.ids[i]), len(s), *x, hashlib.md5(raw).digest(),
                            keys[cut[i] : cut[i + 1]] if some else None, raw.decode("utf-8") if some else None))
        return rows(out, _SET_ARROW)

    return run


# ---------------------------------------------------------------- trie join in a task


class Trie:
    """Path-compressed prefix tree over sets given as rising arrays of local shingle numbers.

    Node ``x`` spells ``row[x][begin[x]:depth[x]]``; children are kept as one concatenated
    array per node, so the overlaps of all children are one gather and one sum."""

    def __init__(self, sets: list[np.ndarray]):
        order = sorted(range(len(sets)), key=lambda i: sets[i].tolist())
        self.leaf_at: list[list[int]] = [[]]
        self.parent, self.begin, self.depth, self.row = [-1], [0], [0], [None]
        stack, prev = [0], None
        for i in order:
            s = sets[i]
            common = 0 if prev is None else _common(prev, s)
            last = None
            while self.depth[stack[-1]] > common:
                last = stack.pop()
            top = stack[-1]
            if last is not None and self.depth[top] < common:  # split the edge of ``last``
                mid = self._node(top, self.depth[top], common, self.row[last])
                self.parent[last], self.begin[last] = mid, common
                stack.append(mid)
                top = mid
            if len(s) > common or (prev is None):
                top = self._node(top, common, len(s), s)
                stack.append(top)
            self.leaf_at[top].append(i)
            prev = s
        n = len(self.parent)
        self.children: list[list[int]] = [[] for _ in range(n)]
        for x in range(1, n):
            self.children[self.parent[x]].append(x)
        self.open = np.zeros(n, np.int64)
        self.low, self.high = np.full(n, 1 << 60), np.zeros(n, np.int64)
        self.node_of = {}
        for x, leaves in enumerate(self.leaf_at):
            for i in leaves:
                self.node_of[i] = x
                y = x
                while y >= 0:
                    self.open[y] += 1
                    self.low[y], self.high[y] = min(self.low[y], len(sets[i])), max(self.high[y], len(sets[i]))
                    y = self.parent[y]
        self.fan = {}
        for x, kids in enumerate(self.children):
            if kids:
                edges = [self.row[c][self.begin[c] : self.depth[c]] for c in kids]
                size = np.array([len(e) for e in edges])
                k = np.array(kids)
                self.fan[x] = (k, np.concatenate(edges), np.cumsum(size) - size,
                               np.array([e[-1] for e in edges]), self.high[k] - np.array(self.depth)[k], self.low[k])

    def _node(self, parent, begin, depth, row) -> int:
        self.parent.append(parent)
        self.begin.append(begin)
        self.depth.append(depth)
        self.row.append(row)
        self.leaf_at.append([])
        return len(self.parent) - 1

    def close(self, i: int) -> None:
        """Set ``i`` is settled: walks skip subtrees that hold settled sets only."""
        x = self.node_of[i]
        self.leaf_at[x].remove(i)
        while x >= 0:
            self.open[x] -= 1
            x = self.parent[x]

    def similar(self, s: np.ndarray, mark: np.ndarray, threshold: int, sizes: list[int]) -> list[int]:
        """Open sets similar to ``s``; ``mark`` is true at its shingles."""
        n, out = len(s), []
        need = 100 + threshold
        stack = [(0, 0)]
        while stack:
            x, overlap = stack.pop()
            out += [i for i in self.leaf_at[x] if need * overlap >= threshold * (n + sizes[i])]
            if x not in self.fan:
                continue
            kids, cat, cuts, last, beyond, low = self.fan[x]
            got = overlap + np.add.reduceat(mark[cat], cuts, dtype=np.int64)
            most = got + np.minimum(n - np.searchsorted(s, last, side="right"), beyond)
            go = (self.open[kids] > 0) & (need * most >= threshold * (n + low))
            stack += zip(kids[go].tolist(), got[go].tolist())
        return out


def _common(a: np.ndarray, b: np.ndarray) -> int:
    k = min(len(a), len(b))
    d = a[:k] != b[:k]
    return int(d.argmax()) if d.any() else k


def join_sets(sets: list[np.ndarray], threshold: int) -> list[tuple[int, int]]:
    """Spanning forest of the similar pairs among sets of hashes, as index pairs."""
    if len(sets) == 2:  # a trie of two paths: the common part and two ends
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(0, 1)] if (100 + threshold) * both >= threshold * (len(sets[0]) + len(sets[1])) else []
    sizes = [len(s) for s in sets]
    _, inv, cnt = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(cnt), np.int64)
    rank[np.argsort(-cnt, kind="stable")] = np.arange(len(cnt))  # what many share stands first
    cut = np.cumsum([0, *sizes])
    local = [np.sort(rank[inv[a:b]]) for a, b in zip(cut[:-1], cut[1:])]
    trie = Trie(local)
    mark = np.zeros(len(cnt), dtype=bool)
    links, waiting = [], list(range(len(sets)))
    settled = [False] * len(sets)
    for root in waiting:
        if settled[root]:
            continue
        settled[root] = True
        trie.close(root)
        queue = [root]
        while queue:
            i = queue.pop()
            mark[local[i]] = True
            for j in trie.similar(local[i], mark, threshold, sizes):
                settled[j] = True
                trie.close(j)
                links.append((i, j))
                queue.append(j)
            mark[local[i]] = False
    return links


# a repeated id may stand for several sets, so links name both ends by id and set
_LINK = pa.schema([(f"{end}_{c}", pa.int64()) for end in "ab" for c in ("rep", "set_a", "set_b")])
_LINK_COLUMNS = ", ".join(f"{f.name} long" for f in _LINK)


def _join_groups(threshold: int):
    def run(table: pa.Table) -> pa.Table:
        out = []
        t = table.sort_by([("group_a", "ascending"), ("group_b", "ascending"), ("group_c", "ascending"), ("rep", "ascending")])
        key = np.stack([t.column(c).to_numpy() for c in ("group_a", "group_b", "group_c")], axis=1)
        name = list(zip(*(t.column(c).to_pylist() for c in ("rep", "set_a", "set_b"))))
        text = t.column("text").combine_chunks()
        val, off = text_sets(pa.concat_arrays(text.chunks) if isinstance(text, pa.ChunkedArray) else text)
        cut = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1), [True]]))
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            if b - a > 1:
                sets = [val[off[i] : off[i + 1]] for i in range(a, b)]
                out += [(*name[a + i], *name[a + j]) for i, j in join_sets(sets, threshold)]
        return rows(out, _LINK)

    return run


# ---------------------------------------------------------------- the operator


def _task_groups(reps: DataFrame, threshold: int, limit: int) -> DataFrame:
    """``reps(rep, n, component)`` with the groups in which each is compared: one group for
    a light component; for a heavy one, neighbouring size classes and pairs of parts."""
    weight = reps.groupBy("component").agg(F.sum("n").alias("w"), F.count(F.lit(1)).alias("m")).filter("m > 1")
    r = reps.join(weight, "component")
    light = r.filter(F.col("w") <= limit).select(
        "rep", "set_a", "set_b", F.col("component").alias("group_a"), F.lit(0).alias("group_b"), F.lit(0).alias("group_c")
    )
    # similar sets differ in size by at most the factor 100 / threshold: same or next class
    band = F.floor(F.log("n") / F.log(F.lit(100.0 / threshold)) + F.lit(1e-9)).cast("int")
    heavy = r.filter(F.col("w") > limit).withColumn("band", band)
    heavy = heavy.withColumn("group_b", F.explode(F.array("band", F.col("band") + 1)))
    band_weight = heavy.groupBy("component", "group_b").agg(
        F.greatest(F.lit(1), F.ceil(F.sum("n") * 2 / F.lit(limit))).cast("int").alias("parts")
    )
    heavy = heavy.join(band_weight, ["component", "group_b"])
    part = F.pmod(F.xxhash64("rep", "set_a", "set_b"), F.col("parts")).cast("int")
    heavy = heavy.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    heavy = heavy.filter((F.col("parts") == 1) | (F.col("part") != F.col("other")))
    heavy = heavy.select(
        "rep", "set_a", "set_b", F.col("component").alias("group_a"), (F.col("group_b") + 1).alias("group_b"),
        (F.least("part", "other").cast("long") * F.lit(1 << 31) + F.greatest("part", "other")).alias("group_c"),
    )
    return light.unionByName(heavy)


def _judged(docs: DataFrame, threshold: int, doc_id: str, text: str, task_shingles: int = TASK_SHINGLES) -> DataFrame:
    """One row per document: ``doc_id`` (null as ``NULL_ID``), ``n_shingles, set_a, set_b,
    text_md5`` and ``node, component``: its own set and the smallest one that links reach,
    each as ``(rep, set_a, set_b)``."""
    n_blocks = block_count(docs, text)
    n_buckets = max(1, n_blocks // 3)
    blocks = to_blocks(docs, n_blocks, doc_id, text, by_text=True)
    asked = blocks.groupBy("block").applyInArrow(alone(_ask_samples(threshold, n_buckets)), ASK)
    counts = ask_buckets(asked, n_buckets, _count_documents)
    sets = written(
        blocks.groupBy("block").cogroup(home(counts, n_blocks)).applyInArrow(_choose_keys(threshold, n_buckets), _SET), "sets"
    )

    may = sets.filter(F.col("text").isNotNull())
    same = ["n_shingles", "set_a", "set_b"]
    reps = written(may.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.min("keys").alias("keys")), "distinct-sets")
    # a set has one node, a hash of its digests: a clash only joins candidates
    reps_at = reps.withColumn("node", F.xxhash64(*same))
    keyed = reps_at.select("node", F.explode("keys").alias("key"))
    low = keyed.groupBy("key").agg(F.min("node").alias("low"))
    stars = keyed.join(low, "key").filter(F.col("node") != F.col("low")).select("node", "low").distinct()
    candidates = components(stars, "node", "low")
    members = reps_at.join(candidates, "node").select("rep", "set_a", "set_b", F.col("n_shingles").alias("n"), "component")
    groups = written(_task_groups(members, threshold, task_shingles), "groups")
    total = groups.join(reps.select("rep", "set_a", "set_b", "n_shingles"), ["rep", "set_a", "set_b"]).agg(F.sum("n_shingles")).first()[0]
    n_tasks = max(1, -(-int(total or 0) // task_shingles))
    texts = may.select(F.col("doc_id").alias("rep"), "set_a", "set_b", "text")
    dealt = groups.join(texts, ["rep", "set_a", "set_b"]).withColumn(
        "task", F.pmod(F.xxhash64("group_a", "group_b", "group_c"), F.lit(n_tasks)).cast("int")
    )
    dealt = dealt.select("task", "group_a", "group_b", "group_c", "rep", "set_a", "set_b", "text").repartition(n_tasks, "task")
    links = written(dealt.groupBy("task").applyInArrow(_join_groups(threshold), _LINK_COLUMNS), "links")
    links = links.select(*[F.struct(*[F.col(f"{end}_{c}").alias(c) for c in ("rep", "set_a", "set_b")]).alias(end) for end in "ab"])
    linked = components(links, "a", "b").withColumnRenamed("node", "at")

    owner = reps.select(*same, F.struct("rep", "set_a", "set_b").alias("at")).join(linked, "at", "left").select(
        *same, F.coalesce("component", "at").alias("component")
    )
    res = sets.select("doc_id", *same, "text_md5", F.struct(F.col("doc_id").alias("rep"), "set_a", "set_b").alias("node"))
    return res.join(owner, same, "left").withColumn("component", F.coalesce("component", "node"))


def near_duplicates(
    docs: DataFrame, threshold: int = 80, doc_id: str = "doc_id", text: str = "text", task_shingles: int = TASK_SHINGLES
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id`` (the smallest id that links
    reach, its own included)."""
    null = F.lit(int(NULL_ID))
    return _judged(docs, threshold, doc_id, text, task_shingles).select(
        F.nullif(F.col("doc_id"), null).alias("doc_id"), "n_shingles", F.nullif(F.col("component.rep"), null).alias("component_id")
    )


def keep_one_per_group(docs: DataFrame, threshold: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component: of its smallest id, where that stands on
    several texts the one with the smallest digests. Rows are judged by id and text; rows
    equal in both are kept once, rows without id all stay."""
    found = _judged(docs, threshold, doc_id, text).filter((F.col("doc_id") != int(NULL_ID)) & (F.col("node") == F.col("component")))
    wordless = F.when(F.col("n_shingles") == 0, F.col("text_md5"))  # these link with nothing
    stay = found.groupBy("doc_id", "set_a", "set_b", wordless.alias("wordless")).agg(F.min("text_md5").alias("_stay_md5"))
    stay = stay.select(F.col("doc_id").alias("_stay"), "_stay_md5")
    named = docs.filter(F.col(doc_id).isNotNull())
    digest = "_md5"
    while digest in docs.columns:
        digest += "_"
    named = named.withColumn(digest, F.unhex(F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"))))
    same = (named[doc_id] == stay["_stay"]) & (named[digest] == stay["_stay_md5"])
    named = named.join(stay, same, "left_semi").dropDuplicates([doc_id, digest]).drop(digest)
    return named.unionByName(docs.filter(F.col(doc_id).isNull()))
