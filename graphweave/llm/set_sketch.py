"""Near-duplicate documents by SetSketch registers.

A document's set holds its distinct 4-word shingles (A-Z lower-cased, words
``[^\\x20\\x09-\\x0D]+``); with fewer words the whole sequence is its one shingle. Documents link
when ``100 * intersection >= threshold * union`` and components of links are groups of copies.

Method. Every shingle draws points of a Poisson process, each in a register picked at random;
a register keeps the smallest point of the whole set, truncated on a scale of powers of
``BASE`` to one byte. The sketch of a union is the larger register of each place (``merged``),
whatever the order or the parts, and two registers agree about as often as the sets overlap.
A set generates its points in rising order, round by round, and stops once every further
point lies above all its registers, so the work is that of the shingles plus some 2,500
points, not shingles times registers.

* *Bands.* ``REGISTERS / BAND`` runs of registers are the keys under which sets meet. Two sets
  of similarity 0.8 miss each other in all bands with a probability under 4e-9.
* *Joint likelihood.* For a pair that met, the numbers of registers that are larger, smaller and
  equal have a likelihood that depends on both (known) sizes and the similarity. A pair is
  left only if its most likely similarity is below the threshold and that beats the threshold
  by a factor over ``exp(DOUBT)``, a chance of about 1e-9 for a pair that links.
* *Verification.* Links are confirmed on the full sets; nothing else makes a link.

Distribution. Equal sets are collapsed to one first, so thousands of copies cost one sketch in
the bands. Sets of one band are joined to the smallest of them (a star, never all pairs), and
components of the stars are the groups in which pairs are compared, inside a task: first the
member that met most others against all of its bands, then only sets that are still apart. A
group of copies costs one comparison each. A group heavier than ``task_shingles`` is peeled
around pivots first (see ``_peel``) and what then is still too heavy is cut into parts of which
every two meet. Sketches and links are written to the shared folder between steps.

Defined results: null, empty and wordless texts have ``n_shingles`` 0, link with nothing and are
their own component; repeated rows stay rows and share a component; of rows without id the
component's smallest id is that of the others, or null if there is none; a null id is ``kept``
if its component has no id. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .jaccard_join import shingle_sets, text_sets
from .line_crf import stretches
from .textblocks import mix, rows, utf8
from .written import written

SHINGLE_WORDS = 4
REGISTERS, BAND = 384, 6
BASE, RATE, TOP = 1.15, 20.0, 255
DOUBT = 18.0
TASK_SHINGLES = 1_000_000
LAST_ID = np.iinfo(np.int64).max  # a null id sorts last and stands for itself
_STEP = np.uint64(0xD1342543DE82EF95)
_LOW32 = np.uint64(0xFFFFFFFF)
_A = np.uint64(0x9E3779B97F4A7C15)

# ---------------------------------------------------------------- sketches


def sketches(val: np.ndarray, off: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """One row of ``m`` one-byte registers per set; ``val[off[i]:off[i + 1]]`` is set ``i``."""
    n = np.diff(off)
    low = np.full(len(n) * m, np.inf)
    at = np.flatnonzero(n)
    doc = np.repeat(np.arange(len(n)), n)
    seed, when, drawn = val, np.zeros(len(val)), 0
    while len(seed):
        size = np.bincount(doc, minlength=len(n))
        # each round every shingle of the smallest sets draws many points, of large ones few
        many = np.clip(2 * m // np.maximum(size, 1), 1, 64)[doc]
        bound = low.reshape(-1, m).max(axis=1)
        points = int(many.max())
        for j in range(points):
            if j:
                on = many > j
                if not on.all():
                    live = np.flatnonzero(on)
                    x, s, d = when[live], seed[live], doc[live]
                else:
                    live, x, s, d = slice(None), when, seed, doc
            else:
                live, x, s, d = slice(None), when, seed, doc
            r = mix(s + _STEP)
            seed[live] = r
            x = x - np.log(((r >> np.uint64(32)).astype(np.float64) + 0.5) / 2.0**32) / (m * RATE)
            when[live] = x
            use = np.flatnonzero(x < bound[d])
            reg = ((r[use] & _LOW32) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
            np.minimum.at(low, d[use] * m + reg, x[use])
        drawn += points
        stay = when < low.reshape(-1, m).max(axis=1)[doc]
        seed, when, doc = seed[stay], when[stay], doc[stay]
    out = np.zeros((len(n), m), np.uint8)
    if len(at):
        k = np.floor(1 - np.log(low.reshape(-1, m)[at]) / np.log(BASE))
        out[at] = np.clip(k, 0, TOP).astype(np.uint8)
    return out


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of a union of sets from their sketches."""
    return np.maximum(a, b)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """The keys of each sketch: the registers of a band as they are, with the band's number."""
    n, m = sketch.shape
    part = sketch.reshape(n, m // BAND, BAND).astype(np.int64)
    key = np.zeros(part.shape[:2], np.int64)
    for j in range(BAND):
        key = (key << 8) | part[:, :, j]
    return key | (np.arange(m // BAND, dtype=np.int64) << (8 * BAND))


def _above(x: np.ndarray) -> np.ndarray:
    """Probability that a register is larger, from the share of the union only one set has."""
    return np.maximum(-np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE), 1e-12)


def log_likelihood(sim, more, less, same, n_a, n_b):
    """Of ``more``, ``less`` and ``same`` registers of a (size ``n_a``) against b (``n_b``)."""
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    p, q = _above(u - v * sim), _above(v - u * sim)
    return more * np.log(p) + less * np.log(q) + same * np.log(np.maximum(1 - p - q, 1e-12))


def most_likely(more, less, same, n_a, n_b):
    """Similarity of the greatest likelihood (it is concave: golden section)."""
    lo, hi = np.zeros(len(same)), np.minimum(n_a / n_b, n_b / n_a)
    g = (5**0.5 - 1) / 2
    for _ in range(24):
        x, y = hi - g * (hi - lo), lo + g * (hi - lo)
        right = log_likelihood(x, more, less, same, n_a, n_b) < log_likelihood(y, more, less, same, n_a, n_b)
        lo, hi = np.where(right, x, lo), np.where(right, hi, y)
    return (lo + hi) / 2


def may_link(sketch: np.ndarray, i: int, others: np.ndarray, n: np.ndarray, threshold: int) -> np.ndarray:
    """Which of ``others`` may link with ``i`` by size and joint likelihood."""
    a, b = n[i], n[others]
    fit = (100 + threshold) * np.minimum(a, b) >= threshold * (a + b)
    out = np.zeros(len(others), dtype=bool)
    at = np.flatnonzero(fit)
    near = sketch[others[at]]
    same = (near == sketch[i]).sum(axis=1)
    sure = 100 * same >= threshold * sketch.shape[1]
    out[at[sure]] = True
    ask = ~sure
    at, near, same = at[ask], near[ask], same[ask].astype(float)
    if len(at):
        more = (sketch[i] > near).sum(axis=1).astype(float)
        less = sketch.shape[1] - more - same
        x, y = float(a), b[at].astype(float)
        best = most_likely(more, less, same, x, y)
        line = np.minimum(threshold / 100, np.minimum(x / y, y / x))
        lost = log_likelihood(best, more, less, same, x, y) - log_likelihood(line, more, less, same, x, y)
        out[at] = (best >= line) | (lost <= DOUBT)
    return out


# ---------------------------------------------------------------- pairs in a task


class Group:
    """Sets that may be similar, in one task: finds a spanning forest of their links."""

    def __init__(self, sets: list[np.ndarray], sketch: np.ndarray, threshold: int, side: np.ndarray | None = None):
        self.n = np.array([len(s) for s in sets], np.int64)
        self.sketch, self.threshold, self.side = sketch, threshold, side
        flat = np.concatenate(sets)
        self.off = np.concatenate([[0], np.cumsum(self.n)])
        self.local = np.unique(flat, return_inverse=True)[1]
        self.mark = np.zeros(int(self.local.max()) + 1, dtype=bool)
        self.group = np.arange(len(sets))
        self.links: list[tuple[int, int]] = []

    def compare(self, i: int, others: np.ndarray) -> None:
        """Join to ``i`` what of ``others`` links with it and is not joined yet."""
        others = others[self.group[others] != self.group[i]]
        if self.side is not None:  # pairs of one side are compared elsewhere
            others = others[self.side[others] != self.side[i]]
        if len(others):
            others = others[may_link(self.sketch, i, others, self.n, self.threshold)]
        if not len(others):
            return
        mine = self.local[self.off[i] : self.off[i + 1]]
        self.mark[mine] = True
        size = self.n[others]
        cut = np.cumsum(size) - size
        at = np.arange(int(size.sum())) + np.repeat(self.off[others] - cut, size)
        both = np.add.reduceat(self.mark[self.local[at]], cut, dtype=np.int64)
        self.mark[mine] = False
        similar = others[(100 + self.threshold) * both >= self.threshold * (self.n[i] + size)]
        _, first = np.unique(self.group[similar], return_index=True)
        for j in similar[first].tolist():
            self.links.append((i, j))
        if len(similar):
            joined = np.append(self.group[similar], self.group[i])
            self.group[np.isin(self.group, joined)] = joined.min()

    def run(self) -> list[tuple[int, int]]:
        if len(self.n) == 2:
            self.compare(0, np.array([1]))
            return self.links
        keys = band_keys(self.sketch).T
        buckets = []
        for key in keys:
            order = np.argsort(key, kind="stable")
            k = key[order]
            cut = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1], [True]]))
            buckets += [order[a:b] for a, b in zip(cut[:-1], cut[1:]) if b - a > 1]
        met = np.zeros(len(self.n), np.int64)
        for b in buckets:
            met[b] += len(b) - 1
        # the member that met most others, against all it met
        pivots: dict[int, list[np.ndarray]] = {}
        for b in buckets:
            pivots.setdefault(int(b[np.argmax(met[b])]), []).append(b)
        for p in sorted(pivots, key=lambda i: (-met[i], i)):
            self.compare(p, np.unique(np.concatenate(pivots[p])))
        # then those outside the largest joined part of a bucket, against all others of it
        todo: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for b in buckets:
            part, inv, size = np.unique(self.group[b], return_inverse=True, return_counts=True)
            if len(part) > 1:
                apart = inv != int(np.argmax(size))
                for i in b[apart].tolist():
                    todo.setdefault(i, []).append((b, apart))
        done = np.zeros(len(self.n), dtype=bool)
        for i in sorted(todo):
            self.compare(i, np.unique(np.concatenate([b[~(done[b] & apart)] for b, apart in todo[i]])))
            done[i] = True
        return self.links


# ---------------------------------------------------------------- the operator

_SET = pa.schema([
    ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("set_a", pa.int64()),
    ("set_b", pa.int64()), ("sketch", pa.binary()),
])
_SET_COLUMNS = "doc_id long, text_hash long, n_shingles long, set_a long, set_b long, sketch binary"
_LINK = pa.schema([(f"{end}_{c}", pa.int64()) for end in "ab" for c in ("rep", "set_a", "set_b")])
_LINK_COLUMNS = ", ".join(f"{f.name} long" for f in _LINK)
_NODE = ["rep", "set_a", "set_b"]


def digests(val: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name each set, whatever the order of its shingles."""
    total = [np.concatenate([[np.uint64(0)], np.cumsum(mix(x), dtype=np.uint64)]) for x in (val, val ^ _A)]
    return tuple((t[off[1:]] - t[off[:-1]]).view(np.int64) for t in total)


def _sketch_rows(k: int):
    def run(batches):
        for batch in batches:
            for lo, hi in stretches(batch.column(2)):
                val, off = shingle_sets(*utf8(batch.column(2).slice(lo, hi - lo)), k)
                a, b = digests(val, off)
                s = sketches(val.copy(), off)
                cols = [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(np.diff(off)),
                        pa.array(a), pa.array(b), pa.array([x.tobytes() for x in s], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, schema=_SET)

    return run


def set_sketches(docs: DataFrame, k: int = SHINGLE_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``doc_id`` (null as ``LAST_ID``), ``text_hash``, ``n_shingles``, the set's 128-bit name
    ``set_a, set_b`` and its ``sketch``."""
    d = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(int(LAST_ID))).alias("doc_id"),
        F.xxhash64(F.col(text).cast("string")).alias("text_hash"), F.col(text).cast("string").alias("text"),
    )
    return d.mapInArrow(_sketch_rows(k), _SET_COLUMNS)


def _band_rows(batches):
    schema = pa.schema([*((c, pa.int64()) for c in _NODE), ("keys", pa.list_(pa.int64()))])
    for batch in batches:
        if batch.num_rows:
            raw = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            keys = band_keys(raw)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * keys.shape[1], pa.int32()), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), flat], schema=schema)


def _join_groups(threshold: int, k: int):
    def run(table: pa.Table) -> pa.Table:
        out = []
        t = table.sort_by([(c, "ascending") for c in ("group_a", "group_b", "group_c", *_NODE)])
        key = np.stack([t.column(c).to_numpy() for c in ("group_a", "group_b", "group_c")], axis=1)
        name = list(zip(*(t.column(c).to_pylist() for c in _NODE)))
        sketch = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(t.num_rows, -1)
        side = t.column("side").to_numpy()
        text = t.column("text").combine_chunks()
        val, off = text_sets(pa.concat_arrays(text.chunks) if isinstance(text, pa.ChunkedArray) else text, k)
        cut = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1), [True]]))
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            if b - a > 1:
                sets = [val[off[i] : off[i + 1]] for i in range(a, b)]
                sides = side[a:b]
                found = Group(sets, sketch[a:b], threshold, sides if sides.min() < sides.max() else None).run()
                out += [(*name[a + i], *name[a + j]) for i, j in found]
        return rows(out, _LINK)

    return run


def _pair_overlaps(k: int):
    """Shingles that the texts of a row share."""

    def run(batches):
        for batch in batches:
            both = []
            for lo, hi in stretches(batch.column(3), 1 << 19):
                a, b = (text_sets(batch.column(c).slice(lo, hi - lo), k) for c in (3, 4))
                for i in range(hi - lo):
                    x, y = (v[o[i] : o[i + 1]] for v, o in (a, b))
                    both.append(len(np.intersect1d(x, y, assume_unique=True)))
            names = [batch.column(c) for c in range(3)]
            yield pa.RecordBatch.from_arrays([*names, pa.array(both, pa.int64())], names=[*_NODE, "both"])

    return run


def _peel(heavy: DataFrame, texts: DataFrame, threshold: int, limit: int, k: int, rounds: int = 3):
    """Heavy groups, member by member against one pivot each round.

    Similarity is one minus a metric: what links with the pivot and what is less than
    ``2 * threshold - 100`` percent similar to it can never link with each other. So linked
    members leave the group with one link each, and only members between the two bounds are still
    compared with them (one side of a group against the other); the others, which now are a
    smaller group, go on. ``(links, groups)``: groups as for ``_join_groups``."""
    links, groups = [], []
    far = 2 * threshold - 100
    left = heavy.withColumn("group_b", F.lit(0).cast("long"))
    for turn in range(rounds):
        if left.isEmpty():
            break
        pivot = left.groupBy("component").agg(F.min(F.struct(*_NODE)).alias("p"))
        pivot = pivot.select("component", *[F.col(f"p.{c}").alias(f"p_{c}") for c in _NODE])
        pivot = pivot.join(texts.select(*[F.col(c).alias(f"p_{c}") for c in _NODE], F.col("text").alias("p_text"),
                                        F.col("n").alias("p_n")), [f"p_{c}" for c in _NODE])
        pivot = written(pivot, "pivots")
        other = left.join(texts, _NODE).join(pivot, "component").filter(
            (F.col("rep") != F.col("p_rep")) | (F.col("set_a") != F.col("p_set_a")) | (F.col("set_b") != F.col("p_set_b"))
        )
        both = other.select(*_NODE, "text", "p_text").mapInArrow(_pair_overlaps(k), "rep long, set_a long, set_b long, both long")
        seen = left.join(written(both, "overlaps"), _NODE).join(pivot.drop("p_text"), "component")
        percent = F.lit(100) * F.col("both")
        union = F.col("n") + F.col("p_n") - F.col("both")
        zone = F.when(percent >= threshold * union, 0).when(percent >= far * union, 1).otherwise(2)
        seen = written(seen.withColumn("zone", zone), "zones")
        links.append(seen.filter("zone = 0").select(
            *[F.col(f"p_{c}").alias(f"a_{c}") for c in _NODE], *[F.col(c).alias(f"b_{c}") for c in _NODE]))
        # members between the bounds against the linked ones, in parts of which each two meet
        part = seen.filter("zone < 2").groupBy("component", "zone").agg(F.sum("n").alias("w"))
        part = part.groupBy("component").pivot("zone", [0, 1]).sum("w").filter("`0` is not null and `1` is not null")
        cells = part.select("component", *[F.ceil(F.col(f"`{z}`") * 2 / limit).cast("int").alias(f"parts_{z}") for z in (0, 1)])
        mine = seen.filter("zone < 2").join(cells, "component")
        h = F.xxhash64(*_NODE)
        own = F.when(F.col("zone") == 0, F.pmod(h, "parts_0")).otherwise(F.pmod(h, "parts_1")).cast("long")
        across = F.when(F.col("zone") == 0, F.col("parts_1")).otherwise(F.col("parts_0"))
        mine = mine.withColumn("own", own).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), across.cast("long") - 1)))
        cell = F.when(F.col("zone") == 0, F.struct(F.col("own").alias("x"), F.col("with").alias("y"))).otherwise(
            F.struct(F.col("with").alias("x"), F.col("own").alias("y")))
        groups.append(mine.withColumn("cell", cell).select(
            *_NODE, F.xxhash64("component", F.lit(turn)).alias("group_a"), (F.col("cell.x") + 1).alias("group_b"),
            F.col("cell.y").alias("group_c"), F.col("zone").cast("int").alias("side")))
        left = seen.filter("zone > 0").select(*left.columns)
        weight = left.groupBy("component").agg(F.sum("n").alias("w")).withColumnRenamed("component", "c")
        joined = left.join(weight, F.col("component") == F.col("c")).drop("c")
        light = joined.filter(F.col("w") <= limit)
        groups.append(light.select(*_NODE, F.xxhash64("component", F.lit(turn)).alias("group_a"),
                                   F.lit(0).cast("long").alias("group_b"), F.lit(0).cast("long").alias("group_c"), F.lit(0).alias("side")))
        left = written(joined.filter(F.col("w") > limit).drop("w"), "left")
    # what no pivot makes lighter: similar sets are of the same or the next size class, parts meet in pairs
    size = F.floor(F.log("n") / F.log(F.lit(100.0 / threshold)) + F.lit(1e-9)).cast("long")
    rest = left.withColumn("size", F.explode(F.array(size, size + 1)))
    parts = rest.groupBy("component", "size").agg(F.greatest(F.lit(1), F.ceil(F.sum("n") * 2 / F.lit(limit))).cast("long").alias("parts"))
    rest = rest.join(parts, ["component", "size"]).withColumn("part", F.pmod(F.xxhash64(*_NODE), F.col("parts")))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    rest = rest.filter((F.col("parts") == 1) | (F.col("part") != F.col("other")))
    groups.append(rest.select(
        *_NODE, F.xxhash64("component", F.lit(rounds), F.col("size")).alias("group_a"), (F.least("part", "other") + 1).alias("group_b"),
        F.greatest("part", "other").alias("group_c"), F.lit(0).alias("side")))
    return links, groups


def _union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def near_duplicates(
    docs: DataFrame, threshold: int = 80, k: int = SHINGLE_WORDS, doc_id: str = "doc_id", text: str = "text",
    task_shingles: int = TASK_SHINGLES,
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id`` (the smallest id that links
    reach, its own included) and ``kept`` (its id is that)."""
    sets = written(set_sketches(docs, k, doc_id, text), "sketches")
    same = ["n_shingles", "set_a", "set_b"]
    reps = sets.filter("n_shingles > 0").groupBy(*same).agg(F.min(F.struct("doc_id", "text_hash", "sketch")).alias("r"))
    reps = written(reps.select(F.col("r.doc_id").alias("rep"), "set_a", "set_b", F.col("n_shingles").alias("n"),
                               F.col("r.text_hash").alias("text_hash"), F.col("r.sketch").alias("sketch")), "distinct-sets")

    # sets that meet in a band are joined to the smallest name there; a clash of names only joins candidates
    keyed = reps.select(*_NODE, "sketch").mapInArrow(_band_rows, "rep long, set_a long, set_b long, keys array<long>")
    keyed = keyed.select(F.xxhash64(*_NODE).alias("node"), F.explode("keys").alias("key"))
    low = keyed.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high").drop("high")
    stars = written(keyed.join(low, "key").filter(F.col("node") != F.col("low")).select("node", "low").distinct(), "stars")
    candidates = components(stars, "node", "low")
    member = reps.withColumn("node", F.xxhash64(*_NODE)).join(candidates, "node").drop("node")
    member = written(member, "members")

    # texts of the members: an id may stand on many texts, so the text's hash is asked for too
    asked = member.select(F.col("rep").alias("doc_id"), "text_hash", "set_a", "set_b", "n", "sketch")
    t = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(int(LAST_ID))).alias("doc_id"),
                    F.xxhash64(F.col(text).cast("string")).alias("text_hash"), F.col(text).cast("string").alias("text"))
    t = t.join(asked.select("doc_id", "text_hash"), ["doc_id", "text_hash"], "left_semi").dropDuplicates(["doc_id", "text_hash"])
    texts = written(t.join(asked, ["doc_id", "text_hash"]).drop("text_hash").withColumnRenamed("doc_id", "rep"), "texts")

    weight = member.groupBy("component").agg(F.sum("n").alias("w"))
    weighed = member.select(*_NODE, "n", "component").join(weight, "component")
    light = weighed.filter(F.col("w") <= task_shingles).select(
        *_NODE, F.col("component").alias("group_a"), F.lit(0).cast("long").alias("group_b"), F.lit(0).cast("long").alias("group_c"),
        F.lit(0).alias("side"))
    heavy = written(weighed.filter(F.col("w") > task_shingles).drop("w"), "heavy")
    links, groups = _peel(heavy, texts.select(*_NODE, "text", "n").drop("component"), threshold, task_shingles, k)
    groups = written(_union([light, *groups]), "groups")
    total = groups.join(member.select(*_NODE, "n"), _NODE).agg(F.sum("n")).first()[0]
    n_tasks = max(1, -(-int(total or 0) * 8 // task_shingles))
    # light groups are bundled, heavier ones travel alone
    dealt = groups.join(texts.drop("n"), _NODE).withColumn(
        "task", F.pmod(F.xxhash64("group_a", "group_b", "group_c"), F.lit(n_tasks)).cast("int"))
    dealt = dealt.select("task", "group_a", "group_b", "group_c", "side", *_NODE, "sketch", "text").repartition(n_tasks, "task")
    links.append(dealt.groupBy("task").applyInArrow(_join_groups(threshold, k), _LINK_COLUMNS))
    found = written(_union(links), "links")
    ends = found.select(*[F.struct(*[F.col(f"{end}_{c}").alias(c) for c in _NODE]).alias(end) for end in "ab"])
    linked = components(ends, "a", "b").select(F.col("node").alias("at"), F.col("component.rep").alias("low"))

    owner = reps.select(F.col("n").alias("n_shingles"), "set_a", "set_b", "rep", F.struct(*_NODE).alias("at"))
    owner = owner.join(linked, "at", "left").select(*same, F.coalesce("low", "rep").alias("component"))
    res = sets.select("doc_id", *same).join(owner, same, "left")
    null = F.lit(int(LAST_ID))
    res = res.select(F.nullif("doc_id", null).alias("doc_id"), "n_shingles",
                     F.nullif(F.coalesce("component", "doc_id"), null).alias("component_id"))
    return res.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
