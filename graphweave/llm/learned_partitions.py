"""Nearest neighbours by inner product with learned partitions.

Method. On a bounded sample of the vectors the neighbour graph is built and cut into parts of
equal size with few cut edges (grown part by part, then improved by moves that keep the
balance). A small network learns from the sample which part a vector's neighbours lie in.
Every vector of the table is filed under its most probable part, and a query visits its
several most probable parts, where all candidates are ranked by the exact inner product.
How many parts a query visits is settled on the sample: the fewest that reach ``RECALL`` there.

Distribution. The sample (``SAMPLE`` vectors in the order of a hash of their ids) bounds what
the fit sees; the index holds every row. A part with many rows (one vector that much of
the table repeats) is dealt over cells of ``CELL_ROWS`` rows, and a query meets each cell
once, so work per task is bounded. Of each cell only a query's best ``k`` move on. All
visits of one query are ranked together with ties to the smaller id.

Candidates are found in single precision with a margin and scored in double precision, each
score summed in one order, so equal vectors have equal scores.

Defined results: null vectors, those without a component, all zero, or with a null or
non-finite component take no part; vectors of another length than the most frequent one
take no part; null ids take no part; rows that repeat an id are one candidate each, and a
query does not meet rows of its own id; query rows equal in id and vector are one query,
those of one id with different vectors are a query each, with ranks of its own; no vectors
give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .written import written

SAMPLE, PART_ROWS, CELL_ROWS, RECALL = 6000, 1500, 8192, 0.95
_NEIGHBOURS, _HIDDEN, _EPOCHS = 10, 96, 25


@dataclass
class Router:
    """Two layers from a direction to the probability of each part."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    visits: int

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(_unit(x) @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def parts(self, x: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` most probable parts of each vector, most probable first."""
        return np.argsort(-self.logits(x), axis=1, kind="stable")[:, :n]


def _unit(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / top
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` nearest others of each vector, by inner product."""
    n = len(x)
    k = min(k, n - 1)
    out = np.zeros((n, k), np.int64)
    for a in range(0, n, 512):
        s = x[a : a + 512] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a : a + 512] = np.argpartition(-s, k - 1, axis=1)[:, :k] if k else 0
    return out


def balanced_parts(graph: np.ndarray, n_parts: int, rounds: int = 8, slack: float = 0.05) -> np.ndarray:
    """Parts of nearly equal size with few edges between them: parts grow along the graph
    until full, then vertices move where most of their neighbours are, while sizes stay
    within ``slack`` of equal."""
    n = len(graph)
    both = np.concatenate([np.stack([np.repeat(np.arange(n), graph.shape[1]), graph.reshape(-1)]),
                           np.stack([graph.reshape(-1), np.repeat(np.arange(n), graph.shape[1])])], axis=1)
    both = both[:, np.argsort(both[0], kind="stable")]
    cut = np.searchsorted(both[0], np.arange(n + 1))
    near = [both[1][a:b] for a, b in zip(cut[:-1], cut[1:])]
    size, part = -(-n // n_parts), np.full(n, -1)
    order = iter(range(n))
    for k in range(n_parts):
        wanted, ties = min(size, int((part < 0).sum())), {}
        while wanted:
            if ties:  # the unassigned vertex with most edges into the part
                v = max(ties, key=lambda u: (ties[u], -u))
                del ties[v]
            else:
                v = next((u for u in order if part[u] < 0), None)
                if v is None:
                    v = int(np.flatnonzero(part < 0)[0])
            part[v] = k
            wanted -= 1
            for u in near[v].tolist():
                if part[u] < 0:
                    ties[u] = ties.get(u, 0) + 1
    fill = np.bincount(part, minlength=n_parts)
    low, high = int(size * (1 - slack)), int(size * (1 + slack)) + 1
    for _ in range(rounds):
        moved = 0
        for v in range(n):
            votes = np.bincount(part[near[v]], minlength=n_parts)
            here, best = part[v], int(votes.argmax())
            if votes[best] > votes[here] and fill[best] < high and fill[here] > low:
                part[v] = best
                fill[best] += 1
                fill[here] -= 1
                moved += 1
        if not moved:
            break
    return part


def train_router(x: np.ndarray, n_parts: int, recall: float = RECALL, k: int = 20, seed: int = 0) -> Router:
    """Fit on a sample; visits come from the sample's own neighbours."""
    rnd = np.random.default_rng(seed)
    x = x.astype(np.float32)
    dim = x.shape[1]
    if n_parts < 2 or len(x) <= 2 * n_parts:
        return Router(np.zeros((dim, 1), np.float32), np.zeros(1, np.float32), np.zeros((1, 1), np.float32), np.zeros(1, np.float32), 1)
    graph = neighbour_graph(x, _NEIGHBOURS)
    part = balanced_parts(graph, n_parts)
    target = np.zeros((len(x), n_parts), np.float32)  # where a vector's neighbours lie, itself among them
    np.add.at(target, (np.arange(len(x))[:, None], part[graph]), 1.0)
    target[np.arange(len(x)), part] += 1
    target /= target.sum(axis=1, keepdims=True)
    u = _unit(x).astype(np.float32)
    p = [rnd.normal(0, (2 / dim) ** 0.5, (dim, _HIDDEN)), np.zeros(_HIDDEN), rnd.normal(0, (2 / _HIDDEN) ** 0.5, (_HIDDEN, n_parts)), np.zeros(n_parts)]
    p = [a.astype(np.float32) for a in p]
    m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(_EPOCHS):
        order = rnd.permutation(len(u))
        for a in range(0, len(u), 128):
            i, t = order[a : a + 128], t + 1
            h = np.maximum(u[i] @ p[0] + p[1], 0)
            z = h @ p[2] + p[3]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            d = (z / z.sum(axis=1, keepdims=True) - target[i]) / len(i)
            dh = (d @ p[2].T) * (h > 0)
            for j, g in enumerate((u[i].T @ dh, dh.sum(axis=0), h.T @ d, d.sum(axis=0))):
                m[j] = 0.9 * m[j] + 0.1 * g
                v[j] = 0.999 * v[j] + 0.001 * g * g
                p[j] -= 0.003 * (m[j] / (1 - 0.9**t)) / (np.sqrt(v[j] / (1 - 0.999**t)) + 1e-8)
    router = Router(*p, visits=n_parts)
    # fewest visits whose parts hold enough of the sample's nearest neighbours
    filed = router.parts(x, 1)[:, 0]
    test = np.arange(0, len(x), max(1, len(x) // 1000))
    nearest = neighbour_graph(x, k)[test]
    visited = np.argsort(np.argsort(-router.logits(x[test]), axis=1, kind="stable"), axis=1)
    rank = visited[np.arange(len(test))[:, None], filed[nearest]]
    router.visits = next((c for c in range(1, n_parts + 1) if (rank < c).mean() >= recall), n_parts)
    return router


# ---------------------------------------------------------------- tables

_FOUND = pa.schema([
    ("query_id", pa.int64()), ("query_key", pa.int64()), ("best", pa.list_(pa.struct([pa.field("minus", pa.float64()), pa.field("vec_id", pa.int64())]))),
])


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, vec`` (doubles) of the vectors that take part."""
    v = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("vec"))
    bad = F.exists("vec", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    v = v.filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0))
    v = v.filter(~F.coalesce(bad, F.lit(True)) & F.exists("vec", lambda c: c != 0))
    sizes = v.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return v.filter(F.size("vec") == (sizes[0]["n"] if sizes else 0))


def _matrix(column) -> np.ndarray:
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    a = pa.concat_arrays(a.chunks) if isinstance(a, pa.ChunkedArray) else a
    return a.flatten().to_numpy(zero_copy_only=False).reshape(len(a), -1)


def _best(queries: np.ndarray, own: np.ndarray, vecs: np.ndarray, ids: np.ndarray, k: int):
    """Per query its best ``k`` of the rows: ``(query, row, score)`` arrays."""
    # scaled to at most one, which changes no order: single precision neither overflows nor goes blind
    scaled = queries / np.abs(queries).max(axis=1, keepdims=True)
    unit = vecs / np.abs(vecs).max()
    q32, v32 = scaled.astype(np.float32), unit.astype(np.float32)
    reach = np.linalg.norm(unit, axis=1).max()
    out = []
    for a in range(0, len(queries), 256):
        s = q32[a : a + 256] @ v32.T
        s[own[a : a + 256, None] == ids[None, :]] = -np.inf
        kth = np.partition(s, -k, axis=1)[:, -k] if s.shape[1] > k else np.full(len(s), -np.inf)
        # rounding of the single-precision sums, generously
        slack = 1e-5 * reach * np.linalg.norm(scaled[a : a + 256], axis=1) + 1e-30
        r, c = np.nonzero((s >= (kth - slack)[:, None]) & (s > -np.inf))
        exact = (queries[a + r] * vecs[c]).sum(axis=1)
        o = np.lexsort((ids[c], -exact, r))
        r, c, exact = r[o], c[o], exact[o]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        out.append((a + r[place < k], c[place < k], exact[place < k]))
    return [np.concatenate(x) for x in zip(*out)]


def nearest(
    vectors: DataFrame, is_query, k: int = 20, sample: int = SAMPLE, part_rows: int = PART_ROWS,
    vec_id: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest found of every row for which ``is_query`` (a column of ``vec_id``)
    holds: ``query_id, rank, vec_id, score``."""
    v = written(usable(vectors, vec_id, embedding), "vectors")
    n = v.count()
    picked = v.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    if not picked:
        return v.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
    n_parts = max(1, min(-(-n // part_rows), sample // 64))
    router = train_router(np.array([r["vec"] for r in picked]), n_parts, k=k)

    def file(batches):
        for batch in batches:
            part = router.parts(_matrix(batch.column("vec")).astype(np.float32), 1)[:, 0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, pa.int32())], names=["vec_id", "vec", "part"])

    filed = written(v.mapInArrow(file, "vec_id long, vec array<double>, part int"), "filed")
    cells = {r["part"]: -(-r["count"] // CELL_ROWS) for r in filed.groupBy("part").count().collect()}  # one row per part
    first = np.concatenate([[0], np.cumsum([cells.get(p, 0) for p in range(n_parts)])])
    n_cells = int(first[-1])
    starts, counts = F.array(*[F.lit(int(x)) for x in first[:-1]]), F.array(*[F.lit(int(cells.get(p, 1))) for p in range(n_parts)])
    part = F.col("part") + 1
    stored = filed.select(
        (F.element_at(starts, part) + F.pmod(F.xxhash64("vec_id"), F.element_at(counts, part))).cast("int").alias("cell"), "vec_id", "vec"
    )

    def visit(batches):
        for batch in batches:
            x = _matrix(batch.column("vec"))
            parts = router.parts(x.astype(np.float32), router.visits)
            row, cell = [], []
            for i, ps in enumerate(parts.tolist()):
                for p in ps:
                    row += [i] * int(first[p + 1] - first[p])
                    cell += range(int(first[p]), int(first[p + 1]))
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell, pa.int32()), *[batch.column(c).take(take) for c in ("vec_id", "key", "vec")]],
                names=["cell", "query_id", "query_key", "query"],
            )

    # a query is one (id, vector); the key tells the vectors of one id apart
    queries = v.filter(is_query(F.col("vec_id"))).distinct().select("vec_id", F.xxhash64("vec").alias("key"), "vec")
    visits = queries.mapInArrow(visit, "cell int, query_id long, query_key long, query array<double>")

    def rank(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            return _FOUND.empty_table()
        ids, own = rows.column("vec_id").to_numpy(), queries.column("query_id").to_numpy()
        q, r, s = _best(_matrix(queries.column("query")), own, _matrix(rows.column("vec")), ids, k)
        # one row per query and cell: the best of the cell, as (-score, id)
        cut = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1], [True]])) if len(q) else np.zeros(1, np.int64)
        pairs = pa.StructArray.from_arrays([pa.array(-s), pa.array(ids[r])], fields=list(_FOUND.field("best").type.value_type))
        best = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pairs, type=_FOUND.field("best").type)
        keys = queries.column("query_key").to_numpy()
        return pa.table([pa.array(own[q[cut[:-1]]]), pa.array(keys[q[cut[:-1]]]), best], schema=_FOUND)

    found = visits.repartition(n_cells, "cell").groupBy("cell").cogroup(stored.repartition(n_cells, "cell").groupBy("cell"))
    found = found.applyInArrow(rank, "query_id long, query_key long, best array<struct<minus: double, vec_id: long>>")
    # a query has at most k candidates for each cell it visits
    best = F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k)
    ranked = found.groupBy("query_id", "query_key").agg(best.alias("best")).select("query_id", F.posexplode("best").alias("place", "b"))
    return ranked.select("query_id", (F.col("place") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.minus")).alias("score"))
