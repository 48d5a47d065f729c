"""Best-fit packing of pieces into sequences of fixed capacity, with large-item matching.

Pieces above a third of the capacity can stand at most twice in a sequence: they are paired
greedily, the longest first, each with the longest partner that still fits (which is
optimal among themselves). Smaller pieces follow by falling length into the smallest gap
that holds them, and open a sequence only when no gap does.

The choice depends on lengths alone, and there are at most ``capacity`` lengths. So the plan
is made on the histogram of lengths: whole groups of equal sequences are filled in one step,
and the driver sees ``capacity`` counts, whatever the size of the corpus. Each piece then
finds its place from its rank among pieces of its length. Ranks are counted in buckets of
(length, hash of the document), so a length that a third of the pieces share is spread out.

Defined results: an empty table gives no sequences; pieces with null ids and repeated rows
are packed like any other; pieces of null or non-positive length, or longer than the
capacity, are an error in the input and raise.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tokens import token_pieces
from .written import written

BUCKET_ROWS = 4096


class _Gaps:
    """Groups of equal sequences ``(first sequence, count)`` by the room they have left."""

    def __init__(self):
        self.sizes: list[int] = []
        self.groups: dict[int, list[tuple[int, int]]] = {}

    def add(self, gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in self.groups:
                bisect.insort(self.sizes, gap)
                self.groups[gap] = []
            self.groups[gap].append((first, count))

    def smallest(self, need: int) -> tuple[int, int, int] | None:
        k = bisect.bisect_left(self.sizes, need)
        if k == len(self.sizes):
            return None
        gap = self.sizes[k]
        first, count = self.groups[gap].pop()
        if not self.groups[gap]:
            del self.groups[gap], self.sizes[k]
        return gap, first, count


def plan(counts: dict[int, int], capacity: int) -> tuple[dict[int, list[tuple[int, int, int, int]]], int]:
    """Places for all pieces: per length runs ``(first rank, pieces per sequence, first
    sequence, offset)``, and the number of sequences."""
    left = dict(counts)
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    gaps, n_seq = _Gaps(), 0

    def place(length, pieces, per, first, offset):
        runs.setdefault(length, []).append((used.get(length, 0), per, first, offset))
        used[length] = used.get(length, 0) + pieces
        left[length] -= pieces

    large = sorted((x for x in left if 3 * x > capacity), reverse=True)
    rising = large[::-1]
    for a in large:
        while left[a]:
            k = bisect.bisect_right(rising, min(a, capacity - a)) - 1
            while k >= 0 and (not left[rising[k]] or (rising[k] == a and left[a] < 2)):
                if not left[rising[k]]:
                    rising.pop(k)
                k -= 1
            if k < 0:
                n = left[a]
                place(a, n, 1, n_seq, 0)
                gaps.add(capacity - a, n_seq, n)
            elif rising[k] == a:
                n = left[a] // 2
                place(a, 2 * n, 2, n_seq, 0)
                gaps.add(capacity - 2 * a, n_seq, n)
            else:
                b = rising[k]
                n = min(left[a], left[b])
                place(a, n, 1, n_seq, 0)
                place(b, n, 1, n_seq, a)
                gaps.add(capacity - a - b, n_seq, n)
            n_seq += n
    for s in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while left[s]:
            found = gaps.smallest(s)
            gap, first, count = found or (capacity, n_seq, -(-left[s] // (capacity // s)))
            if not found:
                n_seq += count
            per = gap // s
            n = min(count, left[s] // per)
            if n:
                place(s, n * per, per, first, capacity - gap)
                gaps.add(gap - per * s, first, n)
                first, count = first + n, count - n
            if count and left[s] and left[s] < per:  # the last ones share one sequence
                rest = left[s]
                place(s, rest, rest, first, capacity - gap)
                gaps.add(gap - rest * s, first, 1)
                first, count = first + 1, count - 1
            gaps.add(gap, first, count)
    return runs, n_seq


def pack_pieces(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """``pieces`` (any columns, with ``doc_id, piece, length``) with ``sequence_id`` and
    ``offset`` (gapless from 0 in each sequence). ``pieces`` is read three times: pass a
    table that is written, not a plan that tokenizes."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad = [x for x in counts if x is None or not 0 < x <= capacity]
    if bad:
        raise ValueError(f"pieces of length {bad[:5]} cannot stand in sequences of {capacity} tokens")
    runs, _ = plan(counts, capacity)
    table = {length: tuple(np.array(c, np.int64) for c in zip(*r)) for length, r in runs.items()}

    n_buckets = max(1, -(-sum(counts.values()) // BUCKET_ROWS))
    tie = [c for c in ("doc_id", "piece", "ids_crc32") if c in pieces.columns]
    # pieces without id, or of one id, are spread by their content
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*tie), F.lit(n_buckets)))
    per = dealt.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = per.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy(*tie))
    ranked = dealt.withColumn("_within", within).join(base, ["length", "_bucket"])
    ranked = ranked.select(*pieces.columns, (F.col("_base") + F.col("_within") - 1).alias("_rank"))

    def run(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        length, rank = lengths.to_numpy(zero_copy_only=False), ranks.to_numpy(zero_copy_only=False)
        place = np.zeros(len(length), np.int64)
        for x in np.unique(length):
            i = np.flatnonzero(length == x)
            first_rank, per_seq, first_seq, offset = table[int(x)]
            k = np.searchsorted(first_rank, rank[i], side="right") - 1
            r = rank[i] - first_rank[k]
            place[i] = (first_seq[k] + r // per_seq[k]) * capacity + offset[k] + r % per_seq[k] * x
        return pa.array(place)

    # only lengths and ranks go to Python; token ids and other columns stay where they are
    place = F.arrow_udf(run, "long")(F.col("length"), F.col("_rank"))
    return ranked.withColumn("_place", place).select(
        *pieces.columns, F.floor(F.col("_place") / capacity).alias("sequence_id"), (F.col("_place") % capacity).alias("offset")
    )


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, with_ids: bool = True,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Tokenize, cut and pack ``docs``: one row per piece with its ids and its place. The
    pieces are written once to the shared scratch folder; tokenizing is never repeated."""
    pieces = token_pieces(docs, tokenizer, capacity, end_id, with_ids, doc_id, text)
    return pack_pieces(written(pieces if with_ids else pieces.drop("ids"), "pieces"), capacity)
