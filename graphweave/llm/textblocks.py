"""Blocks of documents and vectorised word hashing shared by the corpus operators.

A *block* is a group of whole documents. Documents are dealt to blocks by a hash of their id,
with ``by_text`` of their id and text, so that rows without id and different texts under one id
are spread too (only rows equal in both stay together). A hot source, a group of copies or a very
long neighbour never decides the size of a task, and the number of blocks follows the
bytes of the input.
Inside a block numpy works on the UTF-8 buffer that Arrow hands over; across blocks only
fixed-width hashes travel, packed into one binary value per (block, bucket).
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NULL_ID = np.iinfo(np.int64).min  # a null id sorts first and stands for itself
BLOCK_BYTES = 4 << 20

# Messages: blocks ask buckets, buckets answer blocks. A negative block number (-1 - block)
# marks a block's note to its own next pass, which the bucket only hands on.
ASK = "bucket int, block int, payload binary"
ANSWER = "block int, kind int, payload binary"
OWN, REPLY = 0, 1

_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def give_back() -> None:
    """Return freed memory to the system: Arrow's pool and the C heap keep it otherwise, and a
    worker lives on with the most that any of its tasks needed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * _MIX1
    h ^= h >> np.uint64(29)
    h *= _MIX2
    h ^= h >> np.uint64(32)
    return h


def block_count(docs: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES) -> int:
    """Number of blocks for a table: one aggregate over its text lengths."""
    row = docs.agg(F.sum(F.octet_length(F.col(text)).cast("long")).alias("b"), F.count(F.lit(1)).alias("n")).first()
    return int(max(1, -(-int(row["b"] or 0) // block_bytes), -(-int(row["n"]) // 200_000)))


def to_blocks(
    docs: DataFrame, n_blocks: int, doc_id: str = "doc_id", text: str = "text", carry: bool = False,
    by_text: bool = False,
) -> DataFrame:
    """``(block int, doc_id long, text string)``, each block within one partition.

    Only the two wanted columns travel, with ``carry`` also the others in one struct
    ``row``. The result is the one exchange of the texts: every later pass of an operator
    that groups by ``block`` reuses it."""
    d = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
        *([F.struct(*[F.col(c) for c in docs.columns if c != text]).alias("row")] if carry else []),
    )
    d = d.withColumn("block", F.pmod(F.xxhash64("doc_id", *(["text"] if by_text else [])), F.lit(n_blocks)).cast("int"))
    return d.select("block", *[c for c in d.columns if c != "block"]).repartition(n_blocks, "block")


class Block:
    """The documents of one block in (id, text) order, as flat arrays."""

    def __init__(self, table: pa.Table):
        ids = table.column("doc_id").combine_chunks()
        text = table.column("text").combine_chunks()
        if isinstance(ids, pa.ChunkedArray):
            ids = pa.concat_arrays(ids.chunks) if ids.num_chunks else pa.array([], pa.int64())
        if isinstance(text, pa.ChunkedArray):
            text = pa.concat_arrays(text.chunks) if text.num_chunks else pa.array([], pa.string())
        key = np.asarray(ids.fill_null(int(NULL_ID)), dtype=np.int64)
        order = np.argsort(key, kind="stable")
        if len(order) > 1 and (key[order][1:] == key[order][:-1]).any():  # repeated ids: the texts decide
            order = np.array(sorted(range(len(key)), key=lambda i: (key[i], text[i].as_py() or "")), dtype=np.int64)
        text = text.take(pa.array(order))
        self.ids = key[order]
        self.is_null = np.asarray(text.is_null())
        self.buf, self.offsets = utf8(text)
        self.n = len(self.ids)
        self.order = order

    def id_array(self) -> pa.Array:
        return id_array(self.ids)


def id_array(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NULL_ID)


def utf8(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end and the n + 1 offsets; nulls are empty."""
    if text.null_count:
        text = text.fill_null("")
    size = 8 if pa.types.is_large_string(text.type) else 4
    if not len(text):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bufs = text.buffers()
    off = np.frombuffer(bufs[1], np.int64 if size == 8 else np.int32)[text.offset : text.offset + len(text) + 1]
    off = off.astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a block: byte ranges, owner document, 64-bit hash."""

    def __init__(
        self, buf: np.ndarray, offsets: np.ndarray, lower: bool = False, hashes: bool = True, cuts: np.ndarray | None = None,
        space: np.ndarray = _SPACE,
    ):
        """``cuts`` marks bytes at which a word is to end and the next to start; ``space`` the
        byte values between words."""
        n = len(buf)
        inside = ~space[buf]
        first = np.zeros(n + 1, dtype=bool)
        first[offsets] = True
        if cuts is not None:
            first[:n] |= cuts
        start = inside.copy()
        start[1:] &= ~inside[:-1] | first[1:n]
        stop = inside.copy()
        stop[:-1] &= ~inside[1:] | first[1:n]
        self.start = np.flatnonzero(start)
        self.end = np.flatnonzero(stop) + 1
        edge = np.searchsorted(self.start, offsets)
        self.edge = edge  # words of document i are edge[i]:edge[i + 1]
        self.n_words = np.diff(edge)
        self.hash = _word_hashes(buf, self.start, self.end, lower) if hashes else None

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.n_words)), self.n_words)


def _word_hashes(buf, start, end, lower):
    out = np.empty(len(start), dtype=np.uint64)
    step = 1 << 18  # words at a time: bounds the wide temporaries
    for a in range(0, len(start), step):
        s, e = start[a : a + step], end[a : a + step]
        lens = e - s
        total = int(lens.sum())
        at = np.cumsum(lens) - lens
        pos = np.arange(total) - np.repeat(at, lens)
        byte = buf[np.repeat(s, lens) + pos]
        if lower:
            byte = _LOWER[byte]
        power = _powers(int(lens.max()))
        h = np.add.reduceat((byte.astype(np.uint64) + np.uint64(1)) * power[pos], at)
        out[a : a + step] = mix(h + lens.astype(np.uint64) * _MIX1)
    return out


_POWERS = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n, 64) - 1, _BASE)]).astype(np.uint64))
    return _POWERS


def window_minimum(h: np.ndarray, w: int) -> np.ndarray:
    """Position of the leftmost smallest value of every window ``h[i : i + w]``.

    Equal windows pick the same relative position, whatever surrounds them, so a string
    that repeats is met again at the place this picks. Doubling: the best of 2k values
    is the better of two overlapping k."""
    n = len(h) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    at = np.arange(len(h))
    have = 1
    while have < w:
        step = min(have, w - have)
        a, b = at[: len(at) - step], at[step:]
        at = np.where(h[b] < h[a], b, a)
        have += step
    return at


def split_by(bucket: np.ndarray, *arrays: np.ndarray):
    """Yield ``(bucket, arrays of that bucket)``, each array in its given order."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    cuts = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
    ends = np.append(cuts[1:], len(b))
    moved = [a[order] for a in arrays]
    for c, e in zip(cuts, ends):
        yield int(b[c]), [m[c:e] for m in moved]


def ranges_union(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by half-open ranges (ranges that touch are joined)."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    s, e = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], s[1:] > e[:-1]])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(s) - 1)
    return s[new], e[last]


def clipped(start: np.ndarray, end: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """The parts of sorted ranges that lie in ``[lo, hi)``."""
    s, e = np.clip(start, lo, hi), np.clip(end, lo, hi)
    return s[s < e], e[s < e]


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one value. The bytes of each array are stored plane by plane, so the
    high bytes of sorted or small numbers lie together and shuffle compression works."""
    out = [np.array([len(arrays)], np.int32).tobytes()]
    for a in arrays:
        a = np.ascontiguousarray(a)
        out.append(a.dtype.str[1:].encode().ljust(4) + np.array([len(a)], np.int64).tobytes())
        out.append(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() if len(a) else b"")
    return b"".join(out)


def unpack(raw: bytes) -> list[np.ndarray]:
    at, out = 4, []
    for _ in range(int(np.frombuffer(raw, np.int32, 1)[0])):
        kind = np.dtype(raw[at : at + 4].decode().strip())
        n = int(np.frombuffer(raw, np.int64, 1, at + 4)[0])
        at += 12
        size = n * kind.itemsize
        planes = np.frombuffer(raw, np.uint8, size, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += size
    return out


def concat(parts: list[np.ndarray], dtype) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def runs(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted positions as (first, count) runs."""
    if not len(at):
        return at, at
    cut = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1] + 1]))
    return at[cut], np.diff(np.append(cut, len(at)))


def unruns(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    first, count = first.astype(np.int64), count.astype(np.int64)
    return np.arange(int(count.sum())) + np.repeat(first - (np.cumsum(count) - count), count)


def rows(rows, schema: pa.Schema) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.table([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


ASK_ARROW = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("payload", pa.binary())])
ANSWER_ARROW = pa.schema([("block", pa.int32()), ("kind", pa.int32()), ("payload", pa.binary())])


def notes(msgs: pa.Table, kind: int) -> list[list[np.ndarray]]:
    kinds, raws = msgs.column("kind").to_pylist(), msgs.column("payload")
    return [unpack(raws[i].as_py()) for i, k in enumerate(kinds) if k == kind]


def small(*arrays):
    """Counts and block positions in 32 bits where they fit."""
    return [a.astype(np.int32) if not len(a) or a.max() < 2**31 else a for a in arrays]


def meet(table: pa.Table) -> pa.Table:
    """In a bucket: each block hears which of its values others hold too."""
    out, blocks, vals, many = [], [], [], []
    raws = table.column("payload")
    for i, blk in enumerate(table.column("block").to_pylist()):
        raw = raws[i].as_py()
        if blk < 0:  # a note on its way to the next pass
            out.append((-1 - blk, OWN, raw))
            continue
        v, c = unpack(raw)
        blocks.append(np.full(len(v), blk, np.int64))
        vals.append(v)
        many.append(c)
    if vals:
        v, blk = np.concatenate(vals), np.concatenate(blocks)
        _, inv, n = np.unique(v, return_inverse=True, return_counts=True)
        others = n[inv] > 1  # a block sends a value once, so another row is another block
        for b, (x,) in split_by(blk[others], v[others]):
            out.append((b, REPLY, pack(x)))
    return rows(out, ANSWER_ARROW)


def ask_buckets(asked: DataFrame, n_buckets: int, answer) -> DataFrame:
    """Deal the questions of the blocks to buckets and let ``answer`` work on each."""
    return asked.repartition(n_buckets, "bucket").groupBy("bucket").applyInArrow(answer, ANSWER)


def home(answers: DataFrame, n_blocks: int):
    """The answers, grouped like the blocks that asked."""
    return answers.repartition(n_blocks, "block").groupBy("block")


def alone(step):
    """A pass that has no answers to read yet."""

    def run(table: pa.Table) -> pa.Table:
        return step(table, None)

    return run
