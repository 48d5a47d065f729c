"""Removal of repeated byte strings across a corpus with suffix arrays.

Every text is its UTF-8 bytes; matches never cross documents. Each byte goes that lies in a
string of ``length`` bytes which also starts anywhere else, in the same document or another;
overlaps count, and strings are judged on the input.

Method. Suffix arrays are built by two-stage sorting: only suffixes smaller than their
successors (type B) are sorted directly, the others (type A) follow by one scan over the
buckets of first bytes, which puts the predecessor of each suffix it passes into the next
place of its own bucket. Adjacent common prefixes of at least ``length`` bytes are then
found on the sorted order.

Distribution. One suffix array of a whole corpus would be one task, so the corpus is cut
into many small sorting problems that provably hold all repeats:

1. *Anchors.* In every string of ``length`` bytes the first smallest hash of ``gram`` bytes
   marks the string's anchor; equal strings have it at the same place. Blocks ask which
   anchors occur elsewhere.
2. *Pieces.* The strings of an anchor are split by its place in them into ranges of
   ``RANGE`` places. All strings of a range share a core of bytes, so only pieces with equal
   cores (96 bits) can hold equal strings. Equal pieces are collapsed to one with a count
   before any text moves.
3. *Sorting.* Cores under which different pieces meet send these pieces, once each, to the
   bucket of the core, which sorts the suffixes of what it got. The core itself is known to
   be equal and stands there as one sign, so a piece is twice ``RANGE`` bytes at most and a
   string ``RANGE`` bytes. A core with more than ``HOT`` different pieces (a passage that much
   of the corpus quotes) is not gathered in one task: the strings of its pieces are dealt
   out one by one by a 96-bit hash and compared there, which is exact and splits any group.

Defined results: null and empty texts have no bytes and keep the digest of nothing; texts
shorter than ``length`` lose nothing; rows with equal ids count as different documents; a
null id is a document like any other; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textblocks import (
    ANSWER_ARROW,
    ASK,
    ASK_ARROW,
    NULL_ID,
    OWN,
    REPLY,
    Block,
    alone,
    ask_buckets,
    block_count,
    clipped,
    concat,
    home,
    meet,
    mix,
    notes,
    pack,
    ranges_union,
    rows,
    small,
    split_by,
    to_blocks,
    unpack,
)

RANGE = 38
HOT = 4096
_STEP = 1 << 20
_BASE1, _BASE2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_RESULT = "doc_id long, n_bytes long, n_removed long, span_starts array<long>, span_ends array<long>, kept binary"


# ---------------------------------------------------------------- rolling hashes


class _Rolling:
    """Hash of any range of a stretch of bytes from prefix sums modulo 2^64."""

    _tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, base: int):
        power, inverse = self._power(base, len(data) + 1)
        self.inverse = inverse
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=self.sums[1:])

    @classmethod
    def _power(cls, base: int, n: int):
        have = cls._tables.get(base)
        if have is None or len(have[0]) < n:
            out = []
            for b in (base, pow(base, -1, 1 << 64)):
                p = np.full(max(n, _STEP + 2048), np.uint64(b), dtype=np.uint64)
                p[0] = 1
                out.append(np.cumprod(p, dtype=np.uint64))
            have = cls._tables[base] = tuple(out)
        return have

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        return mix((self.sums[k:] - self.sums[:n]) * self.inverse[:n])


def _slide(values: np.ndarray, w: int, op) -> np.ndarray:
    """``op`` (minimum or maximum) over every ``w`` neighbours, in three passes."""
    n = len(values) - w + 1
    if n <= 0:
        return values[:0]
    padded = np.concatenate([values, np.repeat(values[-1:], -len(values) % w)]).reshape(-1, w)
    ahead = op.accumulate(padded, axis=1).reshape(-1)
    back = op.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return op(back[:n], ahead[w - 1 : w - 1 + n])


def _stretches(offsets: np.ndarray, length: int):
    """Overlapping stretches of a block: each string of ``length`` bytes starts in one."""
    n = int(offsets[-1])
    for c in range(0, n, _STEP):
        e = min(n, c + _STEP + length - 1)
        if e - c >= length:
            yield c, e


def _valid_starts(offsets: np.ndarray, c: int, n_starts: int, length: int) -> np.ndarray:
    """Which starts of the stretch at ``c`` have their whole string in one document."""
    ok = np.zeros(n_starts, dtype=bool)
    i, j = np.searchsorted(offsets, [c, c + n_starts], side="right")
    for s, e in zip(offsets[max(0, i - 1) : j], offsets[max(0, i - 1) + 1 : j + 1]):
        if e - s >= length:
            ok[max(0, s - c) : max(0, e - length + 1 - c)] = True
    return ok


def _anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Yield per stretch ``(start of the stretch, rolling hash, anchor places, values)``."""
    w = length - gram + 1
    for c, e in _stretches(offsets, length):
        roll = _Rolling(data[c:e], _BASE1)
        h = roll.grams(gram) | np.uint64(1)
        n_starts = e - c - length + 1
        low = _slide(h, w, np.minimum)
        low[~_valid_starts(offsets, c, n_starts, length)] = 0
        pad = np.zeros(w - 1, dtype=np.uint64)
        at = np.flatnonzero(_slide(np.concatenate([pad, low, pad]), w, np.maximum) == h)
        yield c, e, roll, at, h[at]


# ---------------------------------------------------------------- suffix array


def type_b(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its successor (the end is smallest)."""
    n = len(text)
    if not n:
        return np.zeros(0, dtype=bool)
    nxt = np.empty(n, np.int16)
    nxt[:-1], nxt[-1] = text[1:], -1
    differs = np.append(np.flatnonzero(text != nxt), n - 1)
    decide = differs[np.searchsorted(differs, np.arange(n))]  # the next place where neighbours differ
    return text[decide] < nxt[decide]


def _keys(text: np.ndarray) -> np.ndarray:
    """Eight bytes from every place as one big-endian number, zero-padded."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(text) + 1, dtype=np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k : k + len(out)]
    return out


def sort_directly(keys: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes at ``at`` in the order of their first ``depth`` bytes, eight at a time
    (``keys``); only groups that are still tied are compared further."""
    order = at.copy()
    if len(at) < 2:
        return order
    end = len(keys) - 1
    key = keys[order]
    o = np.argsort(key, kind="stable")
    order, key = order[o], key[o]
    tied = np.concatenate([[False], key[1:] == key[:-1]])  # equal to the one before
    done = 8
    while done < depth and tied.any():
        part = tied.copy()
        part[:-1] |= tied[1:]
        where = np.flatnonzero(part)
        group = np.cumsum(~tied[where])
        key = keys[np.minimum(order[where] + done, end)]
        o = np.lexsort((key, group))
        order[where] = order[where][o]
        same = key[o][1:] == key[o][:-1]
        t = tied[where]
        t[1:] &= same & (group[o][1:] == group[o][:-1])
        tied[where] = t
        done += 8
    return order


def suffix_array(text: np.ndarray, depth: int, keys: np.ndarray | None = None) -> np.ndarray:
    """Suffixes of ``text`` ordered by at least their first ``depth`` bytes: type B sorted
    directly, type A induced bucket by bucket."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    is_b = type_b(text)
    b_sorted = sort_directly(_keys(text) if keys is None else keys, np.flatnonzero(is_b), depth)
    b_first = text[b_sorted]
    b_cut = np.searchsorted(b_first, np.arange(257))
    queues: list[list[np.ndarray]] = [[] for _ in range(256)]  # type A of each bucket, in order

    def induce(passed: np.ndarray) -> None:
        """Put the type A predecessors of ``passed`` into the next places of their buckets."""
        prev = passed[passed > 0] - 1
        prev = prev[~is_b[prev]]
        for c, (p,) in split_by(text[prev], prev):
            queues[c].append(p)

    out = []
    last = np.array([n - 1])  # the empty suffix comes first; the last byte is its predecessor
    if not is_b[n - 1]:
        queues[text[n - 1]].append(last)
    for here in range(256):
        k = 0
        while k < len(queues[here]):  # grows while runs of one byte unroll
            induce(queues[here][k])
            k += 1
        out += queues[here]
        mine = b_sorted[b_cut[here] : b_cut[here + 1]]
        if len(mine):
            induce(mine)
            out.append(mine)
        queues[here] = []
    return np.concatenate(out)


def adjacent_equal(keys: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Per neighbour pair of ``order``: is the common prefix at least ``length`` bytes? All
    places must have that many bytes left."""
    live = np.arange(len(order) - 1) if len(order) > 1 else np.zeros(0, np.int64)
    for done in range(0, length, 8):
        drop = np.uint64(8 * max(0, done + 8 - length))
        a, b = keys[order[live] + done], keys[order[live + 1] + done]
        live = live[(a >> drop) == (b >> drop)]
    out = np.zeros(max(0, len(order) - 1), dtype=bool)
    out[live] = True
    return out


# ---------------------------------------------------------------- passes over blocks


def _ask_anchors(length: int, gram: int, n_buckets: int):
    def run(docs: pa.Table, _msgs) -> pa.Table:
        out = []
        if docs.num_rows:
            no, b = docs.column("block")[0].as_py(), Block(docs)
            place, value = [], []
            for c, _e, _roll, at, h in _anchors(b.buf, b.offsets, length, gram):
                place.append(at + c)
                value.append(h)
            if place:
                p, first = np.unique(np.concatenate(place), return_index=True)
                vals, cnt = np.unique(np.concatenate(value)[first], return_counts=True)
                for bk, (v, m) in split_by((vals % np.uint64(n_buckets)).astype(np.int64), vals, (cnt > 1).astype(np.uint8)):
                    out.append((bk, no, pack(v, m)))
        return rows(out, ASK_ARROW)

    return run


def _own_strings(p: np.ndarray, value: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Per anchor the first and last start of the strings that are its own: no anchor with a
    smaller value, nor an equal one to the left, lies in them."""
    n = len(p)
    left, right = np.full(n, -1, np.int64), np.full(n, np.iinfo(np.int64).max, np.int64)
    stack: list[int] = []
    places, values = p.tolist(), value.tolist()
    for i in range(n):
        while stack and values[stack[-1]] > values[i]:
            right[stack.pop()] = places[i]
        if stack:
            left[i] = places[stack[-1]]
        stack.append(i)
    return np.maximum(p - w + 1, left + 1), np.minimum(p, right - w)


def _pieces(b: Block, reply: np.ndarray, length: int, gram: int, span: int):
    """Pieces of the anchors that repeat: ``(part, anchor place, start, end)``, by start."""
    place, value = [], []
    for c, _e, _roll, at, h in _anchors(b.buf, b.offsets, length, gram):
        place.append(at + c)
        value.append(h)
    if not place:
        return None
    p, first = np.unique(np.concatenate(place), return_index=True)
    v = np.concatenate(value)[first]
    w = length - gram + 1
    x0, x1 = _own_strings(p, v, w)
    doc = np.searchsorted(b.offsets, p, side="right") - 1
    x0, x1 = np.maximum(x0, b.offsets[doc]), np.minimum(x1, b.offsets[doc + 1] - length)
    _, inv, cnt = np.unique(v, return_inverse=True, return_counts=True)
    good = ((cnt[inv] > 1) | np.isin(v, reply)) & (x0 <= x1)
    p, x0, x1 = p[good], x0[good], x1[good]
    low, high = (p - x1) // span, (p - x0) // span  # parts, by the anchor's place in the string
    n = high - low + 1
    i = np.repeat(np.arange(len(p)), n)
    part = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + low[i]
    s = np.maximum(x0[i], p[i] - (part + 1) * span + 1)
    e = np.minimum(x1[i], p[i] - part * span) + length
    o = np.argsort(s, kind="stable")
    return part[o], p[i][o], s[o], e[o]


def _core(part, p, length, span):
    """Byte range that all strings of a part share; ``span - 1`` bytes shorter than they."""
    s = p - part * span
    return s, s - span + 1 + length


class _Named:
    """Pieces with the 96-bit names of their cores and of themselves, sorted by these."""

    def __init__(self, data: np.ndarray, part, p, s, e, length: int, span: int):
        n = len(p)
        core_s, core_e = _core(part, p, length, span)
        names = [np.zeros(n, np.uint64), np.zeros(n, np.uint32), np.zeros(n, np.uint64), np.zeros(n, np.uint32)]
        for c, (i,) in split_by(s // _STEP, np.arange(n)):
            base = c * _STEP
            stretch = data[base : int(e[i].max())]
            one, two = _Rolling(stretch, _BASE1), _Rolling(stretch, _BASE2)
            salt = part[i].astype(np.uint64) + np.uint64(1)
            cs, ce, ps, pe = core_s[i] - base, core_e[i] - base, s[i] - base, e[i] - base
            names[0][i] = mix(one.of(cs, ce) + salt)
            names[1][i] = (mix(two.of(cs, ce) + salt) >> np.uint64(32)).astype(np.uint32)
            salt = mix(salt * np.uint64(1 << 32) + (p[i] - s[i]).astype(np.uint64))
            names[2][i] = mix(one.of(ps, pe) + salt)
            names[3][i] = (mix(two.of(ps, pe) + salt) >> np.uint64(32)).astype(np.uint32)
        o = np.lexsort(names[::-1])
        self.names = [x[o] for x in names]
        self.p, self.s, self.e = p[o], s[o], e[o]
        self.core_s, self.core_e = core_s[o], core_e[o]
        self.first = _changes(*self.names)


def _changes(*columns: np.ndarray) -> np.ndarray:
    """True where a row of sorted columns differs from the row before."""
    out = np.ones(len(columns[0]), dtype=bool)
    if len(out):
        out[1:] = False
        for c in columns:
            out[1:] |= c[1:] != c[:-1]
    return out


def _ask_pieces(length: int, gram: int, span: int, n_buckets: int):
    """Around anchors that repeat: the distinct pieces of the block by name."""

    def run(docs: pa.Table, msgs: pa.Table) -> pa.Table:
        out = []
        if docs.num_rows:
            no, b = docs.column("block")[0].as_py(), Block(docs)
            got = _pieces(b, concat([r[0] for r in notes(msgs, REPLY)], np.uint64), length, gram, span)
            if got is not None and len(got[0]):
                named = _Named(b.buf, *got, length, span)
                at = np.flatnonzero(named.first)
                many = np.diff(np.append(at, len(named.p))) > 1
                names = [x[at] for x in named.names]
                for k, (*x, m) in split_by((names[0] % np.uint64(n_buckets)).astype(np.int64), *names, many.astype(np.uint8)):
                    out.append((k, no, pack(*x, m)))
                part, p, s, e = got
                out.append((no % n_buckets, -1 - no, pack(part.astype(np.uint16), *small(p - s, s, e - s))))
        return rows(out, ASK_ARROW)

    return run


_ALL, _TEXT, _DEAL = 1, 2, 4  # all strings repeat; send the text; send the strings one by one


def _judge_pieces(hot: int):
    """In a bucket of cores: what is each piece to do?"""

    def run(table: pa.Table) -> pa.Table:
        out, blk, got = [], [], []
        raws = table.column("payload")
        for i, no in enumerate(table.column("block").to_pylist()):
            raw = raws[i].as_py()
            if no < 0:
                out.append((-1 - no, OWN, raw))
                continue
            got.append(unpack(raw))
            blk.append(np.full(len(got[-1][0]), no, np.int64))
        if blk:
            blk, names = np.concatenate(blk), [np.concatenate(x) for x in zip(*got)]
            o = np.lexsort([blk, *names[3::-1]])
            blk, (*names, many) = blk[o], (x[o] for x in names)
            new = _changes(*names)
            piece, core = np.cumsum(new) - 1, np.cumsum(_changes(*names[:2])) - 1
            repeats = (np.bincount(piece) > 1) | (np.bincount(piece, weights=many) > 0)
            kinds = np.bincount(core[new])[core]
            todo = np.where(repeats[piece], _ALL, 0)
            todo = np.where((kinds > 1) & new, todo | np.where(kinds > hot, _DEAL, _TEXT), todo).astype(np.uint8)
            tell = todo > 0
            for no, x in split_by(blk[tell], *(x[tell] for x in names), todo[tell]):
                out.append((no, REPLY, pack(*x)))
        return rows(out, ANSWER_ARROW)

    return run


def _send_pieces(length: int, span: int, n_buckets: int):
    """Send what was asked for, and note what is known to repeat."""

    def run(docs: pa.Table, msgs: pa.Table) -> pa.Table:
        out = []
        own = notes(msgs, OWN)
        if not docs.num_rows or not own:
            return rows(out, ASK_ARROW)
        no, b = docs.column("block")[0].as_py(), Block(docs)
        part, ahead, s, size = (x.astype(np.int64) for x in own[0])
        named = _Named(b.buf, part, s + ahead, s, s + size, length, span)
        todo = np.zeros(len(named.p), np.uint8)
        got = notes(msgs, REPLY)
        if got:
            *names, what = (np.concatenate(z) for z in zip(*got))
            # names of the answers are names of this block: ranks in the union are equal
            both = [np.concatenate([x, y]) for x, y in zip(named.names, names)]
            o = np.lexsort(both[::-1])
            rank = np.empty(len(o), np.int64)
            rank[o] = np.cumsum(_changes(*(x[o] for x in both)))
            at_rank = np.zeros(len(o) + 1, np.uint8)
            at_rank[rank[len(named.p) :]] = what
            todo = at_rank[rank[: len(named.p)]]
        every = (todo & _ALL) > 0
        send = np.flatnonzero(named.first & ((todo & _TEXT) > 0))
        data = b.buf.tobytes()
        bucket = (named.names[0][send] % np.uint64(n_buckets)).astype(np.int64)
        for k, (i,) in split_by(bucket, send):
            s, e, cs, ce = (x[i] for x in (named.s, named.e, named.core_s, named.core_e))
            texts = b"".join(data[x:y] + b"\0" + data[z:u] for x, y, z, u in zip(s, cs, ce, e))
            out.append((k, no, pack(
                np.zeros(1, np.int8), named.names[0][i], named.names[1][i], *small(s, cs - s, e - ce),
                (~every[i]).astype(np.uint8), np.frombuffer(texts, np.uint8),
            )))
        deal = named.first & ((todo & _DEAL) > 0)
        if deal.any():
            out += _deal(no, b.buf, named.p[deal], named.s[deal], named.e[deal], every[deal], length, n_buckets)
        rs, re = ranges_union(named.s[every], named.e[every])
        out.append((no % n_buckets, -1 - no, pack(*small(rs, re - rs))))
        return rows(out, ASK_ARROW)

    return run


def _deal(no, data, p, s, e, every, length, n_buckets):
    """All strings of the pieces of hot cores, dealt out by their own 96-bit hash."""
    n = e - s - length + 1
    which = np.repeat(np.arange(len(p)), n)
    at = np.arange(int(n.sum())) + np.repeat(s - (np.cumsum(n) - n), n)
    h1, h2 = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint32)
    for c, (i,) in split_by(at // _STEP, np.arange(len(at))):
        base = c * _STEP
        stretch = data[base : int(at[i].max()) + length]
        rel = (p[which[i]] - at[i]).astype(np.uint64)
        h1[i] = mix(_Rolling(stretch, _BASE1).of(at[i] - base, at[i] - base + length) + rel)
        h2[i] = (mix(_Rolling(stretch, _BASE2).of(at[i] - base, at[i] - base + length) + rel) >> np.uint64(32)).astype(np.uint32)
    out = []
    for k, (x, y, a, w) in split_by((h1 % np.uint64(n_buckets)).astype(np.int64), h1, h2, at, (~every[which]).astype(np.uint8)):
        out.append((k, no, pack(np.ones(1, np.int8), x, y, *small(a), w)))
    return out


def _sort_pieces(length: int, span: int):
    """In a bucket: the suffix array of the pieces, and the strings that stand twice. In a
    piece the core is one sign, so its strings are ``span`` bytes."""

    def run(table: pa.Table) -> pa.Table:
        out, blk, got, dealt = [], [], [], []
        raws = table.column("payload")
        for i, no in enumerate(table.column("block").to_pylist()):
            raw = raws[i].as_py()
            if no < 0:
                out.append((-1 - no, OWN, raw))
                continue
            kind, *rest = unpack(raw)
            if kind[0]:
                dealt.append((np.full(len(rest[0]), no, np.int64), *rest))
            else:
                blk.append(np.full(len(rest[0]), no, np.int64))
                got.append(rest)
        if blk:
            blk, (core, core2, s, before, after, want, text) = np.concatenate(blk), map(np.concatenate, zip(*got))
            s, before = s.astype(np.int64), before.astype(np.int64)
            size = before + 1 + after
            begin = np.cumsum(size) - size
            keys = _keys(text)
            order = suffix_array(text, span, keys)
            owner = np.repeat(np.arange(len(size)), size)
            inside = order - begin[owner[order]]
            own = owner[order]
            whole = (inside <= before[own]) & (inside + span <= size[own])
            order, inside, own = order[whole], inside[whole], own[whole]
            run_no = np.cumsum(np.concatenate([[0], ~adjacent_equal(keys, order, span)]))
            place = before[own] - inside  # of the core in the string
            _, group = np.unique(core + mix(core2.astype(np.uint64)), return_inverse=True)
            o = np.lexsort((place, group[own], run_no))
            hit = o[_twice(run_no[o], group[own][o], place[o])]
            hit = hit[want[own[hit]] > 0]
            _reply(out, blk[own[hit]], s[own[hit]] + inside[hit], length)
        if dealt:
            b, x, y, a, w = map(np.concatenate, zip(*dealt))
            o = np.lexsort((y, x))
            hit = o[_twice(x[o], y[o])]
            hit = hit[w[hit] > 0]
            _reply(out, b[hit], a[hit].astype(np.int64), length)
        return rows(out, ANSWER_ARROW)

    return run


def _twice(*columns: np.ndarray) -> np.ndarray:
    """True for rows of sorted columns that have an equal neighbour."""
    new = _changes(*columns)
    return ~new | ~np.append(new[1:], True) if len(new) else new


def _reply(out, blk, start, length):
    for no, (a,) in split_by(blk, start):
        rs, re = ranges_union(np.sort(a), np.sort(a) + length)
        out.append((no, REPLY, pack(*small(rs, re - rs))))


_RESULT_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
    ("span_starts", pa.list_(pa.int64())), ("span_ends", pa.list_(pa.int64())), ("kept", pa.binary()),
])


def _cut(docs: pa.Table, msgs: pa.Table) -> pa.Table:
    """Last pass: the maximal removed runs of each document, and the bytes that stay."""
    out = []
    if docs.num_rows:
        b = Block(docs)
        got = [*notes(msgs, OWN), *notes(msgs, REPLY)]
        s = concat([x[0].astype(np.int64) for x in got], np.int64)
        n = concat([x[1].astype(np.int64) for x in got], np.int64)
        s, e = ranges_union(s, s + n)
        data = b.buf.tobytes()
        lo = np.searchsorted(e, b.offsets[:-1], side="right")
        hi = np.searchsorted(s, b.offsets[1:], side="left")  # runs of neighbours may touch: clipped
        for i in range(b.n):
            o0, o1 = int(b.offsets[i]), int(b.offsets[i + 1])
            rs, re = clipped(s[lo[i] : hi[i]], e[lo[i] : hi[i]], o0, o1)
            kept = b"".join(data[x:y] for x, y in zip([o0, *re.tolist()], [*rs.tolist(), o1]))
            out.append((
                None if b.ids[i] == NULL_ID else int(b.ids[i]), o1 - o0, int((re - rs).sum()),
                (rs - o0).tolist(), (re - o0).tolist(), kept,
            ))
    return rows(out, _RESULT_ARROW)


def remove_repeated_bytes(
    docs: DataFrame, length: int = 400, doc_id: str = "doc_id", text: str = "text", hot: int = HOT
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed``, the maximal removed runs
    (half-open byte ranges) and the bytes ``kept``."""
    gram, span = max(1, length // 4), min(RANGE, max(1, length // 3))
    n_blocks = block_count(docs, text)
    n_buckets = max(1, n_blocks // 3)
    blocks = to_blocks(docs, n_blocks, doc_id, text, by_text=True)

    def again(msgs, step):
        return blocks.groupBy("block").cogroup(home(msgs, n_blocks)).applyInArrow(step, ASK)

    msgs = ask_buckets(blocks.groupBy("block").applyInArrow(alone(_ask_anchors(length, gram, n_buckets)), ASK), n_buckets, meet)
    msgs = ask_buckets(again(msgs, _ask_pieces(length, gram, span, n_buckets)), n_buckets, _judge_pieces(hot))
    msgs = ask_buckets(again(msgs, _send_pieces(length, span, n_buckets)), n_buckets, _sort_pieces(length, span))
    return blocks.groupBy("block").cogroup(home(msgs, n_blocks)).applyInArrow(_cut, _RESULT)


def repeated_bytes_digest(docs: DataFrame) -> DataFrame:
    """The contract columns of the query, from the operator's own output."""
    r = remove_repeated_bytes(docs)
    return r.select(
        "doc_id", "n_bytes", "n_removed", F.size("span_starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
