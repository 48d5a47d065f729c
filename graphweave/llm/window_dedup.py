"""Removal of repeated word windows across a corpus by level-wise doubling.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A window is ``window`` consecutive words of one
document; a word goes if some window over it has the same word sequence as a window that
starts earlier (smaller document id, or the same document and an earlier start). All
windows are judged on the input.

Method. The window length is reached in doublings, by default 5 -> 10 -> 20 words. At each
length only windows that still have a chance are asked for: a window is represented by one
of its sub-windows of that length (the smallest by hash, so equal windows always choose the
same one), the corpus is asked which of these occur more than once, and only windows whose
representative repeats are carried to twice the length. At the full length the surviving
windows are compared themselves and the first place of each is found. It ends early when no
candidate survives.

Distribution. Documents live in blocks (``textblocks``); a block sends each distinct value
once, so a value that a third of the corpus shares costs one entry per block. Values meet
in buckets of their hash, answers go back to blocks. The text crosses the network once: all
passes read the same exchange.

The shorter lengths compare 64-bit hashes; a clash there only keeps a candidate alive.
The full length compares 96 bits.

Defined results: null text has no words; a document with fewer words than the window loses
nothing; a null id sorts before all others; rows with equal ids are told apart by their
text and then count as an earlier and a later document; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textblocks import (
    ANSWER_ARROW,
    ASK,
    ASK_ARROW,
    NULL_ID,
    OWN,
    REPLY,
    Block,
    Words,
    alone,
    ask_buckets,
    block_count,
    clipped,
    concat,
    give_back,
    home,
    meet,
    mix,
    notes,
    pack,
    ranges_union,
    rows,
    runs,
    small,
    split_by,
    to_blocks,
    unpack,
    unruns,
    window_minimum,
)

_RESULT = "doc_id long, n_words long, n_removed long, removed_starts array<long>, removed_ends array<long>, kept_text string"
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def level_lengths(window: int, levels: int = 3) -> list[int]:
    """Window lengths from short to full, each at most twice the one before."""
    out = [window]
    while len(out) < levels and out[0] > 1:
        out.insert(0, -(-out[0] // 2))
    return out


def _window_hashes(word: np.ndarray, lengths: list[int], mult=_A) -> np.ndarray:
    """Hash of the ``lengths[-1]`` words from every position, built by doubling."""
    h, have = word, 1
    for goal in lengths:
        while have < goal:
            step = min(have, goal - have)
            h = mix(h[: max(0, len(h) - step)] * mult + h[step:])
            have += step
    return h


def _whole_windows(words: Words, window: int) -> np.ndarray:
    """Start positions of all windows that lie within one document."""
    n = np.maximum(words.n_words - window + 1, 0)
    return np.arange(int(n.sum())) + np.repeat(words.edge[:-1] - (np.cumsum(n) - n), n)


def _id_base(b: Block, words: Words) -> np.ndarray:
    """Per document the word index where the documents of its id begin."""
    if not b.n:
        return words.edge[:-1]
    new = np.concatenate([[True], b.ids[1:] != b.ids[:-1]])
    return words.edge[:-1][np.flatnonzero(new)][np.cumsum(new) - 1]


def _surviving(words: Words, msgs: pa.Table, lengths: list[int], level: int) -> np.ndarray:
    """Candidates of ``level``: those of the level before whose representative repeats."""
    window = lengths[-1]
    own = notes(msgs, OWN)
    starts = unruns(*own[0]) if own else _whole_windows(words, window)
    if not len(starts):
        return starts
    reply = concat([r[0] for r in notes(msgs, REPLY)], np.uint64)
    h = _window_hashes(words.hash, lengths[:level])
    at = window_minimum(h, window - lengths[level - 1] + 1)[starts]
    uniq, back = np.unique(at, return_inverse=True)
    _, inv, cnt = np.unique(h[uniq], return_inverse=True, return_counts=True)
    good = (cnt[inv] > 1) | np.isin(h[uniq], reply)
    return starts[good[back]]


def _ask(level: int, lengths: list[int], n_buckets: int):
    """Pass over blocks at a short length: send each distinct representative once."""

    def run(docs: pa.Table, msgs: pa.Table | None) -> pa.Table:
        out: list[tuple[int, int, bytes]] = []
        if docs.num_rows:
            block_no = docs.column("block")[0].as_py()
            b = Block(docs)
            words = Words(b.buf, b.offsets)
            window = lengths[-1]
            starts = _surviving(words, msgs, lengths, level) if level else _whole_windows(words, window)
            if len(starts):
                h = _window_hashes(words.hash, lengths[: level + 1])
                at = np.unique(window_minimum(h, window - lengths[level] + 1)[starts])
                vals, cnt = np.unique(h[at], return_counts=True)
                bucket = (vals % np.uint64(n_buckets)).astype(np.int64)
                for bk, (v, c) in split_by(bucket, vals, (cnt > 1).astype(np.uint8)):
                    out.append((bk, block_no, pack(v, c)))
            if level:
                out.append((block_no % n_buckets, -1 - block_no, pack(*small(*runs(starts)))))
        return rows(out, ASK_ARROW)

    return run


def _ask_full(lengths: list[int], n_buckets: int):
    """Pass over blocks at the full length: the first place of each distinct surviving
    window goes to a bucket; later places in the block are removed without asking."""
    level, window = len(lengths) - 1, lengths[-1]

    def run(docs: pa.Table, msgs: pa.Table | None) -> pa.Table:
        out: list[tuple[int, int, bytes]] = []
        if docs.num_rows:
            block_no = docs.column("block")[0].as_py()
            b = Block(docs)
            words = Words(b.buf, b.offsets)
            starts = _surviving(words, msgs, lengths, level) if level else _whole_windows(words, window)
            if len(starts):
                h = _window_hashes(words.hash, lengths)[starts]
                h2 = (_window_hashes(words.hash, lengths, _B)[starts] >> np.uint64(32)).astype(np.uint32)
                order = np.lexsort((starts, h2, h))
                a, c = h[order], h2[order]
                new = np.concatenate([[True], (a[1:] != a[:-1]) | (c[1:] != c[:-1])])
                later = np.sort(starts[order[~new]])
                out.append((block_no % n_buckets, -1 - block_no, pack(*small(*runs(later)))))
                first = np.sort(order[new])
                h, h2, at = h[first], h2[first], starts[first]
                doc = np.searchsorted(words.edge, at, side="right") - 1
                pos = at - _id_base(b, words)[doc]
                if level:  # windows around one representative stay together
                    s = _window_hashes(words.hash, lengths[:-1])
                    by = s[window_minimum(s, window - lengths[-2] + 1)[at]]
                else:
                    by = h
                bucket = (by % np.uint64(n_buckets)).astype(np.int64)
                for bk, (x, y, d, p) in split_by(bucket, h, h2, b.ids[doc], pos):
                    out.append((bk, block_no, pack(x, y, *_by_id(d, p))))
        return rows(out, ASK_ARROW)

    return run


def _by_id(ids: np.ndarray, pos: np.ndarray) -> list[np.ndarray]:
    """Places in id order as runs of ids and 32-bit positions."""
    cut = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if len(ids) else np.zeros(0, np.int64)
    return [ids[cut], *small(np.diff(np.append(cut, len(ids))), pos)]


def _first_place(table: pa.Table) -> pa.Table:
    """In a bucket: of each window all places but the first are sent back for removal."""
    out, blk, h, h2, ids, pos = [], [], [], [], [], []
    raws = table.column("payload")
    for i, no in enumerate(table.column("block").to_pylist()):
        raw = raws[i].as_py()
        if no < 0:
            out.append((-1 - no, OWN, raw))
            continue
        x, y, d, n, p = unpack(raw)
        blk.append(np.full(len(x), no, np.int64))
        h.append(x)
        h2.append(y)
        ids.append(np.repeat(d, n))
        pos.append(p.astype(np.int64))
    if h:
        blk, h, h2, ids, pos = map(np.concatenate, (blk, h, h2, ids, pos))
        order = np.lexsort((pos, ids, h2, h))
        a, c = h[order], h2[order]
        again = order[1:][(a[1:] == a[:-1]) & (c[1:] == c[:-1])]
        again = again[np.lexsort((pos[again], ids[again], blk[again]))]
        for no, (d, p) in split_by(blk[again], ids[again], pos[again]):
            out.append((no, REPLY, pack(*_by_id(d, p))))
    return rows(out, ANSWER_ARROW)


_RESULT_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
    ("removed_starts", pa.list_(pa.int64())), ("removed_ends", pa.list_(pa.int64())), ("kept_text", pa.string()),
])


def _cut(window: int, layout: bool):
    """Last pass: drop the covered words of each document of the block."""

    def run(docs: pa.Table, msgs: pa.Table) -> pa.Table:
        give_back()
        carried = [docs.schema.field("row")] if "row" in docs.schema.names else []
        if not docs.num_rows:
            return pa.schema([*_RESULT_ARROW, *carried]).empty_table()
        b = Block(docs)
        words = Words(b.buf, b.offsets, hashes=False)
        starts = [unruns(*x) for x in notes(msgs, OWN)]
        for d, n, p in notes(msgs, REPLY):
            doc = np.searchsorted(b.ids, np.repeat(d, n), side="left")
            starts.append(words.edge[:-1][doc] + p)
        at = np.sort(concat(starts, np.int64))
        s, e = ranges_union(at, at + window)
        out = []
        data = b.buf.tobytes()
        lo = np.searchsorted(e, words.edge[:-1], side="right")
        hi = np.searchsorted(s, words.edge[1:], side="left")  # runs of neighbours may touch: clipped below
        for i in range(b.n):
            w0, w1 = int(words.edge[i]), int(words.edge[i + 1])
            rs, re = clipped(s[lo[i] : hi[i]], e[lo[i] : hi[i]], w0, w1)
            o0, o1 = int(b.offsets[i]), int(b.offsets[i + 1])
            keep_s, keep_e = np.append(w0, re), np.append(rs, w1)
            if layout:
                # text before the first word stays; a removed run takes the space behind it
                ends = [int(words.start[x]) if x < w1 else o1 for x in keep_e]
                begins = [o0, *(int(words.start[x]) if x < w1 else o1 for x in re)]
                kept = b"".join(data[x:y] for x, y in zip(begins, ends))
                if not len(rs) and b.is_null[i]:
                    kept = None
            else:
                kept = b" ".join(
                    b" ".join(data[int(words.start[x]) : int(words.end[y - 1])].split())
                    for x, y in zip(keep_s, keep_e) if y > x
                )
            out.append((
                None if b.ids[i] == NULL_ID else int(b.ids[i]), w1 - w0, int((re - rs).sum()),
                (rs - w0).tolist(), (re - w0).tolist(), None if kept is None else kept.decode("utf-8"),
            ))
        res = rows(out, _RESULT_ARROW)
        return res.append_column(carried[0], docs.column("row").take(pa.array(b.order))) if carried else res

    return run


def remove_repeated_windows(
    docs: DataFrame, window: int = 20, levels: int = 3, doc_id: str = "doc_id", text: str = "text",
    layout: bool = False, carry: bool = False,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed``, the removed word ranges
    (half-open, by word number) and ``kept_text``: the kept words joined by one space, or
    with ``layout`` the text with only the removed words and the space behind them cut (a
    text that loses nothing is as it was, null included). With ``carry`` the other columns
    follow in a struct ``row``."""
    n_blocks = block_count(docs, text)
    lengths = level_lengths(window, levels)
    n_buckets = max(1, n_blocks // 3)
    blocks = to_blocks(docs, n_blocks, doc_id, text, carry)
    result = T._parse_datatype_string(_RESULT)
    if carry:
        result = T.StructType([*result.fields, blocks.schema["row"]])

    msgs = None
    for level in range(len(lengths)):
        last = level == len(lengths) - 1
        step = _ask_full(lengths, n_buckets) if last else _ask(level, lengths, n_buckets)
        if msgs is None:
            asked = blocks.groupBy("block").applyInArrow(alone(step), ASK)
        else:
            asked = blocks.groupBy("block").cogroup(home(msgs, n_blocks)).applyInArrow(step, ASK)
        msgs = ask_buckets(asked, n_buckets, _first_place if last else meet)
    return blocks.groupBy("block").cogroup(home(msgs, n_blocks)).applyInArrow(_cut(window, layout), result)


def repeated_windows_digest(docs: DataFrame) -> DataFrame:
    """The contract columns of the query, from the operator's own output."""
    r = remove_repeated_windows(docs)
    return r.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def cut_documents(docs: DataFrame, window: int = 20, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the repeated windows cut from its texts, columns and layout kept. A
    document that had words and loses them all loses its row; ``n_chars``, where the
    table has it, follows the new text."""
    res = remove_repeated_windows(docs, window, doc_id=doc_id, text=text, layout=True, carry=True)
    res = res.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    out = {text: F.col("kept_text")}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("row.n_chars"))
    return res.select(*[out.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


REPEATED_WINDOWS_SQL = r"""
with worded as (select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as ws from documents),
windows as (
    select doc_id, unnest(range(1, len(ws) - 18)) as pos,
        unnest(list_transform(range(1, len(ws) - 18), lambda i: md5(array_to_string(ws[i:i + 19], ' ')))) as name
    from worded
),
repeated as (select doc_id, pos from windows qualify row_number() over (partition by name order by doc_id, pos) > 1),
covered as (select distinct doc_id, unnest(range(pos, pos + 20)) as pos from repeated),
words as (select doc_id, unnest(range(1, len(ws) + 1)) as pos, unnest(ws) as word from worded),
left_over as (
    select doc_id, count(*) as n, string_agg(word, ' ' order by pos) as kept from words anti join covered using (doc_id, pos)
    group by doc_id
)
select doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from worded left join left_over using (doc_id)
"""
