"""Quality rules: lines labelled content or boilerplate by a linear-chain CRF.

Method. Each line with a word is described by a few yes/no features (length, signs, capitals,
ending, repetition). A linear-chain conditional random field scores label sequences: the
features speak for a line, transitions for its neighbours. Viterbi decoding gives the best
sequence; a document is kept if enough of its words stand in content lines, and if the base
rules on length and repetition hold.

Training. Lines have no labels of their own, so the field learns from document labels:
lines of good documents start as content and lines of bad ones as boilerplate, a first fit
without transitions relabels the lines of bad documents that look like content, and a
second fit with transitions learns from the result. Both fits maximise the likelihood
(forward-backward). They use a bounded sample of labelled documents, ``SAMPLE_DOCUMENTS`` in
the order of a hash of their ids, and whole texts; everything else covers all rows.

Work is vectorised over the documents of a batch: features from the UTF-8 buffer, decoding one
line number at a time for all documents that have it, so a text of many lines costs
itself alone.

Defined results: a null, empty or wordless text has no words and fails the base rules; lines
without words are not labelled; without labelled documents of both kinds every line is
content; null ids and repeated rows are judged like others; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textblocks import Words, mix, utf8

SAMPLE_DOCUMENTS = 4000
CONTENT_SHARE = 0.5
MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 10, 20, 5
_STRETCH = 1 << 20
N_FEATURES = 23
_A = np.uint64(0x9E3779B97F4A7C15)

# The signs that count as symbols, and ends of sentences.
SYMBOLS = b"#*$%&|<>"
SENTENCE_ENDS = b".!?"


def _flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_SYMBOL, _END, _MARK = _flags(SYMBOLS), _flags(SENTENCE_ENDS), _flags(b".,;:")
_UPPER, _DIGIT = _flags(bytes(range(65, 91))), _flags(bytes(range(48, 58)))
_LETTER = _flags(bytes([*range(65, 91), *range(97, 123), *range(0xC3, 0x100)]))
_FIRST = _flags(bytes(b for b in range(256) if not 0x80 <= b < 0xC0))  # first byte of a character


class Lines:
    """Lines and words of the texts of a batch, with the counts that the rules need."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        self.words = w = Words(buf, offsets)
        n_docs = len(offsets) - 1
        breaks = np.flatnonzero(buf == 10)
        starts = np.union1d(offsets[:-1][np.diff(offsets) > 0], breaks + 1)
        starts = starts[starts < len(buf)]
        ends = np.append(starts[1:], len(buf))[: len(starts)]
        ends = ends - (buf[ends - 1] == 10)
        doc = np.searchsorted(offsets, starts, side="right") - 1
        first, last = np.searchsorted(w.start, starts), np.searchsorted(w.start, ends)
        full = last > first
        self.start, self.end, self.doc = starts[full], ends[full], doc[full]
        self.first, self.last = first[full], last[full]
        self.n_words = self.last - self.first
        self.edge = np.searchsorted(self.doc, np.arange(n_docs + 1))
        self.buf, self.offsets, self.n_docs = buf, offsets, n_docs
        self._sums = {}
        self.key = self._line_keys()

    def count(self, flags: np.ndarray, start, end) -> np.ndarray:
        k = id(flags)
        if k not in self._sums:
            sums = np.zeros(len(self.buf) + 1, np.int32 if len(self.buf) < 2**31 else np.int64)
            np.cumsum(flags[self.buf], out=sums[1:])
            self._sums[k] = sums
        return (self._sums[k][end] - self._sums[k][start]).astype(np.int64)

    def _line_keys(self) -> np.ndarray:
        """64-bit hash of each line's bytes, white space included."""
        at, n = self.start, self.end - self.start
        if not len(n):
            return np.zeros(0, np.uint64)
        total = np.cumsum(n) - n
        pos = np.arange(int(n.sum())) - np.repeat(total, n)
        byte = self.buf[np.repeat(at, n) + pos].astype(np.uint64)
        return mix(np.add.reduceat(mix((byte + np.uint64(1)) * _A + pos.astype(np.uint64)), total) + n.astype(np.uint64))

    def copies(self) -> tuple[np.ndarray, np.ndarray]:
        """Per line: does an earlier, does any other line of its document equal it?"""
        order = np.lexsort((np.arange(len(self.doc)), self.key, self.doc))
        same = (self.doc[order][1:] == self.doc[order][:-1]) & (self.key[order][1:] == self.key[order][:-1])
        earlier, other = np.zeros((2, len(order)), dtype=bool)
        earlier[order[1:]] = same
        other[order[1:]] |= same
        other[order[:-1]] |= same
        return earlier, other

    def repeated_words(self, k: int = REPEAT_WINDOW) -> np.ndarray:
        """Per document the words under a ``k``-word window that stands there twice."""
        w = self.words
        h = w.hash
        for step in range(1, k):
            h = mix(h[: max(0, len(w.hash) - step)] * _A + w.hash[step:])
        n = np.maximum(w.n_words - k + 1, 0)
        at = np.arange(int(n.sum())) + np.repeat(w.edge[:-1] - (np.cumsum(n) - n), n)
        doc, val = np.repeat(np.arange(self.n_docs), n), h[at]
        order = np.lexsort((val, doc))
        same = (doc[order][1:] == doc[order][:-1]) & (val[order][1:] == val[order][:-1])
        twice = np.zeros(len(order), dtype=bool)
        twice[1:] |= same
        twice[:-1] |= same
        hit = at[order][twice]
        cover = np.zeros(len(w.start) + 1, np.int64)
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + k, -1)
        sums = np.concatenate([[0], np.cumsum(np.cumsum(cover)[:-1] > 0)])
        return sums[w.edge[1:]] - sums[w.edge[:-1]]

    def features(self) -> np.ndarray:
        """Yes/no features of all lines, one row each."""
        s, e, n = self.start, self.end, np.maximum(self.n_words, 1)
        letters = np.maximum(self.count(_LETTER, s, e), 1)
        symbols, marks = self.count(_SYMBOL, s, e) / n, self.count(_MARK, s, e) / n
        upper, digits = self.count(_UPPER, s, e) / letters, self.count(_DIGIT, s, e) / np.maximum(e - s, 1)
        shouts = self.count(_flags_of("!"), s, e) / n
        tail = self.buf[self.words.end[self.last - 1] - 1] if len(s) else np.zeros(0, np.uint8)
        head = self.buf[self.words.start[self.first]] if len(s) else np.zeros(0, np.uint8)
        size = self.count(_FIRST, s, e) / n
        _, other = self.copies()
        h = self.words.hash
        same = np.concatenate([[0], np.cumsum(np.concatenate([[False], h[1:] == h[:-1]]))]) if len(h) else np.zeros(1, np.int64)
        stutter = (same[self.last] - same[np.minimum(self.first + 1, self.last)]) / n
        cols = [
            np.ones(len(s)), n <= 3, (n > 3) & (n < 10), (n >= 10) & (n < 30), n >= 30,
            symbols == 0, (symbols > 0) & (symbols <= 0.1), (symbols > 0.1) & (symbols <= 0.5), symbols > 0.5,
            shouts > 0.2, upper < 0.1, (upper >= 0.1) & (upper <= 0.5), upper > 0.5, _END[tail], other, digits > 0.2,
            marks == 0, marks > 0.4, self.count(_flags_of("|"), s, e) > 0, size < 3.5, size > 10, _UPPER[head], stutter > 0.2,
        ]
        return np.stack([np.asarray(c, np.float64) for c in cols], axis=1)


_ONE: dict[str, np.ndarray] = {}


def _flags_of(char: str) -> np.ndarray:
    return _ONE.setdefault(char, _flags(char.encode()))


# ---------------------------------------------------------------- the field


class Field:
    """Two labels (0 boilerplate, 1 content): ``weights`` speak for content, ``start`` and
    ``move`` (from, to) for sequences."""

    def __init__(self, weights: np.ndarray, start: np.ndarray, move: np.ndarray):
        self.weights, self.start, self.move = weights, start, move

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.zeros(len(x)), x @ self.weights], axis=1)


def _steps(edge: np.ndarray):
    """Per line number the sequences that have it (longest first) and their lines."""
    n = np.diff(edge)
    order = np.argsort(-n, kind="stable")
    falling = n[order]
    for t in range(int(falling[0]) if len(falling) else 0):
        live = order[: np.searchsorted(-falling, -t, side="left")]
        yield t, live, edge[:-1][live] + t


def viterbi(field: Field, scores: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Best label of each line; equal scores go to content."""
    back = np.zeros((len(scores), 2), np.int8)
    best = np.zeros((len(edge) - 1, 2))
    for t, live, at in _steps(edge):
        if t == 0:
            best[live] = field.start + scores[at]
            continue
        way = best[live][:, :, None] + field.move  # sequence, from, to
        take = (way[:, 1] >= way[:, 0]).astype(np.int8)
        back[at] = take
        best[live] = np.where(take == 1, way[:, 1], way[:, 0]) + scores[at]
    label = np.zeros(len(scores), np.int8)
    n = np.diff(edge)
    now = (best[:, 1] >= best[:, 0]).astype(np.int8)
    for t, live, at in reversed(list(_steps(edge))):
        end = n[live] == t + 1
        label[at[end]] = now[live[end]]
        inner = at[~end]
        label[inner] = back[inner + 1, label[inner + 1]]
    return label


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    m = a.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(a - m).sum(axis=axis, keepdims=True))).squeeze(axis)


def likelihood(field: Field, x: np.ndarray, edge: np.ndarray, label: np.ndarray):
    """Log-likelihood of the labels per line, and its gradient in weights, start, move."""
    scores, n = field.scores(x), len(x)
    steps = list(_steps(edge))
    ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
    for t, live, at in steps:
        ahead[at] = scores[at] + (field.start if t == 0 else _log_sum(ahead[at - 1][:, :, None] + field.move, 1))
    size = np.diff(edge)
    for t, live, at in reversed(steps):
        inner = at[size[live] > t + 1]
        behind[inner] = _log_sum(field.move + (scores[inner + 1] + behind[inner + 1])[:, None, :], 2)
    full = size > 0
    last, first = edge[1:][full] - 1, edge[:-1][full]
    z = np.zeros(len(size))
    z[full] = _log_sum(ahead[last], 1)
    z_line = np.repeat(z, size)
    p = np.exp(ahead + behind - z_line[:, None])
    gold = np.eye(2)[label]
    inner = np.ones(n, dtype=bool)
    inner[last] = False
    a = np.flatnonzero(inner)
    pair = np.exp(ahead[a][:, :, None] + field.move + (scores[a + 1] + behind[a + 1])[:, None, :] - z_line[a][:, None, None])
    value = scores[np.arange(n), label].sum() + field.start[label[first]].sum() + field.move[label[a], label[a + 1]].sum() - z.sum()
    moves = np.zeros((2, 2))
    np.add.at(moves, (label[a], label[a + 1]), 1.0)
    grad = (x.T @ (gold[:, 1] - p[:, 1]), (gold[first] - p[first]).sum(axis=0), moves - pair.sum(axis=0))
    return value / n, [g / n for g in grad]


def fit(x: np.ndarray, edge: np.ndarray, label: np.ndarray, chain: bool, rounds: int = 150, decay: float = 1e-3) -> Field:
    """Maximum likelihood by Adam steps; without ``chain`` transitions stay zero."""
    part = [np.zeros(x.shape[1]), np.zeros(2), np.zeros((2, 2))]
    m, v = [np.zeros_like(p) for p in part], [np.zeros_like(p) for p in part]
    for k in range(1, rounds + 1):
        _, grad = likelihood(Field(*part), x, edge, label)
        for i in range(3 if chain else 1):
            g = grad[i] - decay * part[i]
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            part[i] = part[i] + 0.1 * (m[i] / (1 - 0.9**k)) / (np.sqrt(v[i] / (1 - 0.99**k)) + 1e-8)
    return Field(*part)


def train(x: np.ndarray, edge: np.ndarray, good: np.ndarray) -> Field:
    """The field from the lines (features, ``edge`` per document) of good and bad documents;
    all content if a kind is missing."""
    line_good = np.repeat(good, np.diff(edge))
    if not len(x) or line_good.min() == line_good.max():
        return Field(np.eye(1, N_FEATURES)[0], np.zeros(2), np.zeros((2, 2)))
    # both kinds of documents weigh the same in the first fit
    bad = np.flatnonzero(line_good == 0)
    often = max(1, int(len(x) - len(bad)) // len(bad))
    rows = np.concatenate([np.flatnonzero(line_good == 1), *[bad] * min(often, 50)])
    first = fit(x[rows], np.arange(len(rows) + 1), line_good[rows], chain=False)
    label = np.where((line_good == 0) & (x @ first.weights < 0), 0, 1)
    return fit(x, edge, label, chain=True)


def train_on(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> Field:
    """Fit on at most ``sample`` labelled documents (``quality`` 0 or 1). Tasks turn the sample
    into features; what the driver gathers for the fit is one row of bits per line."""
    picked = labels.filter("quality in (0, 1) and doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")
    )
    picked = F.broadcast(picked.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(picked, "doc_id")
    # an id on many rows gives one of its texts, so the driver gathers no more than ``sample`` texts' lines
    rows = rows.groupBy("doc_id", "quality").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def run(batches):
        for batch in batches:
            for lo, hi in stretches(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                lines = Lines(*utf8(part.column("text")))
                x = lines.features().astype(np.uint8)
                bits = [x[a:b].tobytes() for a, b in zip(lines.edge[:-1], lines.edge[1:])]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("quality"), pa.array(bits, pa.binary())],
                                                 names=["doc_id", "quality", "lines"])

    got = rows.select("doc_id", "quality", "text").mapInArrow(run, "doc_id long, quality int, lines binary").collect()
    got = sorted((r["doc_id"], r["quality"], bytes(r["lines"])) for r in got)
    x = np.frombuffer(b"".join(bits for _, _, bits in got), np.uint8).reshape(-1, N_FEATURES).astype(np.float64)
    edge = np.cumsum([0, *(len(bits) // N_FEATURES for _, _, bits in got)])
    return train(x, edge, np.array([q for _, q, _ in got], np.int64))


_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()),
    ("content_words", pa.int64()), ("content_lines", pa.list_(pa.int32())),
])


def judge(ids: list, text: pa.Array, field: Field, content_share: float) -> pa.RecordBatch:
    buf, offsets = utf8(text)
    lines = Lines(buf, offsets)
    w = lines.words
    label = viterbi(field, field.scores(lines.features()), lines.edge)
    n = w.n_words
    in_words = lines.count(_FIRST, w.start, w.end)
    sums = np.concatenate([[0], np.cumsum(in_words)])
    content = np.bincount(lines.doc, weights=lines.n_words * label, minlength=lines.n_docs).astype(np.int64)
    earlier, _ = lines.copies()
    dup = np.bincount(lines.doc, weights=earlier, minlength=lines.n_docs).astype(np.int64)
    repeat = lines.repeated_words()
    failed = (n < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n)
    kept = ~failed & (content >= content_share * n)
    # numbers of the content lines among all lines of the text, from 0
    line_no = lines.count(_flags_of("\n"), offsets[:-1][lines.doc], lines.start)
    on = label == 1
    edge = np.searchsorted(lines.doc[on], np.arange(lines.n_docs + 1))
    spots = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(line_no[on], pa.int32()))
    cols = [
        pa.array(ids, pa.int64()), n, sums[w.edge[1:]] - sums[w.edge[:-1]],
        lines.count(_SYMBOL, offsets[:-1], offsets[1:]), dup, repeat, failed, kept, content, spots,
    ]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(cols, _RESULT)], schema=_RESULT)


def stretches(text: pa.Array, size: int = _STRETCH):
    """Neighbouring texts of about ``size`` bytes together: ``(from, to)`` pairs."""
    _, offsets = utf8(text)
    lo = 0
    while lo < len(text):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        yield lo, hi
        lo = hi


def label_lines(
    docs: DataFrame, field: Field, content_share: float = CONTENT_SHARE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: counts, ``base_failed``, ``kept``, the words in content lines and
    the numbers of these lines."""

    def run(batches):
        for batch in batches:
            for lo, hi in stretches(batch.column(1)):
                yield judge(batch.column(0).slice(lo, hi - lo).to_pylist(), batch.column(1).slice(lo, hi - lo), field, content_share)

    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return d.mapInArrow(
        run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, content_words long, content_lines array<int>",
    )
