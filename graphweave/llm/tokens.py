"""Token ids of whole texts with a given tokenizer file, a batch of documents at a time.

The vocabulary is a ``tokenizers`` JSON file named by its path; every executor opens it
there. For vocabularies that split at white space and drop it, each run of non-space bytes
is encoded by itself, so a batch encodes each distinct run once and gathers the ids of its
documents with numpy. Any other file is encoded text by text.

Runs are also cut between ASCII letters and signs, where the pattern always splits (an
apostrophe excepted, and where a special token might stand), which leaves fewer distinct
ones. Runs of plain Latin letters, digits and ASCII signs take a short way: lower case, the
file's own split pattern, then the library's BPE model per piece. Every other run (other
scripts, control characters, possible special tokens) goes through ``encode`` whole.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textblocks import Words, concat, give_back, utf8

_CACHE_RUNS = 300_000  # distinct runs a worker remembers; more are encoded again
_BATCH_BYTES = 3 << 18  # working arrays take some 60 bytes for each
_KIND = np.zeros(256, dtype=np.uint8)  # 1: ASCII letter, 2: printable ASCII sign but the apostrophe
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[[b for b in range(33, 127) if not chr(b).isalnum() and b != 39]] = 2


def byte_letters() -> list[str]:
    """The printable letter of each byte in byte-level vocabularies: printable Latin-1
    stands for itself, the other bytes follow in order from U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    letters = {b: chr(b) for b in shown}
    rest = [b for b in range(256) if b not in letters]
    letters.update({b: chr(256 + k) for k, b in enumerate(rest)})
    return [letters[b] for b in range(256)]


class BatchEncoder:
    """Ids of many texts at once, equal to the library's ``encode`` without specials added."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.pattern = self._split_pattern(spec)
        self.letters = byte_letters()
        self._forget()
        self.pieces: dict[str, tuple[int, ...]] = {}
        # cuts assume that special tokens start with "<|", as they do in these files
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        # white space between runs is dropped: runs are independent
        self.by_runs = self.pattern is not None and all(x.startswith("<|") for x in self.special)

    def _forget(self):
        """Ids of the runs met so far, found by the hash of a run."""
        self.known, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.known_at, self.known_size, self.known_ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _learn(self, hashes: np.ndarray, got: list[tuple[int, ...]]):
        size = np.fromiter(map(len, got), np.int64, len(got))
        flat = np.fromiter(chain.from_iterable(got), np.int32, int(size.sum()))
        self.known_at = np.concatenate([self.known_at, len(self.known_ids) + np.cumsum(size) - size])
        self.known_size = np.concatenate([self.known_size, size])
        self.known_ids = np.concatenate([self.known_ids, flat])
        known = np.concatenate([self.known, hashes])
        slot = np.concatenate([self.slot, len(self.slot) + np.arange(len(hashes))])
        order = np.argsort(known, kind="stable")
        self.known, self.slot = known[order], slot[order]

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``known`` and whether the hash stands there."""
        at = np.minimum(np.searchsorted(self.known, hashes), max(0, len(self.known) - 1))
        return at, self.known[at] == hashes if len(self.known) else np.zeros(len(hashes), dtype=bool)

    @staticmethod
    def _split_pattern(spec):
        """The split pattern if the file is of the kind the short way follows."""
        norm = spec.get("normalizer") or {}
        steps = [n.get("type") for n in norm.get("normalizers", [])]
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if steps != ["NFC", "Replace", "Lowercase"] or len(pre) != 2 or spec.get("post_processor"):
            return None
        split, level = pre
        if split.get("type") != "Split" or not split.get("invert") or split.get("behavior") != "Removed":
            return None
        if level.get("type") != "ByteLevel" or level.get("add_prefix_space") or level.get("use_regex"):
            return None
        if "\\s" not in split["pattern"].get("Regex", ""):
            return None
        return regex.compile(split["pattern"]["Regex"])

    def _piece(self, piece: str) -> tuple[int, ...]:
        ids = self.pieces.get(piece)
        if ids is None:
            if len(self.pieces) >= _CACHE_RUNS:
                self.pieces.clear()
            text = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
            ids = self.pieces[piece] = tuple([t.id for t in self.model.tokenize(text)])
        return ids

    def run_ids(self, raw: bytes) -> tuple[int, ...]:
        if raw.isalpha():  # ASCII letters only
            return tuple([t.id for t in self.model.tokenize(raw.decode().lower())])
        text = raw.decode("utf-8")
        if text.isalpha() and max(text) < "ɐ" and "İ" not in text:  # Latin letters: one piece
            return tuple([t.id for t in self.model.tokenize("".join([self.letters[b] for b in text.lower().encode()]))])
        plain = (raw.isascii() and text.isprintable()) or all(
            "!" <= c <= "~" or ("¡" <= c < "ɐ" and c != "İ") for c in text
        )
        if plain and not any(s[:2] in text for s in self.special):
            return tuple(chain.from_iterable(map(self._piece, self.pattern.findall(text.lower()))))
        return tuple(self.tok.encode(text, add_special_tokens=False).ids)

    def encode(self, text: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Yield ``(ids, offsets)`` for stretches of the texts, in order; nulls are empty."""
        buf, offsets = utf8(text)
        lo = 0
        while lo < len(text):
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + _BATCH_BYTES, side="right")) - 1)
            if self.by_runs:
                yield self._gather(buf[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            else:
                texts = [t or "" for t in text.slice(lo, hi - lo).to_pylist()]
                got = [self.tok.encode(t, add_special_tokens=False).ids for t in texts]
                yield concat([np.array(g, np.int32) for g in got], np.int32), np.cumsum([0, *map(len, got)])
            lo = hi

    def _gather(self, buf: np.ndarray, offsets: np.ndarray):
        kind, cuts = _KIND[buf], None
        if not ((buf[:-1] == 60) & (buf[1:] == 124)).any():  # no "<|": no special token is cut
            cuts = np.zeros(len(buf), dtype=bool)
            cuts[1:] = (kind[1:] | kind[:-1]) == 3
        words = Words(buf, offsets, lower=True, cuts=cuts)
        if not len(words.start):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        _, first, inv = np.unique(words.hash, return_index=True, return_inverse=True)
        hashes = words.hash[first]
        new = np.flatnonzero(~self._find(hashes)[1])
        if len(self.known) + len(new) > _CACHE_RUNS:  # begin anew with the runs of this batch
            self._forget()
            new = np.arange(len(hashes))
        data = buf.tobytes()
        starts, ends = words.start[first[new]].tolist(), words.end[first[new]].tolist()
        if len(new):
            self._learn(hashes[new], [self.run_ids(data[s:e]) for s, e in zip(starts, ends)])
        slot = self.slot[self._find(hashes)[0]]
        n = self.known_size[slot][inv]
        end = np.cumsum(n)
        ids = self.known_ids[np.arange(int(end[-1])) + np.repeat(self.known_at[slot][inv] - (end - n), n)]
        return ids, np.concatenate([[0], end])[words.edge]


_ENCODERS: dict[str, BatchEncoder] = {}


def encoder(path: str) -> BatchEncoder:
    """One encoder per worker process and file; its caches serve all tasks of the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = BatchEncoder(path)
    return _ENCODERS[path]


_PIECE = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32())),
])
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>"


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, with_ids: bool = True,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Ids of each document, then ``end_id``, cut into pieces of ``capacity`` tokens; only
    the last may be shorter. One row per piece: ``doc_id, piece, start, length, ids_crc32``
    (of the little-endian 32-bit ids) and ``ids`` (null with ``with_ids=False``). A null
    text is empty: its one piece is the end id. Null ids and repeated rows stay rows."""

    def run(batches):
        enc = encoder(tokenizer)
        give_back()  # what other functions left in this worker
        for batch in batches:
            ids_col, at = batch.column(0).to_pylist(), 0
            for flat, offsets in enc.encode(batch.column(1)):
                out = []
                for k in range(len(offsets) - 1):
                    ids = np.append(flat[offsets[k] : offsets[k + 1]], np.int32(end_id)).astype("<u4")
                    for p, s in enumerate(range(0, len(ids), capacity)):
                        part = ids[s : s + capacity]
                        out.append((ids_col[at + k], p, s, len(part), zlib.crc32(part.tobytes()),
                                    part.astype(np.int32) if with_ids else None))
                at += len(offsets) - 1
                cols = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _PIECE)], schema=_PIECE)
            give_back()

    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return d.mapInArrow(run, PIECE)
