"""Split document text into numbered, overlapping chunks.

``fixed`` is pure SQL: chunk ``i`` is characters ``[i*step, i*step + size)`` with
``step = size - overlap`` and ``max(1, ceil((len - overlap) / step))`` chunks for a
non-empty text, so consecutive chunks share exactly ``overlap`` characters and every
chunk has at most ``size`` characters. Empty text gives no chunk rows. The work is
linear in the text length (see ``chunk``).

``recursive`` prefers paragraph, then line, then word, then character breaks. A text is cut
before every paragraph break; pieces longer than ``size`` are cut again before every line break,
then before every space, then into characters. Pieces that were cut out of the same longer piece
are packed greedily: a chunk takes pieces as long as it stays within ``size``; the next one starts
with the trailing pieces that fit in ``overlap`` (and leave room for the piece to come). Breaks stay
at the front of the piece they precede, so no character is lost. This is SQL too: nested ``split``
and one fold over the pieces, linear in the text length.

Null and empty texts give no chunks in either mode; a text is one row and is never cut to a prefix.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphweave.functions import folds
from graphweave.functions.once import once
from graphweave.functions.text import chunk_name as _chunk_name
from graphweave.functions.truth import let

DEFAULT_SIZE = 1500
DEFAULT_OVERLAP = 500


def _check(size: int, overlap: int) -> None:
    if size <= 0 or overlap < 0 or overlap >= size:
        raise ValueError(f"need 0 <= overlap < size, got size={size} overlap={overlap}")


def chunk(
    documents: DataFrame,
    size: int = DEFAULT_SIZE,
    overlap: int = DEFAULT_OVERLAP,
    mode: str = "fixed",
    text_col: str = "text",
    name_col: str = "document_name",
) -> DataFrame:
    """One row per chunk: the input columns, ``text`` replaced by the chunk text,
    plus ``chunk_number`` (0-based INT) and ``chunk_name``."""
    _check(size, overlap)
    if mode == "recursive":
        return _numbered(documents, _recursive(F.col(text_col), size, overlap), text_col, name_col)
    if mode != "fixed":
        raise ValueError(f"unknown chunking mode {mode!r}")
    n_chunks, texts = _fixed(size, overlap, text_col)
    staged = documents.withColumn("__n", n_chunks).where(F.col("__n") > 0)
    return _numbered(staged, texts, text_col, name_col).drop("__n")


@once
def _fixed(size: int, overlap: int, text_col: str) -> tuple[Column, Column]:
    """The number ``__n`` of chunks of a text and, over it, the chunks themselves."""
    step = size - overlap
    n = F.char_length(F.col(text_col))
    # integer ceil division on positive numbers; lengths below ``overlap`` give 1 chunk
    n_chunks = F.when(n <= 0, F.lit(0)).otherwise(
        F.greatest(F.lit(1), F.floor((n - F.lit(overlap) + F.lit(step - 1)) / F.lit(step)).cast("int"))
    )
    # Linear in the text length: one regex pass cuts the text into blocks of ``step``
    # characters; chunk i is the first ``size`` characters from block i on. (``substring`` by
    # character position rescans the text from its start for every chunk, which is
    # quadratic for long texts.)
    blocks = F.regexp_extract_all(F.col(text_col), F.lit(f"(?s).{{1,{step}}}"), 0)
    per_chunk = -(-size // step)
    # The block array is bound with ``let``: a plain column referenced inside the
    # lambda would be inlined by the optimizer and re-split for every chunk.
    texts = let(
        blocks,
        lambda b: F.transform(
            F.sequence(F.lit(0), F.col("__n") - 1),
            lambda i: F.substring(F.array_join(F.slice(b, i + 1, F.lit(per_chunk)), ""), 1, size),
        ),
    )
    return n_chunks, texts


def _numbered(documents: DataFrame, texts: Column, text_col: str, name_col: str) -> DataFrame:
    """One row per element of ``texts``, numbered and named."""
    others = [c for c in documents.columns if c != text_col]
    # posexplode_outer: a plain posexplode lets Spark push an inferred size filter
    # below this projection and build the chunk array twice
    return (
        documents.select(*others, F.posexplode_outer(texts).alias("chunk_number", "__chunk"))
        .where(F.col("__chunk").isNotNull())
        .select(
            *others,
            F.col("chunk_number").cast("int").alias("chunk_number"),
            _chunk_name(F.col(name_col), F.col("chunk_number")).alias("chunk_name"),
            F.col("__chunk").alias(text_col),
        )
    )


# ---------------------------------------------------------------------------
# recursive splitter
# ---------------------------------------------------------------------------


def _cut(text: Column, separator: str) -> Column:
    """``text`` cut before every ``separator``; empty pieces are left out."""
    parts = F.transform(
        F.split(text, separator, -1), lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.lit(separator), p))
    )
    return F.filter(parts, lambda p: p != "")


def _leaves(text: Column, size: int, overlap: int) -> Column:
    """Pieces of at most ``size`` characters in text order: ``(p, len, cut)``. ``cut`` names the
    longer piece that ``p`` was cut out of: the positions of its paragraph, line and word."""

    def leaf(p: Column, *where) -> Column:
        where = [F.lit(0) if w is None else w + 1 for w in where]
        cut = F.struct(*[w.alias(f"c{n}") for n, w in enumerate(where)])
        return F.struct(p.alias("p"), F.char_length(p).alias("len"), cut.alias("cut"))

    def level(pieces: Column, where: tuple, deeper) -> Column:
        padded = where + (None,) * (3 - len(where))
        return F.flatten(F.transform(
            pieces,
            lambda p, i: F.when(F.char_length(p) <= size, F.array(leaf(p, *padded))).otherwise(deeper(p, where + (i,))),
        ))

    # Character breaks: chunk starts and ends all lie on multiples of this block.
    block = gcd(size, overlap)

    def characters(word: Column, where: tuple) -> Column:
        cut = F.regexp_extract_all(word, F.lit(f"(?s).{{1,{block}}}"), 0)
        return F.transform(cut, lambda c: leaf(c, *where))

    def words(line: Column, where: tuple) -> Column:
        return level(_cut(line, " "), where, characters)

    def lines(paragraph: Column, where: tuple) -> Column:
        return level(_cut(paragraph, "\n"), where, words)

    return level(_cut(text, "\n\n"), (), lines)


def _recursive(text: Column, size: int, overlap: int) -> Column:
    """The array of chunk texts."""

    def pack(leaves: Column) -> Column:
        def tail(at: Column, start: Column, room: Column) -> Column:
            """Trailing pieces of the open chunk that fit in ``room`` characters."""
            most = F.least(at - start, F.lit(overlap))  # a piece has a character at least
            newest_first = F.reverse(F.slice(leaves, at - most + 1, most))
            zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("len"), F.lit(True).alias("open"))
            return F.aggregate(newest_first, zero, lambda t, x: F.when(
                t["open"] & (t["len"] + x["len"] <= room),
                F.struct((t["n"] + 1).alias("n"), (t["len"] + x["len"]).alias("len"), F.lit(True).alias("open")),
            ).otherwise(F.struct(t["n"].alias("n"), t["len"].alias("len"), F.lit(False).alias("open"))))

        def chunk_of(at: Column, start: Column) -> Column:
            return F.struct(start.alias("s"), (at - start).alias("n"))

        def step(state, x: Column):
            at, start, length, cut = state
            kept = tail(at, start, F.least(F.lit(overlap), F.lit(size) - x["len"]))
            joined = cut == x["cut"]
            return [
                (at == 0, [at + 1, F.lit(0), x["len"], x["cut"]], None),
                (joined & (length + x["len"] <= size), [at + 1, start, length + x["len"], cut], None),
                (joined, [at + 1, at - kept["n"], kept["len"] + x["len"], cut], chunk_of(at, start)),
                (None, [at + 1, at, x["len"], x["cut"]], chunk_of(at, start)),
            ]

        no_cut = F.struct(*[F.lit(0).alias(f"c{n}") for n in range(3)])
        chunks = folds.collect(
            leaves, "struct<s:int,n:int>", [F.lit(0), F.lit(0), F.lit(0), no_cut], step,
            lambda state: F.filter(F.array(chunk_of(state[0], state[1])), lambda c: c["n"] > 0),
        )
        return F.transform(
            chunks, lambda c: F.array_join(F.transform(F.slice(leaves, c["s"] + 1, c["n"]), lambda x: x["p"]), "")
        )

    return let(_leaves(text, size, overlap), pack)
