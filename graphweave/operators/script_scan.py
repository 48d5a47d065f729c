"""Statements of any load script, cut only at semicolons outside quotes and comments.

Spark cuts the files at every ``;`` into pieces. Whether such a cut ends a statement depends
on everything before it in the file: a piece may begin inside a quoted text or a comment. So each
piece is read as a function from the state it begins in to the state it ends in (six letters, one
per state), functions are composed level by level (pieces to tiles, tiles to splits of the file, splits to
spans, spans to the file), and an exclusive prefix scan of the composed functions gives every tile its
state. Only then is the text walked once with known states.

States: ``.`` outside, the three quotes, ``L`` in a line comment, ``C`` in a block comment. A
backslash escapes the next character inside ``'`` and ``"``, also a semicolon.

Distribution: two shuffles of the text by tile (``TILE`` pieces), one to compose the tiles' functions, which
are written once under the shared checkpoint folder, and one to walk it; every list that is
gathered holds at most ``TILE`` pieces, the tiles of one file split, the splits of ``SPAN`` bytes or the spans of
one file. Statements that cross a tile border are put together from their fragments; numbering these is a
window over at most two rows per tile. No value is larger than a tile or a statement.

Null rows do not occur. An empty file gives no statement; a text that ends inside a quote gives what
is there as its last statement, without a ``;`` at the very end; empty statements and those that begin with no statement word are dropped, as are
comments in front of a statement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from graphweave.sources.store import written

TILE = 1024
SPAN = 64 << 30
STATES = ".'\"`LC"
# closed tokens from the start of the text, then the opening of one that does not close; all loops
# are possessive, which Java runs without recursion
_WALK = (
    r"""(?s)^(?:[^'"`/]++|/(?![/*])|'(?:[^'\\]++|\\.)*+'|"(?:[^"\\]++|\\.)*+"|`[^`]*+`|//[^\n]*+\n|/\*.*?\*/)*+"""
    r"""('|"|`|//|/\*)?"""
)
_LEADING_COMMENTS = r"(?s)^(?:\s++|//[^\n]*+(?:\n|$)|/\*.*?\*/)++"


def _end(text: Column) -> Column:
    """State after ``text`` when it begins outside."""
    opened = F.regexp_extract(text, _WALK, 1)
    opened = F.when(opened == "", F.lit(".")).otherwise(opened)
    return F.replace(F.replace(opened, F.lit("//"), F.lit("L")), F.lit("/*"), F.lit("C"))


def _reopen(state: Column) -> Column:
    """What opens ``state``: put before a piece, the piece can be read as if from outside."""
    s = F.replace(F.replace(state, F.lit("."), F.lit("")), F.lit("L"), F.lit("//"))
    return F.replace(s, F.lit("C"), F.lit("/*"))


def _plain(piece: Column) -> Column:
    """Holds nothing that opens or closes a quote or a comment; a line feed may end a line comment."""
    return ~piece.rlike(r"""['"`/*]""")


def _move(piece: Column) -> Column:
    """End state for each start state, as letters in the order of ``STATES``."""
    walked = F.concat(*[_end(F.concat(_reopen(F.lit(s)), piece)) for s in STATES])
    line_ends = F.lit(STATES.replace("L", "."))
    return F.when(~_plain(piece), walked).when(F.contains(piece, F.lit("\n")), line_ends).otherwise(F.lit(STATES))


def _next(state: Column, piece: Column) -> Column:
    """State after ``piece`` when it begins in ``state``."""
    line_ends = F.replace(state, F.lit("L"), F.lit("."))
    walked = _end(F.concat(_reopen(state), piece))
    return F.when(~_plain(piece), walked).when(F.contains(piece, F.lit("\n")), line_ends).otherwise(state)


def _apply(move: Column, states: Column) -> Column:
    return F.call_function("translate", states, F.lit(STATES), move)


def _compose(moves: Column) -> Column:
    return F.aggregate(moves, F.lit(STATES), lambda done, m: _apply(m, done))


def _starts(moves: DataFrame, levels: list[str]) -> DataFrame:
    """``levels, start``: state in which each row of ``moves`` (``levels, move``) begins."""
    if len(levels) == 1:
        return moves.select(*levels, F.lit(".").alias("start"))
    *outer, inner = levels
    up = moves.groupBy(*outer).agg(F.sort_array(F.collect_list(F.struct(inner, "move"))).alias("__l"))
    begins = _starts(up.select(*outer, _compose(F.transform("__l", lambda x: x["move"])).alias("move")), outer)
    walk = F.aggregate(
        "__l",
        F.struct(F.col("start").alias("s"), F.array().cast("array<string>").alias("out")),
        lambda acc, x: F.struct(_apply(x["move"], acc["s"]).alias("s"), F.concat(acc["out"], F.array(acc["s"])).alias("out")),
        lambda acc: acc["out"],
    )
    pairs = F.arrays_zip(F.transform("__l", lambda x: x[inner]).alias("i"), walk.alias("s"))
    return (
        up.join(begins, outer)
        .select(*outer, F.explode(pairs).alias("__p"))
        .select(*outer, F.col("__p").getField("i").alias(inner), F.col("__p").getField("s").alias("start"))
    )


def statements(spark: SparkSession, path: str, tile: int = TILE) -> DataFrame:
    """``statement``: every statement of the script files under ``path``, whole."""
    raw = spark.read.option("lineSep", ";").option("recursiveFileLookup", "true").text(path)
    where = ["file", "span", "block", "tile"]
    pieces = raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("n"),  # rows of one split are in order
        "value",
    ).select("file", F.expr(f"block div {SPAN}").alias("span"), "block", F.expr(f"n div {tile}").alias("tile"), "n", "value")
    tiles = pieces.groupBy(*where).agg(F.sort_array(F.collect_list(F.struct("n", "value"))).alias("l")).select(
        *where, F.transform("l", lambda x: x["value"]).alias("pieces")
    )
    # the pieces are read as functions once; each level of the scan reads the tiles' functions twice
    moves = written(tiles.select(*where, _compose(F.transform("pieces", _move)).alias("move")), "moves")
    starts = _starts(moves, where)
    # one letter per piece: the state after it
    ends = F.aggregate(
        "pieces",
        F.struct(F.col("start").alias("s"), F.lit("").alias("out")),
        lambda acc, p: F.transform(
            F.array(_next(acc["s"], p)), lambda e: F.struct(e.alias("s"), F.concat(acc["out"], e).alias("out"))
        )[0],
        lambda acc: acc["out"],
    )
    known = tiles.join(starts, where).select(*where, "pieces", "start", ends.alias("ends"))
    cuts = F.filter(F.sequence(F.lit(1), F.size("pieces")), lambda i: F.substring("ends", i, F.lit(1)) == ".")
    cut = known.select(
        *where, "pieces", (F.col("start") != ".").alias("goes_on"), F.explode(F.array(F.concat(F.array(F.lit(0)), cuts))).alias("c")
    )

    def text(frm: Column, to: Column) -> Column:
        return F.array_join(F.slice("pieces", frm + 1, to - frm), ";")

    c, size = F.col("c"), F.size("pieces")
    spans = F.when(
        F.size(c) > 1,
        F.transform(F.slice(c, F.lit(2), F.size(c) - 1), lambda to, i: F.struct(c[i].alias("a"), to.alias("b"))),
    ).otherwise(F.array().cast("array<struct<a:int,b:int>>"))
    rest = F.struct(F.element_at(c, -1).alias("a"), size.alias("b"))
    spans = F.concat(spans, F.when(F.element_at(c, -1) < size, F.array(rest)).otherwise(F.array().cast("array<struct<a:int,b:int>>")))
    parts = cut.select(*where, "pieces", "goes_on", F.element_at(c, -1).alias("last"), F.posexplode(spans).alias("part", "x")).select(
        *where, "part", text(F.col("x.a"), F.col("x.b")).alias("text"),
        (~F.col("goes_on") | (F.col("part") > 0)).alias("opens"),
        (F.col("x.b") <= F.col("last")).alias("closes"),
    )
    whole = parts.where("opens and closes").select(F.col("text").alias("statement"))
    order = [*where[1:], "part"]
    no = F.sum(F.col("opens").cast("bigint")).over(Window.partitionBy("file").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    seams = (
        parts.where("not (opens and closes)")
        .withColumn("no", no)
        .groupBy("file", "no")
        .agg(F.sort_array(F.collect_list(F.struct(*order, "text"))).alias("l"))
        .select(F.array_join(F.transform("l", lambda x: x["text"]), ";").alias("statement"))
    )
    return whole.unionByName(seams).select(F.regexp_replace("statement", _LEADING_COMMENTS, "").alias("statement"))
