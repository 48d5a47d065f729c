"""Text helpers: Unicode-aware strip, newline folding, path pieces, chunk names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip()/str.isspace() whitespace: Unicode White_Space plus the four
# information separators U+001C..U+001F. Java's (?U)\s covers White_Space only.
_WS = r"[\s\x{1c}-\x{1f}]"
_STRIP_RE = rf"(?U)^{_WS}+|{_WS}+$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ustrip(c) -> Column:
    """Strip leading/trailing Unicode whitespace (``str.strip()`` semantics). A text that begins and ends
    with a visible ASCII character is not searched."""
    c = _c(c)
    plain = F.ascii(c).between(33, 126) & F.ascii(F.substring(c, -1, 1)).between(33, 126)
    return F.when(plain, c).otherwise(F.regexp_replace(c, _STRIP_RE, ""))


def is_all_space(c) -> Column:
    """True when the string is empty after a Unicode strip (anchored match that
    stops at the first non-space character instead of rewriting the string; none where the
    string begins with a visible ASCII character)."""
    c = _c(c)
    return ~F.ascii(c).between(33, 126) & c.rlike(rf"(?U)^{_WS}*$")


def fold_newlines(c) -> Column:
    """Universal-newline reading: ``\\r\\n`` and lone ``\\r`` become ``\\n``."""
    return F.regexp_replace(_c(c), "\r\n?", "\n")


def path_suffix(c) -> Column:
    """Lower-cased suffix with its dot (``.txt``); empty when the name has none.

    Like ``PurePath.suffix``: the part after the last dot of the final component,
    ignored for names that start with their only dot (``.env``)."""
    base = F.regexp_extract(_c(c), r"([^/]*)$", 1)
    return F.lower(F.regexp_extract(base, r"^.+(\.[^.]*)$", 1))


def path_stem(c) -> Column:
    """Final path component without its suffix (``PurePath.stem``)."""
    base = F.regexp_extract(_c(c), r"([^/]*)$", 1)
    with_suffix = F.regexp_extract(base, r"^(.+)\.[^.]*$", 1)
    return F.when(with_suffix == "", base).otherwise(with_suffix)


def chunk_name(document_name, chunk_number) -> Column:
    """``<document>_chunk_<n>``."""
    return F.concat(_c(document_name), F.lit("_chunk_"), _c(chunk_number).cast("string"))
