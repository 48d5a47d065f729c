"""Entity identity: the normalised merge key and the name it is built from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from graphweave.functions.text import ustrip


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_name(name) -> Column:
    """Name part of the key: Unicode strip, lower case, each space becomes ``_``.

    Only U+0020 is replaced, so ``New\\tYork`` keeps its tab and stays a separate key."""
    return F.replace(F.lower(ustrip(name)), F.lit(" "), F.lit("_"))


def entity_key(type_col, name) -> Column:
    """``<type>_<normalised name>``; the type keeps its case; a missing name is ``unknown``."""
    return F.concat(_c(type_col), F.lit("_"), key_name(F.coalesce(_c(name), F.lit("unknown"))))
