"""Python truthiness over VARIANT values, the rule that drives the entity merge.

Falsy: SQL NULL, JSON null, ``""``, numeric zero, ``false``, ``[]`` and ``{}``.
Everything else is truthy, including the blank string ``"  "`` and the string ``"0"``.

A value's type tag (``schema_of_variant``) is computed once and bound with
``let`` so the expression tree stays small however often the tag is consulted.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(expr: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``expr`` once and pass it to ``body`` (a one-element transform)."""
    return F.try_element_at(F.transform(F.array(expr), body), F.lit(1))


def tag(v) -> Column:
    """``struct(v, s)`` with ``s`` the variant's schema string (NULL for SQL NULL)."""
    v = _c(v)
    return F.struct(v.alias("v"), F.schema_of_variant(v).alias("s"))


def kind_of(s: Column) -> Column:
    """Coarse kind from a schema string: null/string/bool/number/array/object/other."""
    return (
        F.when(s.isNull() | (s == "VOID"), F.lit("null"))
        .when(s == "STRING", F.lit("string"))
        .when(s == "BOOLEAN", F.lit("bool"))
        .when(s.startswith("ARRAY"), F.lit("array"))
        .when(s.startswith("OBJECT"), F.lit("object"))
        .when(s.isin("BINARY", "DATE", "TIMESTAMP", "TIMESTAMP_NTZ", "UUID"), F.lit("other"))
        .otherwise(F.lit("number"))
    )


def variant_kind(v) -> Column:
    """Kind of a VARIANT column (see ``kind_of``)."""
    return let(F.schema_of_variant(_c(v)), kind_of)


def truthy_tagged(v: Column, s: Column) -> Column:
    """Truthiness from a value and its bound schema string."""
    k = s  # schema string; kinds tested directly to keep the tree flat
    return (
        F.when(k.isNull() | (k == "VOID"), F.lit(False))
        .when(k == "STRING", F.try_variant_get(v, "$", "string") != F.lit(""))
        .when(k == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
        .when(k.startswith("ARRAY"), F.size(F.try_variant_get(v, "$", "array<variant>")) > 0)
        .when(k.startswith("OBJECT"), k != F.lit("OBJECT<>"))
        .when(k.isin("BINARY", "DATE", "TIMESTAMP", "TIMESTAMP_NTZ", "UUID"), F.lit(True))
        .otherwise(F.try_variant_get(v, "$", "double") != F.lit(0.0))
    )


def truthy(v) -> Column:
    """Python ``bool(value)`` for a VARIANT column (never NULL)."""
    return F.coalesce(let(tag(v), lambda t: truthy_tagged(t["v"], t["s"])), F.lit(False))


def is_blank_string(v) -> Column:
    """A VARIANT string that is empty after a Unicode strip (dropped when rendering)."""
    from graphweave.functions.text import is_all_space

    v = _c(v)
    return F.coalesce(
        (F.schema_of_variant(v) == "STRING") & is_all_space(F.try_variant_get(v, "$", "string")), F.lit(False)
    )


def string_truthy(c) -> Column:
    """Python truthiness of a nullable STRING column."""
    c = _c(c)
    return F.coalesce(c != F.lit(""), F.lit(False))
