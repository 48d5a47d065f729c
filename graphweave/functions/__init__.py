"""Column-level helpers. Everything here returns a ``pyspark.sql.Column`` built from
built-in expressions, so it stays inside whole-stage code generation."""

from graphweave.functions.keys import entity_key, key_name
from graphweave.functions.text import (
    chunk_name,
    fold_newlines,
    path_stem,
    path_suffix,
    ustrip,
)
from graphweave.functions.truth import is_blank_string, truthy
from graphweave.functions.literals import literal, string_literal

__all__ = [
    "chunk_name",
    "entity_key",
    "fold_newlines",
    "is_blank_string",
    "key_name",
    "literal",
    "path_stem",
    "path_suffix",
    "string_literal",
    "truthy",
    "ustrip",
]
