"""Entity and relationship extraction per chunk.

``extract(chunks)`` adds ``result`` (the RESPONSE struct) and ``error`` to every chunk
row. With ``fn=None`` the built-in deterministic rules run as plain SQL
(``regexp_extract_all`` + higher-order functions, no Python). A user extractor is any
``fn(batch: pandas.DataFrame) -> sequence of JSON strings / dicts / None`` running in
``mapInPandas``: the client is built once per task, calls are batched per Arrow batch,
and nothing travels through the driver.

Extraction may be costly and non-deterministic: plans write the results to the store
and read them back before anything else depends on them (see ``sources.store``).
"""

from __future__ import annotations

import json
from typing import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphweave import schemas
from graphweave.functions.once import once

# Default rule patterns (no \b, same meaning in Java regex and RE2).
CONCEPT_RE = r"(?:^|[^\p{L}])(\p{Lu}\p{Ll}+\p{L}{2,})"  # group 1: a whole word of 4+ letters, capital first
LICENSE_RE = r"(?:Apache|MIT|GNU General Public) License"
EMAIL_RE = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}"
IPV4_RE = r"[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}"
# The same addresses for Java's matcher, in one pass over the text: one begins where the run of its characters
# begins, or where the match before it ends, and no other start in a run is tried.
EMAIL_SCAN = r"(?:\G|(?<![A-Za-z0-9._%+-]))" + EMAIL_RE

# The type vocabularies (10 entity types, 22 relationship types).
ENTITY_TYPES = (
    "Person", "Organization", "Location", "Event", "Concept",
    "Document", "Date", "Technology", "Product", "Topic",
)
RELATIONSHIP_TYPES = (
    "MENTIONS", "RELATED_TO", "PART_OF", "CONTAINS", "BELONGS_TO",
    "WORKS_FOR", "KNOWS", "COLLABORATES_WITH", "LEADS", "REPORTS_TO",
    "PARTICIPATES_IN", "OCCURS_IN", "CAUSES", "FOLLOWS", "PRECEDES",
    "LOCATED_IN", "NEAR", "TRAVELS_TO",
    "AUTHORED_BY", "REFERENCES", "CITES", "DISCUSSES",
)

LOOSE_PROPERTIES = "struct<entities:array<struct<properties:variant>>,relationships:array<struct<properties:variant>>>"


def empty_props() -> Column:
    return F.expr(f"cast(map() as {schemas.PROPS})")


def _v(c: Column) -> Column:
    return c.cast("variant")


def _ent(type_: str, name: Column, props: Column | None = None) -> Column:
    return F.struct(
        F.lit(type_).alias("type"),
        name.alias("name"),
        (props if props is not None else empty_props()).alias("properties"),
    )


def _rel(source: Column, target: Column, type_: str) -> Column:
    return F.struct(
        source.alias("source"), target.alias("target"), F.lit(type_).alias("type"), empty_props().alias("properties")
    )


def rule_hits(text: Column) -> dict[str, Column]:
    """The four match lists (distinct, in order of first occurrence)."""

    def found(pattern: str, group: int = 0, needs: str | None = None) -> Column:
        hits = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), group))
        if needs is None:
            return hits
        # every match holds ``needs``, which is looked for first
        return F.when(~F.contains(text, F.lit(needs)), F.array().cast("array<string>")).otherwise(hits)

    return {
        "__concepts": found(CONCEPT_RE, 1),
        "__licences": found(LICENSE_RE, needs="License"),
        "__emails": found(EMAIL_SCAN, needs="@"),
        "__ips": found(IPV4_RE),
    }


def rule_response(concepts: Column, licences: Column, emails: Column, ips: Column) -> Column:
    """RESPONSE struct from the default rules, given the four match lists.

    Entities: Concept for every capitalised word of 4+ letters (any script), Technology for
    licence names, Person for each mail address and Organization for its
    lower-cased domain, Location for dotted IPv4-like addresses. Relationships:
    consecutive Concepts RELATED_TO, each Person WORKS_FOR its Organization."""

    def domain(e: Column) -> Column:
        return F.lower(F.substring_index(e, "@", -1))

    domains = F.array_distinct(F.transform(emails, domain))
    entities = F.concat(
        F.transform(concepts, lambda w: _ent("Concept", w)),
        F.transform(licences, lambda w: _ent("Technology", w, F.create_map(F.lit("category"), _v(F.lit("license"))))),
        F.transform(emails, lambda e: _ent("Person", e, F.create_map(F.lit("email"), _v(e)))),
        F.transform(domains, lambda d: _ent("Organization", d, F.create_map(F.lit("domain"), _v(d)))),
        F.transform(ips, lambda a: _ent("Location", a, F.create_map(F.lit("kind"), _v(F.lit("network address"))))),
    )
    pairs = F.when(
        F.size(concepts) > 1,
        F.transform(
            F.sequence(F.lit(1), F.size(concepts) - 1),
            lambda i: _rel(F.element_at(concepts, i), F.element_at(concepts, i + 1), "RELATED_TO"),
        ),
    ).otherwise(F.filter(F.array(_rel(F.lit(""), F.lit(""), "RELATED_TO")), lambda _: F.lit(False)))
    relationships = F.concat(pairs, F.transform(emails, lambda e: _rel(e, domain(e), "WORKS_FOR")))
    return F.struct(entities.alias("entities"), relationships.alias("relationships"))


def apply_rules(chunks: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``result``/``error`` with the default rules: each pattern is scanned
    once per chunk (a projection of its own), then the response is assembled."""
    names, hits, response = _rule_columns(text_col)
    staged = chunks.select("*", *hits)
    return staged.withColumn("result", response).withColumn("error", F.lit(None).cast("string")).drop(*names)


@once
def _rule_columns(text_col: str) -> tuple[list, list, Column]:
    hits = rule_hits(F.col(text_col))
    return list(hits), [c.alias(n) for n, c in hits.items()], rule_response(*[F.col(n) for n in hits])


def spread(chunks: DataFrame, partitions: int | None = None) -> DataFrame:
    """Hash-spread chunks over tasks before CPU-heavy extraction, so one large
    document or one large input split does not serialise the work (one shuffle of
    the chunk text).

    Default: a ``rebalance`` by chunk key, which AQE sizes from the *measured*
    shuffle bytes at runtime (splitting oversized partitions, coalescing tiny ones
    while keeping parallelism), so the task count follows the data. Plan-time size
    estimates are not used: after file scans, joins and explodes they can be off by
    orders of magnitude. An explicit ``partitions`` gives a fixed hash repartition."""
    if partitions:
        return chunks.repartition(int(partitions), "document_name", "chunk_number")
    return chunks.hint("rebalance", "document_name", "chunk_number")


def extract(
    chunks: DataFrame,
    fn: Callable[[pd.DataFrame], Sequence] | None = None,
    text_col: str = "text",
    partitions: int | None = None,
    factory: Callable[[], Callable[[pd.DataFrame], Sequence]] | None = None,
) -> DataFrame:
    """Add ``result`` (RESPONSE struct, NULL on failure) and ``error`` (STRING).

    ``factory`` is called once per task and returns the extractor. ``partitions``: spread chunks over that many tasks first (0 = keep as is)."""
    if partitions != 0:
        chunks = spread(chunks, partitions)
    if fn is None and factory is None:
        return apply_rules(chunks, text_col)
    return parse_results(call_extractor(chunks, fn, factory=factory), "response")


def call_extractor(
    chunks: DataFrame, fn: Callable[[pd.DataFrame], Sequence] | None, out_col: str = "response",
    factory: Callable[[], Callable[[pd.DataFrame], Sequence]] | None = None,
) -> DataFrame:
    """Run a user extractor over Arrow batches; adds ``response`` and ``error``.

    ``factory`` builds the extractor once per task (a client, a model) instead of ``fn``. A
    batch that fails, or gives another number of results than it has chunks, is retried row
    by row, so one bad chunk only fails itself."""
    from graphweave.session import ship_package

    ship_package(chunks.sparkSession)
    schema = T.StructType(
        list(chunks.schema.fields)
        + [T.StructField(out_col, T.StringType()), T.StructField("error", T.StringType())]
    )

    def to_text(x):
        if x is None:
            return None
        return x if isinstance(x, str) else json.dumps(x)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = factory() if factory is not None else fn
        for pdf in batches:
            try:
                out = [to_text(x) for x in call(pdf)]
                if len(out) != len(pdf):
                    raise ValueError(f"{len(out)} results for {len(pdf)} chunks")
                err = [None if x is not None else "empty response" for x in out]
            except Exception:  # isolate the failing rows
                out, err = [], []
                for i in range(len(pdf)):
                    try:
                        (x,) = list(call(pdf.iloc[i : i + 1]))
                        out.append(to_text(x))
                        err.append(None if x is not None else "empty response")
                    except Exception as e:  # noqa: BLE001 - recorded per chunk
                        out.append(None)
                        err.append(f"{type(e).__name__}: {e}")
            pdf = pdf.copy()
            pdf[out_col] = out
            pdf["error"] = err
            yield pdf

    return chunks.mapInPandas(run, schema)


def parse_results(df: DataFrame, response_col: str = "response") -> DataFrame:
    """P5: parse and validate a JSON response into ``result``.

    Required: ``properties``, where given, are a map; both lists, entity ``type`` and ``name``, relationship ``source``,
    ``target`` and ``type``; properties default to an empty map. An invalid
    response makes the chunk a failure (``error`` set, ``result`` NULL)."""
    parsed = F.from_json(F.col(response_col), schemas.RESPONSE)
    # properties that are given must be a map: read once more with loose types
    loose = F.from_json(F.col(response_col), LOOSE_PROPERTIES)

    def maps(items: Column) -> Column:
        return F.forall(
            F.coalesce(items, F.array().cast("array<struct<properties:variant>>")),
            lambda x: F.coalesce(
                x["properties"].isNull() | F.is_variant_null(x["properties"])
                | F.schema_of_variant(x["properties"]).startswith("OBJECT"), F.lit(True),
            ),
        )

    ents, rels = parsed["entities"], parsed["relationships"]
    valid = (
        maps(loose["entities"])
        & maps(loose["relationships"])
        & parsed.isNotNull()
        & ents.isNotNull()
        & rels.isNotNull()
        & F.forall(ents, lambda e: e.isNotNull() & e["type"].isNotNull() & e["name"].isNotNull())
        & F.forall(
            rels,
            lambda r: r.isNotNull() & r["source"].isNotNull() & r["target"].isNotNull() & r["type"].isNotNull(),
        )
    )
    fixed = F.struct(
        F.transform(
            ents,
            lambda e: F.struct(
                e["type"].alias("type"),
                e["name"].alias("name"),
                F.coalesce(e["properties"], empty_props()).alias("properties"),
            ),
        ).alias("entities"),
        F.transform(
            rels,
            lambda r: F.struct(
                r["source"].alias("source"),
                r["target"].alias("target"),
                r["type"].alias("type"),
                F.coalesce(r["properties"], empty_props()).alias("properties"),
            ),
        ).alias("relationships"),
    )
    err = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
    return df.withColumn("result", F.when(err.isNull() & valid, fixed)).withColumn(
        "error",
        F.when(err.isNotNull(), err).when(~F.coalesce(valid, F.lit(False)), F.lit("invalid response")),
    )


def restrict_results(
    results: DataFrame, entity_types: Sequence[str] | None = None, relationship_types: Sequence[str] | None = None
) -> DataFrame:
    """P25 before completion: drop entities and relationships of other types from ``result``
    (None keeps all). Mentions are made from what is left, so none points at a dropped
    entity; relationships to and from dropped entities keep to the strict or load-time
    resolution, as those to unknown names do."""
    def keep(items: Column, types: Sequence[str] | None) -> Column:
        return items if types is None else F.filter(items, lambda x: x["type"].isin(*types, "Chunk", "Document", "BELONGS_TO", "CONTAINS"))

    r = F.col("result")
    kept = F.struct(
        keep(r["entities"], entity_types).alias("entities"), keep(r["relationships"], relationship_types).alias("relationships")
    )
    return results.withColumn("result", F.when(r.isNotNull(), kept))


def enforce_types(rows: DataFrame, types: Sequence[str], mode: str = "off", type_col: str = "type") -> DataFrame:
    """P25: restrict to an allowed vocabulary. ``off`` keeps everything (the
    vocabulary is only advice to the extractor), ``drop`` filters, ``flag`` adds
    ``type_allowed``. Structural types (Chunk, Document, BELONGS_TO, MENTIONS) are
    always allowed."""
    if mode == "off":
        return rows
    allowed = F.col(type_col).isin(*types, "Chunk", "Document", "BELONGS_TO", "MENTIONS")
    if mode == "drop":
        return rows.where(allowed)
    if mode == "flag":
        return rows.withColumn("type_allowed", F.coalesce(allowed, F.lit(False)))
    raise ValueError(f"unknown mode {mode!r}")
