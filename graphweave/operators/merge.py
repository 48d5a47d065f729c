"""Entity resolution with property-level merging.

Rows are grouped by the normalised key ``<type>_<lower(strip(name)) with spaces as _>``.
Within a key, rows are taken in ``ord`` order (default ``path, chunk_number, pos``):

* the type comes from the first row;
* each property takes its **first truthy value, else its last value**;
* properties are ordered by first appearance; a Chunk row that brings a ``text``
  key for an existing node puts it ahead of that row's other new keys.

Execution, in two lanes. Small properties are exploded to ``(key, prop, value)`` rows and
folded with ``min_by``/``max_by`` (partial aggregation before the shuffle, so a hub key
with a third of all rows is reduced map-side), then gathered per key: at most "number of distinct
properties" entries. Large ones (``LARGE``: chunk text, embedding) are folded per key
beside them without being exploded, so each of their values crosses one shuffle, and a row without
any takes the first lane only; both lanes end
partitioned by key and are joined in place. No global order, window or driver state is needed.

Where most keys stand on one row (``mostly_unique``), hashes of the keys are counted first. A row whose
hash occurs once is its node already and is neither exploded nor shuffled; the others, told by a join
with the repeated hashes, take the two lanes. The nodes are the same either way. The repeated hashes are
written before, so that the join is planned by their own size, not by that of all rows.

The fold is *mergeable*: ``fold`` turns rows into state rows ``(entity_key, prop, first, t_ord, t_value,
l_ord, l_value)`` with the first appearance, the first truthy and the last falsy value; ``combine``
of states is the state of their rows together, in any order and with any of them repeated, and
``render`` gives the nodes. ``MergeState`` keeps such states as a table, one part per batch.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphweave.functions.keys import entity_key
from graphweave.functions.once import once
from graphweave.functions.text import ustrip
from graphweave.functions.truth import truthy
from graphweave.operators.shape import set_prop
from graphweave.session import written
from graphweave.sources.store import read_if_exists

LARGE = ("text", "embedding")  # properties that are folded per key, not exploded
DEFAULT_ORD = ("path", "chunk_number", "pos")


def _ord(cols) -> Column:
    return F.struct(*[F.col(c) for c in cols])


def prepare(entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Validate rows, strip Document names and add ``entity_key``.

    Returns ``(rows, quarantine)``. A row without a type, or whose ``name`` property
    is present but not a string, cannot be keyed (the source program aborts on it);
    it goes to quarantine with a ``reason`` instead."""
    ok, reason, name, props, key = _preparation()
    df = entities.withColumn("__ok", ok)
    quarantine = df.where("not __ok").withColumn("reason", reason).drop("__ok")
    rows = df.where("__ok").drop("__ok").withColumn("name", name).withColumn("props", props).withColumn("entity_key", key)
    return rows, quarantine


@once
def _preparation() -> tuple[Column, Column, Column, Column, Column]:
    props = F.col("props")
    nm = props["name"]  # Spark takes the value itself where the map is made in the same plan
    has_name = nm.isNotNull() | F.map_contains_key(props, F.lit("name"))
    name_ok = ~has_name | (F.schema_of_variant(nm) == "STRING")
    ok = F.col("type").isNotNull() & F.coalesce(name_ok, F.lit(False)) & props.isNotNull()
    reason = (
        F.when(F.col("type").isNull(), F.lit("missing type"))
        .when(props.isNull(), F.lit("missing properties"))
        .otherwise(F.lit("name is not a string"))
    )
    name_s = F.coalesce(F.try_variant_get(nm, "$", "string"), F.lit("unknown"))  # in good rows it is missing or a string
    is_doc = F.col("type") == "Document"
    name = F.when(is_doc, ustrip(name_s)).otherwise(name_s)
    named = F.when(is_doc, set_prop(props, "name", F.col("name").cast("variant"))).otherwise(props)
    return ok, reason, name, named, entity_key(F.col("type"), F.col("name"))


def _keyed(rows: DataFrame, ord_cols) -> DataFrame:
    return rows.withColumn("ord", _ord(ord_cols))


def _small(rows: DataFrame) -> DataFrame:
    """State rows of the properties that are not ``LARGE``."""
    long = rows.select("entity_key", "type", "ord", F.posexplode("props").alias("ppos", "prop", "value"))
    return _folded(long.where(~F.col("prop").isin(*LARGE)))


def _folded(long: DataFrame) -> DataFrame:
    return _judged(long).groupBy("entity_key", "prop").agg(*_fold_columns()[2])


def _judged(long: DataFrame) -> DataFrame:
    """``long`` with ``good``, the truth of ``value``, found once per row."""
    first, good, _ = _fold_columns()
    return long.withColumn("__first", first).withColumn("good", good).drop("__first")


@once
def _fold_columns() -> tuple[Column, Column, list]:
    """The first character of ``value`` as text, the truth of ``value`` and the fold. A value whose text begins with
    1-9 or a later character other than ``[``, ``f`` and ``{`` is no zero, false, empty string, list or object."""
    at = F.col("__first")
    plain = (at >= ord("1")) & ~at.isin(ord("["), ord("f"), ord("{"))
    judged = F.when(plain, F.lit(True)).otherwise(truthy(F.col("value")))
    good = F.col("good")
    t, f = F.when(good, F.col("ord")), F.when(good, F.lit(None)).otherwise(F.col("ord"))
    return F.ascii(F.try_variant_get("value", "$", "string")), judged, [
        F.min(F.struct("ord", "ppos", "type")).alias("first"),
        F.min(t).alias("t_ord"), F.min_by("value", t).alias("t_value"),
        F.max(f).alias("l_ord"), F.max_by("value", f).alias("l_value"),
    ]


def _large(rows: DataFrame) -> DataFrame:
    """Per key its first row and the folded ``LARGE`` properties, in one shuffle. Rows whose properties are
    all small stand in the other lane, with their place and type, and are left out."""
    here, aggs = _large_columns()
    return rows.where(here).groupBy("entity_key").agg(*aggs)


@once
def _large_columns() -> tuple[Column, list]:
    props = F.col("props")
    here = F.size(props) == 0
    for p in LARGE:
        here = here | F.map_contains_key(props, F.lit(p))
    aggs = [F.min(F.struct("ord", F.lit(-1).alias("ppos"), "type")).alias("head")]
    for p in LARGE:
        at = F.array_position(F.map_keys("props"), p).cast("int") - 1
        v, has = F.try_element_at("props", F.lit(p)), F.map_contains_key("props", F.lit(p))
        good = F.coalesce(truthy(v), F.lit(False))
        t, f = F.when(has & good, F.col("ord")), F.when(has & ~good, F.col("ord"))
        aggs += [
            F.min(F.when(has, F.struct("ord", at.alias("ppos"), "type"))).alias(f"{p}_first"),
            F.min(t).alias(f"{p}_t_ord"), F.min_by(v, t).alias(f"{p}_t_value"),
            F.max(f).alias(f"{p}_l_ord"), F.max_by(v, f).alias(f"{p}_l_value"),
        ]
    return F.coalesce(here, F.lit(True)), aggs


def _entry(first, prop, t_value, l_value) -> Column:
    return F.struct(first.alias("first"), prop.alias("prop"), F.coalesce(t_value, l_value).alias("value"))


def _row_of(first: Column) -> Column:
    """The row of a first appearance: its place and type."""
    return F.struct(first["ord"].alias("ord"), F.lit(-1).alias("ppos"), first["type"].alias("type"))


def _large_entries() -> Column:
    found = F.array(*[
        _entry(F.col(f"{p}_first"), F.lit(p), F.col(f"{p}_t_value"), F.col(f"{p}_l_value")) for p in LARGE
    ])
    return F.filter(found, lambda x: x["first"].isNotNull())


def _nodes(per_key: DataFrame) -> DataFrame:
    """Nodes of ``(entity_key, head, entries)``."""
    first_ord = F.col("head.ord")

    def sort_key(x):
        # A Chunk row that brings ``text`` to an existing node puts it ahead of
        # that row's other new keys; on the node's first row positions stay.
        f = x["first"]
        moved = (x["prop"] == "text") & (f["type"] == "Chunk") & (f["ord"] != first_ord)
        return F.struct(f["ord"].alias("ord"), F.when(moved, F.lit(-1)).otherwise(f["ppos"]).alias("ppos"))

    ordered = F.array_sort(
        F.transform(F.col("entries"), lambda x: F.struct(sort_key(x).alias("k"), x["prop"].alias("prop"), x["value"].alias("value"))),
        lambda a, b: F.when(a["k"] < b["k"], F.lit(-1)).when(a["k"] > b["k"], F.lit(1)).otherwise(F.lit(0)),
    )
    props = F.map_from_entries(F.transform(ordered, lambda x: F.struct(x["prop"], x["value"])))
    return per_key.select(
        "entity_key",
        F.col("head.type").alias("type"),
        F.try_variant_get(F.try_element_at(props, F.lit("name")), "$", "string").alias("name"),
        props.alias("props"),
        first_ord.alias("first_ord"),
    )


def _merged(rows: DataFrame) -> DataFrame:
    """Nodes of keyed rows by the two lanes."""
    small = _small(rows).groupBy("entity_key").agg(
        F.min(_row_of(F.col("first"))).alias("small_head"),
        F.collect_list(_entry(F.col("first"), F.col("prop"), F.col("t_value"), F.col("l_value"))).alias("small")
    )
    both = _large(rows).join(small, "entity_key", "full")
    entries = F.when(F.col("small").isNull(), _large_entries()).otherwise(F.concat("small", _large_entries()))
    return _nodes(both.select("entity_key", F.least("head", "small_head").alias("head"), entries.alias("entries")))


def _single(rows: DataFrame) -> DataFrame:
    """Nodes of keyed rows that are alone with their key."""
    name = F.try_variant_get(F.col("props")["name"], "$", "string")
    return rows.select("entity_key", "type", name.alias("name"), "props", F.col("ord").alias("first_ord"))


def merge_entities(
    entities: DataFrame, ord_cols=DEFAULT_ORD, prepared: bool = False, mostly_unique: bool = False
) -> DataFrame:
    """Merged nodes: ``entity_key, type, name, props, first_ord`` (one row per key).

    ``mostly_unique`` suits rows that are cheap to read several times and of which few share a key;
    it changes the plan, never the nodes."""
    rows = _keyed(entities if prepared else prepare(entities)[0], ord_cols)
    if not mostly_unique:
        return _merged(rows)
    # two keys of one hash only send both to the lanes
    hashed = rows.withColumn("__hash", F.xxhash64("entity_key"))
    repeated = hashed.groupBy("__hash").agg(F.count("*").alias("n")).where("n > 1").select("__hash")
    repeated = written(repeated, "repeated")
    alone = hashed.join(repeated, "__hash", "left_anti").drop("__hash")
    shared = hashed.join(repeated, "__hash", "left_semi").drop("__hash")
    return _single(alone).unionByName(_merged(shared))


# ---------------------------------------------------------------- mergeable state


def fold(rows: DataFrame, ord_cols=DEFAULT_ORD) -> DataFrame:
    """State rows of prepared entity rows; a row with a null ``prop`` is the first of the key's rows that have
    no property, or large ones. The key's first row is the least ``first`` of its state rows."""
    rows = _keyed(rows, ord_cols)
    small = _small(rows)
    kinds = tuple((f.name, f.dataType.simpleString()) for f in small.schema if f.name in ("t_ord", "t_value", "l_ord", "l_value"))
    return _large(rows).select("entity_key", _large_states(kinds)).unionByName(small)


@once
def _large_states(kinds: tuple) -> Column:
    """The state rows of a row of ``_large``; ``kinds``: columns of a state row and their types."""
    one = lambda p, n: F.col(f"{p}_{n}")
    none = [F.lit(None).cast(kind).alias(n) for n, kind in kinds]
    made = [F.struct(F.lit(None).cast("string").alias("prop"), F.col("head").alias("first"), *none)]
    made += [F.struct(F.lit(p).alias("prop"), one(p, "first").alias("first"), *[one(p, n).alias(n) for n, _ in kinds]) for p in LARGE]
    return F.inline(F.filter(F.array(*made), lambda x: x["first"].isNotNull()))


def combine(*states: DataFrame) -> DataFrame:
    """The state of all rows behind several states. Repeating a state changes nothing."""
    s = states[0]
    for more in states[1:]:
        s = s.unionByName(more)
    return s.groupBy("entity_key", "prop").agg(
        F.min("first").alias("first"),
        F.min("t_ord").alias("t_ord"), F.min_by("t_value", "t_ord").alias("t_value"),
        F.max("l_ord").alias("l_ord"), F.max_by("l_value", "l_ord").alias("l_value"),
    )


def render(state: DataFrame) -> DataFrame:
    """Merged nodes of a state, as ``merge_entities`` gives them for its rows."""
    key_row = F.col("prop").isNull()
    entry = F.when(~key_row, _entry(F.col("first"), F.col("prop"), F.col("t_value"), F.col("l_value")))
    per_key = state.groupBy("entity_key").agg(
        F.min(_row_of(F.col("first"))).alias("head"), F.collect_list(entry).alias("entries"))  # nulls are left out
    return _nodes(per_key)


class MergeState:
    """Merge state as a table under ``path``: ``deltas/batch=<id>`` holds the fold of one batch's rows,
    ``snapshots/<n>`` the state of everything before it.

    A batch reads and writes its own rows only. A retried batch overwrites its own delta, and a
    delta that a snapshot holds too is harmless, because folding rows again changes nothing."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def add(self, rows: DataFrame, batch: str, ord_cols=DEFAULT_ORD) -> None:
        """Fold a batch of prepared entity rows in."""
        fold(rows, ord_cols).write.mode("overwrite").parquet(f"{self.path}/deltas/batch={batch}")

    def _snapshots(self) -> DataFrame | None:
        return read_if_exists(self.spark, f"{self.path}/log")

    def state(self) -> DataFrame | None:
        """Everything folded in so far; None before the first batch."""
        deltas = read_if_exists(self.spark, f"{self.path}/deltas")
        if deltas is None:
            return None
        columns = [c for c in deltas.columns if c != "batch"]
        log = self._snapshots()
        if log is None:
            return combine(deltas.select(*columns))
        newest = log.agg(F.max_by("folder", "number")).first()[0]
        held = log.where(F.col("folder") == newest).select(F.explode("batches").alias("held"))
        left = deltas.join(held, F.col("batch").cast("string") == F.col("held"), "left_anti")
        return combine(self.spark.read.parquet(f"{self.path}/{newest}").select(*columns), left.select(*columns))

    def nodes(self) -> DataFrame | None:
        state = self.state()
        return None if state is None else render(state)

    def compact(self) -> None:
        """Write the whole state as one snapshot that later reads start from. The log row is
        written last: a reader sees the snapshot whole or not at all."""
        deltas = read_if_exists(self.spark, f"{self.path}/deltas")
        if deltas is None:
            return
        batches = deltas.select(F.col("batch").cast("string").alias("batch")).distinct().agg(F.collect_set("batch").alias("batches"))
        log = self._snapshots()
        number = 0 if log is None else log.agg(F.max("number")).first()[0] + 1
        folder = f"snapshots/{number}-{uuid.uuid4().hex[:8]}"
        batches = self.spark.createDataFrame(batches.collect(), "batches array<string>")  # as of the state below
        self.state().write.parquet(f"{self.path}/{folder}")
        batches.select(F.lit(number).alias("number"), F.lit(folder).alias("folder"), "batches").write.mode("append").parquet(f"{self.path}/log")


def merge_relationships(*relationships: DataFrame) -> DataFrame:
    """A3: bag union of relationship rows; no de-duplication, endpoints unchanged."""
    out = relationships[0]
    for r in relationships[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    return out
