"""Graph-load statements and the files around them.

Statements are built per row with built-in string functions; the script is written
by the executors (one statement per row, no driver concatenation).
"""

from __future__ import annotations

import datetime as _dt
from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphweave.functions.literals import escape_string, literal_tagged
from graphweave.functions.truth import let
from graphweave.functions.text import ustrip
from graphweave.functions.truth import is_blank_string
from graphweave.operators import repair, script_scan

# Statement formats of the load script.
NODE_FMT = "MERGE (n:{type} {{{props}}})"
EDGE_FMT = (
    "MATCH (a {{name: '{source}'}})\n"
    "            MATCH (b {{name: '{target}'}})\n"
    "            MERGE (a)-[r:{type}{props}]->(b)"
)
INDEX_FMT = (
    "CREATE VECTOR INDEX {type_lower}_embeddings IF NOT EXISTS\n"
    "                FOR (n:{type}) ON n.embedding\n"
    "                OPTIONS {{\n"
    "                    indexConfig: {{\n"
    "                        `vector.dimensions`: {dims},\n"
    "                        `vector.similarity_function`: '{sim}'\n"
    "                    }}\n"
    "                }}"
)
STATEMENT_SEP = ";\n\n"
SCRIPT_PREFIX = "knowledge_graph_"
ROWS = "_rows"  # our own folder; a leading underscore hides it from readers of the text
STATEMENT_RE = r"(?i)^(MERGE|MATCH|CREATE|CALL|WITH)"


def _fmt(template: str, **cols) -> F.Column:
    """Fill a ``str.format`` template with Columns (literal text stays literal)."""
    import string

    parts = []
    for text, field, _spec, _conv in string.Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if field is not None:
            parts.append(cols[field])
    return F.concat(*parts)


def render_body(props_col="props", max_chars: int | None = None) -> F.Column:
    """P16 + P21: ``k: literal, ...`` after dropping null and blank-string values
    (empty string when nothing is left)."""
    p = F.col(props_col) if isinstance(props_col, str) else props_col
    kept = F.map_filter(p, lambda k, v: ~(v.isNull() | F.is_variant_null(v) | is_blank_string(v)))
    tagged = F.transform(
        F.map_entries(kept), lambda e: F.struct(e["key"].alias("k"), e["value"].alias("v"), F.schema_of_variant(e["value"]).alias("s"))
    )
    return F.array_join(
        F.transform(tagged, lambda x: F.concat(x["k"], F.lit(": "), literal_tagged(x["v"], x["s"], max_chars))), ", "
    )


def _emit(df: DataFrame, keep: list, stmt: F.Column) -> DataFrame:
    """Rows with a non-NULL statement. The statement is a generated column, so the
    NULL test stays above the generator and the statement is built once (a filter
    on a plain computed column would be pushed below it and duplicate the work)."""
    return (
        df.select(*keep, F.explode_outer(F.array(stmt)).alias("statement"))
        .where(F.col("statement").isNotNull())
    )


def node_statements(nodes: DataFrame, max_chars: int | None = None) -> DataFrame:
    """``entity_key, type, statement`` for nodes with at least one property.
    ``max_chars`` cuts long strings as the load format does (T2); by default none is cut."""
    fixed = repair.placeholder(repair.chunk_number(nodes))
    stmt = let(
        render_body("props", max_chars),
        lambda b: F.when(b != "", _fmt(NODE_FMT, type=F.col("type"), props=b)),
    )
    return _emit(fixed, ["entity_key", "type", "first_ord"], stmt)


def edge_statements(rels: DataFrame, max_chars: int | None = None) -> DataFrame:
    """P18 + P23: one statement per relationship row with truthy endpoints."""
    ok = F.coalesce((F.col("source") != "") & (F.col("target") != ""), F.lit(False))
    keep = [c for c in rels.columns if c != "props"]
    stmt = let(
        render_body("props", max_chars),
        lambda b: _fmt(
            EDGE_FMT,
            source=escape_string(F.col("source"), max_chars),
            target=escape_string(F.col("target"), max_chars),
            type=F.col("type"),
            props=F.when(b != "", F.concat(F.lit(" {"), b, F.lit("}"))).otherwise(F.lit("")),
        ),
    )
    return rels.where(ok).select(*keep, stmt.alias("statement"))


def index_statements(nodes: DataFrame, enabled: bool = True, dims: int | None = 1536, sim: str = "cosine") -> DataFrame:
    """One vector-index statement per type having a non-empty embedding.

    ``dims=None`` takes the dimension from the data (largest embedding of the type)."""
    emb = F.try_element_at(F.col("props"), F.lit("embedding"))
    n = F.size(F.try_variant_get(emb, "$", "array<variant>"))
    types = nodes.where(F.coalesce(n > 0, F.lit(False))).groupBy("type").agg(F.max(n).alias("__dims"))
    if not enabled:
        types = types.where(F.lit(False))
    return types.select(
        "type",
        _fmt(
            INDEX_FMT,
            type_lower=F.lower(F.col("type")),
            type=F.col("type"),
            dims=F.col("__dims").cast("string") if dims is None else F.lit(str(dims)),
            sim=F.lit(sim),
        ).alias("statement"),
    )


def write_script(
    node_stmts: DataFrame, edge_stmts: DataFrame, index_stmts: DataFrame, out_dir: str, when: _dt.datetime | None = None
) -> str:
    """K2: write ``<out_dir>/knowledge_graph_<yyyyMMdd_HHmmss>/{1_nodes,2_edges,3_indexes}``,
    one statement per line record ending in ``;\\n\\n``, and the same statements as Parquet rows
    in the hidden folder ``_rows``. Returns the script folder."""
    ts = (when or _dt.datetime.now()).strftime("%Y%m%d_%H%M%S")
    root = f"{out_dir.rstrip('/')}/{SCRIPT_PREFIX}{ts}"
    for sub, df in (("1_nodes", node_stmts), ("2_edges", edge_stmts), ("3_indexes", index_stmts)):
        rows = f"{root}/{ROWS}/{sub}"
        df.select("statement").write.mode("overwrite").parquet(rows)
        df.sparkSession.read.schema("statement string").parquet(rows).write.mode("overwrite").option(
            "lineSep", STATEMENT_SEP
        ).text(f"{root}/{sub}")
    return root


def load_statements(spark: SparkSession, path: str, mode: str = "naive") -> DataFrame:
    """Statements of a script folder.

    ``naive`` cuts at every ``;`` (also inside quoted text), strips and keeps pieces
    that start with MERGE/MATCH/CREATE/CALL/WITH in any case. ``quoted`` cuts only where a ``;``
    stands outside quotes and comments (``script_scan``): it needs nothing but the text and is
    lossless for any well-formed script. ``rows`` reads the statements that ``write_script`` kept
    as rows beside the text: these come back whatever they contain, ill-formed ones too."""
    if mode == "rows":
        return spark.read.schema("statement string").option("recursiveFileLookup", "true").parquet(f"{path.rstrip('/')}/{ROWS}")
    if mode == "quoted":
        raw = script_scan.statements(spark, path).withColumnRenamed("statement", "value")
    elif mode == "naive":
        raw = spark.read.option("lineSep", ";").option("recursiveFileLookup", "true").text(path)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    s = ustrip(F.col("value"))
    return raw.select(s.alias("statement")).where((F.col("statement") != "") & F.col("statement").rlike(STATEMENT_RE))


def apply_statements(
    stmts: DataFrame, writer_factory: Callable[[], Callable[[str], object]] | None = None
) -> DataFrame:
    """K3: run every statement alone through a writer built once per task.

    Returns ``statement, statement_prefix, ok, error``; the default writer is a dry run that
    accepts every statement. Count with ``count_if(ok)`` / ``count_if(not ok)``."""
    schema = T.StructType(
        [
            T.StructField("statement", T.StringType()),
            T.StructField("statement_prefix", T.StringType()),
            T.StructField("ok", T.BooleanType()),
            T.StructField("error", T.StringType()),
        ]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        write = writer_factory() if writer_factory else (lambda q: None)
        for pdf in batches:
            rows = []
            for q in pdf["statement"]:
                try:
                    write(q)
                    rows.append((q, q[:100], True, None))
                except Exception as e:  # noqa: BLE001 - counted as a failure
                    rows.append((q, q[:100], False, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["statement", "statement_prefix", "ok", "error"])

    from graphweave.session import ship_package

    ship_package(stmts.sparkSession)
    return stmts.select("statement").mapInPandas(run, schema)


def latest_script(spark: SparkSession, out_dir: str) -> DataFrame:
    """The most recently modified script folder (file metadata only)."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(out_dir)
        .select("path", "modificationTime")
    )
    script = F.regexp_extract(F.col("path"), rf"^(.*/{SCRIPT_PREFIX}[0-9]{{8}}_[0-9]{{6}})/", 1)
    return (
        files.select(script.alias("script"), "modificationTime")
        .where(F.col("script") != "")
        .groupBy("script")
        .agg(F.max("modificationTime").alias("modified"))
        .orderBy(F.col("modified").desc(), F.col("script").desc())
        .limit(1)
    )


def write_graph(nodes: DataFrame, edges: DataFrame, out_dir: str) -> None:
    """K5: analysis tables as Parquet; edges partitioned by relationship type."""
    nodes.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/nodes")
    edges.write.mode("overwrite").partitionBy("type").parquet(f"{out_dir.rstrip('/')}/edges")
