"""Token counts of documents in flat, unindexed token files.

A token file is nothing but little-endian ids end to end; after each document stands one
separator id. The scan cuts files into blocks of fixed size, searches each block for the
separator with one vectorised comparison, and stitches documents that cross blocks: the
last separator and the number of separators before a block come from a prefix scan over the
blocks' summaries. No file is read twice and no task sees more than a block.

Defined results: an empty file has no documents; two separators in a row are a document of
no tokens; tokens behind the last separator are a document that is not ``complete``. A text
that itself encodes to the separator (``<|endoftext|>`` quoted in it) is written with a
``stand_in`` for it, an id the tokenizer never gives, so it is one token of that document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphweave.session import scratch_dir

from .rangeio import RangeReader, new_file, open_output
from .tokens import encoder
from .written import written

BLOCK_TOKENS = 1 << 20
_FILE = pa.schema([("file", pa.string()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64()))])
_BLOCK = pa.schema([("file", pa.string()), ("block", pa.int64()), ("separators", pa.list_(pa.int64()))])


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, separator: int, dtype: str = "<u2",
    file_tokens: int = 64 << 20, doc_id: str = "doc_id", text: str = "text", stand_in: int | None = None,
) -> DataFrame:
    """Write the ids of ``docs`` as flat files of at most about ``file_tokens`` tokens below
    ``folder``. Lazy: one row per file, ``file, n_tokens`` and the ids of its documents in order;
    write that table before use. A task that runs again writes new files and rows. Separators
    inside texts are written as ``stand_in``; without one such a text is refused."""

    def run(batches):
        enc = encoder(tokenizer)
        sink, name, tokens, names = None, None, 0, []

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([name], pa.string()), pa.array([tokens], pa.int64()), pa.array([names], pa.list_(pa.int64()))],
                schema=_FILE,
            )

        for batch in batches:
            ids_col, at = batch.column(0).to_pylist(), 0
            for flat, offsets in enc.encode(batch.column(1)):
                if sink is None:
                    name = new_file(folder, ".bin")
                    sink, tokens, names = open_output(name), 0, []
                inside = flat == separator
                if inside.any():
                    if stand_in is None:
                        raise ValueError(f"a text encodes to the separator id {separator}")
                    flat = np.where(inside, np.int32(stand_in), flat)
                out = np.insert(flat, offsets[1:], separator)
                sink.write(out.astype(dtype).tobytes())
                tokens += len(out)
                names += ids_col[at : at + len(offsets) - 1]
                at += len(offsets) - 1
                if tokens >= file_tokens:
                    sink.close()
                    sink = None
                    yield row()
        if sink is not None:
            sink.close()
            yield row()

    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return d.mapInArrow(run, "file string, n_tokens long, doc_ids array<long>")


def scan_separators(files: DataFrame, separator: int, dtype: str = "<u2", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``files(file, n_tokens)`` to ``file, block, separators``: where the separator stands
    in each block, as token numbers of the file."""
    width = np.dtype(dtype).itemsize
    blocks = files.filter(F.col("n_tokens") > 0).select(
        "file", "n_tokens",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_tokens") - 1) / block_tokens))).alias("block"),
    )
    # as many tasks as the tokens ask for: rows of blocks are few and small
    total = files.agg(F.sum(F.ceil(F.col("n_tokens") / block_tokens))).first()[0] or 0
    blocks = blocks.repartition(max(1, -(-int(total) // 4)), F.col("file"), F.col("block"))

    def run(batches):
        for batch in batches:
            for file, n, block in zip(*(c.to_pylist() for c in batch.columns)):
                first = block * block_tokens
                with RangeReader(file) as r:
                    raw = r.read(first * width, min(block_tokens, n - first) * width)
                at = np.flatnonzero(np.frombuffer(raw, dtype) == separator) + first
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file]), pa.array([block], pa.int64()), pa.array([at], pa.list_(pa.int64()))], schema=_BLOCK
                )

    return blocks.mapInArrow(run, "file string, block long, separators array<long>")


def token_counts(
    files: DataFrame, separator: int, dtype: str = "<u2", block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """One row per document of ``files(file, n_tokens)``: ``file, ordinal`` (from 0),
    ``start`` (token number), ``n_tokens`` (without the separator), ``complete``."""
    found = written(scan_separators(files, separator, dtype, block_tokens), "separators")
    summary = found.select("file", "block", F.size("separators").alias("n"), F.array_max("separators").alias("last"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        "file", "block",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ordinal0"),
        F.coalesce(F.max("last").over(before), F.lit(-1)).alias("last0"),
    )
    docs = found.filter(F.size("separators") > 0).join(carry, ["file", "block"])
    docs = docs.select(
        "file", "ordinal0", "separators",
        F.concat(F.array("last0"), F.slice("separators", 1, F.size("separators") - 1)).alias("previous"),
    )
    docs = docs.select("file", "ordinal0", F.posexplode(F.arrays_zip("separators", "previous")).alias("k", "s"))
    docs = docs.select(
        "file", (F.col("ordinal0") + F.col("k")).alias("ordinal"), (F.col("s.previous") + 1).alias("start"),
        (F.col("s.separators") - F.col("s.previous") - 1).alias("n_tokens"), F.lit(True).alias("complete"),
    )
    total = summary.groupBy("file").agg(F.sum("n").alias("ordinal"), F.coalesce(F.max("last"), F.lit(-1)).alias("last"))
    rest = files.select("file", F.col("n_tokens").alias("all")).join(total, "file")
    rest = rest.filter(F.col("all") > F.col("last") + 1).select(
        "file", "ordinal", (F.col("last") + 1).alias("start"), (F.col("all") - F.col("last") - 1).alias("n_tokens"),
        F.lit(False).alias("complete"),
    )
    return docs.unionByName(rest)


def free_id(tokenizer: str, separator: int) -> int:
    """The smallest id above the separator and all that the tokenizer gives."""
    return max(separator, *encoder(tokenizer).tok.get_vocab(with_added_tokens=True).values()) + 1


def document_token_counts(docs: DataFrame, tokenizer: str, separator: int, dtype: str = "<u2") -> DataFrame:
    """Write ``docs`` as flat token files, scan them, and give each count its document:
    ``doc_id, n_tokens``. Ids that do not fit ``dtype`` are written in 32 bits."""
    folder, stand_in = scratch_dir(docs.sparkSession, "token-files"), free_id(tokenizer, separator)
    if stand_in > np.iinfo(dtype).max:
        dtype = "<u4"
    files = written(
        write_token_files(docs, folder, tokenizer, separator, dtype, stand_in=stand_in), "token-file-names"
    )
    counts = token_counts(files.select("file", "n_tokens"), separator, dtype)
    owner = files.select("file", F.posexplode("doc_ids").alias("ordinal", "doc_id"))
    owner = owner.withColumn("ordinal", F.col("ordinal").cast("long"))
    return counts.join(owner.hint("merge"), ["file", "ordinal"]).select("doc_id", "n_tokens")
