"""Token counts of the documents in flat token files, found by their end-of-document ids.

The files are nothing but ids of a fixed width, without an index. They are cut into blocks of equal
size; each block is searched for the separator by one vectorised comparison and leaves a small
summary (separators seen, where the last one ended, lengths of the documents that lie inside). A
prefix scan over the summaries, first over groups of blocks and then inside each group, gives every
block the number of documents before it and the ids that its first document has in earlier blocks.

Defined cases: an empty file has no documents; two separators in a row enclose a document of 0 ids;
ids after the last separator are a document that is not ``closed``; a file whose size is no whole
number of ids is an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridcast.llm.common import materialize, shared_dir
from gridcast.llm.textscan import as_bytes
from gridcast.llm.tokens import VOCABULARY, encoder, read_vocabulary

BLOCK_BYTES, GROUP = 8 << 20, 4096
#: Big-endian 16-bit ids. The separator is the first id behind the padded vocabulary whose two bytes
#: are a character of their own (C4 80), which Spark's text writer can put between documents.
DTYPE, SEPARATOR = ">u2", 0xC480


def write_flat(docs: DataFrame, path: str, text: str = "text", vocabulary: str = VOCABULARY, dtype: str = DTYPE,
               separator: int = SEPARATOR) -> None:
    """The ids of all documents, each followed by the separator, in flat files (one per partition).

    Written by Spark's text writer, so a lost task is repeated without leaving half a file. For that
    the separator's bytes must be valid UTF-8.
    """
    closing = np.array([separator], dtype).tobytes().decode("utf-8")
    files = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(files.value, dtype)
        for batch in batches:
            ids, counts = bpe.encode(as_bytes(batch.column(0)))
            raw, ends = ids.tobytes(), np.cumsum(counts) * np.dtype(dtype).itemsize
            rows = [raw[s:e] for s, e in zip([0, *ends[:-1].tolist()], ends.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["value"])

    rows = docs.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(run, "value binary")
    rows.select(F.col("value").cast("string").alias("value")).write.option("lineSep", closing).text(path)


def _read(path: str, start: int, size: int) -> bytes:
    from pyarrow import fs

    if path.startswith("file:") or path.startswith("/"):
        store, name = fs.LocalFileSystem(), re.sub("^file:/*", "/", path)
    else:
        store, name = fs.FileSystem.from_uri(path)
    with store.open_input_file(name) as f:
        return f.read_at(size, start)


def count_tokens(spark: SparkSession, path: str, dtype: str = DTYPE, separator: int = SEPARATOR,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(path, ordinal, start, n_tokens, closed) for every document in the flat files under ``path``."""
    width = np.dtype(dtype).itemsize
    block_bytes -= block_bytes % width
    per_block = block_bytes // width
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    files = files.where(F.when(F.col("length") % width == 0, F.col("length") > 0).otherwise(
        F.raise_error(F.concat(F.lit("not a whole number of ids: "), "path")).cast("boolean")))
    blocks = files.select("path", "length", F.explode(F.expr(f"sequence(0L, (length - 1) DIV {block_bytes}L)")).alias("block"))
    n_blocks = files.agg(F.sum(F.expr(f"(length - 1) DIV {block_bytes}L + 1"))).first()[0] or 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(_read(row["path"], row["block"] * block_bytes, block_bytes), dtype)
                at = np.flatnonzero(ids == separator)
                last = int(at[-1]) + 1 + row["block"] * per_block if len(at) else None
                head = int(at[0]) if len(at) else None
                base = row["block"] * per_block
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["path"]]), pa.array([row["block"]], pa.int64()), pa.array([row["length"]], pa.int64()),
                    pa.array([len(at)], pa.int64()), pa.array([head], pa.int64()), pa.array([last], pa.int64()),
                    pa.array([np.diff(at) - 1], pa.list_(pa.int64())), pa.array([at[:-1] + 1 + base], pa.list_(pa.int64()))],
                    ["path", "block", "length", "n", "head", "last", "inside", "starts"])

    summary = materialize(blocks.repartition(int(-(-n_blocks // 4))).mapInArrow(
        run, "path string, block long, length long, n long, head long, last long, inside array<long>, starts array<long>"))
    summary = summary.withColumn("grp", F.expr(f"block DIV {GROUP}"))
    before = Window.partitionBy("path").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    groups = summary.groupBy("path", "grp").agg(F.sum("n").alias("n"), F.max("last").alias("last")).select(
        "path", "grp", F.sum("n").over(before).alias("n0"), F.max("last").over(before).alias("last0"))
    inner = Window.partitionBy("path", "grp").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    placed = summary.join(groups, ["path", "grp"]).select(
        "path", "block", "n", "head", "inside", "starts", "last", "length",
        (F.coalesce(F.sum("n").over(inner), zero) + F.coalesce("n0", zero)).alias("seen"),
        F.coalesce(F.max("last").over(inner), "last0", zero).alias("begun"))
    first = F.array(F.col("block") * per_block + F.col("head") - F.col("begun"))
    found = F.arrays_zip(F.concat(F.array("begun"), "starts").alias("start"), F.concat(first, "inside").alias("n"))
    docs = placed.where("n > 0").select("path", "seen", F.posexplode(found).alias("i", "d")).select(
        "path", (F.col("seen") + F.col("i")).alias("ordinal"), F.col("d.start").alias("start"),
        F.col("d.n").alias("n_tokens"), F.lit(True).alias("closed"))
    total = F.col("length") / width
    rest = placed.groupBy("path").agg(
        F.sum("n").alias("ordinal"), F.coalesce(F.max("last"), zero).alias("start"),
        F.first("length").alias("length")).where(F.col("start") < total).select(
        "path", "ordinal", "start", (total.cast("long") - F.col("start")).alias("n_tokens"), F.lit(False).alias("closed"))
    return docs.unionByName(rest)


def report(docs: DataFrame) -> DataFrame:
    """Writes ``docs`` as flat token files into the shared folder and counts them there: one row per
    document, named by file number and place in the file."""
    path = shared_dir(docs.sparkSession)
    write_flat(docs, path)
    found = count_tokens(docs.sparkSession, path)
    return found.select(F.regexp_extract("path", r"part-(\d+)", 1).cast("int").alias("part"),
                        "ordinal", "start", "n_tokens", "closed")
