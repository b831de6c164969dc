"""Zone registry and zone files."""

from __future__ import annotations

import csv
import os
from collections.abc import Iterator, Mapping

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.functions.dates import parse_for_date
from gridcast.session import listing, materialize


def zone_registry(spark: SparkSession, paths: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """``{zone: {"train": path, "test": path}}`` as a (zone, split, path) table."""
    rows = [(z, s, p) for z, splits in paths.items() for s, p in splits.items()]
    return spark.createDataFrame(rows, "zone string, split string, path string")


def _plain(path: Column) -> Column:
    """A path without the scheme of local files and without a slash at its end."""
    return F.regexp_replace(F.regexp_replace(path, "^file:/+", "/"), "(?<=.)/+$", "")


def _lines(spark: SparkSession, root: str) -> DataFrame:
    """(file, start, line) of all files below ``root``, which may be a file itself; ``file`` is the encoded path."""
    with listing(spark):
        text = spark.read.option("recursiveFileLookup", True).text(root)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))


def _given(file: Column) -> Column:
    """The path as it was given, without its encoding. For one row per file, since it costs more than reading a line."""
    return _plain(F.try_url_decode(F.replace(file, F.lit("+"), F.lit("%2B"))))


def _headers(lines: DataFrame) -> DataFrame:
    """(file, path, header): each file's first line, found by the tasks that read the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:  # the lines of a file follow each other
            files = pc.run_end_encode(batch.column(0))
            at, firsts = 0, []
            for file, end in zip(files.values.to_pylist(), files.run_ends.to_pylist()):
                if file != last:
                    firsts.append(at)
                last, at = file, end
            yield batch.take(pa.array(firsts, pa.int64()))

    heads = lines.where("start = 0").select("file", "line").mapInArrow(run, "file string, line string")
    return heads.select("file", _given(F.col("file")).alias("path"), F.col("line").alias("header"))


def _root(registry: DataFrame) -> str | None:
    """The folder (or file) that holds all registered paths: what the first and the last in order share."""
    first, last = registry.agg(F.min(_plain(F.col("path"))), F.max(_plain(F.col("path")))).first()
    if first is None or first == last:
        return first
    same = os.path.commonprefix([first + "/", last + "/"])
    return same[:same.rindex("/")] or "/"


def _by_name(columns: list[str], names: list[str]):
    """From a parsed line of a file with these columns to one value per name."""
    def cells(x: Column) -> Column:
        return F.struct(x["bad"].alias("bad"), *[
            (x[f"c{columns.index(n)}"] if n in columns else F.lit(None).cast("string")).alias(f"v{k}") for k, n in enumerate(names)])
    return cells


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def scan_zone_csv(
    spark: SparkSession, registry: DataFrame, missing: str = "error", root: str | None = None, rejects: bool = False,
    most_layouts: int = 1000,
) -> DataFrame:
    """All registered files, every column as text, each row tagged with its zone and split.

    ``registry(zone, split, path)`` names files or folders below ``root`` (by default the folder that holds
    them all); train and test files may lie side by side. Columns are matched by name, so files may order them differently; a column that a file
    lacks is null. Registered paths without a file are an error, unless ``missing`` is "skip"
    (:func:`zones_failed` reports zones without rows). With ``rejects``, lines whose number of values is not
    that of their file's header come as (zone, split, path, line) instead of the others.

    Files are opened by tasks only: one scan picks the header lines, which meet the registry by path, and
    one scan reads the rows. The driver sees the distinct header lines, not the files.
    """
    registry = registry.select("zone", "split", _plain(F.col("path")).alias("path"))
    root = root or _root(registry)
    if root is None or not _exists(spark, root):
        absent = [r.path for r in registry.select("path").limit(6).collect()]
        if missing == "error" and absent:
            raise FileNotFoundError(f"registered without a file: {absent[:5]}")
        return registry.select("zone", "split").limit(0)
    lines = _lines(spark, root)
    heads = materialize(_headers(lines))
    # a file belongs to the entry of its own path or of a folder above it
    parts = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    reach = heads.select("file", "path", "header", F.explode(above).alias("entry"))
    own = materialize(reach.join(registry.withColumnRenamed("path", "entry"), "entry").select("file", "path", "header", "entry", "zone", "split"))
    if missing == "error":
        absent = [r.path for r in registry.join(own.select(F.col("entry").alias("path")), "path", "left_anti").select("path").limit(6).collect()]
        if absent:
            raise FileNotFoundError(f"registered without a file: {absent[:5]}{' and others' if len(absent) > 5 else ''}")
    layouts = [r.header for r in own.select("header").distinct().limit(most_layouts + 1).collect()]
    if len(layouts) > most_layouts:
        raise ValueError(f"more than {most_layouts} different header lines")
    if not layouts:
        return registry.select("zone", "split").limit(0)
    columns = {h: next(csv.reader([h])) for h in sorted(layouts)}
    names = list(dict.fromkeys(c for cs in columns.values() for c in cs))
    value = F.lit(None)
    for header, cs in columns.items():
        schema = ", ".join(f"`c{i}` string" for i in range(len(cs))) + ", `bad` string"
        row = F.from_csv("line", schema, {"columnNameOfCorruptRecord": "bad", "mode": "PERMISSIVE"})
        # inside a lambda, so that a line is parsed once however many cells are taken
        wide = F.transform(F.array(row), _by_name(cs, names))[0]
        value = F.when(F.col("header") == header, wide).otherwise(value)
    rows = lines.join(own.select("file", "path", "header", "zone", "split"), "file").where("not (start = 0 and line = header) and trim(line) <> ''")
    rows = rows.select("zone", "split", "path", "line", value.alias("_v"))
    if rejects:
        return rows.where("_v.bad is not null").select("zone", "split", "path", "line")
    return rows.where("_v.bad is null").select(*[F.col(f"_v.v{k}").alias(n) for k, n in enumerate(names)], "zone", "split")


def parse_dates(df: DataFrame, column: str = "for_date") -> DataFrame:
    return df.withColumn(column, parse_for_date(F.col(column)))


def sort_series(df: DataFrame, date: str = "for_date", *ties: str) -> DataFrame:
    """Rows by date, null dates last. For sinks only; operators order inside their windows."""
    return df.orderBy(F.col(date).asc_nulls_last(), *ties)


def union_zones(*frames: DataFrame) -> DataFrame:
    """Stack zone results by column name; a column one frame lacks becomes null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def zones_failed(registry: DataFrame, done: DataFrame) -> DataFrame:
    """Registered zones without a result row."""
    return registry.select("zone").distinct().join(done.select("zone").distinct(), "zone", "left_anti")
