"""Prediction history, stored weights, adaptation log and run manifest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.config import RUN_STAMP
from gridcast.functions.scores import is_realized

LOG_SCHEMA = "timestamp timestamp_ntz, event_type string, zone string, detail string, value double"


def tag_run(df: DataFrame, run_ts: str | Column) -> DataFrame:
    ts = F.lit(run_ts) if isinstance(run_ts, str) else run_ts
    return df.withColumn("run_timestamp", ts).withColumn(
        "run_date", F.to_date(F.try_to_timestamp(F.col("run_timestamp"), F.lit(RUN_STAMP))))


def history_append(df: DataFrame, path: str, run_ts: str | Column) -> None:
    """Add a run to the history without reading it back; one folder per run date."""
    tag_run(df, run_ts).write.mode("append").partitionBy("run_date").parquet(path)


def open_history(
    spark: SparkSession, name: str, path: str, schema: str, by: Sequence[str] = ("zone", "for_date"), buckets: int = 64,
) -> DataFrame:
    """The history at ``path`` as a table ``name`` of the catalog, made if it is not there: a folder per run
    date, and inside it files by the hash of ``by``, so that aggregates over these columns need no exchange.

    ``by=("zone",)`` spares bias and weights theirs as well, but puts all rows of a zone into one task;
    the default spreads a zone, and a sum per zone then exchanges its partial sums only.
    ``schema`` names the columns besides ``run_timestamp`` and ``run_date``.
    """
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    columns = ", ".join(f"`{c}`" for c in by)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema}, run_timestamp string, run_date date) USING parquet "
        f"PARTITIONED BY (run_date) CLUSTERED BY ({columns}) SORTED BY ({columns}) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")  # run dates that other sessions have written
    return spark.table(name)


def history_insert(df: DataFrame, name: str, run_ts: str | Column) -> None:
    """Add a run to a table of :func:`open_history`, in the table's own files."""
    spark = df.sparkSession
    detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED {name}").collect()}
    by = [c.strip(" `[]") for c in detail["Bucket Columns"].split(",")]
    tag_run(df, run_ts).select(spark.table(name).columns).write.mode("append").partitionBy("run_date").bucketBy(
        int(detail["Num Buckets"]), *by).sortBy(*by).option("path", detail["Location"]).saveAsTable(name)


def history_latest(history: DataFrame, keys: tuple[str, ...] = ("for_date", "zone")) -> DataFrame:
    """The newest run's row per key; of several in one run, the largest. ``max_by`` combines before
    the shuffle; no sort is needed."""
    rest = [c for c in history.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct("run_timestamp", *[c for c in rest if c != "run_timestamp"]))
    return history.groupBy(*keys).agg(newest.alias("_r")).select(*keys, "_r.*").select(*history.columns)


def read_history(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The history table, or an empty one of that schema if no run was stored yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def scored_history(history: DataFrame, dedup: str | None = None) -> DataFrame:
    """Realised rows. Rows of several runs for one slot all count unless ``dedup='latest'``."""
    rows = history_latest(history) if dedup == "latest" else history
    return rows.where(is_realized(F.col("actual")))


def weights_load(stored: DataFrame, default: Mapping[str, float]) -> DataFrame:
    """One row of weights: the newest stored set if it names the same models, else the default.

    ``stored`` has (weights map<string,double>, mape_at_optimum, n_rows_used, updated_at).
    """
    names = F.array_sort(F.array(*[F.lit(m) for m in default]))
    latest = stored.agg(F.max_by("weights", "updated_at").alias("w"))
    usable = F.array_sort(F.map_keys("w")) == names
    return latest.select(*[
        F.when(usable, F.element_at("w", m)).otherwise(F.lit(float(v))).alias(m) for m, v in default.items()])


def log_events(
    df: DataFrame, event_type: str | Column, detail: Column, value: Column, now: Column,
    zone: Column | None = None,
) -> DataFrame:
    """Rows of ``df`` as adaptation-log events."""
    kind = F.lit(event_type) if isinstance(event_type, str) else event_type
    return df.select(
        now.alias("timestamp"), kind.alias("event_type"),
        (F.col("zone") if zone is None else zone).alias("zone"),
        detail.alias("detail"), value.cast("double").alias("value"))


def adapt_log(*events: DataFrame) -> DataFrame:
    out = events[0]
    for e in events[1:]:
        out = out.unionByName(e)
    return out


def run_manifest(
    run_ts: str, registry: DataFrame, predictions: DataFrame, drift: DataFrame,
) -> DataFrame:
    """Run summary as (run_timestamp, item, zone, value) rows.

    Zone lists are rows, not arrays, so a large registry never meets in one cell.
    """
    per_zone = predictions.groupBy("zone").agg(F.count("*").alias("value"))
    ok = per_zone.select(F.lit("zones_ok").alias("item"), "zone", "value")
    failed = registry.select("zone").distinct().join(per_zone, "zone", "left_anti").select(
        F.lit("zones_failed").alias("item"), "zone", F.lit(0).cast("long").alias("value"))
    drifted = drift.where("drift").select(
        F.lit("drift_detected").alias("item"), "zone", F.lit(1).cast("long").alias("value"))
    total = per_zone.agg(F.coalesce(F.sum("value"), F.lit(0)).cast("long").alias("value")).select(
        F.lit("rows").alias("item"), F.lit("ALL").alias("zone"), "value")
    return ok.unionByName(failed).unionByName(drifted).unionByName(total).select(
        F.lit(run_ts).alias("run_timestamp"), "item", "zone", "value")
