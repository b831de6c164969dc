"""File-fed streams, each run to the end of the available input and safe to restart.

What a micro-batch delivers goes into tables by key (``upserts``), under its batch number, so a restart
neither loses nor doubles rows. Nothing is dropped for being late: slots may come in any number of files
and batches and may be delivered again; the newest delivery of a slot counts. Days and windows are
updated as batches come: each batch recomputes the days its slots lie in, and the windows over these
days, from the slots and days stored, and leaves all others untouched. Late rows thereby correct
windows that ended long ago. The ``read_*`` functions read these results, open days and windows included.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.config import DRIFT_DAYS, DRIFT_MAPE_PCT
from gridcast.functions.dates import parse_for_date
from gridcast.functions.scores import ape_masked, finite_or_null, is_realized
from gridcast.streaming.upserts import UpsertTable

SLOT = ["zone", "for_date"]
DAY = "date_format(for_date, 'yyyy-MM-dd')"


def _run(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    query = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def _slots(spark: SparkSession, out_dir: str) -> UpsertTable:
    """Slots as delivered; a file counts as newer than those written before it."""
    return UpsertTable(spark, f"{out_dir}/rows", "zone string, for_date timestamp_ntz, requirement double, arrived timestamp, file string",
                       SLOT, DAY, ["arrived", "batch", "file", "requirement"])


def _scored(spark: SparkSession, out_dir: str) -> UpsertTable:
    return UpsertTable(spark, f"{out_dir}/scores", "zone string, for_date timestamp_ntz, ape double", SLOT, DAY)


def _days(spark: SparkSession, out_dir: str) -> UpsertTable:
    """Sums per zone and day, in partitions by month."""
    return UpsertTable(spark, f"{out_dir}/days", "zone string, date date, s double, n bigint", ["zone", "date"], "date_format(date, 'yyyy-MM')")


def _windows(spark: SparkSession, out_dir: str) -> UpsertTable:
    return UpsertTable(spark, f"{out_dir}/windows", "zone string, window_start date, s double, n bigint", ["zone", "window_start"],
                       "date_format(window_start, 'yyyy-MM')")


def stream_ingest(
    spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, schema: T.StructType, files_per_batch: int = 64,
) -> None:
    """New zone files to ``out_dir``: parsed rows in ``rows``, those without a readable date in ``rejects``."""
    raw = (
        spark.readStream.schema(schema).option("header", True)
        .option("maxFilesPerTrigger", files_per_batch).csv(in_dir)
    )
    parsed = raw.select(
        "zone", F.col("for_date").alias("for_date_text"), parse_for_date(F.col("for_date")).alias("for_date"),
        F.col("requirement").alias("requirement_text"),
        finite_or_null(F.col("requirement").try_cast("double")).alias("requirement"),
        F.col("_metadata.file_modification_time").alias("arrived"), F.col("_metadata.file_path").alias("file"))
    slots = _slots(spark, out_dir)

    def write(batch: DataFrame, number: int) -> None:
        slots.append(batch.where("for_date IS NOT NULL"), number)
        bad = batch.where("for_date IS NULL").select("zone", "for_date_text", "requirement_text", "arrived", "file")
        bad.write.mode("overwrite").parquet(f"{out_dir}/rejects/batch={number}")

    _run(parsed, write, checkpoint)


def read_series(spark: SparkSession, out_dir: str) -> DataFrame:
    """(zone, for_date, requirement) as last delivered: a load replaces its placeholder."""
    return _slots(spark, out_dir).read().select(*SLOT, "requirement")


def read_rejects(spark: SparkSession, out_dir: str) -> DataFrame:
    """Delivered rows whose date could not be read, as they came."""
    schema = "zone string, for_date_text string, requirement_text string, arrived timestamp, file string, batch bigint"
    try:
        return spark.read.schema(schema).parquet(f"{out_dir}/rejects")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def _changed(df: DataFrame, table: UpsertTable) -> list[str]:
    """The partitions of ``table`` that rows of ``df`` lie in."""
    return [r[0] for r in df.select(table.part.alias("p")).distinct().collect()]


def _update(spark: SparkSession, apes: DataFrame, number: int, out_dir: str, window_days: int) -> None:
    """Store a batch of scored slots (zone, for_date, ape), then renew the days and windows they lie in."""
    slots, days, windows = _scored(spark, out_dir), _days(spark, out_dir), _windows(spark, out_dir)
    new = slots.append(apes, number).select("zone", F.to_date("for_date").alias("date")).distinct()
    stored = slots.read(_changed(new.withColumn("for_date", F.col("date").cast("timestamp_ntz")), slots))
    sums = stored.withColumn("date", F.to_date("for_date")).join(new, ["zone", "date"], "left_semi").groupBy("zone", "date").agg(
        F.sum("ape").alias("s"), F.count("ape").alias("n"))
    new = days.append(sums, number).select("zone", "date")
    if window_days:
        hit = new.select("zone", F.explode(F.sequence(F.date_sub("date", window_days - 1), "date")).alias("window_start")).distinct()
        spread = hit.select("zone", F.explode(F.sequence("window_start", F.date_add("window_start", window_days - 1))).alias("date"), "window_start")
        known = days.read(_changed(spread, days))
        windows.append(spread.join(known, ["zone", "date"]).groupBy("zone", "window_start").agg(
            F.sum("s").alias("s"), F.sum("n").alias("n")), number)


def _score(apes: DataFrame, out_dir: str, checkpoint: str, window_days: int = 0) -> None:
    spark = apes.sparkSession
    _run(apes, lambda batch, number: _update(spark, batch, number, out_dir, window_days), checkpoint)


def stream_daily_mape(
    actuals: DataFrame, predictions: DataFrame, pred: str, out_dir: str, checkpoint: str,
) -> None:
    """Scores of arriving actuals. ``actuals`` streams; ``predictions`` is a static table."""
    known = predictions.select("zone", F.col("for_date").cast("timestamp_ntz").alias("for_date"), F.col(pred).alias("_p"))
    dated = actuals.withColumn("for_date", F.col("for_date").cast("timestamp_ntz"))
    scored = dated.where(is_realized(F.col("actual"))).join(known, SLOT).select(
        *SLOT, ape_masked(F.col("actual"), F.col("_p")).alias("ape"))
    _score(scored, out_dir, checkpoint)


def read_daily_mape(spark: SparkSession, out_dir: str) -> DataFrame:
    """MAPE per zone and day over all realised slots so far; ``n_scored`` counts slots with a prediction."""
    return _days(spark, out_dir).read().select(
        "date", "zone", F.try_divide("s", "n").alias("daily_mape"), F.col("n").alias("n_scored"))


def stream_drift(apes: DataFrame, out_dir: str, checkpoint: str, days: int = DRIFT_DAYS) -> None:
    """Errors of realised slots as they arrive: (zone, for_date, ape), kept in windows of ``days`` days,
    one of which begins on every day."""
    _score(apes.select("zone", F.col("for_date").cast("timestamp_ntz").alias("for_date"), "ape"), out_dir, checkpoint, days)


def read_drift(spark: SparkSession, out_dir: str, threshold: float = DRIFT_MAPE_PCT) -> DataFrame:
    """Mean APE over every window that any slot lies in, with the drift verdict."""
    return _windows(spark, out_dir).read().select(
        "zone", "window_start", F.try_divide("s", "n").alias("recent_mape")).withColumn("drift", F.col("recent_mape") > threshold)
