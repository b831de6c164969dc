"""Inputs of the registered queries, derived from the given tables.

A zone is a feeder of ten users; its load is the half-hour sum of their events. So zones, rows and
work grow with ``events``. Loads are kept on multiples of 1/64, which double sums hold exactly.
Other inputs keep single events or orders as rows, where a zone holds a fifth of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.config import LAG_COLUMNS
from gridcast.functions.blend import simple_average, weighted_average
from gridcast.functions.dates import timestamp
from gridcast.functions.scores import add_ape, is_realized
from gridcast.operators.features import add_clock_lags, time_grid
from gridcast.operators.forecast import trailing_mean
from gridcast.sources.history import tag_run

START, END = "2024-01-01 00:00:00", "2024-01-30 23:30:00"
SPLIT, NOW = "2024-01-25 00:00:00", "2024-01-28 12:00:00"
RUN_DATE = "2024-01-28"
ORDER_SPLIT = "2001-01-01 00:00:00"
RUNS = (("20240126_060000", "2024-01-26 06:00:00", 1.0),
        ("20240127_060000", "2024-01-27 06:00:00", 1.02),
        ("20240127_180000", "2024-01-27 18:00:00", 0.98))
HOLIDAYS = ("2024-01-01", "2024-01-16", "2024-01-26")
MODELS = {"M1": "pred_m1", "M2": "pred_m2", "M3": "pred_m3",
          "Ensemble_M1_M2_M3": "pred_ensemble", "Ensemble_M1_M2": "pred_ensemble_m1_m2"}
WEIGHTS = {"pred_m1": 0.5, "pred_m2": 0.3, "pred_m3": 0.2}
PREDS = tuple(WEIGHTS)


def exact64(c: Column) -> Column:
    return F.round(c * 64) / 64


def feeder() -> Column:
    return F.concat(F.lit("Z"), F.lpad(F.expr("CAST(user_id DIV 10 AS STRING)"), 7, "0"))


def slot(ts: str) -> Column:
    """Start of the half hour a stamp falls in."""
    return F.expr(f"{ts} - make_dt_interval(0, 0, minute({ts}) % 30, extract(SECOND FROM {ts}))")


def events(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/events.parquet")


def load_30m(spark: SparkSession, sf: str) -> DataFrame:
    """(zone, for_date, requirement) on the full half-hour grid; 0 where nothing was measured.

    Events and empty slots meet in one aggregate, so the grid costs no join.
    """
    table = events(spark, sf)
    e = table.select(feeder().alias("zone"), slot("ts").alias("for_date"), "value")
    grid = time_grid(feeders(table), timestamp(START), timestamp(END))
    return e.unionByName(grid.withColumn("value", F.lit(0.0))).groupBy("zone", "for_date").agg(
        exact64(F.sum("value")).alias("requirement"))


def feeders(table: DataFrame) -> DataFrame:
    return table.select(feeder().alias("zone")).distinct()


def split_of(date: str = "for_date", at: str = SPLIT) -> Column:
    return F.when(F.col(date) < timestamp(at), "train").otherwise("test")


def masked_load(spark: SparkSession, sf: str) -> DataFrame:
    """The load with placeholders from NOW on."""
    return load_30m(spark, sf).withColumn(
        "requirement", F.when(F.col("for_date") >= timestamp(NOW), 0.0).otherwise(F.col("requirement")))


def masked(spark: SparkSession, sf: str) -> DataFrame:
    return with_split(masked_load(spark, sf))


def with_split(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c not in ("zone", "for_date")]
    return df.select("zone", "for_date", split_of().alias("split"), *rest)


def features(spark: SparkSession, sf: str, *lags: str) -> DataFrame:
    names = lags or tuple(n for n in LAG_COLUMNS if n != "REQUIREMENT_LAG_4D")
    return with_split(add_clock_lags(masked_load(spark, sf), {n: LAG_COLUMNS[n] for n in names}, unique=True))


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Test slots with three model columns; the third has a warm-up of five nulls."""
    f = features(spark, sf, "REQ_LAST168H", "REQ_LAST336H").where(F.col("split") == "test")
    base = f.select(
        "zone", "for_date", F.col("requirement").alias("actual"), F.col("REQ_LAST168H").alias("pred_m1"),
        ((F.col("REQ_LAST168H") + F.col("REQ_LAST336H")) / 2).alias("pred_m2"),
        F.hour("for_date").between(9, 21).cast("int").alias("is_peak"))
    return trailing_mean(base, "pred_m1", 6, ["zone"], grid=True, out="pred_m3").select(
        "zone", "for_date", "actual", *PREDS, "is_peak")


def blended(spark: SparkSession, sf: str) -> DataFrame:
    return with_ensembles(predictions(spark, sf))


def with_ensembles(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "pred_ensemble": weighted_average(WEIGHTS),
        "pred_ensemble_m1_m2": weighted_average({"pred_m1": 0.5, "pred_m2": 0.5}),
    })


def standalone(spark: SparkSession, sf: str) -> DataFrame:
    """The predictions in the standalone form: ``reg``, null instead of 0 for unrealised slots."""
    a = F.col("actual")
    p = predictions(spark, sf)
    return p.select(
        F.col("zone").alias("reg"), "for_date", F.when(is_realized(a), a).alias("actual"), *PREDS,
        simple_average(PREDS).alias("pred_ensemble"), "is_peak")


def by_config(spark: SparkSession, sf: str) -> DataFrame:
    """The standalone predictions under two configs, which use the first and the second model."""
    configs = F.array(F.struct(F.lit("org").alias("config"), F.col("pred_m1").alias("pred")),
                      F.struct(F.lit("tuned").alias("config"), F.col("pred_m2").alias("pred")))
    return standalone(spark, sf).select("reg", "for_date", "actual", "is_peak", F.inline(configs))


def history(spark: SparkSession, sf: str, given: DataFrame | None = None) -> DataFrame:
    """Three runs over the test slots; a run sees no actual at or after its own time. ``given`` are the
    predictions, where they are at hand."""
    runs = F.array(*[F.struct(F.lit(r).alias("run_timestamp"), timestamp(t).alias("_at"), F.lit(f).alias("_f"))
                     for r, t, f in RUNS])
    rows = (predictions(spark, sf) if given is None else given).select("*", F.inline(runs))
    factored = rows.withColumns({p: F.col(p) * F.col("_f") for p in PREDS}).withColumn(
        "actual", F.when(F.col("for_date") >= F.col("_at"), 0.0).otherwise(F.col("actual")))
    return with_ensembles(tag_run(factored.drop("_at", "_f"), F.col("run_timestamp"))).drop("is_peak")


def scored_log(spark: SparkSession, sf: str) -> DataFrame:
    """History with the ensemble's APE, null where the slot is not realised."""
    return add_ape(history(spark, sf), ["pred_ensemble"]).withColumnRenamed("ape_pred_ensemble", "ape_ensemble")


def raw_series(spark: SparkSession, sf: str) -> DataFrame:
    """The load as the files carry it: text dates (some lenient, some broken), text numbers."""
    d = F.col("for_date")
    text = (
        F.when((F.minute(d) == 30) & (F.dayofmonth(d) == 13), F.lit("not a date"))
        .when(F.dayofmonth(d) == 14, F.date_format(d, "d/M/yyyy H:mm"))
        .otherwise(F.date_format(d, "dd/MM/yyyy HH:mm:ss")))
    number = F.when((F.hour(d) == 3) & (F.dayofmonth(d) == 5), F.lit("n/a")).when(
        (F.hour(d) == 4) & (F.dayofmonth(d) == 5), F.lit("Infinity")).otherwise(
        F.col("requirement").cast("decimal(18,6)").cast("string"))
    return masked(spark, sf).select(
        "zone", "split", text.alias("for_date"), number.alias("requirement"),
        (F.hour(d) >= 18).alias("flag"), F.col("zone").alias("reg"))


def readings(spark: SparkSession, sf: str) -> DataFrame:
    """Single events as an uneven series; a zone is an event type and holds a fifth of all rows."""
    return events(spark, sf).select(
        F.col("event_type").alias("zone"), F.col("ts").alias("for_date"), "event_id",
        exact64(F.col("value")).alias("requirement"))


def orders(spark: SparkSession, sf: str) -> DataFrame:
    """Single orders as a multi-year series; a zone is a region and holds a fifth of all rows."""
    t = {n: spark.read.parquet(f"{sf}/{n}.parquet") for n in ("orders", "customer", "nation", "region")}
    return (
        t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
        .join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("r_name").alias("zone"), F.col("o_orderdate").alias("for_date"), "o_orderkey",
                split_of("o_orderdate", ORDER_SPLIT).alias("split"),
                exact64(F.col("o_totalprice")).alias("requirement"), "o_orderpriority", "o_orderstatus"))


def holidays(spark: SparkSession) -> DataFrame:
    values = ", ".join(f"(DATE'{d}')" for d in HOLIDAYS)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(date)")


def registry(spark: SparkSession, sf: str) -> DataFrame:
    """The zones seen in the data, plus one that has no file."""
    return feeders(events(spark, sf)).unionByName(spark.sql("SELECT * FROM VALUES ('Z_EMPTY') AS t(zone)"))
