"""As-of join against looking every row up."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gridcast.operators.asof import as_of_join
from gridcast.operators.ordered import EQUAL

T0 = dt.datetime(2024, 1, 1)


def sides(seed):
    r = random.Random(seed)
    stamp = lambda: None if r.random() < 0.05 else T0 + dt.timedelta(days=r.choice([0, 0, 1, 2, 30, 31, 200]), hours=r.randrange(24))
    zone = lambda: r.choice(["A", "A", "A", "B", None, "left", "C"])
    return [(zone(), stamp(), i) for i in range(200)], [(z if z != "left" else "right", stamp(), r.randrange(5), r.choice([None, 1.5, 2.5])) for z in (zone() for _ in range(150))]


def brute(left, right, strict, within):
    out = []
    low = lambda v: (v is not None, v or 0)
    for z, t, i in left:
        hits = [(s, o, low(v), v) for z2, s, o, v in right if t and s and z2 == z and (s < t if strict else s <= t)]
        best = max(hits, key=lambda h: h[:3], default=None)
        if best and within and best[0] < t - within:
            best = None
        out.append((i, best and best[0], best and best[3]))
    return sorted(out)


@pytest.mark.parametrize("seconds", [3600, 7 * 86400, EQUAL])
@pytest.mark.parametrize("strict,within", [(False, None), (True, None), (False, "2 days")])
def test_equals_a_lookup_of_every_row(spark, seconds, strict, within):
    left, right = sides(seconds + strict)
    a = spark.createDataFrame(left, "zone string, t timestamp_ntz, id long").repartition(5)
    b = spark.createDataFrame(right, "zone string, s timestamp_ntz, o long, v double").repartition(3)
    got = as_of_join(a, b, ["zone"], "t", "s", ["v"], ties=["o"], strict=strict, within=within, seconds=seconds)
    assert got.columns == ["zone", "t", "id", "s_found", "v"]
    assert sorted((r.id, r.s_found, r.v) for r in got.collect()) == brute(left, right, strict, within and dt.timedelta(days=2))


def test_without_right_rows(spark):
    left, _ = sides(1)
    a = spark.createDataFrame(left, "zone string, t timestamp_ntz, id long")
    b = spark.createDataFrame([], "zone string, s timestamp_ntz, v double")
    assert {r.v for r in as_of_join(a, b, ["zone"], "t", "s", ["v"]).collect()} == {None}
    assert as_of_join(a.limit(0), b, ["zone"], "t", "s", ["v"]).collect() == []


def test_one_zone_is_spread_over_tasks(spark):
    rows = spark.range(20_000).select(F.lit("A").alias("zone"), F.timestamp_seconds(F.col("id") * 1800).cast("timestamp_ntz").alias("t"), "id")
    out = as_of_join(rows, rows.select("zone", F.col("t").alias("s"), F.col("id").alias("v")), ["zone"], "t", "s", ["v"], strict=True)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 10_000 and out.where("v is null or v <> id - 1").count() == 1
