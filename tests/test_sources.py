"""Bucketed history and zone files read by tasks."""

import csv
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gridcast.operators import monitor
from gridcast.sources import history as hist
from gridcast.sources import zones

SCHEMA = "zone string, for_date timestamp_ntz, actual double, pred_ensemble double"


def runs(spark, n=3):
    rows = [(z, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), 100.0 + h, 101.0 + h) for z in "ABC" for h in range(30)]
    return [(spark.createDataFrame(rows, SCHEMA).withColumn("pred_ensemble", F.col("pred_ensemble") + k), f"2024010{k + 1}_060000") for k in range(n)]


@pytest.mark.parametrize("by", [("zone", "for_date"), ("zone",)])
def test_bucketed_history_needs_no_exchange(spark, tmp_path, by):
    name = f"history_{len(by)}"
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain = None
        hist.open_history(spark, name, str(tmp_path / "h"), SCHEMA, by, buckets=4)
        for df, stamp in runs(spark):
            hist.history_insert(df, name, stamp)
            tagged = hist.tag_run(df, stamp)
            plain = tagged if plain is None else plain.unionByName(tagged)
        spark.sql(f"DROP TABLE {name}")  # the files stay, as for another session
        table = hist.open_history(spark, name, str(tmp_path / "h"), SCHEMA, by, buckets=4)
        latest = hist.history_latest(table)
        rows = lambda d: sorted(map(str, d.select("zone", "for_date", "actual", "pred_ensemble", "run_timestamp", "run_date").collect()))
        assert rows(latest) == rows(hist.history_latest(plain)) and table.count() == 270
        text = lambda d: d._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text(latest)
        bias = monitor.bias_compute(table)
        assert ("Exchange" in text(bias)) == (by != ("zone",))
        assert {r.zone: round(r.correction, 9) for r in bias.collect()} == {z: -2.0 for z in "ABC"}
        pruned = text(table.where("run_date = DATE'2024-01-02'"))
        assert "PartitionFilters: [isnotnull(run_date" in pruned
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_many_files_of_many_layouts(spark, tmp_path):
    """Three hundred files, quoted commas, a blank and a plus in the folder, and lines that cannot be read."""
    r = random.Random(3)
    root, want, bad, entries = tmp_path / "zone files+x", set(), set(), []
    root.mkdir()
    for k in range(300):
        names = ["for_date", "requirement", "Temp, W"][:2 + k % 2]
        r.shuffle(names)
        path = root / f"z{k}.csv"
        with open(path, "w", newline="") as f:
            w = csv.writer(f)
            w.writerow(names)
            for h in range(3):
                row = {"for_date": f"01/01/2024 {h:02d}:00:00", "requirement": str(k + h), "Temp, W": f"a,{h}"}
                w.writerow([row[n] for n in names])
                want.add((f"Z{k}", row["for_date"], row["requirement"], row["Temp, W"] if len(names) == 3 else None))
            if k % 50 == 0:
                w.writerow(["lone"])
                bad.add((f"Z{k}", "lone"))
        entries.append((f"Z{k}", "train", str(path)))
    registry = spark.createDataFrame(entries, "zone string, split string, path string")
    got = zones.scan_zone_csv(spark, registry)
    assert {(x.zone, x.for_date, x.requirement, x["Temp, W"]) for x in got.collect()} == want and got.count() == 900
    assert {(x.zone, x.line) for x in zones.scan_zone_csv(spark, registry, rejects=True).collect()} == bad
    with pytest.raises(ValueError):
        zones.scan_zone_csv(spark, registry, most_layouts=2)
    some = zones.scan_zone_csv(spark, registry.where("zone in ('Z1', 'Z2')"), root=str(root))
    assert {x.zone for x in some.select("zone").collect()} == {"Z1", "Z2"}


def test_empty_files_and_registry(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("for_date,requirement\n")
    entries = [("A", "train", str(tmp_path / "a.csv")), ("B", "train", str(tmp_path / "b.csv"))]
    registry = spark.createDataFrame(entries, "zone string, split string, path string")
    assert zones.scan_zone_csv(spark, registry, missing="skip").collect() == []
    assert zones.scan_zone_csv(spark, registry.limit(0)).collect() == []


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    """A folder per zone: a listing task has many of them, and lines are matched by their encoded path."""
    for k in range(150):
        (tmp_path / "zone files" / f"zone={k}").mkdir(parents=True)
        (tmp_path / "zone files" / f"zone={k}" / "a+b.csv").write_text(f"for_date,requirement\nd{k},{k}\n")
    entries = [(f"Z{k}", "train", str(tmp_path / "zone files" / f"zone={k}")) for k in range(150)]
    registry = spark.createDataFrame(entries, "zone string, split string, path string").coalesce(1)
    context = spark.sparkContext
    context.setJobGroup("folders", "")
    try:
        got = zones.scan_zone_csv(spark, registry)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert {(r.zone, r.for_date, r.requirement) for r in got.collect()} == {(f"Z{k}", f"d{k}", str(k)) for k in range(150)}
    status = context.statusTracker()
    stages = [status.getStageInfo(s) for j in status.getJobIdsForGroup("folders") for s in status.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s) <= max(100, 4 * context.defaultParallelism)
