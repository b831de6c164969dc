"""Upsert tables and the streams on top of them, against recomputing everything."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from gridcast.streaming import streams
from gridcast.streaming.upserts import UpsertTable

SCHEMA = "k string, d date, v long"


def table(spark, path, **kw):
    return UpsertTable(spark, str(path), SCHEMA, ["k", "d"], "date_format(d, 'yyyy-MM-dd')", **kw)


def deliveries(seed, batches):
    r = random.Random(seed)
    return [[(r.choice("ab") if r.random() > 0.05 else None, dt.date(2024, 1, r.randrange(1, 9)), r.randrange(100))
             for _ in range(r.randrange(0, 12))] for _ in range(batches)]


def newest(batches):
    out = {}
    for rows in batches:
        now = {}
        for k, d, v in rows:
            now[k, d] = max(v, now.get((k, d), v))
        out |= now
    return sorted(((str(k), d, v) for (k, d), v in out.items()))


def rows_of(t, parts=None):
    return sorted((str(r.k), r.d, r.v) for r in t.read(parts).collect())


@pytest.mark.parametrize("every", [3, 100])
def test_table_holds_the_newest_rows(spark, tmp_path, every):
    batches = deliveries(every, 8)
    t = table(spark, tmp_path, merge_every=every)
    for n, rows in enumerate(batches):
        t.append(spark.createDataFrame(rows, SCHEMA), n)
        if n % 3 == 1:  # a batch that is repeated changes nothing, merged or not
            t.append(spark.createDataFrame(rows, SCHEMA), n)
    assert rows_of(t) == newest(batches)
    assert rows_of(t, ["2024-01-03"]) == [r for r in newest(batches) if r[1].day == 3]
    assert len(t.open_batches()) < every or every == 100
    t.merge()
    t.vacuum()
    assert t.open_batches() == [] and rows_of(t) == newest(batches)
    late = [("a", dt.date(2024, 1, 2), 7)]
    t.append(spark.createDataFrame(late, SCHEMA), 50)
    assert rows_of(t) == newest([*batches, late])


def test_read_costs_the_base_and_the_open_deltas(spark, tmp_path):
    """Untouched partitions come without an exchange, and a merge rewrites touched ones only."""
    t = table(spark, tmp_path, merge_every=100)
    for n, rows in enumerate([[("a", dt.date(2024, 1, d), d)] for d in range(1, 9)]):
        t.append(spark.createDataFrame(rows, SCHEMA), n)
    t.merge()
    assert "Exchange" not in t.read()._jdf.queryExecution().executedPlan().toString().split("Union")[0]
    t.append(spark.createDataFrame([("a", dt.date(2024, 1, 4), 99)], SCHEMA), 8)
    alone, mixed = t._state(None)
    assert "Exchange" not in alone._jdf.queryExecution().executedPlan().toString() and alone.count() == 7
    assert {os.path.basename(os.path.dirname(r[0])) for r in mixed.select(F.input_file_name()).collect()} == {"_part=2024-01-04"}
    t.merge()
    assert os.listdir(tmp_path / "base" / "_v=8") and {x for x in os.listdir(tmp_path / "base" / "_v=8") if "part" in x} == {"_part=2024-01-04"}
    assert rows_of(t) == newest([[("a", dt.date(2024, 1, d), 99 if d == 4 else d)] for d in range(1, 9)])


def test_broken_merge_changes_nothing(spark, tmp_path):
    batches = deliveries(5, 4)
    t = table(spark, tmp_path, merge_every=100)
    for n, rows in enumerate(batches):
        t.append(spark.createDataFrame(rows, SCHEMA), n)
    spark.createDataFrame([("z", dt.date(2024, 1, 1), 1, 3, "2024-01-01")], SCHEMA + ", batch long, _part string").write.partitionBy(
        "_part").parquet(str(tmp_path / "base" / "_v=3"))  # written, but no head names it
    assert rows_of(t) == newest(batches)
    t.merge()
    assert rows_of(t) == newest(batches)


def test_empty_table(spark, tmp_path):
    t = table(spark, tmp_path)
    assert t.read().collect() == [] and t.open_batches() == []
    t.merge()
    t.append(spark.createDataFrame([], SCHEMA), 0)
    assert t.read().collect() == []


def slots(seed, n):
    r = random.Random(seed)
    return [(r.choice("AB"), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=30 * r.randrange(48 * 6)), float(r.randrange(1, 40)) / 4) for _ in range(n)]


def expected_days(rows):
    last, out = {}, {}
    for z, t, a in rows:
        last[z, t] = a
    for (z, t), a in last.items():
        out.setdefault((z, t.date()), []).append(a)
    return {k: (sum(v), len(v)) for k, v in out.items()}


@pytest.mark.parametrize("files", [1, 3, 40])
def test_windows_equal_a_recompute_for_any_cut(spark, tmp_path, files):
    """Late files correct windows that ended long ago; only windows over changed days are written."""
    rows = slots(files, 240)
    chunks = [rows[i::files] for i in range(files)] + [[("A", dt.datetime(2024, 1, 1), 100.0)]]
    schema = "zone string, for_date timestamp_ntz, ape double"
    os.makedirs(tmp_path / "in")
    live = spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(f"{tmp_path}/in")
    delivered = []
    for chunk in ([sum(chunks[:-1], [])] if files == 1 else chunks[:-1]) + [chunks[-1]]:
        fresh = list({(z, t): (z, t, a) for z, t, a in chunk}.values())  # a slot once per file
        delivered += fresh
        spark.createDataFrame(fresh, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        if files < 40:
            streams.stream_drift(live, f"{tmp_path}/out", f"{tmp_path}/cp")
    if files == 40:  # several files in a batch: a slot's value is then the largest of the batch's
        streams.stream_drift(live, f"{tmp_path}/out", f"{tmp_path}/cp")
        stored = streams._scored(spark, f"{tmp_path}/out").read().collect()
        delivered = [(r.zone, r.for_date, r.ape) for r in stored]
        assert {(z, t) for z, t, _ in delivered} == {(z, t) for z, t, _ in rows} | {("A", dt.datetime(2024, 1, 1))}
    days, want = expected_days(delivered), {}
    for (z, d), (s, n) in days.items():
        for back in range(3):
            w = (z, d - dt.timedelta(days=back))
            want[w] = (want.get(w, (0, 0))[0] + s, want.get(w, (0, 0))[1] + n)
    got = {(r.zone, r.window_start): r.recent_mape for r in streams.read_drift(spark, f"{tmp_path}/out").collect()}
    assert got == {w: pytest.approx(s / n) for w, (s, n) in want.items()}
    if files < 40:
        last = max(int(x.split("=")[1]) for x in os.listdir(tmp_path / "out" / "windows" / "delta") if "batch" in x)
        changed = spark.read.parquet(f"{tmp_path}/out/windows/delta/batch={last}").collect()
        assert {(r.zone, r.window_start) for r in changed} == {("A", dt.date(2024, 1, 1) - dt.timedelta(days=b)) for b in range(3)}


def test_rows_are_dealt_out_before_they_are_sorted(spark, tmp_path):
    rows = spark.createDataFrame([], f"{SCHEMA}, batch bigint, _part string")
    plan = table(spark, tmp_path).newest(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "Aggregate" not in plan[plan.index("Exchange"):] and "Sort " not in plan[plan.index("Exchange"):]
