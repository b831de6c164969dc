"""What the physical plans must and must not contain."""

import contextlib
import io
import re

import pytest

from gridcast.operators import metrics, slices
from gridcast.plans import inputs as I
from gridcast.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
EAGER = {"scan_zone_csv", "write_table", "snapshot_run", "history_append", "stream_ingest", "stream_daily_mape",
         "stream_drift", "fc_gbt_a", "fc_gbt_b", "param_search_trees", "drop_all_null_cols"}


def plan(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_nested_loops(spark, name):
    text = plan(QUERIES[name](spark, SF), "simple")
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["roll_mean_3", "roll_std_6", "seq_windows_rows", "cv_folds_rows", "timegap_count"])
def test_windows_by_zone_alone_run_over_reduced_rows(spark, name):
    lines = plan(QUERIES[name](spark, SF), "simple").splitlines()
    by_zone = [i for i, line in enumerate(lines) if re.search(r"Window .*\], \[zone#\d+\](, |$)", line)]
    for i in by_zone:
        assert re.search(r"HashAggregate\(keys=\[zone#\d+, _bucket", "".join(lines[i:i + 9])), lines[i]
    assert any(re.search(r"Window .*\[zone#\d+, _bucket", line) for line in lines)


def test_filters_and_columns_reach_the_files(spark, tmp_path):
    I.history(spark, SF).write.partitionBy("run_date").parquet(str(tmp_path / "h"))
    h = spark.read.parquet(str(tmp_path / "h"))
    text = plan(slices.today(h, "2024-01-27").select("zone", "pred_m1"))
    assert "GreaterThanOrEqual(for_date" in text and "LessThan(for_date" in text
    assert re.search(r"ReadSchema: struct<zone:string,for_date:timestamp_ntz,pred_m1:double>", text)
    dated = plan(h.where("run_date < DATE'2024-01-27'").select("zone"))
    assert "PartitionFilters: [isnotnull(run_date" in dated


def test_models_are_scored_without_repeating_rows(spark):
    text = plan(metrics.metrics_zone_model(spark.read.parquet(f"{SF}/events.parquet").selectExpr(
        "event_type AS zone", "value AS actual", "value + 1 AS p", "value + 2 AS q"), {"P": "p", "Q": "q"}), "simple")
    assert text.count("Exchange") == 1 and "Expand" not in text


def test_full_rows_cross_one_exchange_for_row_windows(spark):
    df = QUERIES["roll_mean_6"](spark, SF)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in text
