from __future__ import annotations

import datetime as dt

import pytest

from batchlake.functions.schema import PREDICTION_SCHEMA, TARGET
from batchlake.plans import monitor, reports

T0 = dt.datetime(2024, 1, 1)


def predictions(spark, values, target=850.0):
    rows = [
        (T0 + dt.timedelta(minutes=i), 80.0 + i, 7.0, target, v, f"b{i % 2}")
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, PREDICTION_SCHEMA)


def test_latest_rows_ascend_and_ties_break_by_batch(spark):
    same = [(T0, 1.0, 7.0, 1.0, 1.0, b) for b in ("a", "c", "b")]
    df = spark.createDataFrame(same, PREDICTION_SCHEMA)
    assert [r["batch_id"] for r in monitor.latest_n(df, 2).collect()] == ["b", "c"]
    many = monitor.latest_n(predictions(spark, [850.0] * 9), 4).collect()
    assert [r["temperature_c"] for r in many] == [85.0, 86.0, 87.0, 88.0]


def test_top_rows_do_not_sort_the_table(spark):
    plan = monitor.latest_n(predictions(spark, [1.0] * 3))._jdf.queryExecution()
    assert "TakeOrderedAndProject" in plan.executedPlan().toString()


@pytest.mark.parametrize(
    "value, inside", [(799.94, False), (799.96, True), (900.04, True), (900.06, False)]
)
def test_alert_uses_the_rounded_value(spark, value, inside):
    row = monitor.range_alert(predictions(spark, [value])).first()
    assert row["in_range"] is inside
    assert row["status"] == ("within range" if inside else "outside range")


def test_snapshot(spark):
    row = monitor.monitor_snapshot(monitor.latest_n(predictions(spark, [840.0, 865.26]))).first()
    assert row["rows_shown"] == 2 and row["n_batches"] == 2
    assert row["prediction"] == 865.3 and row["in_range"] is True
    assert row["avg_error"] == 12.63 and row["error_ok"] is True
    assert row["latest_time"] == T0 + dt.timedelta(minutes=1)
    assert row["r2"] is None


def test_nothing_in_gives_nothing_out(spark):
    empty = monitor.latest_n(predictions(spark, []))
    for fn in (monitor.monitor_snapshot, monitor.latest_reading, monitor.avg_error_card):
        assert fn(empty).collect() == []
    assert monitor.error_histogram(empty).collect() == []
    assert monitor.rows_shown(empty).first()["rows_shown"] == 0


def test_histogram_holds_every_row(spark):
    recent = monitor.latest_n(predictions(spark, [850.0 + i for i in range(41)]))
    bins = monitor.error_histogram(recent).orderBy("bin").collect()
    assert sum(b["rows"] for b in bins) == 41
    assert bins[-1]["bin"] == 19 and bins[-1]["rows"] == 3
    assert bins[0]["bin_start"] == 0.0 and bins[-1]["bin_end"] == 40.0


def test_histogram_of_equal_errors_is_one_bin(spark):
    recent = monitor.latest_n(predictions(spark, [851.0] * 5))
    assert [(b["bin"], b["rows"]) for b in monitor.error_histogram(recent).collect()] == [(0, 5)]


def test_batches_without_batch_column(spark):
    recent = monitor.latest_n(predictions(spark, [1.0, 2.0])).drop("batch_id")
    assert monitor.distinct_batches(recent).first()["n_batches"] is None


def test_series_is_long_and_ordered(spark):
    got = monitor.series(monitor.latest_n(predictions(spark, [1.0, 2.0]))).collect()
    assert len(got) == 8
    assert {r["measure"] for r in got} == {"temperature_c", "ph_level", TARGET, "prediction"}
    assert [r["timestamp"] for r in got] == sorted(r["timestamp"] for r in got)


def test_reports(spark):
    df = predictions(spark, [850.126, 849.0])
    assert reports.layer_summary(df).first().asDict() == {
        "rows": 2,
        "n_columns": 6,
        "columns": ",".join(PREDICTION_SCHEMA.names),
    }
    best = reports.accuracy_summary(df).first()
    assert best["max_error_cP"] == 1.0 and best["mean_abs_error_cP"] == 0.56
    sample = reports.prediction_sample(df, 1).collect()
    assert [r["predicted_cP"] for r in sample] == [850.13]
    assert reports.rows_per_batch(df, 1).count() == 1
    assert reports.rows_per_batch(df, None).count() == 2
