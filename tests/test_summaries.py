from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from batchlake.functions.schema import BATCH, GOLD_SCHEMA, PREDICTION_SCHEMA, SILVER_SCHEMA, TIME
from batchlake.operators import learn
from batchlake.operators.clean import quality_counters
from batchlake.plans import reports, summaries
from batchlake.sources import layers
from batchlake.streaming.drop_folder import ingest_files, layer_paths
from test_sources import put, row, text_of


def made(spark, schema, seed, batches, n=40):
    rng = random.Random(seed)
    rows = []
    for batch in batches:
        for i in range(n):
            numbers = [rng.choice([None, rng.uniform(-5, 900)]) for _ in schema.names[1:-1]]
            rows.append((dt.datetime(2024, 1, rng.randrange(1, 28), i % 24), *numbers, batch))
    return spark.createDataFrame(rows, schema)


def close(got, want):
    got, want = got.first().asDict(), want.first().asDict()
    assert got.keys() == want.keys()
    for name, value in want.items():
        assert got[name] == (pytest.approx(value, rel=1e-9) if isinstance(value, float) else value), name


@pytest.mark.parametrize("layer", ["silver", "gold", "predictions"])
def test_merged_reports_equal_scans(spark, tmp_path, layer):
    schema = {"silver": SILVER_SCHEMA, "gold": GOLD_SCHEMA, "predictions": PREDICTION_SCHEMA}[layer]
    path = str(tmp_path / layer)
    layers.write_layer(made(spark, schema, 1, ["a", "20240105", "c"]), path)
    summaries.store_summary(spark, path, layer, ["a", "20240105", "c"])
    # two batches are replaced, one of them by nothing, and one is new
    layers.write_layer(made(spark, schema, 2, ["a", "d"], 25), path, batches=["a", "c", "d"])
    summaries.store_summary(spark, path, layer, ["a", "c", "d"])
    rows, lines = layers.read_layer(spark, path, schema), summaries.read_summary(spark, path, layer)
    assert lines.count() == 3
    close(summaries.layer_summary(lines, layer), reports.layer_summary(rows.select(*schema.names)))
    close(summaries.date_range(lines), reports.date_range(rows))
    assert summaries.rows_per_batch(lines, 2).collect() == reports.rows_per_batch(rows, 2).collect()
    if layer == "silver":
        close(summaries.measure_stats(lines), reports.measure_stats(rows))
    if layer == "gold":
        close(summaries.feature_stats(lines), reports.feature_stats(rows))
    if layer == "predictions":
        close(summaries.accuracy_summary(lines), reports.accuracy_summary(rows))
        good = rows.filter("prediction is not null and viscosity_target_10min is not null")
        lines = summaries.summarise(good, layer)
        close(summaries.model_accuracy(lines), good.agg(learn.rmse_expr().alias("rmse"), learn.r2_expr().alias("r2")))


@pytest.mark.parametrize("layer", ["silver", "gold", "predictions"])
def test_no_rows(spark, layer):
    lines = summaries.summarise(made(spark, summaries.SCHEMAS[layer], 1, []), layer)
    assert summaries.layer_summary(lines, layer).first()["rows"] == 0
    assert summaries.date_range(lines).first()["first_time"] is None
    assert summaries.rows_per_batch(lines).count() == 0


def test_a_report_reads_no_rows(spark, tmp_path):
    path = str(tmp_path / "silver")
    layers.write_layer(made(spark, SILVER_SCHEMA, 1, ["a", "b"]), path)
    summaries.store_summary(spark, path, "silver", ["a", "b"])
    layers.drop_batches(spark, path, ["a", "b"])
    assert summaries.layer_summary(summaries.read_summary(spark, path, "silver"), "silver").first()["rows"] == 80


def test_the_stream_keeps_summaries(spark, tmp_path):
    lake = str(tmp_path / "lake")
    for k, n in enumerate((30, 50)):
        put(tmp_path / "drop" / "run" / "a.csv", text_of([row(i) for i in range(n)], ","), "utf-8")
        ingest_files(spark, [str(tmp_path / "drop" / "run" / "a.csv")], ["run_combined"], str(tmp_path / "drop"), lake, "folder")
        for layer in ("silver", "gold"):
            path = layer_paths(lake)[layer]
            lines = summaries.read_summary(spark, path, layer)
            assert lines.count() == 1 and lines.first()["rows"] == layers.read_layer(spark, path, summaries.SCHEMAS[layer]).count() == n - 20 * (layer == "gold")


def test_counters_add_up(spark):
    rows = [("2024-01-01 00:00:00", "1", "7", "a"), ("2024-01-01 00:00:00", "2", "7", "a"), ("x", "1", "7", "a"), ("2024-01-01 00:00:00", "1", "7", "b"),
            ("2024-01-01 00:00:00", "0", "7", "b"), ("2024-01-02 00:00:00", None, "7", None)]
    raw = spark.createDataFrame(rows, f"{TIME} string, batch_time_mins string, ph_level string, {BATCH} string")
    lines = summaries.batch_counters(raw)
    assert lines.count() == 3
    assert summaries.merged_counters(lines).collect() == quality_counters(raw).collect()
    assert lines.filter(F.col(BATCH) == "a").first()["rows_duplicate"] == 1
