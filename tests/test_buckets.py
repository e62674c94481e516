from __future__ import annotations

import datetime as dt
from pathlib import Path

from pyspark.sql import functions as F

from batchlake.catalog import fixtures as fx
from batchlake.catalog.queries import _drop_by_batch
from batchlake.functions.schema import BATCH, PREDICTION_SCHEMA, TIME
from batchlake.plans import predictions as pr
from batchlake.session import prepare
from batchlake.sources import layers

N = 1_500


def readings(spark, first, last, value):
    at = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(F.col("id") % 3)
    columns = [F.lit(value).alias(c) for c in PREDICTION_SCHEMA.names[1:-1]]
    return spark.range(first, last).select(at.alias(TIME), *columns, F.concat(F.lit("b"), "id").alias(BATCH))


def test_many_batches_are_few_folders(spark, tmp_path):
    """A folder per batch (and day) costs a file and a rename each."""
    layers.write_layer(readings(spark, 0, N, 1.0), str(tmp_path / "layer"))
    assert len(list((tmp_path / "layer").rglob("*.parquet"))) <= layers.BUCKETS
    pr.write_dated(readings(spark, 0, N, 1.0), str(tmp_path / "dated"))
    assert len(list((tmp_path / "dated").rglob("*.parquet"))) <= layers.FEW_BUCKETS * 3


def test_batches_of_a_bucket_are_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "layer")
    layers.write_layer(readings(spark, 0, N, 1.0), path)
    layers.write_layer(readings(spark, 0, 700, 2.0), path, batches=[f"b{k}" for k in range(750)])
    layers.write_layer(readings(spark, N, N + 2, 3.0), path)  # new batches only are added
    got = {r[BATCH]: r["prediction"] for r in layers.read_layer(spark, path, PREDICTION_SCHEMA).collect()}
    assert got == {f"b{k}": 2.0 if k < 700 else 1.0 if k < N else 3.0 for k in range(N + 2) if not 700 <= k < 750}
    layers.drop_batches(spark, path, [f"b{k}" for k in range(1, N + 2)])
    assert [r[BATCH] for r in layers.read_batches(spark, path, PREDICTION_SCHEMA, ["b0", "b5"]).collect()] == ["b0"]


def test_names_of_batches_can_be_rows(spark, tmp_path):
    """Names of all batches of a layer stay off the driver."""
    path, names = str(tmp_path / "layer"), spark.range(690, 710).select(F.concat(F.lit("b"), "id").alias(BATCH))
    layers.write_layer(readings(spark, 0, N, 1.0), path)
    layers.write_layer(layers.of_batches(readings(spark, 0, 700, 2.0), names), path, batches=names)
    got = {r[BATCH]: r["prediction"] for r in layers.read_layer(spark, path, PREDICTION_SCHEMA).collect()}
    assert got == {f"b{k}": 2.0 if 690 <= k < 700 else 1.0 for k in range(N) if not 700 <= k < 710}
    held = layers.read_batches(spark, path, PREDICTION_SCHEMA, names).select(BATCH).collect()
    assert sorted(r[BATCH] for r in held) == [f"b{k}" for k in range(690, 700)]


def test_folders_of_a_layer_are_listed_by_few_tasks(spark, tmp_path):
    """A task for each folder took longer than the listing itself."""
    path = str(tmp_path / "layer")
    layers.write_layer(readings(prepare(spark), 0, N, 1.0), path)
    spark.sparkContext.setJobGroup("listing", "listing")
    layers.read_layer(spark, path, PREDICTION_SCHEMA)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(list((tmp_path / "layer").glob("batch_bucket=*"))) == layers.BUCKETS
    assert stages and max(s.numTasks for s in stages) < layers.BUCKETS


def test_a_drop_by_batch_is_written_by_many_tasks(spark, sf_dir):
    """Files are slow to open: tasks that write them go by their number."""
    names = [r["name"] for r in spark.read.text(_drop_by_batch(spark, sf_dir)).select("_metadata.file_name").distinct().selectExpr("file_name as name").collect()]
    assert len({name.split("-")[1] for name in names}) > 1
    assert fx.sensor_raw(spark, sf_dir).count() == sum(1 if k % 13 else 2 for k in range(fx.events(spark, sf_dir).count()))


def test_files_are_moved_several_at_a_time(spark, tmp_path):
    (tmp_path / "in").mkdir()
    moves = [(str(tmp_path / "in" / f"{k}.csv"), str(tmp_path / "out" / f"{k % 3}" / f"{k}.csv")) for k in range(40)]
    for source, _ in moves[:-1]:  # one has been moved before
        Path(source).write_text(source)
    assert layers.move_files(spark, moves) == 39
    assert [Path(target).read_text() for _, target in moves[:-1]] == [source for source, _ in moves[:-1]]
    assert not list((tmp_path / "in").glob("*.csv"))
