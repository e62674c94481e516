from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from batchlake.functions.schema import BATCH, GOLD_SCHEMA, PREDICTION_SCHEMA, TARGET, TIME
from batchlake.operators.features import build_features
from batchlake.operators.learn import split, train
from batchlake.plans import predictions as pr
from batchlake.plans.medallion import clean
from batchlake.plans.monitor import latest_n
from batchlake.sources import layers
from batchlake.sources.raw_text import read_drop_folder
from batchlake.streaming import drop_folder
from batchlake.streaming.drop_folder import archive_landed, ingest_files, ingest_stream, layer_paths
from batchlake.streaming.scoring import with_scores
from test_sources import put, row, text_of


def folder(tmp_path, n=3, size=40):
    for k in range(n):
        put(tmp_path / "drop" / "run" / f"f{k}.csv", text_of([row(size * k + i) for i in range(size)], ","), "utf-8")
    return tmp_path / "drop"


def test_files_become_predictions_and_a_replay_leaves_no_doubles(spark, tmp_path):
    drop, lake, path, model = folder(tmp_path), str(tmp_path / "lake"), str(tmp_path / "predictions"), str(tmp_path / "model")
    gold = build_features(clean(read_drop_folder(spark, str(drop))).drop("extra"))
    layers.save_model(train(split(gold)[0], trees=3, depth=4), model)
    ingest = with_scores(model, path)
    ingest_stream(spark, str(drop), lake, str(tmp_path / "checkpoint"), max_files=2, ingest=ingest).awaitTermination(200)

    def stored():
        return sorted(map(str, pr.read_dated(spark, path).collect()))

    want = layers.load_model(model).transform(split(layers.read_layer(spark, layer_paths(lake)["gold"], GOLD_SCHEMA))[1])
    want = want.select(*PREDICTION_SCHEMA.names).withColumn(pr.DAY, F.to_date(TIME))
    before = stored()
    assert before == sorted(map(str, want.select(*pr.DATED_SCHEMA.names).collect())) and before
    ingest(spark, [str(drop / "run" / "f1.csv")], ["run_combined"], str(drop), lake, "folder")
    assert stored() == before
    # a batch without a row any more has no predictions either
    for k in range(3):
        put(drop / "run" / f"f{k}.csv", text_of([row(k)[:1] + ["0"] * 6], ","), "utf-8")
    ingest(spark, [str(drop / "run" / f"f{k}.csv") for k in range(3)], ["run_combined"], str(drop), lake, "folder")
    assert stored() == []


def made(spark, seed, n, batch):
    rng = random.Random(seed)
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(24 * 60)), 80.0, 7.0, 800.0, float(i), batch) for i in range(n)]
    return spark.createDataFrame(list({r[0]: r for r in rows}.values()), PREDICTION_SCHEMA)


@pytest.mark.parametrize("n", [1, 30, 100_000])
def test_newest_of_dated_predictions(spark, tmp_path, n):
    path = str(tmp_path / "dated")
    rows = made(spark, 1, 400, "a").union(made(spark, 2, 300, "20240105"))
    pr.write_dated(rows, path)
    assert pr.newest(spark, path, n).collect() == latest_n(rows, n).collect()


def test_newest_reads_the_last_days_only(spark, tmp_path):
    path = str(tmp_path / "dated")
    pr.write_dated(made(spark, 1, 800, "a").union(made(spark, 2, 600, "b")), path)
    files = [r[0] for r in pr.newest_days(spark, path, 40).select(F.input_file_name()).distinct().collect()]
    every = pr.read_dated(spark, path).select(F.input_file_name()).distinct().count()
    assert len(files) <= 8 and every > 100
    plan = pr.newest_days(spark, path, 40)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_replaced_predictions(spark, tmp_path):
    """A batch scored again replaces its rows and its days; one that is named without a row goes."""
    path = str(tmp_path / "dated")
    assert pr.days_path(path) != path
    pr.write_dated(made(spark, 1, 200, "a").union(made(spark, 2, 200, "b")), path)
    again = made(spark, 3, 20, "a").filter(F.col(TIME) < dt.datetime(2024, 1, 20))
    pr.write_dated(again, path, ["a", "b"])
    assert pr.read_dated(spark, path).select(BATCH, TIME).collect() and pr.read_dated(spark, path).count() == again.count()
    assert pr.newest(spark, path, 7).collect() == latest_n(again, 7).collect()
    pr.write_dated(again.limit(0), path, ["a"])
    assert pr.newest(spark, path).count() == 0


def test_archive_follows_the_commit_log(spark, tmp_path):
    drop, lake, checkpoint, archive = folder(tmp_path, 3, 5), str(tmp_path / "lake"), str(tmp_path / "checkpoint"), tmp_path / "archive"
    put(drop / "run" / "bad.csv", "Foo,Bar\n1,2\n", "utf-8")
    stream = ingest_stream(spark, str(drop), lake, checkpoint, max_files=2, archive_dir=str(archive))
    stream.awaitTermination(200)
    away = {p.name for p in archive.rglob("*.csv")}
    assert len(away) >= 1  # those of the first trigger
    archive_landed(spark, str(drop), lake, checkpoint, str(archive))
    assert {p.name for p in archive.rglob("*.csv")} == {"f0.csv", "f1.csv", "f2.csv"}
    assert [p.name for p in drop.rglob("*.csv")] == ["bad.csv"]
    assert archive_landed(spark, str(drop), lake, checkpoint, str(archive)) == 0
    assert layers.names_in(spark, layer_paths(lake)["ledger"] + "/run=" + drop_folder._run_name(checkpoint)) == []


def test_a_trigger_that_is_not_committed_keeps_its_files(spark, tmp_path):
    drop, lake, checkpoint, archive = folder(tmp_path, 1, 5), str(tmp_path / "lake"), str(tmp_path / "checkpoint"), str(tmp_path / "archive")
    path = str(drop / "run" / "f0.csv")
    ingest_files(spark, [path], ["run_combined"], str(drop), lake, "folder")
    drop_folder._note_landed(spark, [path], str(drop), lake, "folder", checkpoint, 0)
    assert archive_landed(spark, str(drop), lake, checkpoint, archive) == 0
    put(tmp_path / "checkpoint" / "commits" / "0", "v1\n{}", "utf-8")
    assert archive_landed(spark, str(drop), lake, checkpoint + "-other", archive) == 0
    assert archive_landed(spark, str(drop), lake, checkpoint, archive) == 1


def test_a_failing_write_keeps_the_batch(spark, tmp_path):
    path, at = str(tmp_path / "layer"), dt.datetime(2024, 1, 1)
    rows = spark.createDataFrame([(at, 1.0, 7.0, 2.0, 3.0, b) for b in ("a", "b", "c")], PREDICTION_SCHEMA)
    layers.write_layer(rows, path)
    broken = rows.withColumn(TARGET, F.raise_error(F.lit("No space left on device")).cast("double"))
    with pytest.raises(Exception, match="No space left"):
        layers.write_layer(broken, path, batches=["a", "b", "c"])

    def kept():
        return sorted(r[BATCH] for r in layers.read_layer(spark, path, PREDICTION_SCHEMA).collect())

    assert kept() == ["a", "b", "c"]
    layers.write_layer(rows.filter("batch_id = 'b'"), path, batches=["a", "b"])
    assert kept() == ["b", "c"]
    layers.write_layer(rows.limit(0), path, batches=["b"])
    assert kept() == ["c"]


def test_all_rejected_files_are_read_again_page_by_page(spark, tmp_path, monkeypatch):
    drop, lake = tmp_path / "drop", str(tmp_path / "lake")
    monkeypatch.setattr(drop_folder, "MAX_FILES_PER_TRIGGER", 2)
    names = [f"f{k}" for k in range(5)]
    for name in names:
        put(drop / f"{name}.csv", "Foo,Bar\n1,2\n", "utf-8")
    ingest_files(spark, [str(drop / f"{n}.csv") for n in names], names, str(drop), lake, "folder")
    put(drop / "f4.csv", text_of([row(i) for i in range(22)], ","), "utf-8")
    assert drop_folder.retry_rejected(spark, str(drop), lake)["rows_saved"] == 22
    rejected = layers.read_layer(spark, layer_paths(lake)["rejected"], drop_folder.REJECTED_SCHEMA)
    assert sorted(r["source_file"] for r in rejected.collect()) == [f"f{k}.csv" for k in range(4)]
