"""Drops of very many small files: no process, literal or task for each of them."""

from __future__ import annotations

import os
from pathlib import Path

import pytest

from batchlake.catalog import fixtures as fx
from batchlake.catalog import queries
from batchlake.sources import layers
from batchlake.sources.raw_text import read_raw_text
from batchlake.streaming.drop_folder import names_of


def _texts(folder: str) -> dict[str, str]:
    return {str(f.parent.relative_to(folder)): f.read_text(encoding="utf-8") for f in Path(folder).glob("run=*/piece=*/*.csv")}


def test_a_drop_by_batch_is_what_sparks_writer_makes(spark, sf_dir, tmp_path):
    drop = queries._drop_by_batch(spark, sf_dir)
    # Hadoop's local files come with checksum files, and a process for each
    assert not list(Path(drop).glob("run=*/piece=*/.*"))
    rows = fx.sensor_raw(spark, sf_dir).selectExpr("*", f"{fx.BATCH} AS run", queries.PIECE_SQL.replace("n %", "line_no %") + " AS piece")
    dealt = rows.repartition(3, "run", "piece").sortWithinPartitions("run", "piece", "line_no", "source_file")
    dealt.select(*fx.HEADERS, "run", "piece").write.partitionBy("run", "piece").options(header=True).csv(str(tmp_path / "by-spark"))
    assert _texts(drop) == _texts(str(tmp_path / "by-spark"))


@pytest.mark.parametrize("names", [["b1", "b 2/é", "b'3", 'b"4'], [], [f"b{k}" for k in range(20_000)]])
def test_names_are_one_local_relation(spark, names):
    frame = layers.names_frame(spark, names)
    assert frame.columns == [layers.BATCH]
    assert str(frame._jdf.queryExecution().optimizedPlan().toString()).startswith("LocalRelation")
    assert sorted(r[0] for r in frame.collect()) == sorted(names)


def test_names_of_files_are_those_given(spark):
    files = [f"file:/drop/run{k % 7}/f{k}.csv" for k in range(1_000)]
    assert names_of(spark, files, "/drop", "folder") == [(f"run{k % 7}_combined", f"run{k % 7}/f{k}.csv") for k in range(1_000)]


def test_small_files_are_gathered_in_few_tasks(spark, tmp_path):
    for k in range(700):
        (tmp_path / f"{k}.csv").write_text(f'Time,Batch Time (mins),R1_PH_R02,note\n2024-01-05 08:00:00,{k},7.1,"a,{k}"\n')
    rows = read_raw_text(spark, str(tmp_path))
    assert rows.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    got = {(r.batch_time_mins, r.extra["note"], r.source_file) for r in rows.collect()}
    assert got == {(str(k), f"a,{k}", f"{k}.csv") for k in range(700)}


def test_mounted_files_are_moved_without_the_stores_calls(spark, tmp_path, monkeypatch):
    def refused(*args):
        raise AssertionError("the store was asked")

    monkeypatch.setattr(layers, "move_file", refused)
    drop, away = tmp_path / "in" / "run=1", tmp_path / "out" / "a b"
    drop.mkdir(parents=True)
    away.mkdir(parents=True)
    (drop / "x.csv").write_text("new")
    (drop / ".x.csv.crc").write_text("sums of new")
    (drop / "y.csv").write_text("y")
    (away / "x.csv").write_text("older")
    (away / ".y.csv.crc").write_text("sums of an older y")
    moves = [(f"file:{drop}/x.csv", f"{away}/x.csv"), (f"{drop}/y.csv", f"file://{away}/y.csv"), (f"{drop}/gone.csv", f"{away}/gone.csv")]
    assert layers.move_files(spark, moves) == 2
    assert {name: (away / name).read_text() for name in os.listdir(away)} == {"x.csv": "new", ".x.csv.crc": "sums of new", "y.csv": "y"}
    assert not os.listdir(drop)
    # the rest of the moves is the store's, whatever the path looks like
    assert not layers._on_mount("hdfs://host/x", True) and not layers._on_mount("/x", False)


def test_a_drop_is_read_once_before_the_model_is_fitted(spark, sf_dir, monkeypatch):
    """The features read their rows twice, for sizes of batches and for windows: not from the files dropped."""
    plans = []

    def build_features(rows):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        raise InterruptedError

    monkeypatch.setattr(queries.ft, "build_features", build_features)
    with pytest.raises(InterruptedError):
        queries.CATALOG["S5_drop_to_predictions"].build(spark, sf_dir)
    assert plans and "parquet" in plans[0].lower() and "binaryfile" not in plans[0].lower()
