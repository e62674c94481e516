from __future__ import annotations

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from batchlake.catalog.fixtures import sensor_gold
from batchlake.functions.schema import MODEL_INPUTS, PREDICTION_COLUMNS, TARGET
from batchlake.operators import learn
from batchlake.plans import monitor
from batchlake.plans.medallion import fit_and_score
from batchlake.sources import layers


@pytest.fixture(scope="module")
def gold(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("gold") / "gold")
    layers.write_layer(sensor_gold(spark, sf_dir), path)
    return path


@pytest.fixture(scope="module")
def run(spark, gold, tmp_path_factory):
    base = tmp_path_factory.mktemp("model")
    model_path, predictions_path = str(base / "model"), str(base / "predictions")
    model, report = fit_and_score(spark, gold, model_path, predictions_path, trees=8, depth=4)
    row = report.first()
    assert row.train_rows + row.test_rows > 0 and row.rmse > 0 and len(row.importances) == 13
    return model, model_path, predictions_path


def rows(spark, gold):
    from batchlake.functions.schema import GOLD_SCHEMA

    return layers.read_layer(spark, gold, GOLD_SCHEMA)


def test_split_is_stable_and_complete(spark, gold):
    df = rows(spark, gold)
    labels = sorted(map(str, learn.label_split(df).select("batch_id", "timestamp", "split").collect()))
    again = learn.label_split(df.repartition(7)).select("batch_id", "timestamp", "split").collect()
    assert labels == sorted(map(str, again))
    train, test = learn.split(df)
    assert train.count() + test.count() == df.count()
    other = learn.label_split(df, seed=7).filter("split = 'test'").count()
    assert train.count() > test.count() > 0 and other > 0


def test_split_by_batch_keeps_batches_whole(spark, gold):
    sides = learn.label_split(rows(spark, gold), by="batch").groupBy("batch_id")
    assert sides.agg(F.countDistinct("split").alias("n")).filter("n > 1").count() == 0


def test_random_split_is_available(spark, gold):
    train, test = learn.split(rows(spark, gold), by="random")
    assert train.count() + test.count() == rows(spark, gold).count()


def test_predictions_cover_the_test_split(spark, gold, run):
    _, _, path = run
    _, test = learn.split(rows(spark, gold))
    stored = spark.read.parquet(path)
    assert stored.columns == PREDICTION_COLUMNS
    assert stored.count() == test.count()
    assert stored.filter("prediction IS NULL").count() == 0


def test_reloaded_model_predicts_the_same(spark, gold, run):
    model, path, _ = run
    _, test = learn.split(rows(spark, gold))
    test = test.orderBy("batch_id", "timestamp")
    first = [r["prediction"] for r in learn.score(model, test).collect()]
    second = [r["prediction"] for r in learn.score(layers.load_model(path), test).collect()]
    assert first == second


def test_importances(spark, run):
    model, _, _ = run
    table = learn.feature_importance(spark, model)
    got = table.orderBy("rank").collect()
    assert sorted(r["feature"] for r in got) == sorted(MODEL_INPUTS)
    assert abs(sum(r["importance"] for r in got) - 1) < 1e-9
    assert [r["importance"] for r in got] == sorted((r["importance"] for r in got), reverse=True)
    tiers = [r["tier"] for r in monitor.importance_series(table).orderBy("rank").collect()]
    assert tiers == ["high"] * 3 + ["middle"] * 3 + ["low"] * 7


def test_accuracy_equals_the_evaluator(spark, run):
    stored = spark.read.parquet(run[2])
    evaluator = RegressionEvaluator(labelCol=TARGET, predictionCol="prediction")
    rmse = learn.rmse(stored).first()["rmse"]
    r2 = learn.r2(stored).first()["r2"]
    assert rmse == pytest.approx(evaluator.setMetricName("rmse").evaluate(stored), rel=1e-9)
    assert r2 == pytest.approx(evaluator.setMetricName("r2").evaluate(stored), abs=1e-9)


def test_r2_of_a_constant_label_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], [TARGET, "prediction"])
    assert learn.r2(df).first()["r2"] is None


def test_the_forest_gathers_its_rows(spark):
    """Each task of a pass makes the statistics of all nodes, so rows dealt widely are gathered."""
    wide = spark.range(0, 900, 1, 60).select((F.col("id") % 7).cast("double").alias("x"))
    assert learn.gathered(wide).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert learn.gathered(wide).count() == 900
