"""The forest grown by regions against MLlib's own."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from batchlake.catalog.fixtures import sensor_gold
from batchlake.functions.schema import GOLD_SCHEMA, MODEL_INPUTS, TARGET
from batchlake.operators import forest, learn
from batchlake.sources import layers

COLS = list(MODEL_INPUTS)
#: MLlib grows the same tree as often as it is asked.
PLAIN = {"numTrees": 1, "maxDepth": 7, "seed": 42, "bootstrap": False, "featureSubsetStrategy": "all"}


@pytest.fixture(scope="module")
def taught(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("gold") / "gold")
    sensor_gold(spark, "/root/testdata/sf0.01").select(*GOLD_SCHEMA.names).write.parquet(path)
    return learn.split(layers.read_layer(spark, path, GOLD_SCHEMA))


def estimator(**params):
    return RandomForestRegressor(featuresCol="features", labelCol=TARGET, **params)


def ours(rows, local_rows=forest.LOCAL_ROWS, **params):
    return forest.fit(estimator(**params), rows.select(*COLS, TARGET), COLS, TARGET, learn.assembler(), local_rows)


def lines(model):
    return [line.strip() for line in model.toDebugString.splitlines()[1:]]


def told(model, rows):
    scored = model.transform(learn.assemble(rows)).select("batch_id", "timestamp", "prediction")
    return np.array([r.prediction for r in scored.orderBy("batch_id", "timestamp").collect()])


@pytest.mark.parametrize("local_rows", [forest.LOCAL_ROWS, 300])
def test_without_chance_the_tree_is_mllibs(taught, local_rows):
    """Whether one task grows it, or all tasks its top."""
    rows, held_out = taught
    own, mllibs = ours(rows, local_rows, **PLAIN), estimator(**PLAIN).fit(learn.assemble(rows))
    shape = [line for line in lines(own) if not line.startswith("Predict")]
    assert shape == [line for line in lines(mllibs) if not line.startswith("Predict")]
    assert len(shape) > 60
    assert told(own, held_out) == pytest.approx(told(mllibs, held_out), rel=1e-9)
    assert own.featureImportances.toArray() == pytest.approx(mllibs.featureImportances.toArray(), abs=1e-9)


def test_limits_are_mllibs(taught):
    limits = PLAIN | {"minInstancesPerNode": 40, "minInfoGain": 50.0, "maxBins": 8}
    own, mllibs = ours(taught[0], **limits), estimator(**limits).fit(learn.assemble(taught[0]))
    assert [line for line in lines(own) if "Predict" not in line] == [line for line in lines(mllibs) if "Predict" not in line]


def test_the_whole_forest_is_as_good_as_mllibs(taught):
    """100 trees of depth 15: error on held-out rows, size, and which inputs matter."""
    rows, held_out = taught
    model = learn.train(rows).stages[-1]
    mllibs = estimator(numTrees=100, maxDepth=15, seed=42).fit(learn.assemble(rows.coalesce(2)))
    assert model.getNumTrees == 100 and max(t.depth for t in model.trees) == 15
    assert model.totalNumNodes == pytest.approx(mllibs.totalNumNodes, rel=0.05)
    truth = np.array([r[TARGET] for r in held_out.orderBy("batch_id", "timestamp").collect()])
    error = [np.sqrt(np.mean((told(m, held_out) - truth) ** 2)) for m in (model, mllibs)]
    assert error[0] == pytest.approx(error[1], rel=0.02)
    assert model.featureImportances.toArray() == pytest.approx(mllibs.featureImportances.toArray(), abs=0.02)


def test_the_same_rows_give_the_same_forest(taught):
    kept = taught[0].select("*").repartition(3, "batch_id").sortWithinPartitions("batch_id", "timestamp").persist()
    kept.count()
    params = {"numTrees": 5, "maxDepth": 8, "seed": 42}
    assert lines(ours(kept, **params)) == lines(ours(kept, **params))
    kept.unpersist()


def test_a_row_is_in_a_bag_as_often_as_poisson_says():
    rules = forest.Rules(10, 5, -42, True, 1.0, 13, 5, 1, 0.0, 0.0)
    bag = rules.bag(3, 1 << 40, 100_000)
    assert bag.mean() == pytest.approx(1, abs=0.02) and (bag == 0).mean() == pytest.approx(np.exp(-1), abs=0.01)
    assert (bag == rules.bag(3, 1 << 40, 100_000)).all() and (bag != rules.bag(4, 1 << 40, 100_000)).any()


def test_nulls_and_no_rows_are_errors(spark, taught):
    with pytest.raises(Exception, match="null"):
        ours(taught[0].withColumn("ph_level", F.lit(None).cast("double")).limit(50), numTrees=2, maxDepth=2)
    with pytest.raises(ValueError, match="no rows"):
        ours(taught[0].filter("false"), numTrees=2, maxDepth=2)


def test_growing_costs_few_jobs(spark, taught):
    """MLlib ran a job, or several, for each level; here regions are grown at once."""
    rows = taught[0].select(*COLS, TARGET).persist()
    rows.count()
    spark.sparkContext.setJobGroup("forest-jobs", "")
    ours(rows, numTrees=3, maxDepth=15, seed=42)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("forest-jobs")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    rows.unpersist()
    assert 0 < len(jobs) < 45
