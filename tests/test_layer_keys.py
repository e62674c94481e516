from __future__ import annotations

from pyspark.sql import functions as F

from batchlake.functions.schema import BATCH, PREDICTION_SCHEMA
from batchlake.plans import summaries
from batchlake.session import prepare
from batchlake.sources import layers
from test_buckets import N, readings


def jobs_of(spark, name, action):
    spark.sparkContext.setJobGroup(name, name)
    try:
        action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def names(spark, first, last):
    return spark.range(first, last).select(F.concat(F.lit("b"), "id").alias(BATCH))


def test_batches_are_replaced_in_few_jobs(spark, tmp_path):
    """Keys were told from the rows again in each of four steps, with a shuffle each time (F10)."""
    path = str(tmp_path / "layer")
    layers.write_layer(readings(prepare(spark), 0, N, 1.0), path)
    new = readings(spark, 0, 700, 2.0)
    assert jobs_of(spark, "replace", lambda: layers.write_layer(new, path, batches=names(spark, 0, 750))) <= 14
    got = {r[BATCH]: r["prediction"] for r in layers.read_layer(spark, path, PREDICTION_SCHEMA).collect()}
    assert got == {f"b{k}": 2.0 if k < 700 else 1.0 for k in range(N) if not 700 <= k < 750}


def test_rows_of_named_batches_are_not_shuffled(spark, tmp_path):
    """Rows were dealt by batch to meet the names; names are few and go to the rows (F12)."""
    path = str(tmp_path / "layer")
    layers.write_layer(readings(prepare(spark), 0, N, 1.0), path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = layers.read_batches(spark, path, PREDICTION_SCHEMA, names(spark, 690, 710))
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
        assert {r[BATCH] for r in rows.collect()} == {f"b{k}" for k in range(690, 710)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_stored_rows_are_not_copied_before_they_replace_others(spark, tmp_path, monkeypatch):
    """Rows that are read from files were written once more, to be read again (F11)."""
    path, source = str(tmp_path / "layer"), str(tmp_path / "source")
    layers.write_layer(readings(prepare(spark), 0, N, 1.0), path)
    readings(spark, 0, 700, 2.0).write.parquet(source)
    rows, labels, fresh = spark.read.schema(PREDICTION_SCHEMA).parquet(source), [], layers.work_path
    monkeypatch.setattr(layers, "work_path", lambda spark, label: labels.append(label) or fresh(spark, label))
    layers.write_layer(rows, path, batches=names(spark, 0, 750), stored=True)
    assert "layer-rows" not in labels
    layers.write_layer(readings(spark, N, N + 2, 3.0), path, batches=[f"b{k}" for k in range(N, N + 2)])
    got = {r[BATCH]: r["prediction"] for r in layers.read_layer(spark, path, PREDICTION_SCHEMA).collect()}
    assert got == {f"b{k}": 2.0 if k < 700 else 1.0 if k < N else 3.0 for k in range(N + 2) if not 700 <= k < 750}


def test_names_in_a_list_become_rows_without_python(spark):
    """A list went through as many Python tasks as there are cores (F11)."""
    rows = layers.names_frame(spark, ["a", "it's", "20240105"])
    assert "ExistingRDD" not in rows._jdf.queryExecution().executedPlan().toString()
    assert [r[BATCH] for r in rows.collect()] == ["a", "it's", "20240105"]
    assert layers.names_frame(spark, []).count() == 0 and layers.names_frame(spark, []).columns == [BATCH]


def test_keys_may_be_null_or_none(spark, tmp_path):
    path = str(tmp_path / "silver")
    rows = readings(prepare(spark), 0, 20, 1.0)
    nameless = rows.limit(1).withColumn(BATCH, F.lit(None).cast("string"))
    layers.write_layer(rows.unionByName(nameless), path)
    layers.write_layer(nameless.withColumn("prediction", F.lit(2.0)), path)
    layers.write_layer(rows.limit(0), path)
    got = layers.read_layer(spark, path, PREDICTION_SCHEMA)
    assert got.count() == 21 and got.filter(f"{BATCH} is null").first()["prediction"] == 2.0
    summaries.store_summary(spark, path, "predictions", got.select(BATCH).filter("false"))
