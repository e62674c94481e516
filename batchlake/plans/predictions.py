"""Predictions stored by buckets of batches and by day, so that the newest are found without reading the rest.

Next to the rows lies one line per (batch, day) with their number. A dashboard that shows
the newest ``n`` walks these lines from the last day back until it has enough rows, and
scans those days only. Batches are replaced whole, so scoring one again leaves no doubles.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchlake.functions.schema import BATCH, PREDICTION_SCHEMA, TIME
from batchlake.operators.learn import prediction_table, score, split
from batchlake.plans.monitor import LATEST_ROWS, latest_n
from batchlake.plans.summaries import summarise, summary_path
from batchlake.session import work_path
from batchlake.sources.layers import of_batches, read_layer, write_layer

DAY = "day"
DATED_SCHEMA = T.StructType([*PREDICTION_SCHEMA.fields, T.StructField(DAY, T.DateType())])
DAYS_SCHEMA = f"{DAY} date, rows long, {BATCH} string"


def days_path(path: str) -> str:
    return path.rstrip("/") + "_days"


def write_dated(predictions: DataFrame, path: str, batches: list[str] | None = None) -> None:
    """Store predictions by batch and day, and the number of rows of each.

    Replaces the batches that ``predictions`` has; those that ``batches`` names besides go. The
    rows are scored once, into a scratch table, and the day lines are written last.
    """
    spark, scratch = predictions.sparkSession, work_path(predictions.sparkSession, "dated")
    predictions.withColumn(DAY, F.to_date(TIME)).select(*DATED_SCHEMA.names).write.parquet(scratch)
    rows = spark.read.schema(DATED_SCHEMA).parquet(scratch)
    if batches is None:
        batches = [r[BATCH] for r in rows.select(BATCH).distinct().collect()]
    write_layer(rows, path, [BATCH, DAY], batches=batches, whole_batches=True)
    days = rows.groupBy(DAY, BATCH).agg(F.count("*").alias("rows"))
    write_layer(days, days_path(path), batches=batches)
    write_layer(summarise(rows.drop(DAY), "predictions"), summary_path(path), batches=batches)


def read_dated(spark: SparkSession, path: str) -> DataFrame:
    return read_layer(spark, path, DATED_SCHEMA)


def newest_days(spark: SparkSession, path: str, n: int = LATEST_ROWS) -> DataFrame:
    """The rows of the last days that hold at least ``n`` together; no other day is read."""
    days = read_layer(spark, days_path(path), DAYS_SCHEMA).groupBy(DAY).agg(F.sum("rows").alias("rows"))
    # one line per day of all batches: short enough for one task
    newer = F.sum("rows").over(Window.orderBy(F.desc(DAY)).rowsBetween(Window.unboundedPreceding, -1))
    first = days.withColumn("_newer", F.coalesce(newer, F.lit(0))).filter(F.col("_newer") < n).agg(F.min(DAY)).first()[0]
    rows = read_dated(spark, path)
    return rows.filter(F.lit(False)) if first is None else rows.filter(F.col(DAY) >= F.lit(first))


def newest(spark: SparkSession, path: str, n: int = LATEST_ROWS) -> DataFrame:
    """``latest_n`` of stored predictions."""
    return latest_n(newest_days(spark, path, n).select(*PREDICTION_SCHEMA.names), n)


def score_batches(model: PipelineModel, gold: DataFrame, path: str, batches: list[str], held_out: bool = True) -> None:
    """Score rows of the feature layer (those held out of training, or all) and replace the batches' predictions."""
    rows = of_batches(gold, batches)
    rows = split(rows)[1] if held_out else rows
    write_dated(prediction_table(score(model, rows)), path, batches)
