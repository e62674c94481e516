"""Summaries of layers, one line per batch, that reports merge instead of reading the rows.

A line has the rows of its batch, its first and last time and, for each measure, how many
values it has, their sum, sum of squares, least and greatest. All of these can be merged, and a
line is replaced with its batch, so a report over a layer of any size reads one line per batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlake.functions.schema import BATCH, GOLD_SCHEMA, PREDICTION_SCHEMA, SILVER_SCHEMA, TARGET, TIME
from batchlake.operators.clean import quality_counters
from batchlake.plans.reports import ACCURACY_SUMMARY, FEATURE_SUMMARY, MEASURE_SUMMARY, abs_error
from batchlake.sources.layers import read_batches, read_layer, write_layer

#: Measures that the reports over each layer need.
MEASURES = {
    "silver": ["viscosity_cp"],
    "gold": ["viscosity_cp", "batch_progress_pct", "temp_rate_change"],
    "predictions": ["prediction", "error", "squared_error", TARGET],
}
SCHEMAS = {"silver": SILVER_SCHEMA, "gold": GOLD_SCHEMA, "predictions": PREDICTION_SCHEMA}
PARTS = ("n", "total", "squares", "least", "greatest")
COUNTERS = ["rows_in", "rows_without_time", "rows_impossible", "rows_before_dedupe", "rows_duplicate", "rows_saved"]


def _measure(name: str) -> Column:
    value = F.col(name)
    return F.struct(
        F.count(value).alias("n"), F.sum(value).alias("total"), F.sum(value * value).alias("squares"), F.min(value).alias("least"), F.max(value).alias("greatest")
    ).alias(name)


def summarise(rows: DataFrame, layer: str) -> DataFrame:
    """One line per batch of a layer's rows."""
    if layer == "predictions":
        rows = abs_error(rows).withColumn("squared_error", F.pow(F.col("error"), F.lit(2)))
    per_batch = rows.groupBy(BATCH).agg(
        F.count("*").alias("rows"), F.min(TIME).alias("first_time"), F.max(TIME).alias("last_time"), *[_measure(m) for m in MEASURES[layer]]
    )
    return per_batch.select("rows", "first_time", "last_time", *MEASURES[layer], BATCH)


def summary_schema(layer: str) -> str:
    numbers = "struct<n:bigint,total:double,squares:double,least:double,greatest:double>"
    return f"rows long, first_time timestamp_ntz, last_time timestamp_ntz, {', '.join(f'{m} {numbers}' for m in MEASURES[layer])}, {BATCH} string"


def summary_path(path: str) -> str:
    return path.rstrip("/") + "_summary"


def store_summary(spark: SparkSession, path: str, layer: str, batches: list[str] | DataFrame) -> None:
    """Renew the lines of some batches from the rows that the layer at ``path`` has of them; no other row is read."""
    rows = read_batches(spark, path, SCHEMAS[layer], batches)
    write_layer(summarise(rows, layer), summary_path(path), batches=batches)


def read_summary(spark: SparkSession, path: str, layer: str) -> DataFrame:
    return read_layer(spark, summary_path(path), summary_schema(layer))


# -- reports -------------------------------------------------------------------


def _merged(measure: str, kind: str) -> Column:
    part = {p: F.col(f"{measure}.{p}") for p in PARTS}
    if kind == "count":
        return F.coalesce(F.sum(part["n"]), F.lit(0))
    if kind == "avg":
        return F.try_divide(F.sum(part["total"]), F.sum(part["n"]))
    return F.min(part["least"]) if kind == "min" else F.max(part["greatest"])


def _report(lines: DataFrame, measures: dict[str, tuple[str, str, int | None]]) -> DataFrame:
    made = {name: (_merged(col, kind), places) for name, (kind, col, places) in measures.items()}
    return lines.agg(*[(value if places is None else F.round(value, places)).alias(name) for name, (value, places) in made.items()])


def layer_summary(lines: DataFrame, layer: str) -> DataFrame:
    names = SCHEMAS[layer].names
    return lines.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.lit(len(names)).alias("n_columns"), F.lit(",".join(names)).alias("columns"))


def date_range(lines: DataFrame) -> DataFrame:
    return lines.agg(F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"))


def measure_stats(lines: DataFrame) -> DataFrame:
    return _report(lines, MEASURE_SUMMARY)


def rows_per_batch(lines: DataFrame, n: int | None = 30) -> DataFrame:
    counts = lines.select(BATCH, "rows").orderBy(BATCH)
    return counts if n is None else counts.limit(n)


def feature_stats(lines: DataFrame) -> DataFrame:
    return _report(lines, FEATURE_SUMMARY)


def accuracy_summary(lines: DataFrame) -> DataFrame:
    return _report(lines, ACCURACY_SUMMARY)


def model_accuracy(lines: DataFrame) -> DataFrame:
    """RMSE and R² of all stored predictions."""
    n, squares = F.sum("squared_error.n"), F.sum("squared_error.total")
    labels, total = F.sum(f"{TARGET}.n"), F.sum(f"{TARGET}.total")
    spread = F.sum(f"{TARGET}.squares") - F.try_divide(total * total, labels)
    return lines.agg(F.sqrt(F.try_divide(squares, n)).alias("rmse"), (1 - F.try_divide(squares, spread)).alias("r2"))


def batch_counters(raw: DataFrame) -> DataFrame:
    """Quality counters of each batch; a duplicate is one of the same batch, so they add up."""
    return quality_counters(raw, by=[BATCH])


def merged_counters(lines: DataFrame) -> DataFrame:
    return lines.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS])
