"""Monitoring queries over predictions: the data behind a plant dashboard.

All of them look at the newest ``n`` predictions (``latest_n``); pass the
predictions themselves to the functions that take ``recent`` to cover all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchlake.functions.schema import BATCH, TARGET, TIME
from batchlake.operators.learn import r2_expr, rmse_expr
from batchlake.plans.reports import abs_error

# Dashboard limits.
LATEST_ROWS = 5_000
VISCOSITY_RANGE = (800, 900)
ERROR_LIMIT = 50
HISTOGRAM_BINS = 20


def latest_n(predictions: DataFrame, n: int = LATEST_ROWS) -> DataFrame:
    """The last ``n`` rows by time, ascending, with their error."""
    newest = predictions.orderBy(F.desc(TIME), F.desc(BATCH)).limit(n)
    return abs_error(newest).orderBy(TIME, BATCH)


def _newest(*cols: str) -> list[Column]:
    """Values of the row with the greatest (time, batch)."""
    newest = F.max_by(F.struct(*cols), F.struct(TIME, BATCH))
    return [newest[c].alias(c) for c in cols]


def latest_reading(recent: DataFrame) -> DataFrame:
    """The newest row: prediction to one decimal, readings as they are.

    ``actual_cp`` is the look-ahead target of that row.
    """
    row = recent.agg(F.count("*").alias("_n"), *_newest(*recent.columns)).filter("_n > 0")
    return row.select(
        TIME,
        BATCH,
        "temperature_c",
        "ph_level",
        F.col(TARGET).alias("actual_cp"),
        F.round("prediction", 1).alias("prediction"),
    )


def error_card(avg_error: Column, limit: float) -> list[Column]:
    return [avg_error.alias("avg_error"), (avg_error < limit).alias("error_ok")]


def avg_error_card(recent: DataFrame, limit: float = ERROR_LIMIT) -> DataFrame:
    mean = recent.agg(F.round(F.avg("error"), 2).alias("avg_error")).filter("avg_error IS NOT NULL")
    return mean.select(*error_card(F.col("avg_error"), limit))


def distinct_batches(recent: DataFrame) -> DataFrame:
    """Number of batches; NULL when the table has no batch column."""
    counted = F.countDistinct(BATCH) if BATCH in recent.columns else F.lit(None).cast("bigint")
    return recent.agg(counted.alias("n_batches"))


def rows_shown(recent: DataFrame) -> DataFrame:
    return recent.agg(F.count("*").alias("rows_shown"))


def alert_columns(shown: Column, lo: float, hi: float) -> list[Column]:
    in_range = shown.between(lo, hi)
    status = F.when(in_range, "within range").otherwise("outside range")
    return [shown.alias("prediction"), in_range.alias("in_range"), status.alias("status")]


def range_alert(
    df: DataFrame, lo: float = VISCOSITY_RANGE[0], hi: float = VISCOSITY_RANGE[1]
) -> DataFrame:
    """Every prediction, as shown to one decimal, against the accepted range."""
    return df.select(TIME, BATCH, *alert_columns(F.round("prediction", 1), lo, hi))


def series(recent: DataFrame, cols=("temperature_c", "ph_level", TARGET, "prediction")) -> DataFrame:
    """Chart series in long form: one row per reading and measure, by time."""
    return recent.unpivot([TIME, BATCH], list(cols), "measure", "value").orderBy(
        TIME, BATCH, "measure"
    )


def error_histogram(recent: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins between smallest and greatest error; only bins with rows."""
    span = recent.agg(F.struct(F.min("error").alias("lo"), F.max("error").alias("hi"))).scalar()
    bounded = recent.filter("error IS NOT NULL").select(
        "error", span["lo"].alias("lo"), span["hi"].alias("hi")
    )
    width = (F.col("hi") - F.col("lo")) / bins
    position = F.floor(F.try_divide(F.col("error") - F.col("lo"), width))
    placed = F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)).cast("int")
    return (
        bounded.groupBy(placed.alias("bin"), "lo", width.alias("width"))
        .agg(F.count("*").alias("rows"))
        .select(
            "bin",
            (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"),
            (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
            "rows",
        )
    )


def importance_series(importance: DataFrame) -> DataFrame:
    """Importances with their display tier: ranks 1-3 high, 4-6 middle, rest low."""
    tier = F.when(F.col("rank") <= 3, "high").when(F.col("rank") <= 6, "middle").otherwise("low")
    return importance.withColumn("tier", tier)


def monitor_snapshot(
    recent: DataFrame,
    predictions: DataFrame | None = None,
    lo: float = VISCOSITY_RANGE[0],
    hi: float = VISCOSITY_RANGE[1],
    limit: float = ERROR_LIMIT,
) -> DataFrame:
    """All cards in one row; no row without data.

    The cards look at ``recent``; RMSE and R² are the model's and come from all
    ``predictions`` when these are given.
    """
    shown = ["temperature_c", "ph_level", TARGET, "prediction"]
    row = recent.agg(
        F.count("*").alias("rows_shown"),
        F.countDistinct(BATCH).alias("n_batches"),
        F.round(F.avg("error"), 2).alias("avg_error"),
        F.max(TIME).alias("latest_time"),
        *_newest(*shown),
    ).filter("rows_shown > 0")
    accuracy = (recent if predictions is None else predictions).agg(
        F.round(rmse_expr(), 6).alias("rmse"), F.round(r2_expr(), 6).alias("r2")
    )
    row = row.join(F.broadcast(accuracy))  # one row each
    return row.select(
        "latest_time",
        F.round("temperature_c", 1).alias("temperature_c"),
        F.round("ph_level", 2).alias("ph_level"),
        F.round(TARGET, 1).alias("actual_cp"),
        *alert_columns(F.round("prediction", 1), lo, hi),
        *error_card(F.col("avg_error"), limit),
        "rmse",
        "r2",
        "n_batches",
        "rows_shown",
    )
