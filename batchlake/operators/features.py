"""Feature operators over (batch, time) series.

Names such as ``temp_rolling_avg_5`` and ``viscosity_target_10min`` are kept
from the domain: the rolling mean covers the current row and the 5 before it,
the target is the value 10 rows ahead, and rates are per row.

Every window operator takes an optional ``profile`` (see ``series``); without
one the input itself is counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchlake.functions.cells import is_positive
from batchlake.functions.schema import BATCH, ENGINEERED, MODEL_INPUTS, SENSORS, TARGET, TIME
from batchlake.operators.series import (
    BatchProfile,
    WindowExpr,
    attach,
    over_batches,
    profile_batches,
)

ROLLING_BACK = 5
TARGET_STEPS = 10

# Sensor -> prefix of its engineered columns.
PREFIX = {"temperature_c": "temp", "ph_level": "ph", "viscosity_cp": "visc"}
LAGS = {
    "temp_lag_1": ("temperature_c", 1),
    "viscosity_lag_1": ("viscosity_cp", 1),
    "viscosity_lag_5": ("viscosity_cp", 5),
    "viscosity_lag_10": ("viscosity_cp", 10),
}


def rolling_expr(col: str, preceding: int = ROLLING_BACK) -> WindowExpr:
    return lambda w: F.avg(col).over(w.rowsBetween(-preceding, 0))


def lag_expr(col: str, steps: int) -> WindowExpr:
    return lambda w: F.lag(col, steps).over(w)


def rate_expr(col: str) -> WindowExpr:
    return lambda w: F.col(col) - F.lag(col, 1).over(w)


def lead_expr(col: str, steps: int) -> WindowExpr:
    return lambda w: F.lead(col, steps).over(w)


def rolling_avg(
    df: DataFrame,
    cols: dict[str, str] | None = None,
    preceding: int = ROLLING_BACK,
    profile: BatchProfile | None = None,
) -> DataFrame:
    """Mean over the current and the ``preceding`` rows; ``cols`` maps sensor to prefix."""
    exprs = {
        f"{prefix}_rolling_avg_{preceding}": rolling_expr(col, preceding)
        for col, prefix in (cols or PREFIX).items()
    }
    return over_batches(df, exprs, preceding, 0, profile or profile_batches(df))


def lag_features(
    df: DataFrame,
    lags: dict[str, tuple[str, int]] | None = None,
    profile: BatchProfile | None = None,
) -> DataFrame:
    lags = lags or LAGS
    exprs = {name: lag_expr(col, steps) for name, (col, steps) in lags.items()}
    back = max(steps for _, steps in lags.values())
    return over_batches(df, exprs, back, 0, profile or profile_batches(df))


def rate_of_change(
    df: DataFrame, cols: dict[str, str] | None = None, profile: BatchProfile | None = None
) -> DataFrame:
    exprs = {f"{prefix}_rate_change": rate_expr(col) for col, prefix in (cols or PREFIX).items()}
    return over_batches(df, exprs, 1, 0, profile or profile_batches(df))


def lead_target(
    df: DataFrame,
    col: str = "viscosity_cp",
    steps: int = TARGET_STEPS,
    name: str = TARGET,
    profile: BatchProfile | None = None,
) -> DataFrame:
    exprs = {name: lead_expr(col, steps)}
    return over_batches(df, exprs, 0, steps, profile or profile_batches(df))


def batch_stats(df: DataFrame, col: str = "batch_time_mins") -> DataFrame:
    """One row per batch: first and last batch time."""
    return df.groupBy(BATCH).agg(
        F.min(col).alias("batch_start"), F.max(col).alias("batch_end")
    )


def batch_bounds(
    df: DataFrame, col: str = "batch_time_mins", n_batches: int | None = None
) -> DataFrame:
    """Append ``batch_start`` and ``batch_end`` to every row.

    With the number of batches known and small the rows are not shuffled at
    all; otherwise Spark joins, and splits a large batch over many tasks.
    """
    return attach(df, batch_stats(df, col), BATCH, n_batches)


def progress_expr(col: str = "batch_time_mins") -> Column:
    span = F.col("batch_end") - F.col("batch_start")
    return F.try_divide(F.col(col) - F.col("batch_start"), span) * 100


def batch_progress(df: DataFrame, col: str = "batch_time_mins") -> DataFrame:
    """Percent of the batch done; NULL for a batch without duration."""
    return df.withColumn("batch_progress_pct", progress_expr(col))


def drop_incomplete(df: DataFrame, cols=(*MODEL_INPUTS, TARGET)) -> DataFrame:
    """Drop rows with NULL or NaN in any of the columns."""
    return df.dropna(subset=list(cols))


def positive_target(df: DataFrame, col: str = TARGET) -> DataFrame:
    return df.filter(is_positive(F.col(col)))


def row_exprs() -> dict[str, WindowExpr]:
    """The engineered columns that depend on neighbouring rows only, the target included."""
    exprs: dict[str, WindowExpr] = {}
    for col, prefix in PREFIX.items():
        exprs[f"{prefix}_rolling_avg_{ROLLING_BACK}"] = rolling_expr(col)
    for name, (col, steps) in LAGS.items():
        exprs[name] = lag_expr(col, steps)
    for col, prefix in PREFIX.items():
        exprs[f"{prefix}_rate_change"] = rate_expr(col)
    exprs[TARGET] = lead_expr("viscosity_cp", TARGET_STEPS)
    return exprs


#: Rows before and after a row that its engineered columns look at.
ROWS_BACK = max(ROLLING_BACK, *[steps for _, steps in LAGS.values()])
ROWS_AHEAD = TARGET_STEPS


def engineer_rows(df: DataFrame, profile: BatchProfile | None = None) -> DataFrame:
    """``row_exprs`` on all rows."""
    return over_batches(df, row_exprs(), ROWS_BACK, ROWS_AHEAD, profile or profile_batches(df))


def engineer(df: DataFrame, profile: BatchProfile | None = None) -> DataFrame:
    """All engineered columns on all rows; nothing dropped."""
    profile = profile or profile_batches(df)
    bounds = {"batch_start": F.min("batch_time_mins"), "batch_end": F.max("batch_time_mins")}
    return batch_progress(over_batches(df, row_exprs(), ROWS_BACK, ROWS_AHEAD, profile, bounds))


def build_features(silver: DataFrame, profile: BatchProfile | None = None) -> DataFrame:
    """Clean readings to complete, model-ready rows (columns of the feature layer)."""
    ready = positive_target(drop_incomplete(engineer(silver, profile)))
    passed_through = [c for c in silver.columns if c not in (TIME, *SENSORS, BATCH)]
    return ready.select(TIME, *SENSORS, *passed_through, *ENGINEERED, TARGET, BATCH)
