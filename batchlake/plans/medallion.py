"""The layer plans: raw rows -> clean layer -> feature layer -> predictions."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlake.functions.schema import (
    BATCH,
    GOLD_SCHEMA,
    NULL_TOKENS,
    PREDICTION_SCHEMA,
    PROVENANCE,
    SENSORS,
    SILVER_SCHEMA,
    TIME,
    TIME_FORMATS,
    with_extra,
)
from batchlake.operators.clean import dedupe, observe_cleaning, observed, type_rows, usable
from batchlake.operators.features import build_features, drop_incomplete
from batchlake.operators.learn import (
    feature_importance,
    prediction_table,
    r2_expr,
    rmse_expr,
    score,
    split,
    train,
)
from batchlake.sources.layers import read_layer, save_model, write_layer, write_predictions


def clean(
    raw: DataFrame, order=tuple(PROVENANCE), formats=TIME_FORMATS, tokens=NULL_TOKENS
) -> DataFrame:
    """Raw string rows to the clean layer: typed, positive, one row per (batch, time)."""
    rows = dedupe(usable(type_rows(raw, formats, tokens)), (BATCH, TIME), order)
    passed_through = [c for c in rows.columns if c == "extra"]
    return rows.select(TIME, *SENSORS, *passed_through, BATCH)


def build_silver(
    bronze: DataFrame, path: str, batches: list[str] | None = None, **clean_options
) -> dict[str, int]:
    """Clean and write; returns row counts taken inside the write job.

    ``batches`` are all batches that ``bronze`` is about: those of them without a clean
    row lose the rows that the layer has of them.
    """
    silver, rows_in, rows_out = observe_cleaning(bronze, lambda df: clean(df, **clean_options))
    write_layer(silver, path, batches=batches)
    counted = observed(rows_in, "rows_in")
    return {
        "rows_in": bronze.count() if counted is None else counted,
        "rows_saved": observed(rows_out, "rows_saved") or 0,
    }


def build_gold(silver: DataFrame, path: str, batches: list[str] | None = None) -> None:
    """Engineer features and write."""
    write_layer(build_features(silver), path, batches=batches)


def fit_and_score(
    spark: SparkSession, gold_path: str, model_path: str, predictions_path: str, **forest
) -> tuple[PipelineModel, DataFrame]:
    """Train on the feature layer, store the model and the test-split predictions.

    Returns the model and one row of sizes, RMSE, R² and importances (by input).
    """
    train_rows, test_rows = split(drop_incomplete(read_layer(spark, gold_path, GOLD_SCHEMA)))
    model = train(train_rows, **forest)
    save_model(model, model_path)
    write_predictions(prediction_table(score(model, test_rows)), predictions_path)
    stored = read_layer(spark, predictions_path, PREDICTION_SCHEMA)
    weights = feature_importance(spark, model).agg(
        F.map_from_entries(F.collect_list(F.struct("feature", "importance"))).alias("importances")
    )
    report = (
        stored.agg(F.count("*").alias("test_rows"), rmse_expr().alias("rmse"), r2_expr().alias("r2"))
        .join(F.broadcast(train_rows.agg(F.count("*").alias("train_rows"))))  # one row each
        .join(F.broadcast(weights))
    )
    return model, report


def run_layers(
    spark: SparkSession, bronze: DataFrame, silver_path: str, gold_path: str
) -> dict[str, int]:
    counts = build_silver(bronze, silver_path)
    build_gold(read_layer(spark, silver_path, with_extra(SILVER_SCHEMA)), gold_path)
    return counts


__all__ = [
    "build_gold",
    "build_silver",
    "clean",
    "fit_and_score",
    "run_layers",
]
