"""From dropped files to predictions in one stream.

Each trigger ingests its files, scores the batches that they belong to with a stored model
and replaces these batches' predictions. All of a batch is scored again, because its
progress, a model input, is relative to the batch's end. A replayed trigger gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from batchlake.functions.schema import GOLD_SCHEMA
from batchlake.plans.predictions import score_batches
from batchlake.sources.layers import exists, load_model, read_batches
from batchlake.streaming.drop_folder import ingest_files, layer_paths

Ingest = Callable[..., dict[str, int]]
Gold = Callable[[SparkSession, str, list[str]], DataFrame]


def rebuilt_gold(spark: SparkSession, out: str, batches: list[str]) -> DataFrame:
    """Feature rows of some batches of a lake that ``ingest_files`` has built."""
    return read_batches(spark, layer_paths(out)["gold"], GOLD_SCHEMA, batches)


def with_scores(model_path: str, predictions_path: str, ingest: Ingest = ingest_files, gold: Gold = rebuilt_gold, held_out: bool = True) -> Ingest:
    """An ``ingest`` for ``ingest_stream`` that also keeps the predictions up to date.

    With ``incremental.append_files`` and ``incremental.read_gold`` only the neighbourhood of new
    rows is recomputed before the batch is scored.
    """

    def run(spark: SparkSession, files: list[str], batches: list[str], root: str, out: str, batch_by: str) -> dict[str, int]:
        counts = ingest(spark, files, batches, root, out, batch_by)
        if exists(spark, layer_paths(out)["gold"]) or gold is not rebuilt_gold and counts["rows_in"]:
            score_batches(load_model(model_path), gold(spark, out, batches), predictions_path, batches, held_out)
        return counts

    return run
