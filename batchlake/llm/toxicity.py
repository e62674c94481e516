"""Toxicity by logistic regression over hashed word n-grams, learnt by FTRL-proximal.

FTRL keeps two numbers for each coordinate: the sum of its gradients, shifted as weights
move, and the sum of their squares, which sets the coordinate's own rate. An L1 term
leaves coordinates at exactly zero until they have earned a weight, so the model is a
short list of (coordinate, weight) that can be broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchlake.llm.base import landed, small_batches
from batchlake.llm.words import WordHasher, lower_ascii, mix

DIMENSIONS = 1 << 20
#: Labelled rows that a model is fitted on, at most: the first by a hash of their id.
SAMPLE_ROWS = 12_000
#: Score from which a document counts as toxic.
THRESHOLD = 0.7


@dataclass(frozen=True)
class Ftrl:
    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 10.0
    l2: float = 0.1
    epochs: int = 8
    #: weight of a toxic row: they are few, and missing one costs more
    lift: float = 3.0
    #: rows that must have a coordinate before it can earn a weight
    least_rows: int = 3


def _words() -> WordHasher:
    """Words are runs of ASCII letters and digits and of all bytes beyond ASCII."""
    letters = np.zeros(256, bool)
    letters[128:] = True
    for low, high in ((48, 58), (65, 91), (97, 123)):
        letters[low:high] = True
    return WordHasher(letters, lower_ascii())


def _grams(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates of words, neighbours and pairs with one word between, and whose they are."""
    pair, gap = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
    shift = np.uint64(65 - DIMENSIONS.bit_length())
    grams, owners = [hashes], [owner]
    for step, salt in ((1, pair), (2, gap)):
        if len(hashes) > step:
            together = owner[:-step] == owner[step:]
            grams.append(mix(hashes[:-step] * salt + hashes[step:])[together])
            owners.append(owner[:-step][together])
    return (np.concatenate(grams) >> shift).astype(np.int32), np.concatenate(owners)


def _owners(offsets: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(offsets) - 1, dtype=np.int64), np.diff(offsets))


def fit(rows: list[tuple[np.ndarray, int]], ftrl: Ftrl = Ftrl()) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and weights from rows of (distinct coordinates, label).

    Coordinate DIMENSIONS is the constant. No rows give no weights.
    """
    grad, square = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)

    def weights(at: np.ndarray | slice) -> np.ndarray:
        z, n = grad[at], square[at]
        pull = np.sign(z) * ftrl.l1 - z
        return np.where(np.abs(z) <= ftrl.l1, 0.0, pull / ((ftrl.beta + np.sqrt(n)) / ftrl.alpha + ftrl.l2))

    seen = np.zeros(DIMENSIONS + 1, np.int32)
    for at, _ in rows:
        seen[at] += 1
    seen[DIMENSIONS] = ftrl.least_rows
    for i, (at, label) in enumerate(rows):  # in place: the whole rows go one by one
        rows[i] = np.append(at[seen[at] >= ftrl.least_rows], DIMENSIONS), label
    for _ in range(ftrl.epochs):
        for at, label in rows:
            w = weights(at)
            error = (sigmoid(w.sum()) - label) * (ftrl.lift if label else 1)
            n = square[at]
            sigma = (np.sqrt(n + error * error) - np.sqrt(n)) / ftrl.alpha
            grad[at] += error - sigma * w
            square[at] += error * error
    w = weights(slice(None))
    return np.flatnonzero(w).astype(np.int32), w[np.flatnonzero(w)]


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, ftrl: Ftrl = Ftrl()) -> DataFrame:
    """A model, rows of (coordinate, weight), from the labelled rows that are not held out.

    At most ``sample_rows`` labelled ids are used, the first by a hash of the id, so the
    broadcast, the features and the one task that runs FTRL over them in that order are
    bounded; the features are made in parallel. Of labels that differ for one id the larger
    counts, of texts that share an id the largest; equal feature sets count once. The model
    is written to the shared folder, so no later failure fits it again.
    """
    small_batches(docs.sparkSession)
    order = F.xxhash64("id")
    wanted = (
        labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(order, "id")
        .limit(sample_rows)
    )
    texts = docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    sample = texts.join(F.broadcast(wanted), "id").groupBy("id", "toxic").agg(F.max("text").alias("text"))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _words()
        for batch in batches:
            hashes, offsets = hasher([v.as_py().encode("utf-8", "replace") for v in batch.column(2)])
            made = []
            for a, b in zip(offsets[:-1], offsets[1:]):
                own, _ = _grams(hashes[a:b], np.zeros(b - a, np.int8))
                made.append(np.unique(own))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.list_(pa.int32()))], names=["id", "toxic", "at"])

    def learnt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, known = [], set()
        for batch in batches:
            for label, at in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = at.values.to_numpy(zero_copy_only=False)
                key = label, hashlib.sha1(values.tobytes()).digest()
                if key not in known:
                    known.add(key)
                    rows.append((values, int(label > 0)))
        at, weights = fit(rows, ftrl)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(weights, pa.float64())], names=["coordinate", "weight"])

    made = landed(sample.mapInArrow(featured, f"id {sample.schema['id'].dataType.simpleString()}, toxic int, at array<int>"), "toxic-sample")
    model = made.repartition(1).sortWithinPartitions(order, "id").select("toxic", "at").mapInArrow(learnt, "coordinate int, weight double")
    return landed(model, "toxic-model")


def scored(docs: DataFrame, model: DataFrame, keep: list[Column]) -> DataFrame:
    """``keep`` columns and ``score`` (0 to 1) of every row; an empty text has the prior's score.

    The weights, at most DIMENSIONS + 1 by construction, are broadcast. Each distinct
    n-gram of a whole text counts once. No model rows (nothing to learn from) give 0.5.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = model.collect()  # at most DIMENSIONS + 1
    table = np.zeros(DIMENSIONS)
    constant = sum(r.weight for r in rows if r.coordinate == DIMENSIONS)
    for r in rows:
        if r.coordinate < DIMENSIONS:
            table[r.coordinate] = r.weight
    at = np.flatnonzero(table).astype(np.int32)
    shipped = spark.sparkContext.broadcast((at, table[at], constant))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, values, constant = shipped.value
        table = np.zeros(DIMENSIONS)
        table[at] = values
        hasher = _words()
        for batch in batches:
            last = batch.num_columns - 1
            hashes, offsets = hasher([(v.as_py() or "").encode("utf-8", "replace") for v in batch.column(last)])
            coordinates, owners = _grams(hashes, _owners(offsets))
            weighty = table[coordinates] != 0
            once = np.unique(owners[weighty] * (DIMENSIONS * 2) + coordinates[weighty])
            sums = np.bincount(once // (DIMENSIONS * 2), table[once % (DIMENSIONS * 2)], batch.num_rows)
            score = pa.array(sigmoid(sums + constant), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], score], names=names)

    taken = docs.select(*keep, F.col("text").alias("__text"))
    schema = T.StructType([*taken.schema.fields[:-1], T.StructField("score", T.DoubleType())])
    names = schema.names
    return taken.mapInArrow(work, schema)


def civil(docs: DataFrame, model: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows below the threshold, unchanged, whatever their columns are called."""
    return scored(docs, model, [F.struct(*[docs[c] for c in docs.columns]).alias("row")]).filter(
        F.col("score") < threshold
    ).select("row.*")
