from __future__ import annotations

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from batchlake.llm import toxicity as tx

BAD = ["scum", "trash", "moron"]


def rows(n: int):
    rnd = random.Random(11)
    words = ["".join(rnd.choices("abcdefgh", k=rnd.randint(2, 5))) for _ in range(800)]
    docs, labels = [], []
    for i in range(n):
        own = rnd.choices(words, k=rnd.randint(20, 80))
        toxic = i % 6 == 0
        for _ in range(3 * toxic):
            own[rnd.randrange(len(own))] = rnd.choice(BAD).upper() + "!"
        docs.append((i, " ".join(own), "x"))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_only_the_lesson_counts(spark):
    docs, labels = rows(1500)
    d = spark.createDataFrame(docs, "doc_id long, text string, score string")
    held = {i for i, *_ in docs if zlib.crc32(str(i).encode()) % 3 == 1}
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.score for r in tx.scored(d, tx.train(d, frame), [F.col("doc_id")]).collect()}
    right = [(got[i] >= tx.THRESHOLD) == bool(t) for i, _, t in labels if i in held]
    assert len(got) == 1500 and len(right) > 400 and np.mean(right) > 0.97
    # labels of held-out rows must not matter
    lies = spark.createDataFrame([(i, q, 1 - t if i in held else t) for i, q, t in labels], "doc_id long, quality int, toxic int")
    again = {r.doc_id: r.score for r in tx.scored(d, tx.train(d, lies), [F.col("doc_id")]).collect()}
    assert again == got


def test_nulls_repeats_empty_tables(spark):
    docs = [(1, None, "x"), (2, "", "x"), (None, "scum", "x"), (3, "fine words", "x"), (3, "fine words", "x"), (4, "a " * 30_000, "x")]
    d = spark.createDataFrame(docs, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, None), (None, 1, 1), (3, 1, 1), (3, 1, 0)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0)):
        model = tx.train(d, known)
        got = tx.scored(d, model, [F.col("doc_id")]).collect()
        assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
        assert tx.civil(d, model).columns == d.columns
    assert tx.scored(d.limit(0), model, [F.col("doc_id")]).count() == 0


def test_l1_leaves_noise_at_zero():
    rnd = np.random.default_rng(2)
    made = [(np.unique(np.append(rnd.integers(10, 5000, 60), [3] * (i % 5 == 0)).astype(int)), int(i % 5 == 0)) for i in range(800)]
    at, weights = tx.fit(made)
    assert 3 in at and len(at) < 400 and weights[list(at).index(3)] > 2
