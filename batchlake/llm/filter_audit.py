"""How filters interact, for every order in which they can run, by wide packed counters.

What a document does in an order depends only on its mask, the set of filters that it fails. One big
integer for each mask holds, in fields of 64 bits, what happens at all steps of all
orders: removed here, redundant here, kept after it. Integers add up field by field, so
one sum per part counts every order at once; a field cannot run over into the next one
before there are 2**64 documents.

A task adds the integers of its rows up, part by part; sums of tasks are added in two
levels, so no task meets more sums than there are tasks in one of GROUPS groups.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchlake.llm.base import text_bytes

FILTERS = "ABCDE"
MOST_FAILED = 1 << len(FILTERS)
#: Bits behind the filters of a mask: the document is good, the document is toxic.
GOOD, TOXIC = MOST_FAILED, MOST_FAILED << 1
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = [(order, step) for order in ORDERS for step in range(len(FILTERS))]
#: What each step counts, in the order of the fields.
COUNTED = ("kept", "removed", "redundant", "good_lost", "toxic_lost")
FIELD_BYTES = 8
WHOLE_BYTES = FIELD_BYTES * len(STEPS) * len(COUNTED)
#: Parts of which a task keeps a sum at once, and groups in which the sums of tasks are added first.
OPEN_PARTS, GROUPS = 64, 64
# White space between words, as a character class of Java's patterns.
SPACE = r"\x20\x09-\x0D"


def outcomes(mask: int) -> np.ndarray:
    """For every step: kept after it, removed here, redundant here, good removed, toxic removed (0 or 1)."""
    rows = np.zeros((len(STEPS), len(COUNTED)), "<u8")
    for row, (order, step) in zip(rows, STEPS):
        before = any(mask >> FILTERS.index(f) & 1 for f in order[:step])
        fails = mask >> FILTERS.index(order[step]) & 1
        removed = fails and not before
        row[:] = (not before and not fails, removed, fails and before, removed and mask & GOOD > 0, removed and mask & TOXIC > 0)
    return rows


@cache
def packed(mask: int) -> int:
    """The outcomes of a mask as one integer."""
    return int.from_bytes(outcomes(mask).tobytes(), "little")


def unpacked(total: int) -> np.ndarray:
    """Counts of a sum of packed outcomes: steps x COUNTED."""
    return np.frombuffer(total.to_bytes(WHOLE_BYTES, "little"), "<u8").reshape(len(STEPS), len(COUNTED))


def failures(text: Column) -> Column:
    """Mask of the filters A to D that a text fails; a null text is empty."""
    text = F.coalesce(text, F.lit(""))

    def judged(words: Column) -> Column:
        n = F.size(words)
        capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
        failed = [
            n < 100,
            100 * F.size(F.array_distinct(words)) < 80 * n,
            100 * capitals > 10 * F.length(text),
            text.rlike("[#$%&*|]"),
        ]
        return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failed)), F.lit(0))

    # bound once, since the list of words is used three times
    return F.transform(F.array(F.regexp_extract_all(text, F.lit(f"[^{SPACE}]+"), F.lit(0))), judged)[0]


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask) of every document; a mask holds the filters it fails and its labels.

    A text is told by its SHA-256. Of equal texts, those of the smallest doc_id pass E; a
    null doc_id is neither smaller nor larger than any, so it passes and fails nobody.
    Joins go by document, not by text, so copies by the thousand meet in no task.
    Of several labels of a document, one that says good (or toxic) is enough.
    """
    each = docs.select(
        "doc_id",
        F.coalesce("lang", F.lit("")).alias("part"),
        F.unhex(F.sha2(text_bytes(), 256)).alias("digest"),
        failures(F.col("text")).alias("failed"),
    )
    first = each.filter("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marks = (
        labels.filter("doc_id is not null and (quality = 1 or toxic = 1)")
        .groupBy("doc_id")
        .agg(F.max(F.when(F.col("quality") == 1, GOOD).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, TOXIC).otherwise(0)).alias("toxic"))
    )
    copy = F.when(F.col("doc_id").isNotNull() & F.col("first").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    mask = F.col("failed") + copy + F.coalesce("good", F.lit(0)) + F.coalesce("toxic", F.lit(0))
    return each.join(first, ["digest", "doc_id"], "left").join(marks, "doc_id", "left").select("part", mask.cast("int").alias("mask"))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of the packed outcomes of a task's rows, for each part."""
    group = TaskContext.get().partitionId() % GROUPS
    sums: dict[str, int] = {}

    def out() -> pa.RecordBatch:
        totals = [t.to_bytes(WHOLE_BYTES, "little") for t in sums.values()]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([group] * len(sums), pa.int32()), pa.array(totals, pa.binary())], names=["part", "grp", "total"]
        )

    for batch in batches:
        for (part, mask), n in Counter(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())).items():
            if part not in sums and len(sums) >= OPEN_PARTS:
                yield out()
                sums.clear()
            sums[part] = sums.get(part, 0) + n * packed(mask)
    yield out()


def _added(frames: Iterator[pd.DataFrame]) -> int:
    return sum(int.from_bytes(t, "little") for frame in frames for t in frame["total"])


def _merged(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    yield pd.DataFrame({"part": [key[0]], "total": [_added(frames).to_bytes(WHOLE_BYTES, "little")]})


def _report(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of a part: all steps of all orders."""
    counts = unpacked(_added(frames))
    report = pd.DataFrame(counts.astype("int64"), columns=list(COUNTED))
    report.insert(0, "part", key[0])
    report.insert(1, "filter_order", [order for order, _ in STEPS])
    report.insert(2, "step", [step + 1 for _, step in STEPS])
    own = pd.Series([order[step] for order, step in STEPS])
    report["shapley"] = report["removed"].groupby(own).transform("sum")
    # who fails one filter only is what this filter still removes as the last one
    report["unique_fails"] = own.map(report["removed"].where(report["step"] == len(FILTERS)).groupby(own).max()).astype("int64")
    yield report


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, with its counts.

    Parts are the values of ``lang``, a null one is the empty string. An empty table has no
    parts and gives no rows. Other columns, and repeated rows, change nothing: each row counts.
    """
    sums = masks(docs, labels).mapInArrow(_sums, "part string, grp int, total binary")
    merged = sums.groupBy("part", "grp").applyInPandas(_merged, "part string, total binary")
    kinds = ", ".join(f"{c} long" for c in (*COUNTED, "shapley", "unique_fails"))
    return (
        merged.groupBy("part")
        .applyInPandas(_report, f"part string, filter_order string, step int, {kinds}")
        .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    )
