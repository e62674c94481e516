"""A training corpus out of ``documents``: five stages, each written and read again.

Rows that are toxic go; boilerplate lines go; one document of each group of near
duplicates stays; documents that hold a benchmark passage go; the rest is encoded.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlake.llm import bpe, decontaminate, line_dedup, ngram_join, toxicity
from batchlake.llm.base import landed, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Near duplicates: word n-grams of five, Jaccard of at least 0.8.
WORDS, PERCENT = 5, 80


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The model learns from the corpus's labels; rows below the threshold stay unchanged."""
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.civil(docs, model)


def lines_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, without its host's boilerplate; ``n_chars`` follows the text."""
    done = line_dedup.drop_boilerplate(docs, F.col("source"))
    row = F.col("row")
    return done.select(
        *[
            F.col("text")
            if c == "text"
            else (F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema[c].dataType)).otherwise(row[c]) if c == "n_chars" else row[c]).alias(c)
            for c in docs.columns
        ]
    )


def copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group, the document with the smallest doc_id stays; of rows that share it, one.

    Documents without words, or without an id, are in no group and stay.
    """
    return ngram_join.representatives(docs, WORDS, PERCENT)


def leaks_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    return bpe.encoded(docs, F.col("text"), path, public_tokenizers.PATTERN, ["doc_id", "lang", "source"])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic_out),
    ("line dedup", lines_out),
    ("n-gram Jaccard join", copies_out),
    ("benchmark decontamination", leaks_out),
    ("byte-level BPE", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: The model and the tokenizer can't be said in SQL.
ORACLE_SQL = None
