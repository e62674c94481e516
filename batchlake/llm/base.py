"""What the operators of this subpackage share: tables, scratch tables, settings."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlake.session import work_path

#: Functions of this subpackage travel to the workers whole, so that the package need not
#: be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__package__])

#: Rows and bytes of one Arrow batch: documents can be long, so few rows at a time.
ARROW_ROWS = 128
ARROW_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds of long texts at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


#: Spark's setting: shuffle files go at the end of the execution that made them.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Paths of the scopes that are open, the innermost last.
_scopes: list[list[str]] = []


def give_back() -> None:
    """Return memory that earlier operators of a Python worker have freed, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def landed(df: DataFrame, label: str, kept: bool = False) -> DataFrame:
    """Write to a new folder below the shared one and read it from there.

    Cuts the lineage: a lost executor costs the tasks it ran, not the steps before. Spark removes
    the shuffle files of the job when the table is written. Inside a
    ``scratch`` scope the table goes with the scope; a ``kept`` one goes with the scope around it.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    around = _scopes[: len(_scopes) - kept]
    if around:
        around[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables landed inside are deleted at the end, so nothing that is read later may hang on them."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def row_and(df: DataFrame, **columns: Column) -> DataFrame:
    """The whole row as one column ``row`` plus named ones, so that no name clashes."""
    return df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), *[c.alias(n) for n, c in columns.items()])


def text_bytes(text: str = "text") -> Column:
    """UTF-8 bytes of a text; a null text has none."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")
