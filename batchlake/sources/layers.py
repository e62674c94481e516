"""Parquet layers and stored models."""

from __future__ import annotations

import errno
import os
import re
from concurrent.futures import ThreadPoolExecutor
from contextlib import suppress
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchlake.functions.schema import BATCH
from batchlake.operators.clean import observed
from batchlake.operators.series import BROADCAST_KEYS
from batchlake.session import work_path


#: Layers are stored by buckets of batches: a folder per batch would be as many folders and tiny
#: files as there are batches. Layers with a folder per day or chunk besides have fewer buckets.
BUCKET, BUCKETS, FEW_BUCKETS = "batch_bucket", 64, 16
#: Columns that get folders of their own below a bucket; readers skip files by them.
FOLDERS = ("day", "chunk")
#: Files that are moved at a time.
MOVERS = 16
#: Names that may stand in a filter; more of them are joined.
NAMED = 100
#: Spark's setting for the least size of a task after gathering. Small buckets are many files,
#: which few tasks would write one after another.
LEAST_TASK, LEAST_TASK_BYTES = "spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k"


def bucket_of(batch: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(batch.cast("string")), F.lit(buckets)).cast("int")


def text_rows(spark: SparkSession, **columns: list[str]) -> DataFrame:
    """Rows of text that the plan holds, so that their number is known and no task makes them.

    Handed over at once: a literal each would be a call of the JVM each, and a plan of as many parts.
    """
    return spark.createDataFrame(pa.table({name: pa.array(values, pa.string()) for name, values in columns.items()}))


def names_frame(spark: SparkSession, batches: list[str] | DataFrame) -> DataFrame:
    """Names of batches as rows; names that are rows (of ``BATCH`` alone) stay so, and off the driver."""
    return batches if isinstance(batches, DataFrame) else text_rows(spark, **{BATCH: list(batches)})


def keep_keys(keys: DataFrame, buckets: int = BUCKETS) -> tuple[DataFrame, list[int]]:
    """Distinct keys, written once as they are asked for several times, and the buckets they fall in.

    Keys below ``BROADCAST_KEYS`` are broadcast, so that rows joined with them stay where they are.
    """
    spark, path, seen = keys.sparkSession, work_path(keys.sparkSession, "keys"), Observation()
    fall_in = F.collect_set(bucket_of(F.col(BATCH), buckets)).alias("buckets")
    keys.distinct().observe(seen, F.count(F.lit(1)).alias("n"), fall_in).write.parquet(path)
    kept = spark.read.schema(keys.schema).parquet(path)
    few = (observed(seen, "n") or 0) <= BROADCAST_KEYS
    return F.broadcast(kept) if few else kept, sorted(observed(seen, "buckets") or [])


def of_batches(rows: DataFrame, batches: list[str] | DataFrame) -> DataFrame:
    """The rows of some batches."""
    if not isinstance(batches, DataFrame) and len(batches) <= NAMED:
        return rows.filter(F.col(BATCH).isin(batches))
    return rows.join(names_frame(rows.sparkSession, batches), BATCH, "left_semi")


def _write(df: DataFrame, path: str, cols: list[str], mode: str, rebalance: bool = True) -> None:
    spark = df.sparkSession
    if rebalance:
        df = df.hint("rebalance", *[F.col(c) for c in cols])
    before = spark.conf.get(LEAST_TASK)
    spark.conf.set(LEAST_TASK, LEAST_TASK_BYTES)
    try:
        df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path)
    finally:
        spark.conf.set(LEAST_TASK, before)


def _same(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Semi or anti join on the columns of ``right``, a null equal to a null."""
    keys = right.select(*[F.col(c).alias(f"_key_{c}") for c in right.columns])
    test = [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in right.columns]
    return left.join(keys, reduce(and_, test), how)


def write_layer(
    df: DataFrame,
    path: str,
    partition_cols: str | list[str] = BATCH,
    rebalance: bool = True,
    batches: list[str] | DataFrame | None = None,
    whole_batches: bool = False,
    stored: bool = False,
) -> None:
    """Write Parquet by buckets of batches, replacing only what ``df`` has: the batches, or the
    (batch, file), (batch, day) and the like that ``partition_cols`` name.

    ``batches`` names all that ``df`` is about; those of them without a row lose what the layer
    has of them, and with ``whole_batches`` the others lose all they had, too. A write that fails
    before its end leaves the old rows. ``stored`` says that ``df`` reads files that this write
    leaves alone; other rows are put in a scratch table first where something may be replaced.

    Where nothing is replaced, rows are added to their bucket. A bucket of which something is
    replaced is written anew as a whole. Buckets beyond the advisory partition size are spread
    over several tasks; ``rebalance`` says so for layers that are not stored by batch.
    """
    cols = [partition_cols] if isinstance(partition_cols, str) else list(partition_cols)
    if BATCH not in cols:
        _write(df, path, cols, "overwrite", rebalance)
        return
    folders = [BUCKET, *[c for c in cols if c in FOLDERS]]
    buckets = BUCKETS if len(folders) == 1 else FEW_BUCKETS
    if not _has_buckets(df.sparkSession, path):
        _write(df.withColumn(BUCKET, bucket_of(F.col(BATCH), buckets)), path, folders, "append")
        return
    spark, new = df.sparkSession, df
    if not stored:  # read several times, and perhaps made from what is replaced
        scratch = work_path(spark, "layer-rows")
        df.write.parquet(scratch)
        new = spark.read.schema(df.schema).parquet(scratch)
    gone = [new.select(*cols)]
    if batches is not None and (isinstance(batches, DataFrame) or batches):
        named = names_frame(spark, batches).select(BATCH)
        if cols != [BATCH]:
            gone.append(named if whole_batches else _same(named, new.select(BATCH).distinct(), "left_anti"))
        else:
            gone = [named if stored else named.union(gone[0])]
    _replace(spark, path, new, gone, folders, buckets)


def _replace(spark: SparkSession, path: str, new: DataFrame | None, gone: list[DataFrame], folders: list[str], buckets: int) -> None:
    """Take the rows with the keys of ``gone`` out of a layer and add ``new`` ones."""
    old = spark.read.parquet(path)
    given = {} if new is None else {f.name: f for f in new.schema.fields}
    if any(f.dataType != given.get(f.name, f).dataType for f in old.schema.fields):  # a day is text, and so on
        old = spark.read.schema(T.StructType([given.get(f.name, f) for f in old.schema.fields])).parquet(path)
    held_keys = [keep_keys(k, buckets) for k in gone]
    gone = [keys for keys, in_buckets in held_keys if in_buckets]
    asked = sorted({b for _, in_buckets in held_keys for b in in_buckets})
    if not asked:
        return
    old = old.filter(F.col(BUCKET).isin(asked))
    hit = reduce(DataFrame.union, [_same(old, k, "left_semi").select(*folders) for k in gone]).distinct().collect()
    rows = None if new is None else new.withColumn(BUCKET, bucket_of(F.col(BATCH), buckets))
    if not hit:
        if rows is not None:
            _write(rows, path, folders, "append")
        return
    if len(folders) == 1:
        inside = F.col(BUCKET).isin(sorted(r[BUCKET] for r in hit))
        kept = old.filter(inside)
        again, others = (None, None) if rows is None else (rows.filter(inside), rows.filter(~inside))
    else:
        # at most a line per folder
        hit_rows = spark.createDataFrame(hit, T.StructType([old.schema[c] for c in folders]))
        for c in folders:
            old = old.filter(F.col(c).isin(sorted({r[c] for r in hit})))
        kept = _same(old, hit_rows, "left_semi")
        again, others = (None, None) if rows is None else (_same(rows, hit_rows, how) for how in ("left_semi", "left_anti"))
    for keys in gone:
        kept = _same(kept, keys, "left_anti")
    if again is not None:
        kept = kept.unionByName(again, allowMissingColumns=True)
    written = Observation()
    place = F.concat_ws("/", *[F.col(c).cast("string") for c in folders])
    _write(kept.observe(written, F.collect_set(place).alias("places")), path, folders, "overwrite")
    left = set(observed(written, "places") or [])
    drop_partitions(spark, path, [r.asDict() for r in hit if "/".join(str(r[c]) for c in folders) not in left])
    if others is not None and (len(folders) > 1 or len(hit) < len(asked)) and not others.isEmpty():
        _write(others, path, folders, "append")


def _has_buckets(spark: SparkSession, path: str) -> bool:
    return any(name.startswith(f"{BUCKET}=") for name in names_in(spark, path))


def _file_system(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root, root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    root, files = _file_system(spark, path)
    return files.exists(root)


def _folder(spark: SparkSession, root, parts: dict[str, object]):
    """Folder of a partition below ``root``, as Spark names it."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    below = "/".join(f"{name}={escape(str(value))}" for name, value in parts.items())
    return spark._jvm.org.apache.hadoop.fs.Path(root, below)


def drop_partitions(spark: SparkSession, path: str, partitions: list[dict[str, object]]) -> None:
    """Remove the folders of some partitions, through the file system that the path names."""
    root, files = _file_system(spark, path)
    for parts in partitions:
        folder = _folder(spark, root, parts)
        if files.exists(folder):
            files.delete(folder, True)


def held(spark: SparkSession, path: str, names: list[tuple[str, str]]) -> set[tuple[str, str]]:
    """Which of some (batch, source file) a layer has rows of."""
    if not names or not exists(spark, path):
        return set()
    asked = text_rows(spark, **{BATCH: [batch for batch, _ in names], "source_file": [name for _, name in names]})
    rows = read_batches(spark, path, T.StructType(asked.schema.fields), sorted({batch for batch, _ in names}))
    return {tuple(r) for r in rows.distinct().join(asked, [BATCH, "source_file"], "left_semi").select(*asked.columns).collect()}


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders right below a folder."""
    root, files = _file_system(spark, path)
    return sorted(status.getPath().getName() for status in files.listStatus(root)) if files.exists(root) else []


def move_file(spark: SparkSession, path: str, target: str) -> bool:
    """Move a file, over an older one of that name; False if it is not there (any more)."""
    source, files = _file_system(spark, path)
    goal, _ = _file_system(spark, target)
    if not files.exists(source):
        return False
    files.mkdirs(goal.getParent())
    files.delete(goal, False)
    if not files.rename(source, goal):
        raise OSError(f"{path} could not be moved to {target}")
    return True


def move_files(spark: SparkSession, moves: list[tuple[str, str]]) -> int:
    """Move files, several at a time: a move is a few calls of the store, which wait more than they work.

    Files of a mounted file system are moved without the store's calls: Hadoop starts a process for
    every folder that it makes there.
    """
    mounted = _file_system(spark, "/")[1].getScheme() == "file"
    with ThreadPoolExecutor(MOVERS) as movers:
        return sum(movers.map(lambda move: _move_mounted(spark, *move) if all(_on_mount(p, mounted) for p in move) else move_file(spark, *move), moves))


def _on_mount(path: str, by_default: bool) -> bool:
    return path.startswith("file:") or by_default and not re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path)


def _move_mounted(spark: SparkSession, path: str, target: str) -> bool:
    """``move_file`` by the operating system, with the checksum file that Hadoop may have put beside."""
    source, goal = (re.sub("^file:/*", "/", p) for p in (path, target))
    sums = [os.path.join(os.path.dirname(p), f".{os.path.basename(p)}.crc") for p in (source, goal)]
    if not os.path.exists(source):
        return False
    os.makedirs(os.path.dirname(goal), exist_ok=True)
    with suppress(FileNotFoundError):
        os.remove(sums[1])
    try:
        os.replace(source, goal)
    except OSError as error:
        if error.errno == errno.EXDEV:  # between two mounts Hadoop copies
            return move_file(spark, path, target)
        raise
    with suppress(FileNotFoundError):
        os.replace(*sums)
    return True


def drop_rows(spark: SparkSession, path: str, keys: DataFrame) -> None:
    """Remove the rows with some keys, (batch), (batch, file), (batch, chunk) and the like, from a layer."""
    if _has_buckets(spark, path):
        folders = [BUCKET, *[c for c in spark.read.parquet(path).columns if c in FOLDERS and _is_folder(spark, path, c)]]
        _replace(spark, path, None, [keys], folders, BUCKETS if len(folders) == 1 else FEW_BUCKETS)


def _is_folder(spark: SparkSession, path: str, name: str) -> bool:
    first = next(n for n in names_in(spark, path) if n.startswith(f"{BUCKET}="))
    return any(n.startswith(f"{name}=") for n in names_in(spark, f"{path.rstrip('/')}/{first}"))


def drop_batches(spark: SparkSession, path: str, batches: list[str]) -> None:
    if batches:
        drop_rows(spark, path, names_frame(spark, batches))


def drop_files(spark: SparkSession, path: str, names: list[tuple[str, str]]) -> None:
    """Remove some (batch, source file) of a layer stored by both."""
    if names:
        drop_rows(spark, path, spark.createDataFrame(names, f"{BATCH} string, source_file string"))


def read_layer(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None
) -> DataFrame:
    """Scan all parts of a Parquet layer.

    Give the schema where it is known: discovery reads it from a file, and would take a day for text.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*([path] if isinstance(path, str) else path)).drop(BUCKET)


def read_batches(spark: SparkSession, path: str, schema: T.StructType | str, batches: list[str] | DataFrame) -> DataFrame:
    """The rows of some batches of a layer without folders below its buckets; other buckets are not read."""
    if isinstance(batches, DataFrame):
        batches, asked = keep_keys(batches.select(BATCH))
    else:
        asked = [r[BUCKET] for r in names_frame(spark, batches).select(bucket_of(F.col(BATCH)).alias(BUCKET)).distinct().collect()]
    known = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = spark.read.schema(T.StructType([*known.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(path)
    return of_batches(rows.filter(F.col(BUCKET).isin(asked)).drop(BUCKET), batches)


def write_predictions(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
