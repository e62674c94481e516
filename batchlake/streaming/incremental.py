"""Features that grow with their batch: a trigger recomputes new rows and their neighbours only.

A batch is stored in chunks of time. New rows touch some chunks; their neighbourhood,
as far as the row windows reach, can lie in the chunks before and after. Only touched
chunks are written to the readings, and only chunks with a row whose window sees a new row to
the features, however long the batch has become. A row late by days repairs its own
neighbourhood in the same way.

What belongs to the whole batch is not stored with its rows: first and last batch time are
merged from one line per chunk when the feature layer is read, and the progress is
computed there. Rows whose look-ahead target is still to come wait in the features as
incomplete rows, which reading drops.

Readings keep where they came from, so that of two rows of the same time the same one
survives in whatever order files arrive. A file that comes again (a replayed trigger, or new
content under an old name) makes its batch be built anew from the raw layer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchlake.functions.schema import (
    BATCH,
    BRONZE_SCHEMA,
    ENGINEERED,
    PROVENANCE,
    SENSORS,
    SILVER_SCHEMA,
    TARGET,
    TIME,
    with_extra,
)
from batchlake.operators.clean import dedupe, type_rows, usable
from batchlake.operators.features import ROWS_AHEAD, ROWS_BACK, batch_progress, drop_incomplete, engineer_rows, positive_target, row_exprs
from batchlake.operators.series import attach, second_number
from batchlake.session import work_path
from batchlake.sources.layers import drop_rows, exists, held, names_frame, of_batches, read_batches, read_layer, text_rows, write_layer
from batchlake.streaming.drop_folder import land, layer_paths, names_of

CHUNK = "chunk"
CHUNK_SECONDS = 6 * 3600
#: Times of chunks that may stand in a filter, so that only their files are listed and read.
NAMED_CHUNKS = 1_000

PLACED = [T.StructField(CHUNK, T.LongType())]
READINGS_SCHEMA = T.StructType([*with_extra(SILVER_SCHEMA).fields, *[BRONZE_SCHEMA[c] for c in PROVENANCE], *PLACED])
FEATURES_SCHEMA = T.StructType(
    [*with_extra(SILVER_SCHEMA).fields, *[T.StructField(c, T.DoubleType()) for c in row_exprs()], *PLACED]
)
CHUNKS_SCHEMA = f"{CHUNK} long, rows long, batch_start double, batch_end double, {BATCH} string"


def incremental_paths(out: str) -> dict[str, str]:
    return layer_paths(out) | {name: f"{out.rstrip('/')}/{name}" for name in ("readings", "features", "chunks")}


def _stored(df: DataFrame, label: str) -> DataFrame:
    """Written below the shared folder and read again: used several times, and read before it is replaced."""
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _clean(raw: DataFrame, chunk_seconds: int) -> DataFrame:
    """Clean rows with their provenance and chunk."""
    rows = dedupe(usable(type_rows(raw)), (BATCH, TIME), tuple(PROVENANCE))
    placed = rows.withColumn(CHUNK, F.floor(second_number(rows, TIME) / chunk_seconds).cast("long"))
    return placed.select(*READINGS_SCHEMA.names)


def near(between_next: Column, between_last: Column, ahead: int, back: int) -> Column:
    """Whether fewer rows lie between a chunk and the next (or last) marked one than a window reaches."""
    return F.coalesce(between_next < ahead, F.lit(False)) | F.coalesce(between_last < back, F.lit(False))


def neighbourhood(chunks: DataFrame, touched: DataFrame) -> DataFrame:
    """(batch, chunk, rows, touched, affected): the chunks that a trigger has to read.

    ``chunks`` has the rows that each chunk holds so far. Affected are chunks with a row whose
    window sees a touched chunk; the others are context, which the affected rows' windows see.
    """
    mark = touched.select(BATCH, CHUNK, F.lit(True).alias("touched"))
    both = chunks.select(BATCH, CHUNK, "rows").join(mark, [BATCH, CHUNK], "full").select(
        BATCH, CHUNK, F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("touched", F.lit(False)).alias("touched")
    )
    order = Window.partitionBy(BATCH).orderBy(CHUNK)
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    placed = both.withColumn("_until", F.sum("rows").over(order)).withColumn("_from", F.col("_until") - F.col("rows"))

    def close(marked: str, ahead: int, back: int) -> Column:
        next_from = F.first(F.when(F.col(marked), F.col("_from")), ignorenulls=True).over(after)
        last_until = F.last(F.when(F.col(marked), F.col("_until")), ignorenulls=True).over(before)
        return F.col(marked) | near(next_from - F.col("_until"), F.col("_from") - last_until, ahead, back)

    # rows before a new one have it in their look-ahead, rows after it in their look-back
    affected = placed.withColumn("affected", close("touched", ROWS_AHEAD, ROWS_BACK))
    needed = affected.withColumn("_needed", close("affected", ROWS_BACK, ROWS_AHEAD))
    return needed.filter("_needed").select(BATCH, CHUNK, "rows", "touched", "affected")


def _of_chunks(rows: DataFrame, chunks: DataFrame) -> DataFrame:
    """The rows of some chunks; if their times are few these are named, so that no other file is read."""
    times = [r[CHUNK] for r in chunks.select(CHUNK).distinct().limit(NAMED_CHUNKS + 1).collect()]
    if len(times) <= NAMED_CHUNKS:
        rows = rows.filter(F.col(CHUNK).isin(times))
    return rows.join(chunks.select(BATCH, CHUNK), [BATCH, CHUNK], "left_semi")


def update(spark: SparkSession, raw: DataFrame, out: str, replaced: list[str], batches: list[str], chunk_seconds: int = CHUNK_SECONDS) -> dict[str, int]:
    """Bring raw rows of ``batches`` into readings and features; those ``replaced`` hold nothing else.

    Returns the rows read, and those written to each layer.
    """
    paths = incremental_paths(out)
    new = _stored(_clean(raw, chunk_seconds), "new-rows")
    known = None
    if exists(spark, paths["chunks"]):
        known = read_batches(spark, paths["chunks"], CHUNKS_SCHEMA, batches)
    stored = spark.createDataFrame([], CHUNKS_SCHEMA) if known is None else known.join(names_frame(spark, replaced), BATCH, "left_anti")
    plan = _stored(neighbourhood(stored, new.select(BATCH, CHUNK).distinct()), "chunk-plan")

    rows = new
    if exists(spark, paths["readings"]):
        old = _of_chunks(read_layer(spark, paths["readings"], READINGS_SCHEMA), plan.filter("rows > 0"))
        rows = dedupe(old.unionByName(new), (BATCH, TIME), tuple(PROVENANCE))
    rows = _stored(rows, "neighbourhood")
    counts = {"rows_in": raw.count(), "readings_written": 0, "features_written": 0}

    def written(part: DataFrame, label: str, layer: str) -> DataFrame:
        part = _stored(part, label)
        counts[f"{layer}_written"] = part.count()
        if counts[f"{layer}_written"]:
            write_layer(part, paths[layer], [BATCH, CHUNK])
        return part

    stale = None
    if known is not None and replaced:
        gone = of_batches(known, replaced).join(new, [BATCH, CHUNK], "left_anti").select(BATCH, CHUNK)
        stale = _stored(gone, "stale-chunks")
    touched = written(rows.join(plan.filter("touched").select(BATCH, CHUNK), [BATCH, CHUNK], "left_semi"), "touched", "readings")
    features = engineer_rows(rows).join(plan.filter("affected").select(BATCH, CHUNK), [BATCH, CHUNK], "left_semi")
    written(features.select(*FEATURES_SCHEMA.names), "features", "features")
    if stale is not None and not stale.isEmpty():
        for layer in ("readings", "features"):
            drop_rows(spark, paths[layer], stale)

    lines = touched.groupBy(CHUNK, BATCH).agg(
        F.count("*").alias("rows"), F.min("batch_time_mins").alias("batch_start"), F.max("batch_time_mins").alias("batch_end")
    )
    kept = stored.join(lines.select(BATCH, CHUNK), [BATCH, CHUNK], "left_anti")
    lines = _stored(kept.unionByName(lines), "chunk-lines")
    write_layer(lines, paths["chunks"], batches=batches)
    return counts


def append_files(
    spark: SparkSession, files: list[str], batches: list[str], root: str, out: str, batch_by: str, chunk_seconds: int = CHUNK_SECONDS
) -> dict[str, int]:
    """Add files to the raw layer, their rows to readings and features.

    Batches of which a file was there before are built anew.
    """
    paths = incremental_paths(out)
    names = names_of(spark, files, root, batch_by)
    replaced = sorted({b for b, _ in held(spark, paths["bronze"], names)})
    land(spark, files, root, paths, batch_by)
    if not exists(spark, paths["bronze"]):  # nothing could be read so far
        return {"rows_in": 0, "readings_written": 0, "features_written": 0}
    raw = read_batches(spark, paths["bronze"], BRONZE_SCHEMA, batches)
    fresh = text_rows(spark, source_file=[f for _, f in names]).distinct()
    again = names_frame(spark, replaced)
    raw = raw.join(again, BATCH, "left_anti").join(fresh, "source_file", "left_semi").unionByName(raw.join(again, BATCH, "left_semi"))
    return update(spark, raw, out, replaced, batches, chunk_seconds)


def read_silver(spark: SparkSession, out: str) -> DataFrame:
    """The clean layer of an incremental lake."""
    rows = read_layer(spark, incremental_paths(out)["readings"], READINGS_SCHEMA)
    return rows.select(*with_extra(SILVER_SCHEMA).names)


def read_gold(spark: SparkSession, out: str, batches: list[str] | None = None) -> DataFrame:
    """The feature layer of an incremental lake (of some batches): bounds joined, incomplete rows dropped."""
    paths = incremental_paths(out)
    rows = read_layer(spark, paths["features"], FEATURES_SCHEMA)
    chunks = read_layer(spark, paths["chunks"], CHUNKS_SCHEMA)
    if batches is not None:
        rows, chunks = (of_batches(df, batches) for df in (rows, chunks))
    bounds = chunks.groupBy(BATCH).agg(F.min("batch_start").alias("batch_start"), F.max("batch_end").alias("batch_end"))
    ready = positive_target(drop_incomplete(batch_progress(attach(rows, bounds, BATCH))))
    passed_through = [c for c in rows.columns if c == "extra"]
    return ready.select(TIME, *SENSORS, *passed_through, *ENGINEERED, TARGET, BATCH)
