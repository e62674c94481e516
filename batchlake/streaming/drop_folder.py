"""Incremental ingestion of a drop folder as a file stream.

The stream only discovers files: its checkpoint gives each file to one trigger.
The rows are read by the batch reader inside ``foreachBatch``, kept in a Parquet
layer by (batch, file), and the batches touched are rebuilt from that layer.
A replayed trigger overwrites the same partitions with the same rows. A file whose content
cannot be read goes to the ``rejected`` layer with the reason, and the others go on; any
other error fails the trigger, which is replayed. ``retry_rejected`` reads files again.

Row windows need a whole batch, so features are recomputed per touched batch
instead of being carried as stream state.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from itertools import islice

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from batchlake.functions.schema import BATCH, BRONZE_SCHEMA, SILVER_SCHEMA, with_extra
from batchlake.operators.clean import derive_batch_id
from batchlake.plans.medallion import build_gold, build_silver
from batchlake.plans.summaries import store_summary
from batchlake.session import work_path
from batchlake.sources.layers import (
    drop_batches,
    drop_files,
    drop_partitions,
    exists,
    held,
    move_files,
    names_in,
    read_batches,
    read_layer,
    text_rows,
    write_layer,
)
from batchlake.sources.raw_text import read_raw_text, relative_name

MAX_FILES_PER_TRIGGER = 1_000
#: What is kept of a reason: its start names the file and the cause, the rest is a trace.
REASON_CHARS = 2_000

# What the reader says about content (in an error of ``raise_error``), and
# Spark's own error for bytes that are no text of the file's encoding.
RAISED = "[USER_RAISED_EXCEPTION]"
CONTENT = ("no column for ", "a quote is never closed in ", "a UTF-16 character with the byte 0A needs ")
MALFORMED = "[MALFORMED_CHARACTER_CODING"

# Columns of Spark's binaryFile source.
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
REJECTED_SCHEMA = f"{BATCH} string, source_file string, reason string"
LEDGER_SCHEMA = f"path string, source_file string, {BATCH} string, run string, trigger long"


def layer_paths(out: str) -> dict[str, str]:
    base = out.rstrip("/")
    return {name: f"{base}/{name}" for name in ("bronze", "silver", "gold", "rejected", "ledger")}


def is_content_error(error: Exception) -> bool:
    """Whether the reader refused what is in a file; no storage, memory or executor trouble."""
    said = str(error)
    return MALFORMED in said or any(f"{RAISED} {start}" in said for start in CONTENT)


def names_of(spark: SparkSession, files: list[str], root: str, batch_by: str) -> list[tuple[str, str]]:
    """(batch, source file) of some files."""
    name = relative_name(F.col("path"), root)
    listed = text_rows(spark, path=files)
    return [tuple(r) for r in listed.select(derive_batch_id(name, batch_by).alias(BATCH), name.alias("source_file")).collect()]


def land(
    spark: SparkSession, files: list[str], root: str, paths: dict[str, str], batch_by: str
) -> None:
    """Write the raw rows of the files; those with content that cannot be read are kept as rejected.

    All files are read once, with the problem of each that has one. Where Spark's own decoder
    fails, the files are halved until the bad ones, at most as many as a trigger has, stand alone.
    """
    scratch = work_path(spark, "landing")
    try:
        raw = read_raw_text(spark, files, root=root, batch_by=batch_by, on_error="mark")
        raw.write.parquet(scratch)
    except (Py4JJavaError, PySparkException) as error:
        if not is_content_error(error):
            raise
        half = len(files) // 2
        if half:
            land(spark, files[:half], root, paths, batch_by)
            land(spark, files[half:], root, paths, batch_by)
            return
        ((batch, name),) = names_of(spark, files, root, batch_by)
        _reject(spark.createDataFrame([(batch, name, str(error).strip()[:REASON_CHARS])], REJECTED_SCHEMA), paths)
        return
    rows = spark.read.schema(raw.schema).parquet(scratch)
    write_layer(rows.filter("problem is null").drop("problem"), paths["bronze"], [BATCH, "source_file"])
    bad = rows.filter("problem is not null").select(BATCH, "source_file", F.left("problem", F.lit(REASON_CHARS)).alias("reason"))
    if not bad.isEmpty():
        _reject(bad, paths)


def _reject(bad: DataFrame, paths: dict[str, str]) -> None:
    write_layer(bad, paths["rejected"], [BATCH, "source_file"])


def retry_rejected(spark: SparkSession, folder: str, out: str, batch_by: str = "folder") -> dict[str, int]:
    """Read all rejected files that are still below ``folder`` again, MAX_FILES_PER_TRIGGER at a time.

    Call it while no stream writes to ``out``. Those that still cannot be read are rejected anew.
    """
    paths = layer_paths(out)
    none = {"rows_in": 0, "rows_saved": 0}
    if not exists(spark, paths["rejected"]):
        return none
    rejected = read_layer(spark, paths["rejected"], REJECTED_SCHEMA)
    named = rejected.select(BATCH, "source_file").distinct()
    counts, page = dict(none), {}
    copy = work_path(spark, "rejected")  # the layer changes on the way
    named.write.parquet(copy)
    for row in spark.read.schema(named.schema).parquet(copy).orderBy(BATCH, "source_file").toLocalIterator():
        path = f"{folder.rstrip('/')}/{row['source_file']}"
        if exists(spark, path):
            page[path] = row
        if len(page) >= MAX_FILES_PER_TRIGGER:
            counts = _read_again(spark, page, folder, out, batch_by, counts)
            page = {}
    return _read_again(spark, page, folder, out, batch_by, counts) if page else counts


def _read_again(spark: SparkSession, page: dict[str, Row], folder: str, out: str, batch_by: str, counts: dict[str, int]) -> dict[str, int]:
    """Ingest some rejected files; those that can be read now are no longer rejected."""
    paths = layer_paths(out)
    now = ingest_files(spark, list(page), sorted({row[BATCH] for row in page.values()}), folder, out, batch_by)
    drop_files(spark, paths["rejected"], sorted(held(spark, paths["bronze"], [tuple(row) for row in page.values()])))
    return {name: counts[name] + now[name] for name in counts}


def ingest_files(
    spark: SparkSession, files: list[str], batches: list[str], root: str, out: str, batch_by: str
) -> dict[str, int]:
    """Add files to the raw layer and rebuild the batches they belong to."""
    paths = layer_paths(out)
    land(spark, files, root, paths, batch_by)

    if not exists(spark, paths["bronze"]):  # nothing could be read so far
        return {"rows_in": 0, "rows_saved": 0}
    bronze = read_batches(spark, paths["bronze"], BRONZE_SCHEMA, batches)
    counts = build_silver(bronze, paths["silver"], batches)
    if counts["rows_saved"]:
        silver = read_batches(spark, paths["silver"], with_extra(SILVER_SCHEMA), batches)
        build_gold(silver, paths["gold"], batches)
    else:
        drop_batches(spark, paths["gold"], batches)
    for layer in ("silver", "gold"):
        if exists(spark, paths[layer]):
            store_summary(spark, paths[layer], layer, batches)
    return counts


def _run_name(checkpoint: str) -> str:
    """What tells the triggers of one checkpoint from those of another."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def _note_landed(spark: SparkSession, files: list[str], root: str, out: str, batch_by: str, checkpoint: str, trigger_id: int) -> None:
    """Enter the files of a trigger that have reached the raw layer in the ledger.

    A replayed trigger writes the same lines. Rejected files are not entered: they stay.
    """
    paths = layer_paths(out)
    named = names_of(spark, files, root, batch_by)
    landed = held(spark, paths["bronze"], named)
    rows = [(path, name, batch) for path, (batch, name) in zip(files, named) if (batch, name) in landed]
    if rows:
        noted = spark.createDataFrame(rows, f"path string, source_file string, {BATCH} string")
        noted = noted.withColumns({"run": F.lit(_run_name(checkpoint)), "trigger": F.lit(trigger_id).cast("long")})
        write_layer(noted.coalesce(1), paths["ledger"], ["run", "trigger"], rebalance=False)


def archive_landed(spark: SparkSession, folder: str, out: str, checkpoint: str, archive_dir: str) -> int:
    """Move files to ``archive_dir`` whose trigger the stream has committed; returns how many.

    Driven by the ledger and the stream's commit log, so a file whose trigger can still be
    replayed is never moved. Files keep their place below the drop folder. A move that was
    cut off is done the next time; a trigger whose files are all moved leaves the ledger.
    """
    paths = layer_paths(out)
    committed = [int(name) for name in names_in(spark, f"{checkpoint.rstrip('/')}/commits") if name.isdigit()]
    if not committed or not exists(spark, paths["ledger"]):
        return 0
    run, last, moved = _run_name(checkpoint), max(committed), 0
    due = read_layer(spark, paths["ledger"], LEDGER_SCHEMA).filter((F.col("run") == run) & (F.col("trigger") <= last))
    triggers, names = set(), due.select("source_file", "trigger").toLocalIterator()
    while page := list(islice(names, MAX_FILES_PER_TRIGGER)):
        moved += move_files(spark, [(f"{folder.rstrip('/')}/{name}", f"{archive_dir.rstrip('/')}/{name}") for name, _ in page])
        triggers |= {trigger for _, trigger in page}
    drop_partitions(spark, paths["ledger"], [{"run": run, "trigger": t} for t in triggers])
    return moved


def ingest_stream(
    spark: SparkSession,
    folder: str,
    out: str,
    checkpoint: str,
    trigger: dict | None = None,
    batch_by: str = "folder",
    archive_dir: str | None = None,
    max_files: int = MAX_FILES_PER_TRIGGER,
    on_counts: Callable[[int, dict[str, int]], None] | None = None,
    ingest: Callable[..., dict[str, int]] | None = None,
) -> StreamingQuery:
    """Start ingestion of ``folder`` into layers below ``out``.

    ``ingest`` takes the files of a trigger; ``ingest_files`` by default, which rebuilds the
    batches they belong to. ``incremental.append_files`` recomputes new rows and their neighbours.

    ``trigger`` is passed to the stream, ``{"availableNow": True}`` by default;
    ``{"processingTime": "2 seconds"}`` keeps watching. ``archive_dir`` moves
    files away whose trigger has been committed, at the start of a later trigger; call
    ``archive_landed`` when the stream has stopped for those of the last one. ``max_files``
    bounds a trigger and with it the list of file and batch names handled on the driver.
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.[cC][sS][vV]")
        .option("maxFilesPerTrigger", str(max_files))
    )
    # names only: the content column is pruned from the scan
    listed = F.col("_metadata.file_path")
    found = reader.load(folder).select(
        F.col("path"),
        derive_batch_id(relative_name(listed, folder), batch_by).alias(BATCH),
    )

    def on_trigger(batch: DataFrame, trigger_id: int) -> None:
        names = batch.collect()
        if archive_dir:
            archive_landed(spark, folder, out, checkpoint, archive_dir)
        if not names:
            return
        counts = (ingest or ingest_files)(
            spark,
            [row["path"] for row in names],
            sorted({row[BATCH] for row in names}),
            folder,
            out,
            batch_by,
        )
        if archive_dir:
            _note_landed(spark, [row["path"] for row in names], folder, out, batch_by, checkpoint, trigger_id)
        if on_counts:
            on_counts(trigger_id, counts)

    return (
        found.writeStream.foreachBatch(on_trigger)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
