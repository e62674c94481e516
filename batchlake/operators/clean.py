"""Cleaning operators: raw string rows to typed, positive, unique readings."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from batchlake.functions import cells
from batchlake.functions.schema import (
    BATCH,
    HEADER_RULES,
    NULL_TOKENS,
    PROVENANCE,
    SENSORS,
    TIME,
    TIME_FORMATS,
    role_of,
)

POSITIVE = ["batch_time_mins", "ph_level"]


def standardise_columns(df: DataFrame, rules=HEADER_RULES) -> DataFrame:
    """Rename historian headers to roles.

    Headers no rule matches keep their name, and so does every further header
    of a role already taken.
    """
    taken, renames = set(df.columns), {}
    for name in df.columns:
        role = role_of(name, rules)
        if role and role not in taken:
            renames[name] = role
            taken.add(role)
    return df.withColumnsRenamed(renames)


def strip_thousands(df: DataFrame, cols=SENSORS) -> DataFrame:
    return df.withColumns({c: cells.without_thousands(F.col(c)) for c in cols})


def null_tokens(df: DataFrame, cols=SENSORS, tokens=NULL_TOKENS) -> DataFrame:
    return df.withColumns({c: cells.without_null_tokens(F.col(c), tokens) for c in cols})


def parse_timestamps(df: DataFrame, col: str = TIME, formats=TIME_FORMATS) -> DataFrame:
    return df.withColumn(col, cells.parse_time(F.col(col), formats))


def cast_numeric(df: DataFrame, cols=SENSORS) -> DataFrame:
    return df.withColumns({c: cells.to_number(F.col(c)) for c in cols})


def positive_test(cols=POSITIVE) -> Column:
    test = F.lit(True)
    for c in cols:
        test = test & cells.is_positive(F.col(c))
    return test


def keep_positive(df: DataFrame, cols=POSITIVE) -> DataFrame:
    return df.filter(positive_test(cols))


def dedupe(df: DataFrame, keys=(BATCH, TIME), order=tuple(PROVENANCE)) -> DataFrame:
    """First row per key in the given order.

    Spark plans ``row_number() = 1`` with a partial group limit ahead of the
    shuffle, so each map task sends at most one row per key, however many
    copies of it exist.
    """
    spec = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(spec)).filter("_rank = 1").drop("_rank")


def derive_batch_id(relative_path: Column, batch_by: str = "folder") -> Column:
    """Batch name of a file, from its path relative to the drop folder.

    ``folder``: files below a sub-folder form one batch ``<folder>_combined``,
    a file at the top is its own batch. ``file``: every file is its own batch.
    """
    by_file = F.regexp_replace(relative_path, r"\.csv|\.CSV", "")
    if batch_by == "file":
        return by_file
    if batch_by == "folder":
        nested = relative_path.contains("/")
        folder = F.substring_index(relative_path, "/", 1)
        return F.when(nested, F.concat(folder, F.lit("_combined"))).otherwise(by_file)
    raise ValueError(f"batch_by must be 'folder' or 'file', not {batch_by!r}")


def type_rows(raw: DataFrame, formats=TIME_FORMATS, tokens=NULL_TOKENS) -> DataFrame:
    """The row-wise part of cleaning, before any row is removed."""
    df = standardise_columns(raw)
    missing = [c for c in SENSORS if c not in df.columns]
    df = df.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else df
    df = strip_thousands(df)
    if "extra" in df.columns:
        df = df.withColumn("extra", F.transform_values("extra", lambda _, v: cells.without_thousands(v)))
    df = null_tokens(df, tokens=tokens)
    df = parse_timestamps(df, formats=formats)
    return cells.evaluate_once(cast_numeric(df), [TIME, *POSITIVE])


def usable(typed: DataFrame) -> DataFrame:
    """Rows with a timestamp and physically possible readings."""
    return keep_positive(typed.filter(F.col(TIME).isNotNull()))


def quality_counters(
    raw: DataFrame, keys=(BATCH, TIME), formats=TIME_FORMATS, tokens=NULL_TOKENS, by: list[str] | None = None
) -> DataFrame:
    """One row of counts (for each value of ``by``, some of the keys): rows in, rejects by cause, rows before and after dedupe."""
    typed, by = type_rows(raw, formats, tokens), by or []
    timed = F.col(TIME).isNotNull()
    kept = timed & F.coalesce(positive_test(), F.lit(False))
    grouped = [F.col(k).alias(k) if k in by else F.when(kept, F.col(k)).alias(k) for k in keys]
    per_key = typed.groupBy(*grouped, kept.alias("_kept")).agg(
        F.count("*").alias("_rows"),
        F.count_if(~timed).alias("_untimed"),
        F.count_if(timed & ~kept).alias("_impossible"),
    )
    saved = F.count_if(F.col("_kept"))
    before = F.coalesce(F.sum(F.when(F.col("_kept"), F.col("_rows"))), F.lit(0))
    return per_key.groupBy(*by).agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows_in"),
        F.coalesce(F.sum("_untimed"), F.lit(0)).alias("rows_without_time"),
        F.coalesce(F.sum("_impossible"), F.lit(0)).alias("rows_impossible"),
        before.alias("rows_before_dedupe"),
        (before - saved).alias("rows_duplicate"),
        saved.alias("rows_saved"),
    )


def observe_cleaning(raw: DataFrame, clean_fn) -> tuple[DataFrame, Observation, Observation]:
    """Clean ``raw`` and count rows in and rows out inside the job that uses the result.

    The counts are ready, without a job of their own, once the returned
    DataFrame has been written; see ``observed``.
    """
    rows_in, rows_out = Observation(), Observation()
    counted = raw.observe(rows_in, F.count(F.lit(1)).alias("rows_in"))
    result = clean_fn(counted).observe(rows_out, F.count(F.lit(1)).alias("rows_saved"))
    return result, rows_in, rows_out


def observed(observation: Observation, name: str) -> int | None:
    """The count, or None where Spark dropped the counted part of a plan (no rows came out)."""
    try:
        return observation.get.get(name)
    except Py4JJavaError:
        return None
