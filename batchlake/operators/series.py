"""Row windows over batches that stay parallel when one batch is huge.

A window partitioned by batch puts a batch in one task. That is the best plan
while batches are small, and the wrong one when a batch holds a third of the
data. The helpers here count rows per batch first and choose:

* no large batch: the plain window, one shuffle;
* otherwise: small batches keep the plain window, and large ones are cut at
  quantiles of time into slices of about ``slice_rows`` rows, however uneven a
  batch is. Their windows run per (batch,
  slice). Rows close to a slice edge, whose frame reaches into a neighbour
  slice, are computed from the rows near the edges only (at most
  ``2 * (back + ahead)`` rows per slice), which is a tiny fraction of the batch.
  Both parts of a large batch read the same shuffle.

The outcome is the same rows and values either way.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchlake.functions.schema import BATCH, TIME

SLICE_ROWS = 2_000_000
#: Quantiles that slices are cut at, and the accuracy of their ranks.
QUANTILES = 1024
ACCURACY = 20_000
BROADCAST_KEYS = 200_000

WindowExpr = Callable[[WindowSpec], Column]


@dataclass(frozen=True)
class BatchProfile:
    """Batch sizes: two counts on the driver, the per-batch rows as a DataFrame."""

    sizes: DataFrame
    n_batches: int
    n_large: int
    slice_rows: int

    @property
    def has_large(self) -> bool:
        return self.n_large > 0


def second_number(df: DataFrame, order: str) -> Column:
    """Whole seconds since the epoch, rising with ``order`` in any session time zone."""
    kind = df.schema[order].dataType
    at = F.col(order)
    if isinstance(kind, T.TimestampNTZType):
        if df.sparkSession.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "Z"):
            return F.unix_seconds(at.cast("timestamp"))
        # a zone with clock changes would put some wall-clock times out of order
        days = F.unix_date(at.cast("date")).cast("bigint")
        return days * 86_400 + F.hour(at) * 3_600 + F.minute(at) * 60 + F.second(at)
    if isinstance(kind, T.TimestampType):
        return F.unix_seconds(at)
    raise TypeError(f"{order} must be a timestamp, not {kind.simpleString()}")


def micro_number(df: DataFrame, order: str) -> Column:
    """Microseconds since the epoch, rising with ``order`` like ``second_number``."""
    part = F.date_part(F.lit("SECONDS"), F.col(order))
    return second_number(df, order) * 1_000_000 + F.round((part - F.floor(part)) * 1_000_000).cast("bigint")


def profile_batches(
    df: DataFrame, batch: str = BATCH, order: str = TIME, slice_rows: int = SLICE_ROWS
) -> BatchProfile:
    """Count rows per batch (one narrow scan, combined before its shuffle).

    ``df`` may be a cheaper table with at least as many rows per batch than
    the one the windows run on, e.g. the rows before cleaning.
    """
    sizes = df.groupBy(F.col(batch).alias(BATCH)).agg(F.count("*").alias("batch_rows"))
    counts = sizes.agg(
        F.count("*").alias("n_batches"),
        F.count_if(F.col("batch_rows") > slice_rows).alias("n_large"),
    ).first()
    return BatchProfile(sizes, counts["n_batches"], counts["n_large"], slice_rows)


def attach(df: DataFrame, small: DataFrame, key: str, n_keys: int | None = None) -> DataFrame:
    """Left equi-join of per-key values.

    Broadcast only with a known key count below ``BROADCAST_KEYS``; otherwise
    the choice is Spark's, which splits skewed keys at run time.
    """
    if n_keys is not None and n_keys <= BROADCAST_KEYS:
        small = F.broadcast(small)
    return df.join(small, on=key, how="left").select(
        *[df[c] for c in df.columns], *[small[c] for c in small.columns if c != key]
    )


def over_batches(
    df: DataFrame,
    exprs: Mapping[str, WindowExpr],
    back: int,
    ahead: int,
    profile: BatchProfile,
    per_batch: Mapping[str, Column] | None = None,
    batch: str = BATCH,
    order: str = TIME,
) -> DataFrame:
    """Append window columns; no expression may look further than back/ahead rows.

    ``per_batch`` are aggregates over the whole batch, appended after them.
    ``order`` must be unique within a batch (cleaned readings are).
    """
    per_batch = per_batch or {}
    whole = Window.partitionBy(batch).orderBy(order)
    every = _all_rows(whole)

    def windowed(rows: DataFrame, spec: WindowSpec, *more: Column) -> DataFrame:
        return rows.select("*", *[fn(spec).alias(name) for name, fn in exprs.items()], *more)

    def plain(rows: DataFrame) -> DataFrame:
        return windowed(rows, whole, *[agg.over(every).alias(n) for n, agg in per_batch.items()])

    if not profile.has_large:
        return plain(df)

    large = _large_batches(df, per_batch, profile, batch, order)
    small_rows = df.join(large.select(batch), on=batch, how="left_anti").select(*df.columns)
    large_rows = df.join(large, on=batch).select(
        *[df[c] for c in df.columns],
        *per_batch,
        F.size(F.filter("_cuts", lambda cut: cut < micro_number(df, order))).alias("_slice"),
    )

    sliced = Window.partitionBy(batch, "_slice").orderBy(order)
    placed = windowed(
        large_rows,
        sliced,
        F.row_number().over(sliced).alias("_nth"),
        F.count("*").over(_all_rows(sliced)).alias("_of"),
    )
    before, after = F.col("_nth") - 1, F.col("_of") - F.col("_nth")
    reach = back + ahead
    is_inner = (before >= back) & (after >= ahead)
    near_edge = placed.filter((before < reach) | (after < reach))
    near_edge = near_edge.select(*df.columns, *per_batch, is_inner.alias("_inner"))

    out = [*df.columns, *exprs, *per_batch]
    inner = placed.filter(is_inner).select(*out)
    edges = windowed(near_edge, whole).filter("NOT _inner").select(*out)
    return plain(small_rows).select(*out).union(inner).union(edges)


def _all_rows(spec: WindowSpec) -> WindowSpec:
    """The whole partition, ordered like ``spec`` so that both share one window pass."""
    return spec.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _large_batches(
    df: DataFrame, per_batch: Mapping[str, Column], profile: BatchProfile, batch: str, order: str
) -> DataFrame:
    """Batches above ``slice_rows`` with the times they are cut at and their aggregates.

    At most (all rows / slice_rows) rows, counted by the profile, so the
    broadcast has a known bound; beyond ``BROADCAST_KEYS`` the join is Spark's
    choice.
    """
    sizes = profile.sizes.filter(F.col("batch_rows") > profile.slice_rows).select(
        F.col(BATCH).alias(batch), F.ceil(F.col("batch_rows") / profile.slice_rows).alias("_slices")
    )
    if profile.n_large <= BROADCAST_KEYS:
        sizes = F.broadcast(sizes)
    shares = F.array(*[F.lit(k / QUANTILES) for k in range(1, QUANTILES)])
    values = df.join(sizes, on=batch).groupBy(batch, "_slices").agg(
        F.percentile_approx(micro_number(df, order), shares, ACCURACY).alias("_quantiles"),
        *[agg.alias(n) for n, agg in per_batch.items()],
    )
    step = F.greatest(F.floor(F.lit(QUANTILES) / F.col("_slices")), F.lit(1))
    large = values.select(
        batch,
        F.array_distinct(F.filter("_quantiles", lambda _, i: (i + 1) % step == 0)).alias("_cuts"),
        *per_batch,
    )
    return F.broadcast(large) if profile.n_large <= BROADCAST_KEYS else large
