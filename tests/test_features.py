from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from batchlake.functions.schema import GOLD_SCHEMA, SILVER_SCHEMA, TARGET
from batchlake.operators import features as ft
from batchlake.operators.series import _large_batches, attach, micro_number, over_batches, profile_batches

START = dt.datetime(2024, 1, 1)


def series(batch, n, seed=0, gap=lambda i: 60, value=None):
    rng = random.Random(f"{batch}{seed}")
    at, out = START, []
    for i in range(n):
        at = at + dt.timedelta(seconds=gap(i))
        visc = rng.uniform(1, 100) if value is None else value(i)
        out.append((at, float(i + 1), visc, rng.uniform(20, 90), rng.uniform(1, 14), 1.0, batch))
    return out


def silver(spark, rows):
    return spark.createDataFrame(rows, SILVER_SCHEMA)


def by_hand(rows):
    """The features of one batch in plain Python."""
    rows = sorted(rows)
    bt, visc, temp, ph = ([r[k] for r in rows] for k in (1, 2, 3, 4))

    def mean(xs, i):
        part = [x for x in xs[max(0, i - 5) : i + 1] if x is not None]
        return sum(part) / len(part) if part else None

    def back(xs, i, k):
        return xs[i - k] if i >= k else None

    def rate(xs, i):
        before = back(xs, i, 1)
        return None if before is None or xs[i] is None else xs[i] - before

    out = {}
    for i, row in enumerate(rows):
        span = max(bt) - min(bt)
        out[(row[6], row[0])] = (
            mean(temp, i), mean(ph, i), mean(visc, i),
            back(temp, i, 1), back(visc, i, 1), back(visc, i, 5), back(visc, i, 10),
            rate(temp, i), rate(ph, i), rate(visc, i),
            min(bt), max(bt), (bt[i] - min(bt)) / span * 100 if span else None,
            visc[i + 10] if i + 10 < len(rows) else None,
        )
    return out


COLUMNS = [
    "temp_rolling_avg_5", "ph_rolling_avg_5", "visc_rolling_avg_5",
    "temp_lag_1", "viscosity_lag_1", "viscosity_lag_5", "viscosity_lag_10",
    "temp_rate_change", "ph_rate_change", "visc_rate_change",
    "batch_start", "batch_end", "batch_progress_pct", TARGET,
]


def close(a, b):
    if a is None or b is None:
        return a is b
    return abs(a - b) < 1e-9 * max(1, abs(a))


def check_engineered(spark, batches, slice_rows):
    rows = [row for batch in batches for row in batch]
    df = silver(spark, rows).repartition(3)
    profile = profile_batches(df, slice_rows=slice_rows)
    got = ft.engineer(df, profile).collect()
    want = {}
    for batch in batches:
        want.update(by_hand(batch))
    assert len(got) == len(want)
    for row in got:
        expected = want[(row["batch_id"], row["timestamp"])]
        for name, value in zip(COLUMNS, expected):
            assert close(row[name], value), (name, row)
    return profile


def uneven(i):
    """Bursts, gaps and one stray jump."""
    return 1 if i % 7 else (9_000 if i != 21 else 40_000_000)


@pytest.mark.parametrize("slice_rows", [1, 3, 8, 25, 60, 10_000])
def test_engineered_columns_equal_plain_python(spark, slice_rows):
    batches = [
        series("big", 150),
        series("bursty", 90, gap=uneven),
        series("edge", 11),
        series("one", 1),
        series("small", 20),
    ]
    profile = check_engineered(spark, batches, slice_rows)
    assert profile.n_batches == 5
    assert profile.has_large == (slice_rows < 150)


def test_sliced_plan_with_null_readings(spark):
    gaps = series("n", 80, value=lambda i: None if i % 5 == 0 else float(i))
    check_engineered(spark, [gaps, series("m", 30)], 20)


def test_a_third_of_all_rows_in_one_batch_is_spread_over_tasks(spark):
    rows = series("hot", 600) + [r for k in range(40) for r in series(f"b{k}", 30)]
    df = silver(spark, rows)
    profile = profile_batches(df, slice_rows=50)
    assert profile.n_large == 1
    out = over_batches(df, {"x": ft.lag_expr("viscosity_cp", 10)}, 10, 0, profile)
    hot = out.filter("batch_id = 'hot'").groupBy(F.spark_partition_id()).count()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_slice" in plan
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert hot.count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_slices_of_an_uneven_batch_are_bounded(spark):
    """Half of the rows within a few minutes of a batch of many days."""
    day = series("burst", 400, gap=lambda i: 86_400)
    burst = series("burst", 400, gap=lambda i: 1)
    shifted = [(row[0] + dt.timedelta(days=30, seconds=30), *row[1:]) for row in burst]
    df = silver(spark, day + shifted)
    profile = profile_batches(df, slice_rows=50)
    cuts = _large_batches(df, {}, profile, "batch_id", "timestamp")
    slice_ = F.size(F.filter("_cuts", lambda cut: cut < micro_number(df, "timestamp")))
    sizes = df.join(cuts, "batch_id").groupBy(slice_.alias("s")).count().collect()
    assert len(sizes) >= 16 and max(r["count"] for r in sizes) <= 100


def test_eleven_rows_give_one_target(spark):
    df = ft.lead_target(silver(spark, series("b", 11)))
    assert df.filter(F.col(TARGET).isNotNull()).count() == 1


def test_constant_batch_time_has_no_progress(spark):
    rows = [(*r[:1], 5.0, *r[2:]) for r in series("b", 12)]
    out = ft.engineer(silver(spark, rows))
    assert out.filter("batch_progress_pct IS NOT NULL").count() == 0
    assert ft.build_features(silver(spark, rows)).count() == 0


def test_incomplete_rows_and_nan_are_dropped(spark):
    rows = series("b", 40)
    rows[15] = (*rows[15][:3], float("nan"), *rows[15][4:])
    out = ft.build_features(silver(spark, rows))
    assert out.schema == GOLD_SCHEMA or out.columns == GOLD_SCHEMA.names
    assert out.filter(F.isnan("temperature_c")).count() == 0
    # rows 10..29 are complete; the NaN spoils itself, five averages and one rate
    assert out.count() == 20 - 6


def test_target_must_be_positive(spark):
    rows = series("b", 30, value=lambda i: float(25 - i))
    assert ft.build_features(silver(spark, rows)).filter(f"{TARGET} <= 0").count() == 0


def test_batches_do_not_influence_each_other(spark):
    a, b = series("a", 40), series("b", 40)
    alone = ft.build_features(silver(spark, a)).collect()
    both = ft.build_features(silver(spark, a + b)).filter("batch_id = 'a'").collect()
    assert sorted(map(str, alone)) == sorted(map(str, both))


def test_batch_bounds_and_stats(spark):
    df = silver(spark, series("a", 5) + series("b", 3))
    stats = {r["batch_id"]: (r["batch_start"], r["batch_end"]) for r in ft.batch_stats(df).collect()}
    assert stats == {"a": (1.0, 5.0), "b": (1.0, 3.0)}
    for n_batches in (None, 2):
        out = ft.batch_bounds(df, n_batches=n_batches).select("batch_id", "batch_start", "batch_end")
        assert {tuple(r) for r in out.collect()} == {("a", 1.0, 5.0), ("b", 1.0, 3.0)}


def test_join_is_not_broadcast_by_hint_beyond_the_bound(spark):
    df = silver(spark, series("a", 5))
    hinted = attach(df, ft.batch_stats(df), "batch_id", 10)
    unhinted = attach(df, ft.batch_stats(df), "batch_id", 10**9)
    assert "strategy=broadcast" in hinted._jdf.queryExecution().logical().toString()
    assert "strategy=broadcast" not in unhinted._jdf.queryExecution().logical().toString()


def test_plan_has_one_shuffle_one_scan_no_join(spark, sf_dir):
    path = f"{sf_dir}/events.parquet"
    df = spark.read.parquet(path).select(
        F.col("ts").alias("timestamp"),
        F.col("value").alias("batch_time_mins"),
        F.col("value").alias("viscosity_cp"),
        F.col("value").alias("temperature_c"),
        F.col("value").alias("ph_level"),
        F.col("value").alias("r1_mass"),
        F.col("user_id").cast("string").alias("batch_id"),
    )
    out = ft.build_features(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("FileScan") == 1
    assert plan.count("Sort [") == 1
    assert "Join" not in plan
    assert "rangepartitioning" not in plan


def test_sliced_plan_reads_one_shuffle_twice(spark):
    df = silver(spark, series("a", 100))
    out = ft.build_features(df, profile_batches(df, slice_rows=20))
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in final


def test_session_time_zone_does_not_change_slices(spark):
    rows = series("a", 300, gap=lambda i: 1_800)
    df = silver(spark, rows)
    plain = ft.engineer(df, profile_batches(df)).collect()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        sliced = ft.engineer(df, profile_batches(df, slice_rows=15)).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert sorted(map(str, plain)) == sorted(map(str, sliced))
