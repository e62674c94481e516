from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from batchlake.functions import cells
from batchlake.functions.schema import ROLES, TIME, role_of
from batchlake.operators import clean as cl
from batchlake.plans.medallion import build_silver, clean
from batchlake.session import work_path
from batchlake.sources.layers import read_layer

KEYS = ", batch_id string, source_file string, block_start long, line_no long"
RAW = ", ".join(f"{r} string" for r in ROLES) + KEYS


def raw_row(time, bt="1", visc="1", temp="1", ph="7", mass="1", batch="b", file="f", line=1):
    return (time, bt, visc, temp, ph, mass, batch, file, 0, line)


@pytest.mark.parametrize(
    "header, role",
    [
        ("Time", "timestamp"),
        ("﻿Time ", "timestamp"),
        ("Timer", None),
        ("BATCH TIME (min)", "batch_time_mins"),
        ("x.R1_VISC_CP.PV", "viscosity_cp"),
        ("R1 Jacket TEMP", "temperature_c"),
        ("R1_PH_R02", "ph_level"),
        ("R1 Mass kg", "r1_mass"),
        ("R2 Mass kg", None),
    ],
)
def test_header_rules(header, role):
    assert role_of(header) == role


def test_first_header_of_a_role_wins(spark):
    df = spark.createDataFrame([("a", "b", "c")], ["R1 temp A", "R1 temp B", "note"])
    assert cl.standardise_columns(df).columns == ["temperature_c", "R1 temp B", "note"]


def test_thousands_and_null_tokens(spark):
    df = spark.createDataFrame([("64,734.01", "Null"), ("nan", "7")], ["a", "b"])
    out = cl.cast_numeric(cl.null_tokens(cl.strip_thousands(df, ["a", "b"]), ["a", "b"]), ["a", "b"])
    assert [tuple(r) for r in out.collect()] == [(64734.01, None), (None, 7.0)]


def test_bad_number_becomes_null(spark):
    df = spark.createDataFrame([("12x",)], ["a"])
    assert cl.cast_numeric(df, ["a"]).first()["a"] is None


@pytest.mark.parametrize(
    "text, value",
    [
        ("1/5/2024 8:00:00.123 AM", dt.datetime(2024, 1, 5, 8, 0, 0, 123000)),
        ("1/5/2024 8:00:00.123 pm", dt.datetime(2024, 1, 5, 20, 0, 0, 123000)),
        ("1/5/2024 13:00:00", dt.datetime(2024, 1, 5, 13)),
        ("2024-01-05 08:00:00", dt.datetime(2024, 1, 5, 8)),
        ("1/5/2024 8:00 PM", dt.datetime(2024, 1, 5, 20)),
        ("1/5/2024 8:00:00 PM", None),
        ("31/31/2024 8:00 PM", None),
        ("garbage", None),
        (None, None),
    ],
)
def test_parse_time(spark, text, value):
    df = spark.createDataFrame([(text,)], "timestamp string")
    assert cl.parse_timestamps(df).first()[TIME] == value


def test_extra_format_by_parameter(spark):
    df = spark.createDataFrame([("1/5/2024 8:00:00 PM",)], "timestamp string")
    out = cl.parse_timestamps(df, formats=["M/d/yyyy h:mm:ss a"])
    assert out.first()[TIME] == dt.datetime(2024, 1, 5, 20)


def test_unknown_pattern_letters_have_no_guard():
    assert cells.shape_of("EEE, d MMM") is None


def test_guard_accepts_all_the_formatter_accepts(spark):
    stamps = spark.range(0, 3000).select(
        F.timestamp_seconds(F.col("id") * 7919 + 1_700_000_000).alias("t")
    )
    for fmt in ["M/d/yyyy h:mm:ss.SSS a", "M/d/yyyy H:mm:ss", "yyyy-MM-dd HH:mm:ss", "M/d/yyyy h:mm a"]:
        text = stamps.select(F.date_format("t", fmt).alias("s"))
        missed = text.filter(~F.col("s").rlike(cells.shape_of(fmt))).count()
        assert missed == 0


def test_keep_positive_drops_null_nan_and_zero(spark):
    rows = [(1.0, 7.0), (0.0, 7.0), (1.0, float("nan")), (None, 7.0), (1.0, -1.0)]
    df = spark.createDataFrame(rows, "batch_time_mins double, ph_level double")
    assert [tuple(r) for r in cl.keep_positive(df).collect()] == [(1.0, 7.0)]


def test_dedupe_keeps_first_by_file_and_line_and_keeps_batches_apart(spark):
    t = "2024-01-05 08:00:00"
    rows = [
        raw_row(t, visc="3", file="g", line=1),
        raw_row(t, visc="2", file="f", line=9),
        raw_row(t, visc="1", file="f", line=2),
        raw_row(t, visc="5", batch="c"),
    ]
    out = clean(spark.createDataFrame(rows, RAW)).orderBy("batch_id").collect()
    assert [(r["batch_id"], r["viscosity_cp"]) for r in out] == [("b", 1.0), ("c", 5.0)]


def test_dedupe_reduces_copies_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("batch_id"), (F.col("id") % 5).alias(TIME), "id")
    plan = cl.dedupe(df, order=("id",))._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_rows_without_time_are_rejected_and_counted(spark):
    t = "2024-01-05 08:00:00"
    rows = [raw_row("oops"), raw_row(t), raw_row(t, line=2), raw_row(t, ph="0"), raw_row(None, bt="0")]
    raw = spark.createDataFrame(rows, RAW)
    assert clean(raw).count() == 1
    assert cl.quality_counters(raw).first().asDict() == {
        "rows_in": 5,
        "rows_without_time": 2,
        "rows_impossible": 1,
        "rows_before_dedupe": 2,
        "rows_duplicate": 1,
        "rows_saved": 1,
    }


def test_counters_of_an_empty_table_are_zero(spark):
    counts = cl.quality_counters(spark.createDataFrame([], RAW)).first()
    assert set(counts) == {0}


def test_write_job_reports_its_own_counts(spark):
    t = "2024-01-05 08:00:00"
    raw = spark.createDataFrame([raw_row(t), raw_row(t, line=2), raw_row("x")], RAW)
    path = work_path(spark, "silver")
    assert build_silver(raw, path) == {"rows_in": 3, "rows_saved": 1}
    assert read_layer(spark, path).count() == 1


def test_missing_optional_columns_become_null(spark):
    df = spark.createDataFrame(
        [("2024-01-05 08:00:00", "1", "7", "b", "f", 0, 1)],
        "Time string, `Batch Time` string, R1_PH_R02 string" + KEYS,
    )
    row = clean(df).first()
    assert row["ph_level"] == 7.0 and row["viscosity_cp"] is None and row["r1_mass"] is None


@pytest.mark.parametrize(
    "path, by_folder, by_file",
    [
        ("a.csv", "a", "a"),
        ("a.csv.CSV", "a", "a"),
        ("run7/a.csv", "run7_combined", "run7/a"),
        ("run7/sub/a.csv", "run7_combined", "run7/sub/a"),
    ],
)
def test_derive_batch_id(spark, path, by_folder, by_file):
    row = spark.createDataFrame([(path,)], ["p"]).select(
        cl.derive_batch_id(F.col("p"), "folder"), cl.derive_batch_id(F.col("p"), "file")
    ).first()
    assert tuple(row) == (by_folder, by_file)


cell = st.sampled_from(["1", "0", "Null", "1,5", "x", "", "-3", "NaN"])


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(cell, cell, cell, st.integers(0, 5)), min_size=1, max_size=15), st.randoms())
def test_row_order_and_partitions_do_not_matter(spark, values, random):
    rows = [
        raw_row(f"2024-01-05 08:00:0{s}", bt=a, visc=b, ph=c, line=i)
        for i, (a, b, c, s) in enumerate(values)
    ]
    shuffled = rows[:]
    random.shuffle(shuffled)
    first = clean(spark.createDataFrame(rows, RAW)).collect()
    second = clean(spark.createDataFrame(shuffled, RAW).repartition(3)).collect()
    assert sorted(map(str, first)) == sorted(map(str, second))
