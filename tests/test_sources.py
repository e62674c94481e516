from __future__ import annotations

import csv
import datetime as dt
import io
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from batchlake.functions.schema import (
    BRONZE_SCHEMA,
    GOLD_SCHEMA,
    PREDICTION_SCHEMA,
    ROLES,
    SILVER_SCHEMA,
)
from batchlake.operators.features import build_features
from batchlake.plans.medallion import clean
from batchlake.sources import layers
from batchlake.sources.raw_text import plain_path, read_drop_folder, read_raw_text
from batchlake.streaming.drop_folder import ingest_stream, layer_paths

HEADER = ["Time", "Batch Time", "X.R1_VISC_CP", "R1 Temp °C", "R1_PH_R02", "R1 Mass", "Operator"]


def row(i, who="ann"):
    stamp = dt.datetime(2024, 1, 5, 8) + dt.timedelta(minutes=i)
    return [stamp.strftime("%Y-%m-%d %H:%M:%S"), str(i + 1), f"{800 + i}.5", "80.1", "7.1", "64,734.01", who]


def text_of(rows, sep, header=HEADER, newline="\r\n"):
    def quote(cell):
        return f'"{cell}"' if sep in cell or '"' in cell or "," in cell else cell

    return newline.join(sep.join(quote(c) for c in r) for r in [header, *rows]) + newline


def put(path: Path, text: str, encoding: str, bom: bytes = b""):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(bom + text.encode(encoding))


LE, BE, U8 = ("utf-16-le", b"\xff\xfe"), ("utf-16-be", b"\xfe\xff"), ("utf-8", b"\xef\xbb\xbf")


def rows_of(df):
    return sorted(tuple(r) for r in df.select("batch_time_mins", "viscosity_cp", "temperature_c", "r1_mass").collect())


@pytest.fixture
def mixed(tmp_path):
    put(tmp_path / "u16_tab.csv", text_of([row(i) for i in range(5)], "\t"), *LE)
    order = [3, 0, 6, 1, 2, 5, 4]
    shuffled = [[r[k] for k in order] for r in [row(i) for i in range(5, 9)]]
    put(tmp_path / "u8_bom_comma.csv", text_of(shuffled, ",", [HEADER[k] for k in order]), *U8)
    put(tmp_path / "u8_tab.CSV", text_of([row(i) for i in range(9, 11)], "\t", newline="\n"), "utf-8")
    put(tmp_path / "u8_semicolon.csv", text_of([row(11)], ";"), "utf-8")
    put(tmp_path / "u16_be.csv", text_of([row(i) for i in range(12, 15)], "\t"), *BE)
    put(tmp_path / "blank_first.csv", "\n \r\n" + text_of([row(15)], ",") + "\n\n", "utf-8")
    put(tmp_path / "empty.csv", "", "utf-8")
    put(tmp_path / "notes.txt", "not a csv", "utf-8")
    return tmp_path


EXPECTED = sorted((str(i + 1), f"{800 + i}.5", "80.1", "64,734.01") for i in range(16))


def test_mixed_encodings_separators_and_column_orders(spark, mixed):
    df = read_raw_text(spark, str(mixed))
    assert df.columns == [f.name for f in BRONZE_SCHEMA]
    assert rows_of(df) == EXPECTED
    assert {r["extra"]["Operator"] for r in df.collect()} == {"ann"}
    names = {r["batch_id"] for r in df.select("batch_id").distinct().collect()}
    assert names == {"u16_tab", "u8_bom_comma", "u8_tab", "u8_semicolon", "u16_be", "blank_first"}


def test_split_reader_gives_the_same_rows(spark, mixed):
    whole = read_raw_text(spark, str(mixed))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "101")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        split = read_raw_text(spark, str(mixed), whole_file_bytes=0)
        got = rows_of(split)
        kept = clean(split).select("batch_id", "timestamp", "r1_mass").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == EXPECTED
    wanted = clean(whole).select("batch_id", "timestamp", "r1_mass").collect()
    assert sorted(kept) == sorted(wanted)


def test_split_reader_orders_lines_within_a_file(spark, tmp_path):
    """The first of two rows with one timestamp survives, also across splits."""
    rows = [[*row(0)[:1], "1", str(i), "80", "7", "1", "x"] for i in range(1, 200)]
    for name, coding in (("a", LE), ("b", BE), ("c", ("utf-8",))):
        put(tmp_path / f"{name}.csv", text_of(rows, "\t"), *coding)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = read_raw_text(spark, str(tmp_path), whole_file_bytes=0)
        assert df.rdd.getNumPartitions() > 3
        assert [r["viscosity_cp"] for r in clean(df).collect()] == [1.0, 1.0, 1.0]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.fixture
def tiny_splits(spark):
    """Splits of some hundred bytes."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "301")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("coding", [LE, BE])
def test_characters_with_the_byte_0a(spark, tmp_path, tiny_splits, coding):
    """U+010A and U+0A05 hold the byte, also side by side and at the ends of cells."""
    names = ["ਅ", "Ċ", "ĊਅĊ", "xਅ", "Ċx", "ਊ", "਀", "plain", "ਊĊ\u0a0a"]
    rows = [row(i, names[i % len(names)]) for i in range(20)]
    put(tmp_path / "a.csv", text_of(rows, "\t"), *coding)
    put(tmp_path / "b.csv", text_of(rows, "\t", newline="\n").rstrip("\n"), *coding)
    want = sorted((r[1], r[6]) for r in rows)
    for size in (1 << 20, 0):
        got = read_raw_text(spark, str(tmp_path), whole_file_bytes=size)
        for name in ("a.csv", "b.csv"):
            own = got.filter(F.col("source_file") == name)
            assert sorted((r["batch_time_mins"], r["extra"]["Operator"]) for r in own.collect()) == want, (size, name)


def quoted_table(sep, n=30, seed=1):
    """Rows with quotes, separators and line breaks in their last cell, as the csv module writes them."""
    rng = random.Random(seed)
    notes = ["plain", "two\nlines", 'say "hi"', f"a{sep}b", "x\n\ny", '"', '""\n"', f'"\n{sep}"', "end\n", f"{sep}\n{sep}", "", "1,2", 'q",\n"z']
    rows = [[*row(i)[:6], rng.choice(notes)] for i in range(n)]
    rows[0][6] = notes[1]
    out = io.StringIO()
    csv.writer(out, delimiter=sep, lineterminator="\n").writerows([HEADER, *rows])
    read = list(csv.reader(io.StringIO(out.getvalue()), delimiter=sep))[1:]
    return out.getvalue(), sorted((r[1], r[6]) for r in read)


@pytest.mark.parametrize("sep", ["\t", ";", ",", "|"])
def test_line_breaks_in_quotes_equal_the_csv_module(spark, tmp_path, tiny_splits, sep):
    want = {}
    for seed, coding in enumerate((("utf-8",), U8, LE, BE)):
        text, want[f"f{seed}.csv"] = quoted_table(sep, 18, seed)
        put(tmp_path / f"f{seed}.csv", text, *coding)
    for size in (1 << 20, 0):
        got = read_raw_text(spark, str(tmp_path), whole_file_bytes=size).collect()
        for name, rows in want.items():
            assert sorted((r["batch_time_mins"], r["extra"]["Operator"]) for r in got if r["source_file"] == name) == rows, (size, name)


def test_a_long_cell_spans_several_splits(spark, tmp_path, tiny_splits):
    note = "\n".join(f"line {i}" for i in range(120))
    rows = [row(0), [*row(1)[:6], note], row(2), [*row(3)[:6], "a\nb"]]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows([HEADER, *rows])
    put(tmp_path / "a.csv", out.getvalue(), "utf-8")
    got = read_raw_text(spark, str(tmp_path), whole_file_bytes=0)
    assert sorted((r["batch_time_mins"], r["extra"]["Operator"]) for r in got.collect()) == sorted((r[1], r[6]) for r in rows)


def test_a_quote_that_is_never_closed(spark, tmp_path, monkeypatch):
    from batchlake.sources import raw_text

    text = 'Time,Batch Time,R1_PH_R02,Note\n2024-01-05 08:00:00,1,7,5" pipe\n2024-01-05 08:01:00,2,7,"open\n' + "x,1,2,3\n" * 30
    put(tmp_path / "a.csv", text, "utf-8")
    monkeypatch.setattr(raw_text, "MOST_LINES", 20)
    for size in (0, 1 << 20):
        with pytest.raises(Exception, match="a quote is never closed in a.csv"):
            read_raw_text(spark, str(tmp_path), whole_file_bytes=size).collect()


@pytest.mark.parametrize("size", [0, 1 << 20])
def test_problems_as_rows(spark, tmp_path, size):
    put(tmp_path / "good.csv", text_of([row(i) for i in range(5)], ","), "utf-8")
    put(tmp_path / "bad.csv", "Foo,Bar\n1,2\n3,4\n", "utf-8")
    got = read_raw_text(spark, str(tmp_path), whole_file_bytes=size, on_error="mark").collect()
    bad = [r for r in got if r["problem"]]
    assert len(got) == 6 and [r["source_file"] for r in bad] == ["bad.csv"]
    assert bad[0]["problem"] == "no column for timestamp in bad.csv" and bad[0]["timestamp"] is None


@pytest.mark.parametrize("size", [0, 1 << 20])
def test_utf16_without_a_mark(spark, tmp_path, tiny_splits, size):
    want = {}
    for name, coding in (("le", "utf-16-le"), ("be", "utf-16-be"), ("u8", "utf-8")):
        rows = [row(i, who) for i, who in enumerate(["ann", "Ж", "日本", "ਅ", "é"] * 3)]
        put(tmp_path / f"{name}.csv", text_of(rows, "\t"), coding)
        want[f"{name}.csv"] = sorted((r[1], r[6]) for r in rows)
    got = read_raw_text(spark, str(tmp_path), whole_file_bytes=size).collect()
    for name, rows in want.items():
        assert sorted((r["batch_time_mins"], r["extra"]["Operator"]) for r in got if r["source_file"] == name) == rows, name


@pytest.mark.parametrize("size", [0, 1 << 20])
def test_separator_by_even_cells(spark, tmp_path, size):
    """Headers with more commas than separators; texts with more of a mark than there are separators."""
    header = ["Time", "Batch Time, (mins), run", "R1_PH_R02, at, 20", "R1 Temp, C, avg"]
    body = [[row(i)[0], f"{i + 1},0", "7,1", "80,1"] for i in range(6)]
    for k, sep in enumerate([";", "\t", "|"]):
        lines = [sep.join(f'"{c}"' for c in header), *(sep.join(r) for r in body)]
        put(tmp_path / f"f{k}.csv", "\n".join(lines) + "\n", "utf-8")
        put(tmp_path / f"g{k}.csv", "\n".join([sep.join(header), *lines[1:]]) + "\n", "utf-8")
    got = read_raw_text(spark, str(tmp_path), whole_file_bytes=size).collect()
    assert len(got) == 36
    assert {(r["ph_level"], r["temperature_c"]) for r in got} == {("7,1", "80,1")}


def test_quotes_and_short_lines(spark, tmp_path):
    text = 'Time,Batch Time,R1_PH_R02,Note\n2024-01-05 08:00:00,1,"7,5","say ""hi"", ok"\n2024-01-05 08:01:00,2\n'
    put(tmp_path / "a.csv", text, "utf-8")
    rows = read_raw_text(spark, str(tmp_path)).orderBy("line_no").collect()
    assert (rows[0]["ph_level"], rows[0]["extra"]["Note"]) == ("7,5", 'say "hi", ok')
    assert rows[1]["ph_level"] is None and rows[1]["viscosity_cp"] is None


def test_second_column_of_a_role_is_kept_as_extra(spark, tmp_path):
    text = "Time,Batch Time,R1_PH_R02,R1 Temp A,R1 Temp B,Note,Note\n2024-01-05 08:00:00,1,7,80,81,x,y\n"
    put(tmp_path / "a.csv", text, "utf-8")
    got = read_raw_text(spark, str(tmp_path)).first()
    assert got["temperature_c"] == "80"
    assert got["extra"] == {"R1 Temp B": "81", "Note": "x", "Note.7": "y"}


@pytest.mark.parametrize("limit", [10**6, 0])
def test_missing_role_names_the_file(spark, tmp_path, limit):
    put(tmp_path / "other.csv", text_of([row(0)], "\t", ["When", *HEADER[1:]]), "utf-16-le")
    with pytest.raises(Exception, match="no column for timestamp in other.csv"):
        read_raw_text(spark, str(tmp_path), whole_file_bytes=limit).collect()


def test_awkward_file_names(spark, tmp_path):
    put(tmp_path / "run 1+2%" / "a b.csv", text_of([row(0)], ","), "utf-8")
    got = read_drop_folder(spark, str(tmp_path)).first()
    assert (got["batch_id"], got["source_file"]) == ("run 1+2%_combined", "run 1+2%/a b.csv")


def test_plain_path():
    assert plain_path("file:///a/b/") == plain_path("file:/a/b") == plain_path("/a/b") == "/a/b"
    assert plain_path("s3a://bucket/x") == "/bucket/x"


def test_folder_is_one_batch_merged_by_role(spark, tmp_path):
    put(tmp_path / "run7" / "a.csv", text_of([row(0)], "\t"), *LE)
    put(tmp_path / "run7" / "deep" / "b.csv", text_of([row(1)[::-1]], ",", HEADER[::-1]), "utf-8")
    df = read_drop_folder(spark, str(tmp_path))
    assert {r["batch_id"] for r in df.collect()} == {"run7_combined"}
    assert clean(df).count() == 2
    per_file = read_drop_folder(spark, str(tmp_path), batch_by="file")
    assert {r["batch_id"] for r in per_file.collect()} == {"run7/a", "run7/deep/b"}


def test_layer_keeps_other_batches_and_text_ids(spark, tmp_path):
    path = str(tmp_path / "layer")

    def layer(batch, n):
        stamp = dt.datetime(2024, 1, 1)
        rows = [(stamp + dt.timedelta(minutes=i), 1.0, 1.0, 1.0, 1.0, 1.0, batch) for i in range(n)]
        return spark.createDataFrame(rows, SILVER_SCHEMA)

    layers.write_layer(layer("20240105", 3).union(layer("20240106", 2)), path)
    layers.write_layer(layer("20240105", 4), path)
    back = layers.read_layer(spark, path, SILVER_SCHEMA)
    counts = {r["batch_id"]: r["count"] for r in back.groupBy("batch_id").count().collect()}
    assert counts == {"20240105": 4, "20240106": 2}


def test_predictions_round_trip_and_parts(spark, tmp_path):
    paths = [str(tmp_path / p) for p in ("p1", "p2")]
    for k, path in enumerate(paths):
        one = (dt.datetime(2024, 1, 1), 1.0, 7.0, 2.0, float(k), "b")
        layers.write_predictions(spark.createDataFrame([one], PREDICTION_SCHEMA), path)
    back = layers.read_layer(spark, paths, PREDICTION_SCHEMA)
    assert sorted(r["prediction"] for r in back.collect()) == [0.0, 1.0]
    assert back.columns == PREDICTION_SCHEMA.names


# -- stream --------------------------------------------------------------------


def run_stream(spark, tmp_path, **options):
    counts = []
    query = ingest_stream(
        spark,
        str(tmp_path / "drop"),
        str(tmp_path / "lake"),
        str(tmp_path / "checkpoint"),
        on_counts=lambda trigger_id, c: counts.append(c),
        **options,
    )
    query.awaitTermination(120)
    return counts


def layer(spark, tmp_path, name, schema):
    return layers.read_layer(spark, layer_paths(str(tmp_path / "lake"))[name], schema)


def test_stream_picks_up_new_files_extends_batches_and_restarts(spark, tmp_path):
    drop = tmp_path / "drop"
    put(drop / "run1" / "a.csv", text_of([row(i) for i in range(25)], "\t"), *LE)
    put(drop / "solo.csv", text_of([row(i) for i in range(30)], ","), "utf-8")
    assert run_stream(spark, tmp_path) == [{"rows_in": 55, "rows_saved": 55}]

    # nothing new
    assert run_stream(spark, tmp_path) == []

    # a late file of a known batch, overlapping it by five rows
    put(drop / "run1" / "late.csv", text_of([row(i) for i in range(20, 40)], ";"), "utf-8")
    assert run_stream(spark, tmp_path) == [{"rows_in": 45, "rows_saved": 40}]

    silver = layer(spark, tmp_path, "silver", SILVER_SCHEMA)
    sizes = {r["batch_id"]: r["count"] for r in silver.groupBy("batch_id").count().collect()}
    assert sizes == {"run1_combined": 40, "solo": 30}
    gold = layer(spark, tmp_path, "gold", GOLD_SCHEMA)
    expected = build_features(clean(read_drop_folder(spark, str(drop))).drop("extra"))
    assert sorted(map(str, gold.collect())) == sorted(map(str, expected.select(*gold.columns).collect()))


def test_stream_in_small_triggers_archives_files(spark, tmp_path):
    drop, archive = tmp_path / "drop", tmp_path / "archive"
    for k in range(3):
        put(drop / "run" / f"f{k}.csv", text_of([row(10 * k + i) for i in range(10)], ","), "utf-8")
    counts = run_stream(spark, tmp_path, max_files=1, archive_dir=str(archive))
    assert [c["rows_saved"] for c in counts] == [10, 20, 30]
    assert layer(spark, tmp_path, "bronze", BRONZE_SCHEMA).count() == 30
    assert list(archive.rglob("*.csv"))


def test_replayed_trigger_changes_nothing(spark, tmp_path):
    from batchlake.streaming.drop_folder import ingest_files

    drop = tmp_path / "drop"
    put(drop / "a.csv", text_of([row(i) for i in range(random.Random(1).randint(21, 30))], ","), "utf-8")
    call = (spark, [str(drop / "a.csv")], ["a"], str(drop), str(tmp_path / "lake"), "folder")
    assert ingest_files(*call) == ingest_files(*call)
    bronze = layer(spark, tmp_path, "bronze", BRONZE_SCHEMA)
    assert bronze.count() == bronze.select("line_no").distinct().count()
    assert set(ROLES) <= set(bronze.columns)
    assert bronze.filter(F.col("source_file") == "a.csv").count() == bronze.count()


REJECTED = "batch_id string, source_file string, reason string"


def test_a_bad_file_does_not_stop_the_others(spark, tmp_path):
    drop = tmp_path / "drop"
    put(drop / "bad.csv", "Foo,Bar\n1,2\n", "utf-8")
    assert run_stream(spark, tmp_path) == [{"rows_in": 0, "rows_saved": 0}]
    put(drop / "bad2.csv", "Foo,Bar\n1,2\n", "utf-8")
    for name in ("one", "two"):
        put(drop / f"{name}.csv", text_of([row(i) for i in range(22)], ","), "utf-8")
    assert run_stream(spark, tmp_path) == [{"rows_in": 44, "rows_saved": 44}]
    rejected = spark.read.schema(REJECTED).parquet(layer_paths(str(tmp_path / "lake"))["rejected"]).collect()
    assert sorted(r["source_file"] for r in rejected) == ["bad.csv", "bad2.csv"]
    assert all("no column for" in r["reason"] for r in rejected)


def test_only_content_is_rejected_and_rejected_files_can_be_retried(spark, tmp_path, monkeypatch):
    from batchlake.streaming import drop_folder

    drop, lake = tmp_path / "drop", str(tmp_path / "lake")
    good = text_of([row(i) for i in range(22)], ",")
    put(drop / "good.csv", good, "utf-8")
    put(drop / "bad.csv", "Foo,Bar\n1,2\n", "utf-8")
    call = (spark, [str(drop / f"{n}.csv") for n in ("bad", "good")], ["bad", "good"], str(drop), lake, "folder")

    def full(df, *_):
        spark.range(1).select(F.raise_error(F.lit("No space left on device"))).collect()

    with monkeypatch.context() as m:
        m.setattr(drop_folder, "write_layer", full)
        with pytest.raises(Exception, match="No space left"):
            drop_folder.ingest_files(*call)
    assert not layers.exists(spark, layer_paths(lake)["rejected"])
    assert drop_folder.ingest_files(*call)["rows_saved"] == 22
    rejected = lambda: layer(spark, tmp_path, "rejected", REJECTED).count()
    drop_folder.retry_rejected(spark, str(drop), lake)
    assert rejected() == 1
    put(drop / "bad.csv", good, "utf-8")
    drop_folder.retry_rejected(spark, str(drop), lake)
    assert rejected() == 0
    assert layer(spark, tmp_path, "bronze", BRONZE_SCHEMA).select("source_file").distinct().count() == 2


def test_rows_that_are_all_rejected_count_as_zero_and_leave_nothing_behind(spark, tmp_path):
    from batchlake.streaming.drop_folder import ingest_files

    drop, lake = tmp_path / "drop", str(tmp_path / "lake")
    call = (spark, [str(drop / "a.csv")], ["a"], str(drop), lake, "folder")
    put(drop / "a.csv", text_of([row(i) for i in range(25)], ","), "utf-8")
    assert ingest_files(*call)["rows_saved"] == 25
    assert layer(spark, tmp_path, "gold", GOLD_SCHEMA).count() > 0
    put(drop / "a.csv", text_of([row(i)[:1] + ["0"] * (len(HEADER) - 1) for i in range(7)], ","), "utf-8")
    assert ingest_files(*call) == {"rows_in": 7, "rows_saved": 0}
    assert layer(spark, tmp_path, "silver", SILVER_SCHEMA).count() == 0
    assert layer(spark, tmp_path, "gold", GOLD_SCHEMA).count() == 0


def test_a_bar_separates_too(spark, tmp_path):
    put(tmp_path / "a.csv", text_of([row(0), row(1)], "|"), *LE)
    assert clean(read_raw_text(spark, str(tmp_path))).count() == 2
