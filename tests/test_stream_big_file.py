from __future__ import annotations

from batchlake.functions.schema import SILVER_SCHEMA
from batchlake.session import prepare
from batchlake.sources import layers, raw_text
from batchlake.streaming.drop_folder import ingest_stream, layer_paths
from test_sources import put, row, text_of


def test_the_stream_reads_a_file_of_some_megabytes_in_splits(spark, tmp_path, monkeypatch):
    """Files of tens of megabytes, whole in each task of an executor, ended it for want of heap (F2)."""
    wide = [[*row(i)[:-1], f"{i}{'0' * 60}"] for i in range(50_000)]
    put(tmp_path / "drop" / "run" / "a.csv", text_of(wide, ","), "utf-8")
    assert 4 << 20 < (tmp_path / "drop" / "run" / "a.csv").stat().st_size < 64 << 20
    split, used = raw_text._split_files, []
    monkeypatch.setattr(raw_text, "_split_files", lambda *a: used.append(a) or split(*a))
    lake, counts = str(tmp_path / "lake"), []
    stream = ingest_stream(prepare(spark), str(tmp_path / "drop"), lake, str(tmp_path / "stream"), on_counts=lambda _, n: counts.append(n))
    stream.awaitTermination()
    assert len(used) == 1
    silver = layers.read_layer(spark, layer_paths(lake)["silver"], SILVER_SCHEMA)
    assert counts == [{"rows_in": 50_000, "rows_saved": silver.count()}]
    assert silver.count() == len({r[0] for r in wide})
