from __future__ import annotations

from batchlake.functions.schema import ROLES
from batchlake.sources import raw_text
from test_sources import put, row, text_of


def test_a_file_of_some_megabytes_is_not_read_whole(spark, tmp_path, monkeypatch):
    """Files of tens of megabytes, one per task, filled an executor's memory."""
    wide = [[*row(i)[:-1], f"{i}{'0' * 60}"] for i in range(50_000)]
    put(tmp_path / "drop" / "run" / "a.csv", text_of(wide, ","), "utf-8")
    size = (tmp_path / "drop" / "run" / "a.csv").stat().st_size
    assert 4 << 20 < size < 64 << 20
    split, used = raw_text._split_files, []
    monkeypatch.setattr(raw_text, "_split_files", lambda *a: used.append(a) or split(*a))
    got = raw_text.read_raw_text(spark, str(tmp_path / "drop")).select(*ROLES)
    assert len(used) == 1
    whole = raw_text.read_raw_text(spark, str(tmp_path / "drop"), whole_file_bytes=64 << 20).select(*ROLES)
    assert got.count() == whole.count() == 50_000 and got.exceptAll(whole).isEmpty()


def test_the_lines_of_a_whole_file_are_no_column_of_a_step(spark, tmp_path):
    """Each step kept a copy of all lines and of all records of a file, for each task of an executor (F2)."""
    put(tmp_path / "drop" / "run" / "a.csv", text_of([row(i) for i in range(30)], ","), "utf-8")
    rows = raw_text.read_raw_text(spark, str(tmp_path / "drop"))
    assert rows.count() == 30
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" in plan
    assert "records#" not in plan and "lines#" not in plan
