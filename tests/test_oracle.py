from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry
from batchlake.catalog.queries import CATALOG
from batchlake.functions.schema import GOLD_SCHEMA
from tools.compare import rows_of

SQL = {name: query.sql for name, query in CATALOG.items() if query.sql}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def test_entry(spark):
    df = entry(spark)
    assert df.columns == GOLD_SCHEMA.names
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    frame = CATALOG[name].build(spark, sf_dir)
    got = frame.collect()
    assert got
    if name not in SQL:
        return
    want = duck.sql(SQL[name])
    assert sorted(frame.columns) == sorted(want.columns)
    assert rows_of(frame.columns, got) == rows_of(want.columns, want.fetchall())
