from __future__ import annotations

import ast
from pathlib import Path

import duckdb
import pytest

import brute
import corpus_pipeline as cp
from batchlake.llm import decontaminate as dc
from batchlake.llm import line_dedup as ld
from batchlake.llm.base import table
from batchlake.llm.catalog import QUERIES, SQL
from test_line_dedup import plain
from tools.compare import rows_of

ROOT = Path(__file__).resolve().parents[2]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    frame, want = QUERIES[name](spark, sf_dir), duck.sql(SQL[name])
    assert sorted(frame.columns) == sorted(want.columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(want.columns, want.fetchall())


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages_equal_brute_force(spark, sf_dir):
    """Each stage after the model against a plain version of itself, on its own input."""
    docs = table(spark, sf_dir, "documents")
    civil = cp.toxic_out(spark, docs, sf_dir)
    assert civil.columns == docs.columns and 0 < civil.count() <= docs.count()
    rows = civil.collect()
    lines = cp.lines_out(spark, civil, sf_dir).collect()
    want = plain([(r.doc_id, r.text, r.source) for r in rows], ld.BOILERPLATE_RATIO, ld.LEAST_PAGES)
    assert sorted(((r.doc_id, r.text) for r in lines), key=str) == sorted((w[:2] for w in want), key=str)

    stage = spark.createDataFrame(lines, docs.schema)
    ordered = sorted(lines, key=lambda r: r.doc_id)
    root = brute.components(len(ordered), brute.jaccard_links([r.text for r in ordered], cp.WORDS, cp.PERCENT))
    heads = [r for i, r in enumerate(ordered) if root[i] == i]
    kept = cp.copies_out(spark, stage, sf_dir).collect()
    assert sorted(kept) == sorted(heads) and len(kept) < len(lines)

    items = [(r.item_id, dc.normal(r.text)) for r in table(spark, sf_dir, "benchmark").collect()]
    stage = spark.createDataFrame(kept, docs.schema)
    clean = cp.leaks_out(spark, stage, sf_dir).collect()
    assert sorted(clean) == sorted(r for r in kept if not any(p in dc.normal(r.text) for _, p in items))


def test_run_gives_the_rows_of_the_stages(spark, sf_dir):
    got = cp.run(spark, sf_dir).collect()
    docs = table(spark, sf_dir, "documents")
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in docs.collect())
    assert all(len(r.token_ids) == r.n_tokens for r in got)


def test_nothing_else_imports_the_subpackage():
    for path in [*ROOT.glob("batchlake/**/*.py"), *ROOT.glob("tools/*.py"), ROOT / "bench.py"]:
        if "llm" in path.relative_to(ROOT).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n.split(".") for n in names), path
