from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from batchlake.llm import line_dedup as ld


def plain(rows, ratio, least):
    pages = defaultdict(set)
    for _, text, host in rows:
        if text is not None:
            pages[host].add(text)
    count = Counter((h, line) for h, texts in pages.items() for t in texts for line in {x.strip(" ") for x in t.split("\n")})
    out = []
    for i, text, host in rows:
        lines = [] if text is None else text.split("\n")
        drop = {x for x in lines if x.strip(" ") and (c := count[host, x.strip(" ")]) >= least and c > ratio * len(pages[host])}
        kept = [x for x in lines if x not in drop]
        out.append((i, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


ROWS = (
    [(i, f"menu\nbody {i}\n menu \n\nfoot {i % 3}", "a") for i in range(30)]
    + [(100 + i, "copied\npage", "a") for i in range(40)]
    + [(200 + i, f"menu\nother {i}", None) for i in range(20)]
    + [(300 + i, f"menu\ntiny {i}", "c") for i in range(3)]
    + [(400, None, "a"), (401, "", "a"), (None, "menu", "a"), (402, "x" * 200_000 + "\nmenu", "a"), (403, "\n\n", None)]
)


@pytest.mark.parametrize("shuffled", [False, True])
def test_equals_brute_force(spark, monkeypatch, shuffled):
    if shuffled:
        monkeypatch.setattr(ld, "BROADCAST_LINES", -1)
    docs = spark.createDataFrame([(*r, "clash") for r in ROWS], "doc_id long, text string, source string, host string")
    got = ld.drop_boilerplate(docs, F.col("source")).select("row.doc_id", "text", "n_lines", "n_dropped").collect()
    want = plain(ROWS, ld.BOILERPLATE_RATIO, ld.LEAST_PAGES)
    assert sorted((tuple(r) for r in got), key=str) == want
    dropped = {r[0]: r[3] for r in want}
    assert dropped[0] == 3 and dropped[100] == 0 and dropped[300] == 0 and dropped[200] == 1


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert ld.drop_boilerplate(none, F.col("source")).count() == 0
