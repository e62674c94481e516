from __future__ import annotations

import random

from pyspark.sql import functions as F

from batchlake.llm import decontaminate as dc

SYLLABLES = ["th", "er", "on", "an", "re", "ti", "sh", "ble", "wh", "ou", "in", "at", "ét"]


def prose(rnd, words):
    return " ".join("".join(rnd.choices(SYLLABLES, k=rnd.randint(1, 4))) for _ in range(words))


def distance(passage: bytes, text: bytes) -> int:
    """Fewest edits that turn the passage into a part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(passage):
        new = [i + 1]
        for j, d in enumerate(text):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def edited(rnd, text: str, edits: int) -> str:
    out = list(text)
    for _ in range(edits):
        at, kind = rnd.randrange(len(out)), rnd.randrange(3)
        out[at : at + (kind != 2)] = [] if kind == 1 else [rnd.choice("abcde ")]
    return "".join(out)


def test_finds_what_the_edit_budget_allows():
    rnd = random.Random(7)
    items = [(i, prose(rnd, rnd.randint(12, 40))) for i in range(25)]
    index = dc.PassageIndex(items)
    inside = 0
    for _ in range(60):
        i, passage = rnd.choice(items)
        budget = index.passages[i].edits
        text = dc.normal(prose(rnd, 20) + " " + edited(rnd, passage, rnd.randint(0, budget + 3)) + " " + prose(rnd, 20))
        least = distance(dc.normal(passage), text)
        found = {m[0]: m for m in index.search([text])[0]}
        assert (i in found) == (least <= budget)
        if i in found:
            inside += 1
            assert found[i][3] == least or least == 0
    assert inside > 20


def test_parts_of_long_texts_overlap(monkeypatch):
    monkeypatch.setattr(dc, "PART_BYTES", 300)
    rnd = random.Random(8)
    items = [(i, prose(rnd, 30)) for i in range(6)]
    index = dc.PassageIndex(items)
    for i, passage in items:
        text = dc.normal(prose(rnd, rnd.randint(0, 200)) + " " + passage.upper() + " " + prose(rnd, 100))
        (match,) = index.search([text])[0]
        assert match[0] == i and text[match[1] : match[2]] == dc.normal(passage)


def test_rows_nulls_blocks(spark, monkeypatch):
    rnd = random.Random(9)
    items = [(i, prose(rnd, 25)) for i in range(12)]
    bench = spark.createDataFrame([*items, (90, None), (91, ""), (92, "tiny"), (93, items[0][1])], "item_id long, text string")
    rows = [(1, "x " + items[3][1], "m"), (2, prose(rnd, 80), "m"), (3, None, "m"), (4, "", "m"), (5, " TINY\n", "m"), (6, "tiny thing", "m"),
            (None, items[0][1] + " " + items[7][1], "m"), (1, "x " + items[3][1], "m")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, matches string")
    want = sorted([(1, [3]), (1, [3]), (2, []), (3, []), (4, []), (5, [92]), (6, []), (None, [0, 7, 93])], key=str)
    for block in (dc.BLOCK_BYTES, 600):
        monkeypatch.setattr(dc, "BLOCK_BYTES", block)
        got = dc.matched(docs, bench, [F.col("doc_id")]).collect()
        assert sorted(((r.doc_id, sorted(m.item_id for m in r.matches)) for r in got), key=str) == want
    clean = dc.clean(docs, bench)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [2, 3, 4, 6]
    assert dc.clean(docs.limit(0), bench).count() == 0
    assert dc.clean(docs, bench.limit(0)).count() == len(rows)
