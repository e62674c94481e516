from __future__ import annotations

import random
import re
from itertools import permutations

import pytest

from batchlake.llm import filter_audit as fa

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(docs, labels):
    """Each row through each order, one at a time."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = {}
    failed = []
    for i, text, _ in docs:
        t = text or ""
        words = WORD.findall(t)
        fails = set()
        if len(words) < 100:
            fails.add("A")
        if 100 * len(set(words)) < 80 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 10 * len(t):
            fails.add("C")
        if re.search("[#$%&*|]", t):
            fails.add("D")
        if i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs):
            fails.add("E")
        failed.append(fails)
    for part in {p or "" for _, _, p in docs}:
        mine = [(d, f) for d, f in zip(docs, failed) if (d[2] or "") == part]
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                removed = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                all_failing = [x for x in mine if f in x[1]]
                rows[part, order, step] = [
                    len(left), len(removed), len(all_failing) - len(removed), sum(x[1] == {f} for x in mine),
                    sum(x[0][0] in good for x in removed), sum(x[0][0] in toxic for x in removed),
                ]
    out = []
    for (part, order, step), counts in rows.items():
        f = order[step - 1]
        shapley = sum(rows[p, o, s][1] for p, o, s in rows if p == part and o[s - 1] == f)
        out.append((part, order, step, *counts, shapley))
    return sorted(out)


def audited(spark, docs, labels, extra=False):
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    if extra:
        frame = frame.selectExpr("*", "1 AS part", "2 AS mask", "'x' AS digest", "3 AS failed", "4 AS first")
    return sorted(tuple(r) for r in fa.audit(frame.repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect())


def made(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(200)] + ["LOUD"] * 40 + ["a#b"] * 2
    texts = [" ".join(rng.choices(words, k=rng.choice([0, 3, 99, 100, 150]))) for _ in range(n // 2)] + [None, "", "x\x0by z"]
    texts += [" ".join(f"v{rng.randrange(9999)}" for _ in range(120)) for _ in range(n // 4)]
    return [(rng.choice([None, *range(n)]), rng.choice(texts), rng.choice(["en", "de", None, ""])) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_orders(spark, seed):
    docs = made(seed, 60)
    docs += docs[:7]
    labels = [(i, i % 3 % 2, i % 2) for i in range(40)] + [(3, None, None), (None, 1, 1), (4, 1, 1), (4, 0, 0)]
    assert audited(spark, docs, labels, extra=True) == plain(docs, labels)


def test_a_step_count_per_part_even_where_nothing_fails(spark):
    rows = audited(spark, [(1, " ".join(map(str, range(120))), "en")], [])
    assert len(rows) == 600 and all(r[3:] == (1, 0, 0, 0, 0, 0, 0) for r in rows)


def test_empty_table(spark):
    assert audited(spark, [], []) == []


def test_null_and_repeated_rows(spark):
    docs = [(1, None, "en"), (1, None, "en"), (2, "", "en"), (None, "", "en")]
    rows = {(r[1], r[2]): r[3:] for r in audited(spark, docs, [(2, 1, 0)])}
    # every text is short; one copy has a larger id than another and fails E as well
    assert rows["EABCD", 1] == (3, 1, 0, 0, 1, 0, 60)
    assert rows["ABCDE", 5][:4] == (0, 0, 1, 0)


def test_fields_do_not_run_over():
    many = (1 << 63) - 1
    masks = range(fa.TOXIC << 1)
    total = sum(fa.packed(m) for m in masks) + many * fa.packed(3)
    want = sum(fa.outcomes(m).astype(object) for m in masks) + many * fa.outcomes(3).astype(object)
    assert (fa.unpacked(total).astype(object) == want).all()


def test_long_and_repeated_text(spark):
    text = "word " * 200_000
    rows = {(r[1], r[2]): r for r in audited(spark, [(i, text, "en") for i in range(20)], [])}
    assert rows["BACDE", 1][4] == 20 and rows["EABCD", 1][4] == 19


def test_many_parts_flush_their_sums(spark):
    docs = [(i, f"t{i}", f"lang{i % 150}") for i in range(300)]
    rows = audited(spark, docs, [])
    assert len(rows) == 150 * 600 and all(r[4] == 2 for r in rows if r[1] == "ABCDE" and r[2] == 1)
