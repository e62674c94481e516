from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import cache
from itertools import product

import pytest
from pyspark.sql import functions as F

from batchlake.llm import conversations as cv
from batchlake.llm.catalog import QUERIES

SOLID = re.compile(r"[^\x20\x09-\x0D]")
SENTENCE = re.compile("(s?(ua)+)?")


def hurt(rows):
    """The damaged rows, in order."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        harm = zlib.crc32(key.encode()) % 20
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        role = "user" if harm == 4 else role
        out += [(conv, turn, role, text)] * (0 if harm == 0 else 2 if harm == 3 else 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        found = SOLID.findall(text)
        fault = cv.BLANK if not found else cv.DUPLICATE if (role, text) in seen else cv.CUT if found[-1] not in ".!?" else cv.NONE
        seen.add((role, text))
        out.append(fault)
    return out


def cheapest(initials, fault):
    """The least (cost, audit, roles) from left to right, state by state, without any chart."""

    @cache
    def rest(i, state, inserted):
        """From row i on; ``state`` is the output so far, cut to what matters."""
        options = []
        if i == len(initials) and state in ("", "a"):
            options.append((0, ""))
        after = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        if inserted < 3:
            for r in set(after) & set("ua"):
                cost, audit = rest(i, r, inserted + 1)
                options.append((cost + 5, "I" + audit))
        if i < len(initials):
            cost, audit = rest(i + 1, state, 0)
            options.append((cost + 2, "D" + audit))
            if fault[i] not in (cv.BLANK, cv.DUPLICATE):
                extra = 5 * (fault[i] == cv.CUT)
                if initials[i] and initials[i] in after:
                    cost, audit = rest(i + 1, initials[i], 0)
                    options.append((cost + extra, "K" + audit))
                for r in set(after) & set("ua"):
                    cost, audit = rest(i + 1, r, 0)
                    options.append((cost + 1 + extra, "R" + audit))
        return min(options, default=(10**9, ""))

    for i in range(len(initials), 0, -50):  # so that the recursion stays flat
        for state in ("", "s", "u", "a"):
            rest(i, state, 0)
    return rest(0, "", 0)


def plain(rows):
    """The report of one conversation."""
    mine = hurt(rows)
    fault = faults(mine)
    turns = [r[1] for r in mine if r[1] is not None]
    initials = [r[2][:1] for r in mine]
    cost, audit = cheapest(tuple(initials), tuple(fault))
    out, at = [], 0
    kept = len(audit) - audit.count("D")
    roles = iter("s" * (kept % 2) + "ua" * (kept // 2))
    for edit in audit:
        if edit == "I":
            out.append({"u": "user:", "a": "assistant:"}[next(roles)])
            continue
        _, _, role, text = mine[at]
        at += 1
        if edit != "D":
            want = next(roles)
            assert edit == "R" or want == role[:1]
            out.append((role if edit == "K" else {"u": "user", "a": "assistant"}[want]) + ":" + text)
    assert at == len(mine) and SENTENCE.fullmatch("".join(x[:1] for x in out))
    return (
        rows[0][0],
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(fault.count(f) for f in (cv.BLANK, cv.DUPLICATE, cv.CUT)),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost,
        audit,
        hashlib.sha256("\n".join(out).encode()).hexdigest(),
    )


def reports(rows):
    convs = {}
    for row in rows:
        convs.setdefault(row[0], []).append(row)
    return sorted(map(plain, convs.values()), key=str)


SCHEMA = "conv_id long, turn long, role string, text string"


def reported(spark, rows, schema=SCHEMA, parts=4):
    frame = spark.createDataFrame(rows, schema).repartition(parts)
    return sorted((tuple(r) for r in cv.report(cv.damaged(frame), frame, F.col("copies")).collect()), key=str)


def made(seed, convs, longest):
    rng = random.Random(seed)
    texts = ["Hi.", "Yes!", "No?", "cut", "cut ", "Two. ", "x.\n", "", " \t", None, "é.", "a.b"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "User", "", None]
    rows = []
    for conv in [None, *range(convs)]:
        for turn in range(rng.randrange(1, longest)):
            rows.append((conv, rng.choice([turn, turn, turn, turn // 2, None, turn * 3]), rng.choice(roles), rng.choice(texts)))
    return rows + rows[:5]


@pytest.mark.parametrize("n", range(6))
def test_chart_equals_plain_search(n):
    kinds = list(product(["u", "a", "s", "t", ""], [cv.NONE, cv.CUT, cv.BLANK]))
    rng = random.Random(n)
    rows = product(kinds, repeat=n) if n < 3 else ([rng.choice(kinds) for _ in range(rng.choice([n, 3 * n]))] for _ in range(400))
    for row in rows:
        chart = cv.Chart()
        for initial, fault in row:
            chart.add(cv.row_cell(initial, fault, 1))
        assert cv.best(chart.cell()) == cheapest(tuple(i for i, _ in row), tuple(f for _, f in row)), row


def test_any_split_gives_the_same_cell():
    rng = random.Random(3)
    for _ in range(50):
        cells = [cv.row_cell(rng.choice("uast"), rng.choice([0, 1, 2, 3]), rng.choice([1, 1, 2, 4])) for _ in range(9)]
        whole = cells[0]
        for cell in cells[1:]:
            whole = cv.combined(whole, cell)
        at = rng.randrange(1, 9)
        left, right = cv.Chart(), cv.Chart()
        for cell in cells[:at]:
            left.add(cell)
        for cell in cells[at:]:
            right.add(cell)
        assert cv.combined(left.cell(), right.cell()) == whole


def test_copies_equal_rows_of_their_own():
    for initial, fault, copies in product("uast", (cv.NONE, cv.CUT, cv.BLANK, cv.DUPLICATE), (2, 3)):
        chart = cv.Chart()
        chart.add(cv.row_cell(initial, fault, 1))
        for _ in range(copies - 1):
            chart.add(cv.row_cell(initial, cv.BLANK if fault == cv.BLANK else cv.DUPLICATE, 1))
        assert chart.cell() == cv.row_cell(initial, fault, copies)


@pytest.mark.parametrize("seed", [1, 2])
def test_report_equals_plain(spark, seed):
    rows = made(seed, 60, 14)
    assert reported(spark, rows) == reports(rows)


def test_one_long_conversation_over_many_tasks(spark):
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice(["A.", "B.", f"{t}.", "cut"])) for t in range(450)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert reported(spark, rows + [(2, 0, "user", "x.")]) == reports(rows + [(2, 0, "user", "x.")])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_query_equals_plain(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op13_conversation_repair"](spark, sf_dir)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == reports(rows)


def test_repaired_rows(spark):
    rows = [r for r in made(9, 20, 9)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = cv.repaired(frame).orderBy("conv_id", "position").collect()
    of = {}
    for r in got:
        assert r.position == len(of.setdefault(r.conv_id, []))
        of[r.conv_id].append(f"{r.role}:{r.text}")
    digests = {r.conv_id: r.repaired_sha256 for r in cv.report(frame, frame).collect()}
    for conv, digest in digests.items():
        assert hashlib.sha256("\n".join(of.get(conv, [])).encode()).hexdigest() == digest
        assert SENTENCE.fullmatch("".join(x[:1] for x in of.get(conv, [])))


def test_edges(spark):
    """An empty table; conversations that lose all rows; nulls only; columns with clashing names; long texts."""
    assert reported(spark, []) == []
    gone = [(c, t, "user", "x.") for c in range(60) for t in [0] if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert gone and [r[1:] for r in reported(spark, gone)] == [(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())] * len(gone)
    empty = [(None, None, None, None), (7, None, "user", "y" * 100_000 + "."), (7, None, "assistant", "  " * 50_000)]
    assert reported(spark, empty) == reports(empty)
    names = "conv_id long, turn long, role string, text string, copies string, digest int, harm int, counted int, fault int"
    rows = [(*r, "many", 1, 2, 3, 4) for r in made(4, 5, 6)]
    assert reported(spark, rows, names) == reports([r[:4] for r in rows])


def test_text_ids(spark):
    rows = [(f"c{c}", t, r, x) for c, t, r, x in made(8, 5, 6) if c is not None]
    assert reported(spark, rows, SCHEMA.replace("conv_id long", "conv_id string")) == reports(rows)
