"""Cheapest repair of conversations, by weighted CYK parsing of intervals.

A repair edits rows (keep, rerole, delete, insert) until the initials of the roles are of the
language (s?(ua)+)?. The grammar in Chomsky normal form has a nonterminal [p,q] for each
two states of the language: the rows of a span, edited, lead from p to q. Its rules are
[p,q] -> [p,r] [r,q], and [p,q] -> a row with an edit, with any number of insertions around
it (the insertion closure). A cell of the chart holds for each nonterminal over a span the least
(cost, audit). Two different audits of a span at the same cost are never prefixes of each
other, so the least audit of a span is made of least audits of its parts.

The language is regular, so each split of a span gives the same cell. The chart holds only
the spans that halving makes, combined from short to long: rows of a task into spans, and
the spans of several tasks into the conversation. Rows are dealt out by range of
(conversation, turn), so a conversation with a third of all rows is parsed by many tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchlake.llm.base import landed, small_batches

#: Costs of the edits; a truncated row that stays costs TRUNCATED more.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# White space, ends of sentences, legal neighbours.
WHITE, ENDS, LEGAL = " \t\n\x0b\x0c\r", (".", "!", "?"), ("su", "ua", "au")

#: The states of the language by what they can read; the first and the last may end it.
STEPS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
START, ACCEPTING = 0, (0, 3)
FAULTS = ("none", "blank", "duplicate", "truncated")
NONE, BLANK, DUPLICATE, CUT = range(len(FAULTS))

Item = tuple[int, str]
Cell = tuple[Item | None, ...]


def _nonterminals() -> list[tuple[int, int]]:
    """Pairs of states of which the second can be reached from the first."""
    reached = {(p, p) for p in range(len(STEPS))}
    while more := {(p, r) for p, q in reached for r in STEPS[q].values()} - reached:
        reached |= more
    return sorted(reached)


PAIRS = _nonterminals()
PLACE = {pair: i for i, pair in enumerate(PAIRS)}
#: For each nonterminal [p,q] the places of [p,r] and [r,q] for all r.
RULES = [[(PLACE[p, r], PLACE[r, q]) for r in range(len(STEPS)) if (p, r) in PLACE and (r, q) in PLACE] for p, q in PAIRS]


def combined(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans."""
    out: list[Item | None] = []
    for rules in RULES:
        best, ways = None, []
        for i, j in rules:
            a, b = left[i], right[j]
            if a is not None and b is not None:
                cost = a[0] + b[0]
                if best is None or cost < best:
                    best, ways = cost, [(a, b)]
                elif cost == best:
                    ways.append((a, b))
        out.append(None if best is None else (best, min(a[1] + b[1] for a, b in ways)))
    return tuple(out)


def _cell(items: Iterable[tuple[tuple[int, int], Item]]) -> Cell:
    least: dict[tuple[int, int], Item] = {}
    for pair, item in items:
        least[pair] = min(least.get(pair, item), item)
    return tuple(least.get(pair) for pair in PAIRS)


def _closure() -> Cell:
    """Any number of insertions: longer ones are tried until nothing gets cheaper."""
    none = [((p, p), (0, "")) for p in range(len(STEPS))]
    one = [((p, q), (INSERT, "I")) for p, step in enumerate(STEPS) for r, q in step.items() if r in "ua"]
    cell = _cell(none + one)
    while (longer := combined(cell, cell)) != cell:
        cell = longer
    return cell


INSERTED = _closure()


@lru_cache(maxsize=4096)
def row_cell(initial: str, fault: int, copies: int) -> Cell:
    """The cell of a row and of its further copies, which are deleted, with insertions around them.

    ``fault`` is that of the first copy. Of audits with deletions in a row, those with the
    insertions behind them are least, so insertions between them are not needed.
    """
    gone = fault in (BLANK, DUPLICATE)
    if copies > 1 and not gone:
        return combined(row_cell(initial, fault, 1), row_cell(initial, DUPLICATE, copies - 1))
    items = [((p, p), (DELETE * copies, "D" * copies)) for p in range(len(STEPS))]
    extra = TRUNCATED if fault == CUT else 0
    for p, step in enumerate(() if gone else STEPS):
        if initial in step:
            items.append(((p, step[initial]), (extra, "K")))
        items += [((p, q), (REROLE + extra, "R")) for r, q in step.items() if r in "ua"]
    return combined(combined(INSERTED, _cell(items)), INSERTED)


class Chart:
    """Spans that are taken in from left to right; equal lengths are combined."""

    def __init__(self) -> None:
        self.spans: list[tuple[int, Cell]] = []

    def add(self, cell: Cell, length: int = 1) -> None:
        self.spans.append((length, cell))
        while len(self.spans) > 1 and self.spans[-2][0] <= self.spans[-1][0]:
            (n, right), (m, left) = self.spans.pop(), self.spans.pop()
            self.spans.append((m + n, combined(left, right)))

    def cell(self) -> Cell:
        """The whole span; no span at all is the closure of insertions."""
        whole = None
        for _, cell in reversed(self.spans):
            whole = cell if whole is None else combined(cell, whole)
        return INSERTED if whole is None else whole


def best(cell: Cell) -> Item:
    """The least (cost, audit) that makes the span a sentence."""
    return min(item for q in ACCEPTING if (item := cell[PLACE[START, q]]) is not None)


def wanted_roles(audit: str) -> Iterator[str]:
    """Initials of the rows of a repaired conversation: an audit leaves only one possible."""
    n = len(audit) - audit.count("D")
    if n % 2:
        yield "s"
    yield from "ua" * (n // 2)


class Counts:
    """What is counted along a span of rows in order, and can be added to the span behind it."""

    FIELDS = "rows long, blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, first string, last string"

    def __init__(self, values: Iterable = (0, 0, 0, 0, 0, 0, None, None, None, None)):
        self.rows, self.blank, self.duplicate, self.truncated, self.illegal, self.turns, self.low, self.high, self.first, self.last = values

    def values(self) -> tuple:
        return self.rows, self.blank, self.duplicate, self.truncated, self.illegal, self.turns, self.low, self.high, self.first, self.last

    @classmethod
    def of(cls, turn: int | None, initial: str, fault: int, copies: int) -> Counts:
        repeated = BLANK if fault == BLANK else DUPLICATE
        n = [(copies - 1) * (repeated == f) + (fault == f) for f in (BLANK, DUPLICATE, CUT)]
        among = (copies - 1) * (initial * 2 not in LEGAL)
        return cls((copies, *n, among, int(turn is not None), turn, turn, initial, initial))

    def add(self, right: Counts) -> None:
        if not right.rows:
            return
        if self.rows:
            self.illegal += self.last + right.first not in LEGAL
            self.turns -= self.high is not None and self.high == right.low
        else:
            self.first = right.first
        for name in ("rows", "blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(self, name, getattr(self, name) + getattr(right, name))
        self.low = right.low if self.low is None else self.low
        self.high = self.high if right.high is None else right.high
        self.last = right.last

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies of conversations after damage by crc32(conv_id:turn) % 20.

    0 drops a row, 1 empties its text, 2 removes ``.!?``, 3 makes a second copy, 4 sets the role
    to user. A null is one space in the hash, as a role and as a text.
    """
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    taken = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("harm"))
    return taken.filter("harm <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("harm") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _digested(rows: DataFrame) -> DataFrame:
    return rows.select("conv_id", "turn", "role", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), "text", "copies")


def _narrow(rows: DataFrame) -> DataFrame:
    """One row per (conversation, turn, role, text), without the text: its copies and the first one's fault.

    A role and text are seen earlier where an earlier turn of the conversation has them. Joined by
    the whole key, so that a text repeated many times meets in no one task.
    """
    tail = F.rtrim("text", F.lit(WHITE))
    facts = F.when(tail == "", BLANK).when(~F.substring(tail, -1, 1).isin(*ENDS), CUT).otherwise(NONE)
    each = _digested(rows).withColumn("fault", facts)
    each = each.groupBy("conv_id", "turn", "role", "digest").agg(F.sum("copies").alias("copies"), F.first("fault").alias("fault"))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = each.groupBy("conv_id", "role", "digest").agg(F.min(turn).alias("first"))
    first = first.select(*[F.col(c).alias(f"{c}_") for c in ("conv_id", "role", "digest")], F.col("first.turn").alias("turn_"), F.lit(True).alias("seen"))
    same = (
        F.col("conv_id").eqNullSafe(F.col("conv_id_"))
        & (F.col("role") == F.col("role_"))
        & (F.col("digest") == F.col("digest_"))
        & F.col("turn").eqNullSafe(F.col("turn_"))
    )
    later = F.col("seen").isNull() & (F.col("fault") != BLANK)
    return each.join(first, same, "left").select(
        "conv_id",
        "turn",
        "role",
        "digest",
        F.substring("role", 1, 1).alias("initial"),
        F.when(later, DUPLICATE).otherwise(F.col("fault")).alias("fault"),
        "copies",
    )


def _tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 512) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*held), schema)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield out()
            held = []
    if held:
        yield out()


def _mapped(df: DataFrame, work: Callable[[Iterator[tuple]], Iterator[tuple]], fields: str, kind: T.DataType) -> DataFrame:
    """``work`` over the rows of each partition in order; what it gives starts with conv_id."""
    schema = T.StructType([T.StructField("conv_id", kind), *T._parse_datatype_string(fields).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        yield from _batched(work(_tuples(batches)), to_arrow_schema(schema))

    return df.mapInArrow(run, schema)


CELL = "cell array<struct<cost:long,audit:string>>"


def _spans(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Counts and cell of each conversation's rows in this task."""
    task = TaskContext.get().partitionId()
    conv, chart, counts = None, None, None
    for own, turn, _, _, initial, fault, copies in rows:
        if chart is None or own != conv:
            if chart is not None:
                yield conv, task, *counts.values(), _as_dicts(chart.cell())
            conv, chart, counts = own, Chart(), Counts()
        chart.add(row_cell(initial, fault, copies), copies)
        counts.add(Counts.of(turn, initial, fault, copies))
    if chart is not None:
        yield conv, task, *counts.values(), _as_dicts(chart.cell())


def _as_dicts(cell: Cell) -> list[dict | None]:
    return [None if item is None else {"cost": item[0], "audit": item[1]} for item in cell]


def _parsed(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Counts, cost and audit of each conversation, whose spans come in order."""
    started, conv, chart, counts = False, None, Chart(), Counts()

    def out() -> tuple:
        cost, audit = best(chart.cell()) if counts.rows else (0, "")
        return conv, counts.gaps(), counts.blank, counts.duplicate, counts.truncated, counts.illegal, cost, audit

    for own, _, *values, cell in rows:
        if started and own != conv:
            yield out()
            chart, counts = Chart(), Counts()
        started, conv = True, own
        if cell is not None:
            right = Counts(values)
            chart.add(tuple(None if item is None else (item["cost"], item["audit"]) for item in cell), right.rows)
            counts.add(right)
    if started:
        yield out()


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def parsed(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """Counts, cost and audit of each conversation in ``convs`` (conv_id), those without rows too."""
    kind = rows.schema["conv_id"].dataType
    order = ["conv_id", "turn", "role", "digest"]
    narrow = landed(_narrow(rows), "conversation-rows")
    dealt = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    spans = _mapped(dealt, _spans, f"task int, {Counts.FIELDS}, {CELL}", kind)
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in spans.schema.fields[1:]]
    spans = spans.unionByName(convs.select("conv_id").distinct().select("conv_id", *none))
    return _mapped(spans.repartition("conv_id").sortWithinPartitions("conv_id", "task"), _parsed, RESULT, kind)


def _replayed(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(what was counted or None, position, edit, role, text): a conversation's head, then its rows in order.

    The first row of a conversation has its audit, its other rows follow in order; no more than
    one row and the audit are held.
    """
    head, letters, at, wanted, place = None, "", 0, iter(()), 0

    def inserted(end: bool) -> Iterator[tuple]:
        nonlocal at, place
        while at < len(letters) and letters[at] == "I":
            role = next(wanted)
            yield head[0], place, "I", "user" if role == "u" else "assistant", ""
            at, place = at + 1, place + 1
        assert not end or at == len(letters)

    for conv, counted, _, role, _, text, copies in rows:
        if counted is not None:
            if head:
                yield from inserted(True)
            head, letters, at, place = (conv, counted), counted["audit"], 0, 0
            wanted = wanted_roles(letters)
            yield conv, None, None, None, counted
            continue
        for _ in range(copies):
            yield from inserted(False)
            edit = letters[at]
            at += 1
            if edit != "D":
                new = next(wanted)
                yield conv, place, edit, role if edit == "K" else "user" if new == "u" else "assistant", text
                place += 1
    if head:
        yield from inserted(True)


def _rows_only(rows: Iterator[tuple]) -> Iterator[tuple]:
    return (row for row in _replayed(rows) if row[1] is not None)


def _digests(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Counts of each conversation and the digest of its repaired rows."""
    conv, counted, digest = None, None, hashlib.sha256()
    for own, place, _, role, text in _replayed(rows):
        if place is None:
            if counted is not None:
                yield conv, *counted.values(), digest.hexdigest()
            conv, counted, digest = own, text, hashlib.sha256()
        else:
            digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
    if counted is not None:
        yield conv, *counted.values(), digest.hexdigest()


def _in_order(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows in order, in one partition.

    The rows of one conversation go through one task, one after another: its digest has to
    be computed in order.
    """
    small_batches(rows.sparkSession)
    heads = landed(parsed(rows, convs), "conversation-audits")
    counted = F.struct(*heads.columns[1:])
    none = {c: F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("turn", "role", "text", "copies")}
    digest = F.lit(None).cast("binary").alias("digest")
    heads = heads.select("conv_id", counted.alias("counted"), none["turn"], none["role"], digest, none["text"], none["copies"])
    texts = _digested(rows).select("conv_id", F.lit(None).cast(heads.schema["counted"].dataType).alias("counted"), "turn", "role", "digest", "text", "copies")
    both = heads.unionByName(texts).repartition("conv_id")
    return both.sortWithinPartitions(F.col("conv_id"), F.col("counted").isNull(), "turn", "role", "digest")


def _taken(rows: DataFrame, copies: Column | None) -> DataFrame:
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    copies = F.lit(1) if copies is None else copies
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.cast("long").alias("copies"))


def report(rows: DataFrame, convs: DataFrame, copies: Column | None = None) -> DataFrame:
    """One row per conversation of ``convs``: counts, cost, audit and the digest of its repaired rows.

    ``rows`` has conv_id, turn (a whole number), role and text, each row as often as ``copies``
    says; other columns are ignored. Rows go by turn, nulls first, those of the same turn by
    role and by the digest of their text. A null role or text is one space, a null conv_id is
    a conversation of its own. Without rows all counts are 0 and the audit is empty; an
    empty table of conversations gives no rows.
    """
    taken = _taken(rows, copies)
    return _mapped(_in_order(taken, convs), _digests, f"{RESULT}, repaired_sha256 string", taken.schema["conv_id"].dataType)


def repaired(rows: DataFrame, copies: Column | None = None) -> DataFrame:
    """The rows of the repaired conversations: conv_id, position (from 0), edit, role, text."""
    taken = _taken(rows, copies)
    fields = "position long, edit string, role string, text string"
    return _mapped(_in_order(taken, taken), _rows_only, fields, taken.schema["conv_id"].dataType)
