"""Records of files that were cut at the byte 0A, put together again.

Two things can cut a record: a line break inside a quoted cell, and a UTF-16 character one of
whose bytes is 0A. What a line means then depends on all lines before it, in other splits
of the file too. Each line is taken as a small function of the state at its start, each
split as the composition of its lines, and a prefix over the few splits of a file gives the
state at the start of each; so no file is read in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEPARATORS = ("\t", ";", "|", ",")
#: The inside of a quoted cell: anything but a single quote.
QUOTED = '(?:[^"]++|"")*+'
PLACE = ("block_start", "line_no")


def _cell(mark: str) -> str:
    """A cell: quoted as a whole, or not beginning with a quote."""
    return f'(?> *"{QUOTED}"[^{mark}\n]*+|(?! *")[^{mark}\n]*+)'


def fields_pattern(mark: str) -> str:
    """A record, line breaks in quoted cells included; a quote that is never closed is a character."""
    cell = f"(?>{_cell(mark)}|[^{mark}\n]*+)"
    mark = _escaped(mark)
    return f"({cell}(?:{mark}{cell})*+)(?:\n|\\z)"


def _open_pattern(mark: str) -> str:
    """A line that begins outside quotes and ends inside."""
    return f'^(?:{_cell(mark)}{_escaped(mark)})*+ *"{QUOTED}\\z'


def _still_open_pattern(mark: str) -> str:
    """A line that begins inside quotes, leaves them and ends inside other ones."""
    m = _escaped(mark)
    return f'^{QUOTED}"[^{mark}]*+(?:{m}{_cell(mark)})*+{m} *"{QUOTED}\\z'


def _escaped(mark: str) -> str:
    return "\\|" if mark == "|" else mark


def of_mark(separator: Column, pattern: Callable[[str], str]) -> Column:
    """The pattern of the separator."""
    choice = F.when(separator == SEPARATORS[0], pattern(SEPARATORS[0]))
    for mark in SEPARATORS[1:]:
        choice = choice.when(separator == mark, pattern(mark))
    return choice


def _matches(line: Column, separator: Column, pattern: Callable[[str], str]) -> Column:
    choice = F.when(~line.contains('"'), False)
    for mark in SEPARATORS:
        choice = choice.when(separator == mark, line.rlike(pattern(mark)))
    return F.coalesce(choice, F.lit(False))


def ends_open(line: Column, separator: Column) -> Column:
    """Whether a line that begins outside quotes leaves one open."""
    return _matches(line, separator, _open_pattern)


def _lines() -> tuple:
    order = Window.partitionBy("source_file", "block_start").orderBy("line_no")
    return order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1), order


def _blocks() -> tuple:
    order = Window.partitionBy("source_file").orderBy("block_start")
    return order.rowsBetween(Window.unboundedPreceding, -1), order


def _grouped(lines: DataFrame, starts: Column, value: str, joined: Callable[[Column], Column]) -> DataFrame:
    """Each line that starts a record with the lines behind it that do not, in other splits too."""
    until, _, _ = _lines()
    marked = lines.withColumn("_starts", starts)
    marked = marked.withColumn("_own", F.last(F.when(F.col("_starts"), F.col("line_no")), ignorenulls=True).over(until))
    before, _ = _blocks()
    last = marked.groupBy("source_file", "block_start").agg(F.max(F.when(F.col("_starts"), F.col("line_no"))).alias("_last"))
    carried = F.last(F.when(F.col("_last").isNotNull(), F.struct("block_start", F.col("_last").alias("line_no"))), ignorenulls=True).over(before)
    last = last.withColumn("_carried", carried).drop("_last")
    own = F.struct("block_start", F.col("_own").alias("line_no"))
    placed = marked.join(last, ["source_file", "block_start"]).withColumn("_at", F.when(F.col("_own").isNotNull(), own).otherwise(F.col("_carried")))
    # one record's lines, not a file's, come together here
    parts = F.array_sort(F.collect_list(F.struct(*PLACE, value)))
    others = [c for c in lines.columns if c not in ("source_file", *PLACE, value)]
    records = placed.groupBy("source_file", "_at").agg(parts.alias("_parts"), *[F.first(c).alias(c) for c in others])
    return records.select("source_file", "_at.block_start", "_at.line_no", *others, joined(F.col(f"_parts.{value}")).alias(value))


def quoted(lines: DataFrame, most_lines: int) -> DataFrame:
    """Lines (source_file, block_start, line_no, line, separator) joined where quotes hold a line break.

    A line maps "outside or inside quotes" at its start to the same at its end. It forgets the
    state, keeps it or turns it round; so the state is that behind the last line that
    forgets, turned round as often as lines since then say. A record of more than
    ``most_lines`` lines is a quote that is never closed, and raises.
    """
    until, before, _ = _lines()
    line, mark = F.col("line"), F.col("separator")
    from_outside = ends_open(line, mark)
    closes = line.rlike(f'^{QUOTED}"')
    from_inside = ~closes | _matches(line, mark, _still_open_pattern)
    known = lines.withColumns({"_out": from_outside, "_in": from_inside})
    known = known.withColumns({"_turns": (F.col("_out") & ~F.col("_in")).cast("int"), "_forgets": F.col("_out") == F.col("_in")})
    known = known.withColumn("_all", F.sum("_turns").over(until))
    known = known.withColumn("_point", F.when(F.col("_forgets"), F.struct(F.col("_out").cast("int").alias("state"), F.col("_all").alias("at"))))

    def effect(point: Column, turns: Column) -> Column:
        """(whether the state at the start matters not, the state for a start outside)."""
        turned = (turns - F.coalesce(point.at, F.lit(0)) + F.coalesce(point.state, F.lit(0))) % 2
        return F.struct(point.isNotNull().alias("fixed"), turned.alias("state"))

    known = known.withColumns(
        {
            "_before": effect(F.last("_point", ignorenulls=True).over(before), F.coalesce(F.sum("_turns").over(before), F.lit(0))),
            "_after": effect(F.last("_point", ignorenulls=True).over(until), F.col("_all")),
        }
    )
    earlier, _ = _blocks()
    blocks = known.groupBy("source_file", "block_start").agg(F.max_by("_after", "line_no").alias("_whole"))
    turns = F.when(~F.col("_whole.fixed"), F.col("_whole.state")).otherwise(0)
    blocks = blocks.withColumn("_sum", F.sum(turns).over(Window.partitionBy("source_file").orderBy("block_start")))
    point = F.when(F.col("_whole.fixed"), F.struct(F.col("_whole.state").alias("state"), F.col("_sum").alias("at")))
    blocks = blocks.withColumn("_point", point)
    begins = effect(F.last("_point", ignorenulls=True).over(earlier), F.coalesce(F.sum(turns).over(earlier), F.lit(0)))
    blocks = blocks.withColumn("_begin", begins.state).select("source_file", "block_start", "_begin")
    states = known.join(blocks, ["source_file", "block_start"])
    inside = F.when(F.col("_before.fixed"), F.col("_before.state")).otherwise((F.col("_before.state") + F.col("_begin")) % 2) == 1
    states = states.withColumn("_inside", inside)
    run = F.sum(F.col("_inside").cast("int")).over(_lines()[2].rowsBetween(-most_lines, 0))
    unclosed = F.raise_error(F.concat(F.lit("a quote is never closed in "), F.col("source_file"))).cast("string")
    states = states.withColumn("line", F.when(run > most_lines, unclosed).otherwise(line)).select(*lines.columns, "_inside")
    records = _grouped(states, ~F.col("_inside"), "line", lambda parts: F.array_join(parts, "\n"))
    return records.select(*lines.columns)


def characters(records: DataFrame) -> DataFrame:
    """Records (source_file, block_start, line_no, bytes, encoding, file_size) of UTF-16 files, cut
    at line feeds only.

    A byte 0A is a line feed if it is the right half of a unit whose other half is zero. The
    bytes ahead of it in the file, summed over the splits, say which half it is. One that ends
    the file is in no record, but in the file's size.
    """
    until, before, order = _lines()
    size = F.length("bytes") + 1
    edge = F.when(F.length("bytes") == 0, "0A").otherwise(F.hex(F.substring("bytes", 1, 1)))
    earlier, along = _blocks()
    blocks = records.groupBy("source_file", "block_start").agg(F.sum(size).alias("_size"), F.min_by(edge, "line_no").alias("_edge"))
    blocks = blocks.select(
        "source_file",
        "block_start",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"),
        F.lead("_edge").over(along).alias("_next_edge"),
        F.sum("_size").over(Window.partitionBy("source_file")).alias("_total"),
    )
    known = records.join(blocks, ["source_file", "block_start"])
    at = F.col("_offset") + F.sum(size).over(until) - 1  # where the byte 0A stands
    behind = F.coalesce(F.lead(edge).over(order), F.col("_next_edge"))
    ahead = F.hex(F.expr("substring(bytes, length(bytes), 1)"))
    little = (at % 2 == 0) & (behind == "00")
    feed = F.when(F.col("encoding") == "UTF-16LE", little).otherwise((at % 2 == 1) & (ahead == "00"))
    known = known.withColumn("_feed", F.coalesce(feed, F.lit(False)))
    lost = behind.isNull() & (F.col("_total") == F.col("file_size")) & ~F.col("_feed")
    known = known.withColumn("bytes", F.when(lost, F.concat("bytes", F.unhex(F.lit("0A")))).otherwise(F.col("bytes")))
    ends = known.groupBy("source_file", "block_start").agg(F.max_by("_feed", "line_no").alias("_feeds"))
    ends = ends.withColumn("_fed", F.coalesce(F.last("_feeds").over(earlier), F.lit(True))).drop("_feeds")
    known = known.join(ends, ["source_file", "block_start"])
    starts = F.coalesce(F.lag("_feed").over(order), F.col("_fed"))
    columns = ["source_file", *PLACE, "bytes"]
    known = known.withColumn("_begins", starts).select(*columns, "_begins")

    def joined(parts: Column) -> Column:
        return F.unhex(F.array_join(F.transform(parts, lambda x: F.hex(x)), "0A"))

    return _grouped(known, F.col("_begins"), "bytes", joined).select(*columns)
