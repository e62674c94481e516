"""Historian CSV drops of mixed encoding, separator and column order.

Files up to ``WHOLE_FILE_BYTES`` are read whole, one row per file, and decoded
exactly. Bigger files go through the line reader, which splits them over many
tasks; their header is looked up per file, with whether a line leaves a quote open or a
UTF-16 character is cut. Such files alone pay for joining lines again (``rejoin``). Which
files are big is known from the listing alone.

A file without a byte-order mark is UTF-16 if its zero bytes say so, else UTF-8. The
separator is the mark that cuts the first lines into equally many cells.

What cannot be read (a missing column, a quote that is never closed) raises, naming the file,
or with ``on_error="mark"`` gives one row for the file with the ``problem``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from batchlake.functions.cells import evaluate_once
from batchlake.functions.schema import BATCH, BOM_CHARS, REQUIRED_ROLES, ROLES, role_column
from batchlake.operators.clean import derive_batch_id
from batchlake.session import work_path
from batchlake.sources import rejoin
from batchlake.sources.rejoin import ends_open, fields_pattern, of_mark

#: A file read whole is held many times over (bytes, a copy of the text per step, lines being cut)
#: by each task of an executor.
WHOLE_FILE_BYTES = 4 * 1024 * 1024
BROADCAST_FILES = 50_000
#: More small files a task, on the average, are gathered in fewer tasks, of so many bytes at most.
FILES_A_TASK, TASK_BYTES = 16, 64 * 1024 * 1024

# Byte-order marks, as hex.
UTF16_LE_BOM = "FFFE"
UTF16_BE_BOM = "FEFF"
UTF8_BOM = "EFBBBF"
LINE_FEED = "\n"
#: A record without text, as hex: white space of one or two bytes behind a byte-order mark.
BLANK_RECORD = "^(FFFE|FEFF|EFBBBF)?(00|0D|20|09)*$"
SEPARATORS = ("\t", ";", "|", ",")
RETURN = "\r"
#: Lines that the separator is told from, bytes that the encoding is told from, and lines that a
#: quoted cell may span in a big file.
SAMPLE_LINES, SAMPLE_BYTES, MOST_LINES = 20, 4096, 10_000

_LISTING = {"recursiveFileLookup": "true", "pathGlobFilter": "*.[cC][sS][vV]"}


# -- names ---------------------------------------------------------------------


def plain_path(path: str) -> str:
    """Path without scheme, slashes collapsed: ``file:/d/x`` and ``/d/x`` agree."""
    bare = "/" + re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*|^/+", "", path)
    return bare.rstrip("/")


def relative_name(file_path: Column, root: str) -> Column:
    """Path below ``root`` of a file URI as Spark's file metadata reports it."""
    decoded = F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))
    bare = F.concat(F.lit("/"), F.regexp_replace(decoded, r"^[A-Za-z][A-Za-z0-9+.-]*:/*|^/+", ""))
    below = plain_path(root) + "/"
    inside = F.substr(bare, F.lit(len(below) + 1))
    return F.when(bare.startswith(below), inside).otherwise(F.substring_index(bare, "/", -1))


def is_blank(line: Column) -> Column:
    return F.trim(line).isin("", RETURN)


def without_return(line: Column) -> Column:
    return F.when(line.endswith(RETURN), F.left(line, F.length(line) - 1)).otherwise(line)


# -- fields --------------------------------------------------------------------


def separator_of(header: Column, sample: Column) -> Column:
    """The mark that cuts the header and the other first lines into equally many cells, and most.

    Without such a mark the one that cuts the header into most cells. Quotes are heeded; a line
    with an odd number of them, a part of a longer record, does not count.
    """
    whole = F.filter(sample, lambda x: (F.length(x) - F.length(F.replace(x, F.lit('"'), F.lit("")))) % 2 == 0)

    def cells(mark: str, lines: Column) -> Column:
        return F.transform(lines, lambda x: F.size(fields_of(x, F.lit(mark))))

    def first_of(scores: dict[str, Column], otherwise: Column) -> Column:
        most = F.greatest(*scores.values())
        choice = F.when(most <= 1, otherwise)
        for mark, score in scores.items():
            choice = choice.when(score == most, mark)
        return choice

    def even(counts: Column) -> Column:
        return F.when(F.array_min(counts) == F.array_max(counts), F.array_max(counts)).otherwise(1)

    by_header = first_of({m: F.size(fields_of(header, F.lit(m))) for m in SEPARATORS}, F.lit(","))
    return first_of({m: F.coalesce(even(cells(m, whole)), F.lit(1)) for m in SEPARATORS}, by_header)


def fields_of(line: Column, separator: Column) -> Column:
    """Cells of a line; quoted cells may hold separators and doubled quotes."""
    mark = F.when(separator == "|", "\\|").otherwise(separator)  # in a pattern
    quoted = F.regexp_extract_all(
        F.concat(separator, line),
        F.concat(mark, F.lit(' *("(?:[^"]++|"")*+"|[^'), separator, F.lit("]*+)")),
        F.lit(1),
    )
    unquoted = F.transform(
        quoted,
        lambda cell: F.when(
            cell.startswith('"') & cell.endswith('"') & (F.length(cell) > 1),
            F.replace(cell.substr(F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"')),
        ).otherwise(cell),
    )
    return F.when(line.contains('"'), unquoted).otherwise(F.split(line, mark))


def with_layout(files: DataFrame, header: Column, separator: Column) -> DataFrame:
    """Files with their ``layout``. Names and roles of the columns are asked for many times in it."""
    names = F.transform(
        fields_of(header, separator),
        lambda name: F.trim(F.regexp_replace(name, BOM_CHARS, "")),
    )
    named = evaluate_once(files.withColumn("_names", names), ["_names"])
    roles = F.transform("_names", lambda name: F.coalesce(role_column(name), F.lit("")))
    known = evaluate_once(named.withColumn("_roles", roles), ["_roles"])
    laid_out = known.withColumn("layout", layout_of(F.col("_names"), F.col("_roles"), separator, F.col("source_file")))
    return evaluate_once(laid_out, ["layout"]).drop("_names", "_roles")


def layout_of(names: Column, roles: Column, separator: Column, source: Column) -> Column:
    """Where each role sits in a file, as a struct; ``problem`` names the file and a missing role.

    ``extra_at``/``extra_names`` list the columns without a role of their own.
    """

    def at(role: str) -> Column:
        found = F.array_position(roles, role).cast("int")
        return F.when(found > 0, found)

    spare = F.filter(
        F.sequence(F.lit(1), F.size(names)),
        lambda i: (F.element_at(roles, i) == "")
        | (F.array_position(roles, F.element_at(roles, i)) != i),
    )
    spare_names = F.transform(
        spare,
        lambda i: F.when(
            F.array_position(names, F.element_at(names, i)) == i, F.element_at(names, i)
        ).otherwise(F.concat_ws(".", F.element_at(names, i), i.cast("string"))),
    )
    missing = [F.when(at(role).isNull(), F.concat(F.lit(f"no column for {role} in "), source)) for role in REQUIRED_ROLES]
    return F.struct(
        separator.alias("separator"),
        F.coalesce(*missing).alias("problem"),
        *[at(role).alias(role) for role in ROLES],
        spare.alias("extra_at"),
        spare_names.alias("extra_names"),
    )


def role_cells(lines: DataFrame) -> DataFrame:
    """Lines with their file's layout to one string column per role; a line without one has a problem."""
    split_up = lines.withColumn("_cells", F.when(F.col("problem").isNull(), fields_of(F.col("line"), F.col("layout.separator"))))

    def cell(at: Column) -> Column:
        return F.when(at.isNotNull(), F.get("_cells", at - 1))

    extra = F.when(
        F.size("layout.extra_at") > 0,
        F.map_from_arrays("layout.extra_names", F.transform("layout.extra_at", cell)),
    )
    return split_up.select(
        *[cell(F.col(f"layout.{role}")).alias(role) for role in ROLES],
        extra.alias("extra"),
        "block_start",
        "line_no",
        "source_file",
        "problem",
    )


# -- lines ---------------------------------------------------------------------


def encoding_of(start: Column) -> Column:
    """Name of a file's encoding from its first bytes: by its mark, else by where zero bytes stand.

    Text of Latin letters and digits has a zero in most UTF-16 units, in the second byte of
    little endian and the first of big endian; UTF-8 has none.
    """
    bom = F.hex(F.substring(start, 1, 2))
    units = F.regexp_extract_all(F.hex(F.substring(start, 1, SAMPLE_BYTES)), F.lit("...."), F.lit(0))
    low, high = (F.size(F.filter(units, test)) for test in (lambda u: u.endswith("00"), lambda u: u.startswith("00")))
    often = F.size(units) * 0.3
    return (
        F.when(bom == UTF16_LE_BOM, "UTF-16LE")
        .when(bom == UTF16_BE_BOM, "UTF-16BE")
        .when((low > often) & (low > 3 * high), "UTF-16LE")
        .when((high > often) & (high > 3 * low), "UTF-16BE")
        .otherwise("UTF-8")
    )


def _whole_files(files: DataFrame, root: str) -> DataFrame:
    """(source_file, block_start, line_no, line, layout, problem) of files read in one piece."""
    start = F.hex(F.substring("content", 1, 3))
    marked = F.when(start == UTF8_BOM, 4).when(start.startswith(UTF16_LE_BOM) | start.startswith(UTF16_BE_BOM), 3).otherwise(1)
    body = F.substring("content", marked, F.length("content"))
    encoding = encoding_of(F.col("content"))
    text = (
        F.when(encoding == "UTF-16LE", F.decode(body, "UTF-16LE"))
        .when(encoding == "UTF-16BE", F.decode(body, "UTF-16BE"))
        .otherwise(body.cast("string"))
    )
    named = files.select(
        relative_name(F.col("_metadata.file_path"), root).alias("source_file"), text.alias("text")
    )
    named = evaluate_once(named, ["source_file", "text"])
    # only the text goes from step to step: a step keeps a copy of its row, and cut into lines it takes several times its bytes
    lines = F.split("text", LINE_FEED)
    first = F.slice(F.filter(lines, lambda x: ~is_blank(x)), 1, SAMPLE_LINES)
    sampled = evaluate_once(named.withColumn("sample", F.transform(first, without_return)), ["sample"]).filter(F.size("sample") > 0)
    marked_up = sampled.withColumn("separator", separator_of(F.get("sample", F.lit(0)), F.col("sample")))
    marked_up = evaluate_once(marked_up, ["separator"])
    # no line that begins outside quotes leaves one open: lines are records
    plain = ~F.exists(lines, lambda x: ends_open(x, F.col("separator")))
    marked_up = evaluate_once(marked_up.withColumn("plain", plain), ["plain"])
    records = F.when(F.col("plain"), lines).otherwise(F.regexp_extract_all("text", of_mark(F.col("separator"), fields_pattern), F.lit(1)))

    def head_of(records: Column) -> Column:
        # the header is record 0 unless blank lines stand before it
        blanks_first = F.array_position(F.transform(records, lambda x: ~is_blank(x)), True) - 1
        at = F.when(~is_blank(F.get(records, F.lit(0))), 0).otherwise(blanks_first).cast("int")
        unclosed = F.when(F.col("plain"), False).otherwise(F.exists(records, lambda x: ends_open(x, F.col("separator"))))
        return F.struct(at.alias("at"), F.get(records, at).alias("record"), unclosed.alias("unclosed"))

    # the records have a name within this expression, and no column
    headed = evaluate_once(marked_up.withColumn("head", F.get(F.transform(F.array(records), head_of), F.lit(0))), ["head"])
    unclosed = F.when(F.col("head.unclosed"), F.concat(F.lit("a quote is never closed in "), F.col("source_file")))
    header = without_return(F.col("head.record"))
    laid_out = with_layout(headed, header, F.col("separator")).withColumn("problem", F.coalesce("layout.problem", unclosed))
    # a file with a problem is one row
    shown = F.when(F.col("problem").isNull(), records).otherwise(F.array("head.record"))
    exploded = evaluate_once(laid_out, ["problem"]).select(
        "source_file", "layout", F.col("head.at").alias("header_at"), "problem", F.posexplode(shown).alias("line_no", "line")
    )
    data = (F.col("line_no") > F.col("header_at")) & ~is_blank(F.col("line"))
    return exploded.filter(F.col("problem").isNotNull() | data).select(
        "source_file",
        F.lit(0).cast("bigint").alias("block_start"),
        F.col("line_no").cast("bigint").alias("line_no"),
        without_return(F.col("line")).alias("line"),
        "layout",
        "problem",
    )


def _record_text(encoding: Column, first: Column, source: Column, data: Column | None = None, strict: bool = True) -> Column:
    """Text of a record cut at the byte 0A, whatever the encoding.

    A UTF-16 line feed is two bytes, so its 00 stays on a neighbouring record:
    ahead of the next one (little endian) or behind this one (big endian, where
    only the last record of a file may lack it). It is taken off before
    decoding. Where the byte 0A belonged to another character, the rest of that
    character shows in the length or edge bytes of the next record; that raises
    instead of giving wrong text.
    """
    data = F.col("bytes") if data is None else data
    size = F.length(data)
    odd = size % 2 == 1
    marked = F.hex(F.substring(data, 1, 2)).isin(UTF16_LE_BOM, UTF16_BE_BOM)
    starts_00 = F.hex(F.substring(data, 1, 1)) == "00"
    ends_00 = F.hex(F.substring(data, size, F.lit(1))) == "00"
    cut_wrong = F.lit(None).cast("string")
    if strict:
        cut_wrong = F.raise_error(F.concat(F.lit("a UTF-16 character with the byte 0A needs a whole-file read of "), source)).cast("string")
    start = F.when(first & marked, 3).otherwise(1)

    def decoded(begin: Column, end: Column, charset: str) -> Column:
        return F.decode(F.substring(data, begin, end - begin + 1), charset)

    little = (
        F.when(first & ~odd, decoded(start, size, "UTF-16LE"))
        .when(~first & odd & starts_00, decoded(F.lit(2), size, "UTF-16LE"))
        .otherwise(cut_wrong)
    )
    big = (
        F.when(odd & ends_00, decoded(start, size - 1, "UTF-16BE"))
        .when(~odd & ~ends_00, decoded(start, size, "UTF-16BE"))
        .otherwise(cut_wrong)
    )
    utf8_bom = first & (F.hex(F.substring(data, 1, 3)) == UTF8_BOM)
    text = (
        F.when(encoding == "UTF-16LE", little)
        .when(encoding == "UTF-16BE", big)
        .otherwise(F.substring(data, F.when(utf8_bom, 4).otherwise(1), size).cast("string"))
    )
    return text


def _heads(records: DataFrame) -> DataFrame:
    """One row per file: encoding, header, separator, layout, and whether lines have to be joined again.

    The first lines of a file leave the map side, and counts of what is odd in any of its lines.
    """
    source, size = F.col("source_file"), F.length("bytes")
    first = records.filter("block_start = 0")
    sample = first.filter(~F.hex("bytes").rlike(BLANK_RECORD))
    order = Window.partitionBy("source_file").orderBy("line_no")
    sample = sample.withColumn("_nth", F.row_number().over(order)).filter(F.col("_nth") <= SAMPLE_LINES)
    sample = sample.groupBy("source_file").agg(F.array_sort(F.collect_list(F.struct("line_no", "bytes"))).alias("sample"))
    start = first.groupBy("source_file").agg(
        F.min_by(F.substring("bytes", 1, SAMPLE_BYTES), "line_no").alias("mark"), F.min("line_no").alias("first_at")
    )
    odd, quote = size % 2 == 1, F.lit('"')
    starts_00, ends_00 = F.hex(F.substring("bytes", 1, 1)) == "00", F.hex(F.expr("substring(bytes, length(bytes), 1)")) == "00"
    text = F.col("bytes").cast("string")
    flags = records.groupBy("source_file").agg(
        F.count_if(~(odd & starts_00)).alias("n_little"),
        F.count_if(~((odd & ends_00) | (~odd & ~ends_00))).alias("n_big"),
        F.bool_or(text.contains(quote)).alias("quotes"),
        *[F.bool_or(ends_open(without_return(text), F.lit(m))).alias(f"open_{i}") for i, m in enumerate(SEPARATORS)],
    )
    known = start.join(sample, "source_file").join(flags, "source_file").withColumn("encoding", encoding_of(F.col("mark")))
    lines = F.transform("sample", lambda r: _record_text(F.col("encoding"), r.line_no == F.col("first_at"), source, r.bytes, strict=False))
    lines = F.transform(F.filter(lines, lambda x: x.isNotNull()), without_return)
    known = evaluate_once(known.withColumn("lines", lines), ["lines"])
    header = F.get("lines", F.lit(0))
    known = evaluate_once(known.withColumn("separator", separator_of(header, F.col("lines"))), ["separator"])
    known = with_layout(known, header, F.col("separator"))
    little = F.col("encoding") == "UTF-16LE"
    wide = F.col("encoding") != "UTF-8"
    opened = F.when(F.col("separator") == SEPARATORS[0], F.col("open_0"))
    for i, mark in enumerate(SEPARATORS[1:], 1):
        opened = opened.when(F.col("separator") == mark, F.col(f"open_{i}"))
    return known.select(
        "source_file",
        "first_at",
        F.get("sample", F.lit(0)).line_no.alias("header_at"),
        "encoding",
        "layout",
        # the first record of a little-endian file has no zero of a line feed ahead
        (wide & F.when(little, F.col("n_little") > 1).otherwise(F.col("n_big") > 0)).alias("cut"),
        F.when(wide, F.col("quotes")).otherwise(opened).alias("open"),
    )


def _split_files(text: DataFrame, root: str, n_files: int) -> DataFrame:
    """The same columns for files read line by line, each file in many tasks.

    Lines are numbered per task and ordered within a file by (block_start,
    line_no). The files are scanned once for their heads, and once for their rows.
    """
    spark, meta = text.sparkSession, F.col("_metadata")
    records = text.select(
        relative_name(meta["file_path"], root).alias("source_file"),
        meta["file_block_start"].alias("block_start"),
        F.monotonically_increasing_id().alias("line_no"),
        F.col("value").cast("binary").alias("bytes"),
        meta["file_size"].alias("file_size"),
    )
    path, made = work_path(spark, "heads"), _heads(records)
    made.write.parquet(path)
    heads = spark.read.schema(made.schema).parquet(path)
    again = heads.agg(F.bool_or("cut").alias("cut"), F.bool_or("open").alias("open")).first()

    def headed(rows: DataFrame, heads: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(heads) if n_files <= BROADCAST_FILES else heads, "source_file")

    def lines_of(rows: DataFrame) -> DataFrame:
        """Lines of records, with their file's head."""
        line = _record_text(F.col("encoding"), (F.col("block_start") == 0) & (F.col("line_no") == F.col("first_at")), F.col("source_file"))
        not_data = (F.col("block_start") == 0) & (F.col("line_no") <= F.col("header_at"))
        kept = rows.filter(~not_data & F.col("layout.problem").isNull())
        return kept.select("source_file", "block_start", "line_no", line.alias("line"), "layout", "open")

    good = headed(records, heads.filter(~F.col("cut") & ~F.col("open")))
    rows = lines_of(good)
    if again["cut"] or again["open"]:
        odd = headed(records, heads.filter("cut or open")).select(*records.columns, "encoding", "cut", "open")
        parts = ["source_file", "block_start", "line_no", "bytes"]
        whole = odd.filter("not cut").select(*parts).unionByName(rejoin.characters(odd.filter("cut")).select(*parts))
        lines = lines_of(headed(whole, heads))
        joined = rejoin.quoted(lines.filter("open").withColumn("separator", F.col("layout.separator")).drop("layout", "open"), MOST_LINES)
        joined = headed(joined, heads.select("source_file", "layout", "open")).select(*lines.columns)
        rows = rows.unionByName(lines.filter("not open")).unionByName(joined)
    rows = rows.filter(~is_blank(F.col("line"))).select(
        "source_file", "block_start", "line_no", without_return(F.col("line")).alias("line"), "layout", F.lit(None).cast("string").alias("problem")
    )
    bad = heads.filter("layout.problem is not null").select(
        "source_file", F.lit(0).cast("bigint").alias("block_start"), F.col("header_at").alias("line_no"), F.lit("").alias("line"), "layout", "layout.problem"
    )
    return rows.unionByName(bad)


# -- reader --------------------------------------------------------------------


def read_raw_text(
    spark: SparkSession,
    path: str | list[str],
    root: str | None = None,
    batch_by: str = "folder",
    whole_file_bytes: int = WHOLE_FILE_BYTES,
    on_error: str = "raise",
) -> DataFrame:
    """All CSV rows below ``path`` as strings by role, with file and line.

    ``root`` is the drop folder that batch names are relative to (``path`` when
    it is one folder). With ``on_error="mark"`` a column ``problem`` is added; a file with a
    problem gives one row that holds nothing else.
    """
    paths = [path] if isinstance(path, str) else list(path)
    root = root or paths[0]
    files = spark.read.format("binaryFile").options(**_LISTING).load(paths)
    big = F.col("length") > whole_file_bytes
    n_big, n_small, small_bytes = files.select(big.alias("big"), "length").agg(
        F.count_if("big"), F.count_if(~F.col("big")), F.sum(F.when(~F.col("big"), F.col("length")))
    ).first()
    small = files.filter(~big)
    # Spark deals small files by 32 to a task, and each task takes the time to make its code
    tasks = max(4 * spark.sparkContext.defaultParallelism, -(-(small_bytes or 0) // TASK_BYTES))
    if n_small > FILES_A_TASK * tasks:
        small = small.coalesce(tasks)
    rows = role_cells(_whole_files(small, root))
    if n_big:
        text = (
            spark.read.options(lineSep=LINE_FEED, **_LISTING)
            .text(paths)
            .filter(F.col("_metadata.file_size") > whole_file_bytes)
        )
        rows = rows.union(role_cells(_split_files(text, root, n_big)))
    batch = derive_batch_id(F.col("source_file"), batch_by).alias(BATCH)
    columns = [*ROLES, "extra", "block_start", "line_no"]
    if on_error == "mark":
        return rows.select(*columns, batch, "source_file", "problem")
    raised = F.when(F.col("problem").isNotNull(), F.raise_error(F.col("problem")).cast("boolean")).otherwise(True)
    return rows.filter(raised).select(*columns, batch, "source_file")


def read_drop_folder(
    spark: SparkSession, folder: str, batch_by: str = "folder", **options
) -> DataFrame:
    """Every CSV below ``folder``, merged by role rather than by column position."""
    return read_raw_text(spark, folder, root=folder, batch_by=batch_by, **options)
