"""Cell-level expressions: text clean-up, timestamp parsing, keyed hashing."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchlake.functions.schema import NULL_TOKENS, TIME_FORMATS

# Text a format letter run may stand for. Each one accepts at least
# what the formatter accepts, so the guard below never rejects a parseable text.
_LETTER_SHAPES = {
    "M": r"\d+",
    "d": r"\d+",
    "h": r"\d+",
    "H": r"\d+",
    "yyyy": r"[+-]?\d{4,}",
    "MM": r"\d\d",
    "dd": r"\d\d",
    "hh": r"\d\d",
    "HH": r"\d\d",
    "mm": r"\d\d",
    "ss": r"\d\d",
    "SSS": r"\d{3}",
    "a": r"\S+",
}


def without_thousands(cell: Column) -> Column:
    return F.replace(cell, F.lit(","), F.lit(""))


def without_null_tokens(cell: Column, tokens=NULL_TOKENS) -> Column:
    return F.when(~cell.isin(list(tokens)), cell)


def to_number(cell: Column) -> Column:
    return cell.try_cast("double")


def is_positive(value: Column) -> Column:
    """Greater than zero and not NaN (Spark orders NaN above every number)."""
    return (value > 0) & ~F.isnan(value)


def shape_of(fmt: str) -> str | None:
    """Regular expression of the texts a datetime pattern can match.

    None for a pattern with letters outside the table: such a format is tried
    on every row.
    """
    out = []
    for run in re.finditer(r"([A-Za-z])\1*|[^A-Za-z]", fmt):
        token = run.group(0)
        if token[0].isalpha():
            if token not in _LETTER_SHAPES:
                return None
            out.append(_LETTER_SHAPES[token])
        else:
            out.append(re.escape(token))
    return "^" + "".join(out) + "$"


def parse_time(cell: Column, formats=TIME_FORMATS) -> Column:
    """First format that parses wins; text that fits none becomes NULL.

    A regular expression stands before each parse attempt, because a failed
    attempt costs an exception per row and format.
    """
    attempts = []
    for fmt in formats:
        attempt = F.try_to_timestamp(cell, F.lit(fmt))
        shape = shape_of(fmt)
        attempts.append(attempt if shape is None else F.when(cell.rlike(shape), attempt))
    return F.coalesce(*attempts).cast("timestamp_ntz")


def time_text(value: Column) -> Column:
    """Fixed-width text of a timestamp, for hashing."""
    return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")


HASH_RANGE = 1 << 32


def hash_number(seed: int, *parts: Column) -> Column:
    """0 to HASH_RANGE - 1 from the md5 of seed and key parts; the same on every engine and run."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def evaluate_once(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep filters on costly columns above the place where they are computed.

    Spark moves a filter below a projection by repeating the projection's
    expressions in it, so a parsed column would be parsed once to filter and
    once to keep. Filters do not move below a generator that makes the column.
    """
    others = [c for c in df.columns if c not in cols]
    made = df.select(*others, F.inline(F.array(F.struct(*cols))))
    return made.select(*df.columns)
