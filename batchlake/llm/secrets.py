"""Secrets in texts: three exact patterns, and windows of high entropy in candidate strings.

Everything is built-in functions. A pattern's places come from splitting the text at its
matches: the lengths of pieces and matches add up to starts and ends in code points. The
entropy of a sliding window follows from counts that change by one character in and one
out for each step; sums are kept in whole millionths of a bit, so they never drift.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the contract: kinds in their order, patterns, least lengths.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 8
#: A run is taken from its first AKIA to its end or not at all, so the least length can be asked for at once.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"

# The sliding window: its width, candidate strings, and the entropy (bits for each character)
# that a window needs in strings of hex digits and in strings of the wider class.
WINDOW = 24
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{WINDOW},}}"
HEX_ONLY = r"^[0-9A-Fa-f]+$"
MIXED = r"^(?=.*[0-9])(?=.*[A-Za-z]).*$"
HEX_BITS, WIDE_BITS = 3.0, 4.0
#: Strings that look random and are not secrets: universal ids, examples, the alphabet in order.
ALLOWED = (
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
    r"|example|placeholder|abcdefghij|0123456789|x{6,}"
)

MILLION = 1_000_000
#: c log2 c in millionths, by c
TERMS = [round(c * math.log2(c) * MILLION) if c else 0 for c in range(WINDOW + 1)]
SPAN = "struct<start:int,rank:int,end:int>"


def term_limit(bits: float) -> int:
    """The largest sum of c log2 c in a window with at least so many bits for each character."""
    return math.floor(WINDOW * (math.log2(WINDOW) - bits) * MILLION)


def _places(text: Column, pattern: str, matches: Column, keep: Column, rank: int) -> Column:
    """Spans of the matches; ``keep`` has a boolean for each."""
    pieces = F.split(text, pattern, -1)

    def step(state: Column, i: Column) -> Column:
        start = state.at + F.length(F.get(state.pieces, i))
        end = start + F.length(F.get(matches, i))
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"))
        return F.struct(
            end.alias("at"),
            state.pieces.alias("pieces"),
            F.when(F.get(keep, i), F.concat(state.found, F.array(span))).otherwise(state.found).alias("found"),
        )

    none = F.array().cast(f"array<{SPAN}>")
    begin = F.struct(F.lit(0).alias("at"), pieces.alias("pieces"), none.alias("found"))
    walked = F.aggregate(F.sequence(F.lit(0), F.size(matches) - 1), begin, step, lambda s: s.found)
    return F.when(F.size(matches) > 0, walked).otherwise(none)


def _windows(candidate: Column, limit: Column) -> Column:
    """Places in a candidate covered by windows at or above the wanted entropy, joined where they touch."""
    terms = F.lit(TERMS)
    zero = F.lit(0)

    def step(state: Column, i: Column) -> Column:
        new = F.instr(F.lit(ALPHABET), F.substring(candidate, i + 1, 1)) - 1
        old = F.when(i >= WINDOW, F.instr(F.lit(ALPHABET), F.substring(candidate, i + 1 - WINDOW, 1)) - 1).otherwise(F.lit(-1))
        had_new, had_old = F.get(state.counts, new), F.get(state.counts, old)
        same = new == old
        change = F.when(same, zero).otherwise(
            F.get(terms, had_new + 1) - F.get(terms, had_new)
            + F.when(old >= 0, F.get(terms, had_old - 1) - F.get(terms, had_old)).otherwise(zero)
        )
        counts = F.when(same, state.counts).otherwise(
            F.transform(state.counts, lambda c, j: F.when(j == new, c + 1).when(j == old, c - 1).otherwise(c))
        )
        total = (state.total + change).cast("long")
        hot = (i >= WINDOW - 1) & (total <= limit)
        start = i - WINDOW + 1
        joins = hot & (state.open >= 0) & (start <= state.end)
        fresh = hot & ~joins
        closed = F.when(fresh & (state.open >= 0), F.concat(state.found, F.array(F.struct(state.open.alias("open"), state.end.alias("end")))))
        return F.struct(
            counts.alias("counts"),
            total.alias("total"),
            F.when(fresh, start).otherwise(state.open).alias("open"),
            F.when(hot, i + 1).otherwise(state.end).alias("end"),
            closed.otherwise(state.found).alias("found"),
        )

    begin = F.struct(
        F.array_repeat(zero, len(ALPHABET)).alias("counts"),
        zero.cast("long").alias("total"),
        F.lit(-1).alias("open"),
        zero.alias("end"),
        F.array().cast("array<struct<open:int,end:int>>").alias("found"),
    )
    return F.aggregate(
        F.sequence(zero, F.length(candidate) - 1),
        begin,
        step,
        lambda s: F.when(s.open >= 0, F.concat(s.found, F.array(F.struct(s.open.alias("open"), s.end.alias("end"))))).otherwise(s.found),
    )


def _entropy_spans(strings: Column, places: Column) -> Column:
    """Spans in the text of all hot places of all candidates that are not allowed."""

    def of(span: Column, i: Column) -> Column:
        candidate = F.get(strings, i)
        limit = F.when(candidate.rlike(HEX_ONLY), F.lit(term_limit(HEX_BITS))).otherwise(F.lit(term_limit(WIDE_BITS)))
        return F.transform(
            _windows(candidate, limit.cast("long")),
            lambda w: F.struct((span.start + w.open).alias("start"), span["rank"].alias("rank"), (span.start + w.end).alias("end")),
        )

    return F.flatten(F.transform(places, of))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s.start.cast("string"), s.end.cast("string"))), ",")


def with_secrets(docs: DataFrame, keep: list[Column]) -> DataFrame:
    """``keep`` columns, n_assign, n_access, n_hex, n_entropy, base_sha256, spans.

    Spans are kind:start:end in code points, end exclusive, by start and then kind. A null
    text is empty. Candidates need digits and letters or hex digits only; those on the
    allow-list add nothing, nor do places inside a span of the first three kinds, which
    always stay. A map without a shuffle.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    everything = lambda m: F.transform(m, lambda _: F.lit(True))
    found = docs.select(F.struct(*keep).alias("kept"), text.alias("text")).select(
        "kept",
        "text",
        F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(0)).alias("m_assign"),
        F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)).alias("m_access"),
        F.regexp_extract_all("text", F.lit(HEX), F.lit(0)).alias("m_hex"),
        F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("m_entropy"),
    )
    values = F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(1))
    long_enough = F.transform(values, lambda v: F.length(v) >= ASSIGN_LEAST)
    wanted = F.transform("m_entropy", lambda c: (c.rlike(HEX_ONLY) | c.rlike(MIXED)) & ~c.rlike(ALLOWED))
    placed = found.select(
        "kept",
        _places(F.col("text"), ASSIGN, F.col("m_assign"), F.when(F.size("m_assign") > 0, long_enough), 0).alias("assign"),
        _places(F.col("text"), ACCESS, F.col("m_access"), everything(F.col("m_access")), 1).alias("access"),
        _places(F.col("text"), HEX, F.col("m_hex"), everything(F.col("m_hex")), 2).alias("hex"),
        _places(F.col("text"), CANDIDATE, F.col("m_entropy"), wanted, 3).alias("candidates"),
        F.filter("m_entropy", lambda c: (c.rlike(HEX_ONLY) | c.rlike(MIXED)) & ~c.rlike(ALLOWED)).alias("strings"),
    )
    based = placed.select(
        "kept", "assign", "access", "hex", F.array_sort(F.concat("assign", "access", "hex")).alias("base"),
        F.when(F.size("strings") > 0, _entropy_spans(F.col("strings"), F.col("candidates"))).otherwise(F.array().cast(f"array<{SPAN}>")).alias("windows"),
    )
    added = F.filter("windows", lambda w: ~F.exists("base", lambda b: (b.start <= w.start) & (w.end <= b.end)))
    return based.select(
        "kept.*",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.size(added).cast("long").alias("n_entropy"),
        F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("base", added))).alias("spans"),
    )
