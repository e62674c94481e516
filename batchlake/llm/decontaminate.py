"""Benchmark passages in documents, edits allowed: q-gram lemma filter, banded alignment.

A passage of m bytes that occurs with at most k edits shares at least m - q + 1 - k q of its
q-grams with the place where it occurs, and their diagonals (place in the text less
place in the passage) lie within k of each other. So q-grams of the passage are
counted in bands of diagonals that overlap by half, bands below the bound are
dropped, and what is left is aligned inside its band.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchlake.llm.base import small_batches

Q = 10
#: Edits allowed for each byte of a passage.
EDIT_RATE = 0.06
#: Passages that are indexed and broadcast at once; a larger benchmark takes more passes.
BLOCK_BYTES = 8 << 20
#: Text looked at together; longer texts are cut into parts that overlap by a whole passage.
PART_BYTES = 1 << 20
_TABLE_BITS = 22
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
MATCHES = "array<struct<item_id:bigint,start:bigint,end:bigint,edits:int>>"


def normal(text: str | None) -> bytes:
    """Lower case, runs of white space as one blank; places are bytes of this form."""
    return " ".join((text or "").lower().split()).encode("utf-8", "replace")


def gram_keys(data: bytes) -> np.ndarray:
    """A 64-bit key of the q bytes from each place on; equal q-grams have equal keys."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    left = np.ndarray((n,), "<u8", data, 0, (1,))
    right = np.ndarray((n,), "<u8", data, Q - 8, (1,))
    return left * _K1 + right * _K2


def edits_within(passage: bytes, text: bytes, low: int, high: int, most: int) -> tuple[int, int] | None:
    """(edits, end in the text) of the best place of ``passage`` on diagonals low to high.

    Row i has a cell for each diagonal: the fewest edits that turn the first i bytes into
    text ending there. None if more than ``most`` are needed.
    """
    width = high - low + 1
    padded = np.full(len(text) + 2 * (width + len(passage)), 256, np.int16)
    base = width + len(passage)
    padded[base : base + len(text)] = np.frombuffer(text, np.uint8)
    steps = np.arange(width, dtype=np.int32)
    ends = low + steps
    far = np.int32(len(passage) + len(text) + 1)
    row = np.where((ends >= 0) & (ends <= len(text)), 0, far).astype(np.int32)
    for i, byte in enumerate(passage):
        at = base + low + i
        new = row + (padded[at : at + width] != byte)
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        row = np.minimum.accumulate(new - steps) + steps
    ends = ends + len(passage)
    row = np.where((ends >= 0) & (ends <= len(text)), row, far)
    best = int(np.argmin(row))
    return (int(row[best]), int(ends[best])) if row[best] <= most else None


@dataclass
class Passage:
    item_id: int
    data: bytes
    edits: int
    least: int  # q-grams that a place within the edits must share


class PassageIndex:
    """q-grams of a block of passages with the places where each occurs."""

    def __init__(self, items: list[tuple[int, str | None]]):
        self.passages, self.whole = [], {}
        for item_id, text in items:
            data = normal(text)
            if 0 < len(data) < Q:
                self.whole.setdefault(data, []).append(item_id)
            elif data:
                edits = min(int(EDIT_RATE * len(data)), (len(data) - Q) // Q)
                self.passages.append(Passage(item_id, data, edits, len(data) - Q + 1 - edits * Q))
        keys = [gram_keys(p.data) for p in self.passages]
        owner = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        place = np.concatenate([np.arange(len(k)) for k in keys]) if keys else np.empty(0, np.int64)
        flat = np.concatenate(keys) if keys else np.empty(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.grams, self.begin = np.unique(flat[order], return_index=True)
        self.begin = np.append(self.begin, len(flat))
        self.owner, self.place = owner[order], place[order]
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[self.grams >> np.uint64(64 - _TABLE_BITS)] = True
        self.least = np.array([p.least for p in self.passages], np.int64)
        self.longest = max([len(p.data) + 4 * p.edits + Q for p in self.passages], default=0)

    def _hits(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Places in the text that hold a known q-gram, and which."""
        if not len(self.grams):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        keys = gram_keys(data)
        at = np.flatnonzero(self.table[keys >> np.uint64(64 - _TABLE_BITS)])
        gram = np.minimum(np.searchsorted(self.grams, keys[at]), len(self.grams) - 1)
        known = self.grams[gram] == keys[at]
        return at[known], gram[known]

    def search(self, texts: list[bytes]) -> list[list[tuple[int, int, int, int]]]:
        """(item_id, start, end, edits) of the passages found in each text."""
        found: list[dict] = [{} for _ in texts]
        for i, text in enumerate(texts):
            for item_id in self.whole.get(text, ()):
                found[i][item_id] = (0, len(text), 0)
        group, size = [], 0
        for i, text in enumerate(texts):
            for start in range(0, max(len(text) - self.longest, 1), PART_BYTES):
                part = text[start : start + PART_BYTES + self.longest]
                if size + len(part) > PART_BYTES and group:
                    self._search_group(group, found)
                    group, size = [], 0
                group.append((i, start, part))
                size += len(part)
        if group:
            self._search_group(group, found)
        return [sorted((k, *v) for k, v in x.items()) for x in found]

    def _search_group(self, group: list[tuple[int, int, bytes]], found: list[dict]) -> None:
        parts = [part for _, _, part in group]
        at, gram = self._hits(b"\n".join(parts))  # no passage holds a line feed
        if not len(at):
            return
        begins = np.cumsum([0, *(len(p) + 1 for p in parts)])
        part = np.searchsorted(begins, at, "right") - 1
        # all hits of a passage in a part bound those of any band in it
        counts = self.begin[gram + 1] - self.begin[gram]
        where = np.repeat(np.arange(len(at)), counts)
        entry = np.arange(len(where)) - np.repeat(np.cumsum(counts) - counts, counts) + self.begin[gram[where]]
        owner = self.owner[entry]
        pair = part[where] * len(self.passages) + owner
        pairs, back, total = np.unique(pair, return_inverse=True, return_counts=True)
        enough = (total >= self.least[pairs % len(self.passages)])[back]
        where, entry, pair = where[enough], entry[enough], pair[enough]
        diagonal = at[where] - begins[part[where]] - self.place[entry]
        order = np.argsort(pair, kind="stable")
        cuts = np.flatnonzero(np.diff(pair[order], prepend=-1))
        for rows in np.split(order, cuts[1:]) if len(order) else []:
            i, start, text = group[pair[rows[0]] // len(self.passages)]
            passage = self.passages[pair[rows[0]] % len(self.passages)]
            if (best := self._verified(passage, text, diagonal[rows], self.place[entry[rows]])) is not None:
                edits, begin, end = best
                old = found[i].get(passage.item_id)
                if old is None or edits < old[2]:
                    found[i][passage.item_id] = (start + begin, start + end, edits)

    def _verified(self, passage: Passage, text: bytes, diagonals: np.ndarray, places: np.ndarray):
        step = max(passage.edits, 1)
        first = diagonals // step
        band = np.concatenate((first, first - 1))
        seen = np.unique(np.stack((band, np.concatenate((places, places)))), axis=1)
        bands, shared = np.unique(seen[0], return_counts=True)
        best = None
        for b in bands[shared >= passage.least]:
            low = int(b) * step - passage.edits
            high = (int(b) + 2) * step + passage.edits
            exact = text.find(passage.data, max(low, 0), max(high, 0) + len(passage.data))
            if exact >= 0:
                return 0, exact, exact + len(passage.data)
            done = edits_within(passage.data, text, low, high, passage.edits)
            if done and (best is None or done[0] < best[0]):
                best = done[0], max(done[1] - len(passage.data), 0), done[1]
        return best


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str | None]]]:
    """The items in groups of about BLOCK_BYTES, so that what is held at once is bounded."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = total // BLOCK_BYTES + 1
    for block in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block) if n > 1 else items
        yield [(r.item_id, r.text) for r in rows.collect()]


def matched(docs: DataFrame, benchmark: DataFrame, keep: list[Column]) -> DataFrame:
    """``keep`` columns and ``matches``: the items found in each row's whole text.

    A map without a shuffle, once for each block of the benchmark (one block up to 8 MB).
    Null and empty texts and items match nothing; an item shorter than a q-gram matches
    only a text that equals it; equal items with different ids are all reported.
    """
    spark = docs.sparkSession
    small_batches(spark)
    out = docs.select(*keep, F.col("text").alias("__text"), F.expr(f"cast(array() as {MATCHES})").alias("matches"))
    schema = T.StructType([*out.schema.fields[:-1], T.StructField("matches", T._parse_datatype_string(MATCHES))])
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())]))

    def pass_over(items: list[tuple[int, str | None]]):
        shipped = spark.sparkContext.broadcast(items)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = PassageIndex(shipped.value)
            for batch in batches:
                n = batch.num_columns
                texts = [normal(v.as_py()) for v in batch.column(n - 2)]
                before = batch.column(n - 1).to_pylist()
                new = [
                    old + [dict(zip(("item_id", "start", "end", "edits"), m)) for m in more]
                    for old, more in zip(before, index.search(texts))
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns[: n - 1], pa.array(new, kind)], names=schema.names)

        return work

    for items in _blocks(benchmark):
        if items:
            out = out.mapInArrow(pass_over(items), schema)
    return out.drop("__text")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows without any benchmark passage, unchanged."""
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    return matched(docs, benchmark, [row]).filter(F.size("matches") == 0).select("row.*")
