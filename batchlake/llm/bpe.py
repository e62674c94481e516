"""Byte-level BPE by dynamic programming over prefixes.

BPE has a property that its merge loop hides: the last token of the encoding of a prefix is
unique, and an encoding is right exactly if each two neighbours in it would stay apart. So
one table of the last token of every prefix says all: the tokens of a piece are read off
backwards, appending extends the table, and an edit recomputes it only until it agrees
with the old table again. Time is linear in the piece, however long it is.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from batchlake.llm.base import give_back, small_batches

NONE = -1
#: Pieces kept by a worker (and as many older ones), and the length up to which one is kept.
CACHED_PIECES = 250_000
CACHED_CHARS = 48


class Vocabulary:
    """Ranks of byte strings, how each token is made of two, and which pairs stay apart."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1:
                parts = self._merged(token, rank)
                if len(parts) == 2:
                    self.halves[rank] = (parts[0], parts[1])
                    self.joined[parts[0], parts[1]] = rank
        #: tokens that merging can make; others stand only for a piece equal to them
        made = {t: r for t, r in ranks.items() if len(t) == 1 or r in self.halves}
        #: each tail of a token: the token that it is itself, or NONE
        self.tails = dict.fromkeys((t[i:] for t in made for i in range(len(t))), NONE) | made
        self._apart: dict[tuple[int, int], bool] = {}

    @classmethod
    def parse(cls, content: bytes) -> Vocabulary:
        rows = (line.split() for line in content.splitlines() if line.strip())
        return cls({base64.b64decode(token): int(rank) for token, rank in rows})

    def _merged(self, token: bytes, below: int) -> list[int]:
        """The token's bytes merged by all ranks below its own."""
        parts = [self.ranks[token[i : i + 1]] for i in range(len(token))]
        while len(parts) > 2:
            pairs = [self.joined.get((a, b), below) for a, b in zip(parts, parts[1:])]
            least = min(pairs)
            if least >= below:
                break
            at = pairs.index(least)
            parts[at : at + 2] = [least]
        return parts

    def apart(self, left: int, right: int) -> bool:
        """Whether BPE leaves these two as neighbours.

        Goes back in time from the finished pair: undoing whichever half was merged last
        shows each pair that ever met at the border and for how long. Had one of them a
        merge that was due in that time, it would have crossed the border.
        """
        known = self._apart[left, right] = self._never_crossed(left, right)
        return known

    def extend(self, data: bytes, last: list[int]) -> None:
        """Add the last tokens of the prefixes of ``data`` that ``last`` does not have yet."""
        tails, apart = self.tails.get, self._apart.get
        for end in range(len(last), len(data) + 1):
            start = end - 1
            while start >= 0:
                token = tails(data[start:end])
                if token is None:  # no token ends like this
                    start = 0
                elif token >= 0:
                    if not start:
                        break
                    before = last[start]
                    known = apart((before, token))
                    if self.apart(before, token) if known is None else known:
                        break
                start -= 1
            if start < 0:
                raise ValueError("a byte without a token")
            last.append(token)

    def read_off(self, data: bytes, last: list[int]) -> list[int]:
        """The encoding, from its end to its start and turned round."""
        out, at = [], len(data)
        while at:
            token = last[at]
            out.append(token)
            at -= len(self.bytes_of[token])
        out.reverse()
        return out

    def _never_crossed(self, a: int, b: int) -> bool:
        until = len(self.ranks) * 2  # the rank at which the pair at the border ceases to be
        while True:
            crossing = self.joined.get((a, b))
            if crossing is not None and crossing < until:
                return False
            formed_a = a if a in self.halves else -1
            formed_b = b if b in self.halves else -1
            if formed_a < 0 and formed_b < 0:
                return True
            # of equal merges the left one comes first, so the right one is undone first,
            # and a crossing of its own rank would have come before it
            if formed_b >= formed_a:
                until, b = formed_b + 1, self.halves[b][0]
            else:
                until, a = formed_a, self.halves[a][1]


class PrefixTable:
    """``last[i]`` is the last token of the encoding of the first ``i`` bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [NONE]
        self.append(data)

    def append(self, more: bytes) -> PrefixTable:
        """Exact: earlier entries do not depend on what follows."""
        self.data += more
        self.vocabulary.extend(self.data, self.last)
        return self

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` for the bytes from start to end; returns how many entries were computed.

        An entry depends on the entries and bytes of the longest token before it, so once
        that many agree with the old table behind the edit, all later ones do.
        """
        old, tail = self.last, self.data[end:]
        self.data, self.last = self.data[:start] + new + tail, old[: start + 1]
        shift, agreed, reach = len(new) - (end - start), 0, self.vocabulary.longest
        for at in range(start + 1, len(self.data) + 1):
            self.vocabulary.extend(self.data[:at], self.last)
            inside = at - shift > end
            agreed = agreed + 1 if inside and self.last[at] == old[at - shift] else 0
            if agreed >= reach:
                self.last += old[at - shift + 1 :]
                return at - start
        return len(self.data) - start

    def tokens(self) -> list[int]:
        return self.vocabulary.read_off(self.data, self.last)


class Encoder(dict):
    """Encodes texts; as a dict it keeps the ids of pieces as little-endian bytes."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.pieces, self.older = vocabulary, regex.compile(pattern), {}

    def __missing__(self, piece: str) -> bytes:
        data = piece.encode("utf-8", "replace")
        packed = self.older.get(piece)
        if packed is None:
            whole = self.vocabulary.ranks.get(data)
            if whole is not None:
                ids = [whole]
            else:
                last = [NONE]
                self.vocabulary.extend(data, last)
                ids = self.vocabulary.read_off(data, last)
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED_PIECES:  # the pieces in use come back from the older half
                self.older = dict(self)
                self.clear()
            self[piece] = packed
        return packed

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; a null text is empty."""
        return b"".join(map(self.__getitem__, self.pieces.findall(text or "")))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, np.frombuffer(packed, "<u4").tolist()))


class EncodedText:
    """A text with its pieces and ids that takes appends and edits without encoding all anew."""

    #: A piece can depend on two characters behind it (a contraction), so on two pieces.
    BACK = 3

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder, self.text, self.starts, self.ids = encoder, "", [], []
        self.replace(0, 0, text)

    def append(self, more: str) -> int:
        return self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> int:
        """Returns how many pieces were encoded."""
        shift = len(new) - (end - start)
        text = self.text[:start] + new + self.text[end:]
        first = max(0, int(np.searchsorted(self.starts, start, "left")) - self.BACK)
        old = {s + shift: i for i, s in enumerate(self.starts) if s >= end}
        starts, ids, resume = [], [], len(self.starts)
        for m in self.encoder.pieces.finditer(text, self.starts[first] if self.starts else 0):
            if m.start() in old and m.start() >= start + len(new):
                resume = old[m.start()]
                break
            starts.append(m.start())
            ids.append(self.encoder[m.group()])
        self.starts = self.starts[:first] + starts + [s + shift for s in self.starts[resume:]]
        self.ids = self.ids[:first] + ids + self.ids[resume:]
        self.text = text
        return len(ids)

    def packed(self) -> bytes:
        return b"".join(self.ids)


def encoded(docs: DataFrame, text: Column, path: str, pattern: str, keep: list[str], ids: bool = True) -> DataFrame:
    """``keep`` columns, n_tokens, ids_sha256, decoded_sha256 and, if wanted, token_ids.

    A map over partitions without a shuffle. The rank file (of a fixed size, about a
    megabyte) is read where the session runs and broadcast. A null or empty text has no
    tokens; each id sequence is decoded again and both ends are digested.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shipped = spark.sparkContext.broadcast(Path(path).read_bytes())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        encoder = Encoder(Vocabulary.parse(shipped.value), pattern)
        for batch in batches:
            out = {"n": [], "i": [], "d": [], "t": []}
            for value in batch.column(batch.num_columns - 1):
                packed = encoder.encode(value.as_py())
                out["n"].append(len(packed) // 4)
                out["i"].append(hashlib.sha256(packed).hexdigest())
                out["d"].append(hashlib.sha256(encoder.decode(packed)).hexdigest())
                if ids:
                    out["t"].append(np.frombuffer(packed, "<i4"))
            arrays = [pa.array(out["n"], pa.int64()), pa.array(out["i"], pa.string()), pa.array(out["d"], pa.string())]
            if ids:
                arrays.append(pa.array(out["t"], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], names=schema.names)

    taken = docs.select(*[docs[c] for c in keep], text.alias("__text"))
    added = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * ids
    schema = T.StructType(taken.schema.fields[:-1] + T._parse_datatype_string(added).fields)
    return taken.mapInArrow(work, schema)
