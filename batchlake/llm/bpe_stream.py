"""BPE as a streaming transducer with bounded lookahead, and its inverse as a state machine.

A border between two tokens can still be undone by text further right, but not by text far
to the right: whether a merge crosses the border hangs on whether its right half gets
formed, which hangs on a merge of lower rank across the right end of that half, and so on.
Ranks fall along such a chain, so one pass over the merge list gives the longest chain in
bytes, the lookahead. A token is stable once so many bytes behind it are known; it is
emitted then, and the transducer forgets it. Text comes in chunks, and what is held is
bounded by the chunk and the lookahead, whatever the length of a text or of a piece.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchlake.llm.base import small_batches

# How byte-level BPE cuts text into pieces, and its classes of characters.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACES, CLASSES = r"\s", (r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]")

#: Characters read at once; a piece longer than LONG (3 at least, the longest
#: contraction) characters at their end is passed on in parts.
CHUNK, LONG = 1 << 16, 1 << 10
#: Characters whose piece can still change with what follows them.
MARGIN = 3
#: Short pieces kept by a worker (twice as many at most), and the length up to which one is kept.
CACHED_PIECES, CACHED_CHARS = 400_000, 32
#: Up to so many bytes the least rank is looked up in a list, beyond in a heap.
FEW_BYTES = 48


def byte_of_char() -> dict[str, int]:
    """The character that stands for each byte: itself if it can be seen, else one from 256 on."""
    seen = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173}
    hidden = (b for b in range(256) if b not in seen)
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass
class Merges:
    """A merge list over ids: bytes of each id, rank of each pair, id that each rank makes."""

    bytes_of: dict[int, bytes]
    pairs: list[tuple[int, int]]
    made: list[int]
    specials: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.single = [0] * 256
        for i, data in self.bytes_of.items():
            if len(data) == 1 and i not in self.specials.values():
                self.single[data[0]] = i
        self.rank_of = {pair: rank for rank, pair in enumerate(self.pairs)}
        known = set(self.single)
        for (left, right), new in zip(self.pairs, self.made):
            if left not in known or right not in known or new in known:
                raise ValueError("a merge list in which each token is made once, of tokens made before it, is needed")
            known.add(new)
        self.longest = max(len(self.bytes_of[i]) for i in known)
        self.lookahead = self._lookahead()

    @classmethod
    def parse(cls, content: bytes) -> Merges:
        """Of a tokenizer file with a byte-level BPE model and no normalisation."""
        whole = json.loads(content)
        model, before = whole["model"], whole["pre_tokenizer"] or {}
        plain = not (whole.get("normalizer") or model.get("dropout") or model.get("ignore_merges") or model.get("byte_fallback"))
        plain &= not (model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"))
        plain &= before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        plain &= not any(t[k] for t in whole["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        if not plain or model["type"] != "BPE":
            raise ValueError("not a plain byte-level BPE tokenizer")
        table, vocab = byte_of_char(), model["vocab"]
        specials = {t["content"]: t["id"] for t in whole["added_tokens"]}

        def data(token: str) -> bytes:
            return bytes(table[c] for c in token) if all(c in table for c in token) else token.encode()

        halves = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        return cls(
            {i: data(t) for t, i in (vocab | specials).items()},
            [(vocab[a], vocab[b]) for a, b in halves],
            [vocab[a + b] for a, b in halves],
            specials,
        )

    def _lookahead(self) -> int:
        """Bytes behind a border that decide whether it stays, for the worst border.

        ``own[t]`` says how far a merge of t with a token to its right (of the ranks seen so far)
        looks; ``inner[t]`` the same for the tokens that stood at t's right end before t was made.
        """
        own = dict.fromkeys(self.bytes_of, 0)
        inner = dict.fromkeys(self.bytes_of, 0)
        for (left, right), new in zip(self.pairs, self.made):
            beyond = max(own[right], inner[right])
            inner[new] = beyond
            own[left] = max(own[left], len(self.bytes_of[right]) + beyond)
        return max(max(own.values()), max(inner.values()))

    def merged(self, data: bytes) -> list[int]:
        """The encoding of bytes that nothing follows."""
        parts = [self.single[b] for b in data]
        return self._by_list(parts) if len(parts) <= FEW_BYTES else self._by_heap(parts)

    def _by_list(self, parts: list[int]) -> list[int]:
        rank, none = self.rank_of.get, len(self.pairs)
        ranks = [rank(pair, none) for pair in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            at = ranks.index(least)
            parts[at : at + 2] = [self.made[least]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank((parts[at - 1], parts[at]), none)
            if at < len(ranks):
                ranks[at] = rank((parts[at], parts[at + 1]), none)
        return parts

    def _by_heap(self, parts: list[int]) -> list[int]:
        rank, n = self.rank_of, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        due = [(rank[pair], i) for i, pair in enumerate(zip(parts, parts[1:])) if pair in rank]
        heapq.heapify(due)
        while due:
            r, i = heapq.heappop(due)
            j = after[i]
            if j >= n or (parts[i], parts[j]) != self.pairs[r]:
                continue
            parts[i], parts[j] = self.made[r], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (new := rank.get((parts[i], parts[k]))) is not None:
                    heapq.heappush(due, (new, i))
            if (h := before[i]) >= 0 and (new := rank.get((parts[h], parts[i]))) is not None:
                heapq.heappush(due, (new, h))
        return [p for p in parts if p >= 0]


class Transducer:
    """Tokens of one piece whose bytes come in parts; holds at most ``window`` bytes between calls."""

    def __init__(self, merges: Merges):
        self.merges, self.held = merges, b""
        self.window = 4 * (merges.lookahead + merges.longest)

    def feed(self, data: bytes) -> list[int]:
        """The tokens that have become stable."""
        out: list[int] = []
        self.held += data
        at, size_of = 0, self.merges.bytes_of
        while len(self.held) - at >= self.window:
            stable = at + self.window - self.merges.lookahead
            for token in self.merges.merged(self.held[at : at + self.window]):
                end = at + len(size_of[token])
                if end > stable:
                    break
                out.append(token)
                at = end
        self.held = self.held[at:]
        return out

    def finish(self) -> list[int]:
        data, self.held = self.held, b""
        return self.merges.merged(data)


class Scanner:
    """Cuts text that comes in chunks into pieces; a long one comes in parts."""

    _pieces = regex.compile(PIECES)
    _runs = [regex.compile(f"{c}*") for c in (SPACES, *CLASSES)]

    def __init__(self) -> None:
        self.rest, self.run = "", None

    def feed(self, chunk: str, last: bool) -> tuple[tuple[str, bool] | None, list[str], str]:
        """A part of the open piece and whether it ends there; whole pieces; the start of a new open one."""
        text, self.rest, part = self.rest + chunk, "", None
        if self.run is not None:
            end = self.run.match(text).end()
            to_end, spaces = end == len(text), self.run is self._runs[0]
            # of white space, the last character belongs to what follows, if anything does
            part = text[: end - (spaces and not (to_end and last))], not to_end or last
            text = text[len(part[0]) :]
            if not part[1]:
                self.rest = text
                return part, [], ""
            self.run = None
        pieces, held = self._pieces.findall(text), ""
        if last:
            return part, pieces, ""
        if pieces and len(pieces[-1]) > LONG:
            piece = pieces.pop()
            self.run = next(r for r in self._runs if r.match(piece, len(piece) - 1).end() == len(piece))
            keep = len(piece) - (self.run is self._runs[0])
            self.rest = piece[keep:]
            return part, pieces, piece[:keep]
        while pieces and len(held) < MARGIN:
            held = pieces.pop() + held
        self.rest = held
        return part, pieces, ""


class Encoder(dict):
    """Ids of texts; as a dict it keeps the ids of short pieces, as decimal numbers joined by commas."""

    def __init__(self, merges: Merges):
        self.merges, self.older = merges, {}
        self.special = regex.compile("|".join(map(regex.escape, sorted(merges.specials, key=len, reverse=True))) or "(?!)")
        self.reach = max(map(len, merges.specials), default=1) - 1

    def __missing__(self, piece: str) -> str:
        ids = self.older.get(piece)
        if ids is None:
            transducer = Transducer(self.merges)
            ids = ",".join(map(str, transducer.feed(piece.encode("utf-8", "replace")) + transducer.finish()))
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED_PIECES:  # the pieces in use come back from the older half
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def _sections(self, chunks: Iterable[str]) -> Iterator[tuple[str, int | None]]:
        """Text between special tokens, which are found before anything else, and their ids."""
        held = ""
        for chunk in chunks:
            held += chunk
            at = 0
            # one that starts close to the end waits, as a longer one may start there too
            while (m := self.special.search(held, at)) and m.start() < len(held) - self.reach:
                yield held[at : m.start()], self.merges.specials[m.group()]
                at = m.end()
            keep = max(at, len(held) - self.reach)
            if keep > at:
                yield held[at:keep], None
            held = held[keep:]
        at = 0
        for m in self.special.finditer(held):
            yield held[at : m.start()], self.merges.specials[m.group()]
            at = m.end()
        yield held[at:], -1

    def stream(self, chunks: Iterable[str]) -> Iterator[str]:
        """Ids of the text that the chunks make, as they become stable, joined by commas; none is empty."""
        scanner, transducer = Scanner(), Transducer(self.merges)
        for section, special in self._sections(chunks):
            ends = special is not None
            part, pieces, opened = scanner.feed(section, ends)
            out: list[str] = []
            if part:
                out += map(str, transducer.feed(part[0].encode("utf-8", "replace")))
                if part[1]:
                    out += map(str, transducer.finish())
            out += map(self.__getitem__, pieces)
            if opened:
                out += map(str, transducer.feed(opened.encode("utf-8", "replace")))
            if ends:
                scanner = Scanner()
                if special >= 0:
                    out.append(str(special))
            if out:
                yield ",".join(out)

    def encode(self, text: str | None) -> list[int]:
        """All ids of a text; a null one has none."""
        return [int(i) for ids in self.stream(chunked(text)) for i in ids.split(",")]


def chunked(text: str | None, size: int = CHUNK) -> Iterator[str]:
    for at in range(0, len(text or ""), size):
        yield text[at : at + size]


class Decoder:
    """Text of ids that come one after another.

    The state between calls is the start of a character whose other bytes are still to come.
    Bytes that cannot be part of a character become U+FFFD.
    """

    def __init__(self, merges: Merges):
        self.bytes_of = {str(i): data for i, data in merges.bytes_of.items()}
        self.reset()

    def reset(self) -> None:
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: str) -> str:
        """The text that ids (decimal, joined by commas) complete."""
        return self.machine.decode(b"".join(map(self.bytes_of.__getitem__, ids.split(",")))) if ids else ""

    def finish(self) -> str:
        text = self.machine.decode(b"", True)
        self.reset()
        return text


def _shipped(docs: DataFrame, path: str):
    """The tokenizer file (a fixed size, a few megabytes), read where the session runs, broadcast."""
    spark = docs.sparkSession
    small_batches(spark)
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encoded(docs: DataFrame, text: Column, path: str, keep: list[str], ids: bool = True) -> DataFrame:
    """``keep`` columns, n_tokens, ids_sha256, decoded_sha256 and, if wanted, token_ids.

    A map over partitions without a shuffle. A null or empty text has no tokens. The string of a
    special token in a text is that token. Ids are decoded again as they come out, and
    both ends are digested: ids in decimal joined by commas, the decoded text in UTF-8.
    """
    shipped = _shipped(docs, path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = Merges.parse(shipped.value)
        encoder, decoder = Encoder(merges), Decoder(merges)
        for batch in batches:
            out: dict[str, list] = {"n": [], "i": [], "d": [], "t": []}
            for value in batch.column(batch.num_columns - 1):
                n, own, back, kept = 0, hashlib.sha256(), hashlib.sha256(), []
                for stable in encoder.stream(chunked(value.as_py())):
                    own.update((b"," if n else b"") + stable.encode())
                    n += stable.count(",") + 1
                    back.update(decoder.feed(stable).encode())
                    if ids:
                        kept += map(int, stable.split(","))
                back.update(decoder.finish().encode())
                for name, x in zip(out, (n, own.hexdigest(), back.hexdigest(), kept)):
                    out[name].append(x)
            arrays = [pa.array(out["n"], pa.int64()), pa.array(out["i"], pa.string()), pa.array(out["d"], pa.string())]
            if ids:
                arrays.append(pa.array(out["t"], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], names=schema.names)

    taken = docs.select(*[docs[c] for c in keep], text.alias("__text"))
    added = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * ids
    schema = T.StructType(taken.schema.fields[:-1] + T._parse_datatype_string(added).fields)
    return taken.mapInArrow(work, schema)


def decoded(rows: DataFrame, ids: Column, path: str, keep: list[str]) -> DataFrame:
    """``keep`` columns and the text of the ids; null ids give a null text, unknown ids raise."""
    shipped = _shipped(rows, path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(Merges.parse(shipped.value))
        for batch in batches:
            texts = []
            for value in batch.column(batch.num_columns - 1):
                own = value.as_py()
                texts.append(None if own is None else decoder.feed(",".join(map(str, own))) + decoder.finish())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=schema.names)

    taken = rows.select(*[rows[c] for c in keep], F.filter(ids, lambda i: i.isNotNull()).alias("__ids"))
    schema = T.StructType([*taken.schema.fields[:-1], T.StructField("text", T.StringType())])
    return taken.mapInArrow(work, schema)
