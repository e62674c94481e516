"""Exact Jaccard self-join of documents on word n-grams, by vertical partitioning.

The n-grams of all documents have one global order, that of their 64-bit hashes. The
order is cut into fragments, so that each document's set falls into segments.

Candidates: sets that are similar enough differ in at most d n-grams, so of more than d
fragments they agree in some whole segments. Documents of a size class are cut into d + 1
fragments (and some to spare for empty ones) and meet where a segment is equal. A
segment holds several n-grams, so a common line or passage alone brings nobody
together. A pair has to agree in T segments, a number that follows from the sizes, so each
document leaves out the T - 1 that most others share. Sets with too many empty
segments also meet on their first n-grams (prefix filter), so no pair is lost.

Counting: the sets of candidates are cut into a few coarse fragments, the overlap of each
pair is counted in each of them apart and summed for the pair.

Groups: within a segment's documents, only pairs with one centre are counted first. The
centre of a segment is its most central set, or a set yet more central that this one often
meets, so that a group has few centres. Pairs already in one component need no count. Small
segments in which components still meet then compare all their pairs and are done with; sets that
have little else in common mostly meet there. In the others each compares one more set with those
of other components and is done with it. For the sets that
then still meet across components, the difference of each to a centre decides: two sets
that link must share so many n-grams of their differences (they differ from each other by
what they do not share), so they meet again only on a prefix of these, those last that many
sets of the centre share. What meets there goes through a star once more, and only what is
then still apart is counted pair by pair. Copies by the thousand cost a star and short
prefixes, not all pairs, and no link between components is missed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from batchlake.llm.base import landed, scratch, small_batches, text_bytes
from batchlake.llm.components import components
from batchlake.llm.words import WordHasher, byte_class, lower_ascii, mix

#: Coarse fragments in which overlaps are counted.
FRAGMENTS = 2
#: A segment seen so often by one task is hot: its further rows are dealt over SALTS parts.
HOT_ROWS = 64
SALTS = 32
#: Classes of differences, for each difference that a link allows; the last one, NEAR, has all
#: greater ones, of sets that have little to do with their centre.
CLASSES, NEAR = 6, 12
#: Texts that a scan decodes at once.
SCAN_ROWS = 512
#: Keys that a worker gives back at once.
BATCH_KEYS = 20_000
#: N-grams that many sets of a centre share, of all centres, that may be broadcast (8 bytes each).
BROADCAST_GRAMS = 2_000_000
#: Sets up to which a segment compares all its pairs: at most so many rows for each of its own.
SMALL_SETS = 16
#: Rounds in which each larger segment compares one set with its others and is done with it.
ROUNDS = 1
#: Sets of one centre in a part, when they are joined with what belongs to the centre.
PART_SETS = 4096
#: Sets from which the n-grams are told that many sets of a centre share, and the share
#: (one in so many) that counts as many. They only decide the order of n-grams, not which are used.
SHOWN_SETS, MANY = 64, 8
#: Keys of texts that may be broadcast (8 bytes each).
BROADCAST_TEXTS = 200_000
#: Kinds of a segment's key, in its lowest bits: of the class above the set's own, of a prefix, hot.
UP, PREFIX, HOT, KIND_BITS = 1, 2, 4, 3
_SEEN_BITS = 20
FRAGMENT = "key long, fragment int, tokens array<long>, sketch array<long>"
_STEP = np.uint64(0xD6E8FEB86659FD93)


class Shingler:
    """Sets of word n-grams of texts, as sorted distinct 64-bit hashes.

    Words are runs of bytes other than blank, tab and line ends, with A-Z in lower case.
    A text with fewer words than n is one n-gram, one without words has none.
    """

    def __init__(self, n: int):
        self.n = n
        self.hasher = WordHasher(byte_class(b" \t\n\x0b\x0c\r", inverse=True), lower_ascii())

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        hashes, offsets = self.hasher(texts)
        return [self._set(hashes[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]

    def _set(self, words: np.ndarray) -> np.ndarray:
        if not len(words):
            return words
        n = min(self.n, len(words))
        rolled = np.full(len(words) - n + 1, n, np.uint64)
        for i in range(n):
            rolled = rolled * _STEP + words[i : len(words) - n + 1 + i]
        return np.unique(mix(rolled))


def set_key(tokens: np.ndarray) -> int:
    """A signed 64-bit key of a set; 0 for the empty one."""
    if not len(tokens):
        return 0
    whole = mix(tokens * _STEP + np.uint64(1)).sum(dtype=np.uint64) + np.uint64(len(tokens))
    return int(mix(np.array([whole])).view(np.int64)[0])


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Parities of how many n-grams fall into each of m buckets, as bits of 64-bit words.

    The sketches of two sets differ in at most as many bits as the sets differ in n-grams, so
    they can prove that two sets do not link. m is a power of two, twice the set's size at
    least; the wider of two sketches is folded upon itself.
    """
    words = 1 << max(0, (2 * len(tokens) - 1).bit_length() - 6)
    bits = np.bincount((tokens & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8).reshape(words, 64), axis=1, bitorder="little").view("<u8")[:, 0]


def apart_by(a: Column, b: Column) -> Column:
    """By how many n-grams two sets differ at least, by their sketches."""
    words = F.least(F.size(a), F.size(b))

    def folded(x: Column) -> Column:
        halves = F.zip_with(F.slice(x, F.lit(1), words), F.slice(x, words + 1, words), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(x) == 2 * words, halves).otherwise(x)

    bits = F.zip_with(folded(a), folded(b), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    least = F.aggregate(bits, F.lit(0), lambda total, n: total + n)
    # sets of which one is over twice as large as the other need no sketch
    return F.when(F.greatest(F.size(a), F.size(b)) <= 2 * words, least).otherwise(F.lit(0))


class Segments:
    """Keys of the segments of a set, for Jaccard of at least ``percent`` / 100."""

    def __init__(self, percent: int):
        self.percent, self.ratio = percent, (100 / percent) ** 2
        self.first = [1]
        self.cuts: list[tuple[int, int]] = []

    def _class(self, size: int) -> int:
        while self.first[-1] <= size:
            low = self.first[-1]
            high = max(low + 1, math.ceil(low * self.ratio))
            self.first.append(high)
            differ = 2 * (high - 1) * (100 - self.percent) // (100 + self.percent)
            spare = 0
            if differ:
                empty = (differ + 1) * math.exp(-low * self.percent / 100 / (differ + 1))
                spare = math.ceil(1 + empty + 3 * math.sqrt(empty))
            self.cuts.append((differ, spare))
        return int(np.searchsorted(self.first, size, "right")) - 1

    def _classes(self, size: int) -> range:
        """A pair meets in the class of its larger set; a set also goes to the next class up if a
        partner can be there."""
        return range(self._class(size), self._class(size * 100 // self.percent) + 1)

    def _parts(self, tokens: np.ndarray, c: int) -> tuple[int, np.ndarray, np.ndarray]:
        """Number of fragments of a class, the fragment of each n-gram and where a new one begins."""
        differ, spare = self.cuts[c]
        parts = differ + 1 + spare
        part = ((tokens >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        return parts, part, np.flatnonzero(np.diff(part, prepend=np.uint64(parts)))

    def spared(self, tokens: np.ndarray) -> list[int]:
        """How many of its most shared segments a set can leave out, in its class and the next one up."""
        size, out = len(tokens), [0, 0]
        for up, c in enumerate(self._classes(size)) if size else ():
            if self.cuts[c][0]:
                largest = min(self.first[c + 1] - 1, size * 100 // self.percent)
                agree = len(self._parts(tokens, c)[2]) - (size + largest) * (100 - self.percent) // (100 + self.percent)
                out[up] = max(agree - 1, 0)
        return out

    def keys(self, tokens: np.ndarray) -> np.ndarray:
        """Keys of the segments of a set; the lowest bits are the kind (UP, PREFIX).

        Classes whose sets must be equal have no keys.
        """
        found = [tokens[:0]]
        for up, c in enumerate(self._classes(len(tokens))) if len(tokens) else ():
            found += self._keys_in(tokens, c, UP * up)
        return np.concatenate(found)

    def _keys_in(self, tokens: np.ndarray, c: int, kind: int) -> list[np.ndarray]:
        differ, spare = self.cuts[c]
        if not differ:
            return []
        parts, part, begins = self._parts(tokens, c)
        keys = [_marked(mix(np.add.reduceat(mix(tokens), begins) + mix(part[begins] + np.uint64(parts << 32))), kind)]
        if parts - len(begins) > spare:
            prefix = tokens[: len(tokens) - math.ceil(len(tokens) * self.percent / 100) + 1]
            keys.append(_marked(mix(prefix + mix(np.array([parts], np.uint64))), kind + PREFIX))
        return keys


def _marked(keys: np.ndarray, kind: int) -> np.ndarray:
    return keys >> np.uint64(KIND_BITS) << np.uint64(KIND_BITS) | np.uint64(kind)


class Recent:
    """What was seen lately, in a table of fixed size; how often, or 0."""

    def __init__(self, bits: int = _SEEN_BITS):
        self.shift = np.uint64(64 - bits)
        self.tags, self.counts = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)

    def count(self, keys: np.ndarray) -> np.ndarray:
        slots = (keys * _STEP) >> self.shift
        known = self.tags[slots] == keys
        self.counts[slots] = np.where(known, self.counts[slots] + 1, 1)
        self.tags[slots] = keys
        return self.counts[slots] - 1


def _shingled(docs: DataFrame, n: int) -> DataFrame:
    small_batches(docs.sparkSession)
    # a scan holds its rows in arrays that grow by doubling: few long texts at once
    docs.sparkSession.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(SCAN_ROWS))
    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), text_bytes().alias("text"))


def _indexed(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """One row per document: doc_id, text_key, size, key, spared (see ``Segments.spared``)."""
    taken = _shingled(docs, n)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, segments = Shingler(n), Segments(percent)
        for batch in batches:
            sets = shingler([v.as_py() for v in batch.column(2)])
            columns = [
                *batch.columns[:2],
                pa.array([len(tokens) for tokens in sets], pa.int64()),
                pa.array([set_key(tokens) for tokens in sets], pa.int64()),
                pa.array([segments.spared(tokens) for tokens in sets], pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "size", "key", "spared"])

    kind = taken.schema["doc_id"].dataType.simpleString()
    return landed(taken.mapInArrow(work, f"doc_id {kind}, text_key long, size long, key long, spared array<int>"), "ngram-index")


def _segments(docs: DataFrame, n: int, percent: int, hot_rows: int) -> DataFrame:
    """(segment, key) of every set, made again from the texts: they are too many to be stored.

    A worker gives the segments of a set once as long as it remembers the set.
    """
    taken = _shingled(docs, n)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, segments, sets, often = Shingler(n), Segments(percent), Recent(16), Recent()
        for batch in batches:
            made, keys = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for tokens in shingler([v.as_py() for v in batch.column(2)]):
                key = set_key(tokens)
                if len(tokens) and not sets.count(np.array([key]).view(np.uint64))[0]:
                    own = segments.keys(tokens)
                    made.append(own | np.where(often.count(own >> np.uint64(KIND_BITS)) >= hot_rows, np.uint64(HOT), np.uint64(0)))
                    keys.append(np.full(len(own), key))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(made).view(np.int64)), pa.array(np.concatenate(keys))], names=["segment", "key"])

    return taken.mapInArrow(work, "segment long, key long")


def difference(tokens: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """What only one of a set and its centre has; n-grams that the centre lacks come first."""
    return np.concatenate((np.setdiff1d(tokens, centre, True), np.setdiff1d(centre, tokens, True)))


def class_of(differ: int, width: int) -> int:
    return min(differ // width, NEAR)


def difference_keys(
    order: np.ndarray, classes: list[int], limits: list[int], width: int, least_limits: list[int] | None = None, common: np.ndarray | None = None
) -> np.ndarray:
    """Keys on which a set meets partners, in some classes of difference, that share its centre.

    Let x and y differ from the centre by dx and dy n-grams, and link only if they differ by at
    most some limit from each other. As they differ by dx + dy less twice what their
    differences share, they share at least (dx + dy - limit) / 2 of these. So for each class
    of dy, a prefix of x's difference (``order``) is enough, in any order that all sets of a
    centre have: n-grams that many share (``common``) last, as given, before them those that
    the centre lacks first. Where nothing need be shared, they meet on 0.

    Each side knows only bounds of the other's difference and of the limit (``limits``, and
    from below ``least_limits``), so one can need nothing where the other needs something:
    x then emits 0 and its whole difference, unless no pair with the class needs anything.
    """
    if common is not None and len(common):
        order = np.concatenate((order[~np.isin(order, common)], common[np.isin(common, order)]))
    own, found = len(order), [order[:0]]
    for other, most, sure in zip(classes, limits, least_limits or [-1] * len(classes)):
        # a partner differs from the centre by no more or less than the limit allows
        low, high = max(other * width, own - most), own + most if other == NEAR else other * width + width - 1
        need = -((most - own - low) // 2)
        if need <= min(own, high):
            grams = order[: own - max(need, 1) + 1] if own + high > sure else order[:0]
            if need <= 0:
                grams = np.append(grams, np.uint64(0))
            pair = np.uint64((min(class_of(own, width), other) << 32) + max(class_of(own, width), other))
            found.append(mix(grams * _STEP + pair))
    return np.concatenate(found)


def _tokens(column: pa.Array) -> list[np.ndarray]:
    return [x.values.to_numpy(zero_copy_only=False).view(np.uint64) if x.is_valid else np.empty(0, np.uint64) for x in column]


def _dealt(table: DataFrame) -> DataFrame:
    """Rows of centres (with ``parts``) once for each part that the centre's sets are dealt over."""
    return table.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))


def _differences(pairs: DataFrame, fragments: DataFrame) -> DataFrame:
    """``pairs`` (a, b, ...) of centres and sets with ``order``, the set's difference to the centre."""
    wanted = _ends(pairs)
    # the fragments of one set, not of a group of documents, come together here
    sets = fragments.join(wanted, "key", "left_semi").groupBy("key").agg(F.flatten(F.collect_list("tokens")).alias("tokens"))
    sets = landed(sets, "ngram-sets")
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PART_SETS).cast("int").alias("parts"))
    of_a = _dealt(sets.join(parts, F.col("key") == F.col("a")).select("a", "parts", F.col("tokens").alias("of_a"))).drop("parts")
    kept = pairs.columns
    dealt = pairs.join(parts, "a").withColumn("part", F.pmod(F.xxhash64("b"), "parts").cast("int")).select(*kept, "part")
    both = dealt.join(sets.select(F.col("key").alias("b"), F.col("tokens").alias("of_b")), "b").join(of_a, ["a", "part"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(_tokens(batch.column(len(kept) + 1)), _tokens(batch.column(len(kept))))
            orders = [difference(np.sort(own), np.sort(centre)).view(np.int64) for own, centre in sides]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(orders, pa.list_(pa.int64()))], names=[*kept, "order"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.schema.fields)
    return landed(both.select(*kept, "of_a", "of_b").mapInArrow(work, f"{kinds}, order array<long>"), "ngram-differences")


def _shared_by_many(differences: DataFrame, sizes: DataFrame) -> DataFrame:
    """(a, common): n-grams in the differences of many sets of a centre, the most frequent last.

    Told from some SHOWN_SETS sets of each centre (which has ``n`` and ``near`` in ``sizes``), so that it
    does not grow with it. Sets far from the centre differ from it by nearly all they have, and
    what the centre lacks stands first with them anyway.
    """
    shown = differences.join(sizes, "a").filter((F.size("order") < F.col("near")) & (F.pmod(F.xxhash64("b"), F.col("n")) < SHOWN_SETS))
    often = shown.select("a", F.explode("order").alias("token")).groupBy("a", "token").agg(F.count(F.lit(1)).alias("often"))
    sets = shown.groupBy("a").agg(F.count(F.lit(1)).alias("sets"))
    many = often.join(sets, "a").filter((F.col("often") > 1) & (F.col("often") * MANY >= F.col("sets")))
    listed = F.array_sort(F.collect_list(F.struct("often", "token")))
    return landed(many.groupBy("a").agg(listed.getField("token").alias("common")), "ngram-common")


def _meetings(differences: DataFrame, able: DataFrame) -> DataFrame:
    """(meeting, a, b, size_b, differ, root_b, outside): where the ``able`` sets of a centre meet each other.

    What is known of sets and centres is broadcast if it was counted to be little, else dealt out.
    """
    sizes = able.groupBy("a").agg(F.max("n").alias("n"), F.max("parts").alias("parts"), (F.max("width") * NEAR).alias("near"))
    common = _shared_by_many(differences, sizes.select("a", "n", "near"))
    if (common.agg(F.sum(F.size("common"))).first()[0] or 0) <= BROADCAST_GRAMS:
        common, on = F.broadcast(common), ["a"]
    else:
        common, on = _dealt(common.join(sizes, "a")).select("a", "part", "common"), ["a", "part"]
    if able.count() <= BROADCAST_TEXTS:
        able = F.broadcast(able)
    both = differences.select("a", "b", "order").join(able, ["a", "b"]).join(common, on, "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centres, classes, limits, least, width = (batch.column(i).to_pylist() for i in (0, 6, 7, 8, 9))
            orders, common = _tokens(batch.column(10)), _tokens(batch.column(11))
            made: list[np.ndarray] = []
            for k in range(batch.num_rows):
                keys = difference_keys(orders[k], classes[k], limits[k], width[k], least[k], common[k])
                made.append(mix(keys + np.array([centres[k]]).view(np.uint64)).view(np.int64))
                if sum(map(len, made)) >= BATCH_KEYS or k == batch.num_rows - 1:
                    which = pa.array(np.repeat(np.arange(k + 1 - len(made), k + 1), [len(m) for m in made]), pa.int64())
                    columns = [batch.column(i).take(which) for i in range(6)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(made)), *columns], names=["meeting", *kept])
                    made = []

    kept = ["a", "b", "size_b", "differ", "root_b", "outside"]
    taken = both.select(*kept, "classes", "limits", "least_limits", "width", "order", "common")
    return taken.mapInArrow(work, "meeting long, a long, b long, size_b long, differ long, root_b long, outside boolean")


def _met(index: DataFrame, segments: DataFrame) -> DataFrame:
    """(segment, key, size, weight): sets by the segments that may bring them to a partner.

    One shuffle of narrow rows keeps the segments that several sets have; hot ones are dealt
    over several parts. The others are few. A set's most shared segments are left out, as
    many as it can spare in that class; the order is the same for all sets.
    """
    kind = F.col("segment").bitwiseAND((1 << KIND_BITS) - 1)
    each = segments.select(
        F.shiftright("segment", KIND_BITS).alias("segment"),
        F.when(kind >= HOT, F.pmod("key", F.lit(SALTS)) + 1).otherwise(0).cast("byte").alias("salt"),
        "key",
        kind.bitwiseAND(HOT - 1).cast("byte").alias("kind"),
    )
    w = W.partitionBy("segment", "salt")
    several = each.select("*", F.min("key").over(w).alias("low"), F.max("key").over(w).alias("high"))
    with scratch(index.sparkSession):
        shared = landed(several.filter("salt > 0 or low < high").select("segment", "key", "kind"), "ngram-shared")
        often = shared.groupBy("segment").agg(F.count(F.lit(1)).alias("often"))
        # weight says how central a set is: it counts the segments left out too
        ranked = shared.join(often, "segment").select(
            "*",
            F.sum("often").over(W.partitionBy("key")).alias("weight"),
            F.dense_rank().over(W.partitionBy("key", "kind").orderBy(F.desc("often"), "segment")).alias("rank"),
        )
        sizes = index.filter("size > 0").groupBy("key").agg(F.max(F.struct("size", "spared")).alias("of"))
        spared = F.when(F.col("kind") >= PREFIX, 0).otherwise(F.get("of.spared", F.col("kind").cast("int")))
        kept = ranked.join(sizes, "key").filter(F.col("rank") > spared).select("segment", "key", "of.size", "weight")
        return landed(kept, "ngram-met", kept=True)


def _fragments(docs: DataFrame, index: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(key, fragment, tokens, sketch) of the wanted sets, made again from one text of each.

    The sketch stands with the first fragment of a set only.

    The list of texts is broadcast if it was counted to be short; else texts are dealt
    by their key. Equal texts are reduced to one ahead of the shuffle.
    """
    texts = landed(
        index.select("key", "text_key").join(wanted, "key", "left_semi").groupBy("key").agg(F.min("text_key").alias("text_key")).select("text_key"),
        "ngram-texts",
    )
    if texts.count() <= BROADCAST_TEXTS:
        texts = F.broadcast(texts)
    own = docs.select(F.xxhash64("text").alias("text_key"), "text").join(texts, "text_key", "left_semi")
    taken = own.groupBy("text_key").agg(F.first("text").alias("text")).select("text_key", text_bytes().alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        for batch in batches:
            out: dict[str, list] = {"key": [], "fragment": [], "tokens": [], "sketch": []}
            for tokens in shingler([v.as_py() for v in batch.column(1)]):
                key = set_key(tokens)
                bits = sketch(tokens).view(np.int64)
                cuts = np.searchsorted(tokens, (np.arange(1, FRAGMENTS, dtype=np.uint64) << np.uint64(64 - FRAGMENTS.bit_length() + 1)))
                for fragment, part in enumerate(np.split(tokens.view(np.int64), cuts)):
                    if len(part):
                        for name, value in zip(out, (key, fragment, part, bits)):
                            out[name].append(value)
                        bits = None  # once for each set
            kinds = pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))

    return landed(taken.mapInArrow(work, FRAGMENT), "ngram-fragments")


def _counted(pairs: DataFrame, fragments: DataFrame) -> DataFrame:
    """``pairs`` with ``shared``: overlaps counted for each fragment and summed."""
    fragments = landed(fragments.join(_ends(pairs), "key", "left_semi").drop("sketch"), "ngram-needed")
    left = fragments.select(F.col("key").alias("a"), "fragment", F.col("tokens").alias("of_a"))
    right = fragments.select(F.col("key").alias("b"), "fragment", F.col("tokens").alias("of_b"))
    partial = (
        pairs.join(left, "a")
        .join(right, ["b", "fragment"], "left")
        .select("a", "b", "size_a", "size_b", F.coalesce(F.size(F.array_intersect("of_a", "of_b")), F.lit(0)).cast("long").alias("shared"))
    )
    return partial.groupBy("a", "b", "size_a", "size_b").agg(F.sum("shared").alias("shared"))


def similar_documents(docs: DataFrame, n: int = 5, percent: int = 80, hot_rows: int = HOT_ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id of every row, by links of Jaccard >= percent / 100.

    The component is the smallest doc_id reachable by links. Documents without words (or
    text) have an empty set, link with nothing and keep their own id. Equal sets link.
    A null doc_id takes part but never names a component that has another id. Sets are
    told apart by 64-bit keys: for a billion documents the odds that any two sets share one
    by chance are about one in forty. Other columns are ignored.
    """
    index, named = _grouped(docs, n, percent, hot_rows)
    full = index.filter("size > 0").select("doc_id", "size", "key")
    empty = index.filter("size = 0").select("doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return (
        full.join(named, "key").select("doc_id", F.col("size").alias("n_shingles"), "component_id").unionByName(empty)
    )


def representatives(docs: DataFrame, n: int = 5, percent: int = 80, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows, unchanged, of one document of each group: the one with the smallest doc_id.

    Of rows that share this id one stays; a row without an id stands for its group only if
    no other can. Rows without words are in no group and all stay. What goes is a list of
    (id, text), broadcast if it was counted to be short, else joined in a shuffle.
    """
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))
    with scratch(docs.sparkSession):
        index, named = _grouped(docs, n, percent, hot_rows)
        rows = index.filter("size > 0").join(named.select("key", "root"), "key")
        rows = rows.groupBy("root", name.alias("name"), "text_key").agg(F.first("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))
        first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
        heads = rows.groupBy("root").agg(F.min(first).alias("head"))
        is_head = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key").eqNullSafe(F.col("head"))
        judged = rows.join(heads, "root").select("name", "text_key", (~is_head).alias("goes"), "copies").filter("goes or copies > 1")
        judged = landed(judged, "ngram-judged", kept=True)
        if judged.count() <= BROADCAST_TEXTS:
            judged = F.broadcast(judged)
    own = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), name.alias("name"), F.xxhash64("text").alias("text_key"))
    joined = own.join(judged, ["name", "text_key"], "left").filter("goes is null or not goes")
    repeated = joined.filter("copies > 1").dropDuplicates(["name", "text_key"]).select("row.*")
    return joined.filter("copies is null").select("row.*").unionByName(repeated)


def _grouped(docs: DataFrame, n: int, percent: int, hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """The index, and (key, root, component_id) of every set in it."""
    index = _indexed(docs, n, percent)
    with scratch(docs.sparkSession):
        met = _met(index, _segments(docs, n, percent, hot_rows))
        join = _Join(docs, index, n, percent)
        # at first each set is a component of its own
        join.link(join.fits(join.star(met)), fetch=True)
        rows = join.crossing(met)
        if not rows.isEmpty():
            rows = join.settle_small(rows)
        for _ in range(ROUNDS):
            rows = join.crossing(rows)
            if not rows.isEmpty():
                rows = join.settle(rows)
        rows = join.crossing(rows)
        if not rows.isEmpty():
            join.apart(rows)
        sets = index.filter("size > 0").groupBy("key").agg(F.min("doc_id").alias("least"))
        named = sets.join(join.label, F.col("key") == F.col("node"), "left").select("key", "least", F.coalesce("root", "key").alias("root"))
        least = named.groupBy("root").agg(F.min("least").alias("component_id"))
        return index, landed(named.join(least, "root").select("key", "root", "component_id"), "ngram-named", kept=True)


def _ends(pairs: DataFrame) -> DataFrame:
    """key of every set in a pair."""
    return pairs.select(F.col("a").alias("key")).distinct().unionByName(pairs.select(F.col("b").alias("key")).distinct()).distinct()


def _hubs(rows: DataFrame) -> DataFrame:
    """(segment, hub, hub_weight): the most central set of each segment."""
    hub = rows.groupBy("segment").agg(F.max(F.struct("weight", "key")).alias("hub"))
    return hub.select("segment", F.col("hub.key").alias("hub"), F.col("hub.weight").alias("hub_weight"))


def _centres(met: DataFrame) -> DataFrame:
    """(hub, centre): for the most central set of a segment, the one that stands for it.

    That is the most central among the hubs of its own segments, if a quarter of these have it.
    Any choice is right, as long as all sets of a segment have the same; few centres are best.
    """
    hubs = landed(_hubs(met), "ngram-hubs")
    own = met.join(hubs.select(F.col("hub").alias("key")).distinct(), "key", "left_semi").select("segment", "key").join(hubs, "segment")
    seen = own.groupBy("key", "hub").agg(F.count(F.lit(1)).alias("n"), F.max("hub_weight").alias("hub_weight"))
    total = seen.groupBy("key").agg(F.sum("n").alias("total"))
    near = seen.join(total, "key").filter("4 * n >= total").groupBy("key").agg(F.max(F.struct("hub_weight", "hub")).alias("top"))
    return total.join(near, "key", "left").select(F.col("key").alias("hub"), F.coalesce("top.hub", "key").alias("centre"))


class _Join:
    """The sets fetched and the components that the links found make."""

    def __init__(self, docs: DataFrame, index: DataFrame, n: int, percent: int):
        self.docs, self.index, self.n, self.percent = docs, index, n, percent
        spark = docs.sparkSession
        self.label = spark.createDataFrame([], "node long, root long")
        self.fragments = spark.createDataFrame([], FRAGMENT)
        self.sizes = index.filter("size > 0").groupBy("key").agg(F.max("size").alias("size"))

    def root(self, rows: DataFrame, key: str, name: str) -> DataFrame:
        """``rows`` with the component of the set ``key``."""
        label = self.label.select(F.col("node").alias(key), F.col("root").alias(name))
        return rows.join(label, key, "left").withColumn(name, F.coalesce(name, key))

    def fits(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose sizes allow a link."""
        return pairs.filter(F.least("size_a", "size_b") * 100 >= F.greatest("size_a", "size_b") * self.percent)

    def crossing(self, rows: DataFrame) -> DataFrame:
        """The rows of segments in which two components meet, with the component."""
        rows = self.root(rows.drop("root"), "key", "root")
        split = rows.groupBy("segment").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
        return landed(rows.join(split.select("segment"), "segment", "left_semi"), "ngram-crossing")

    def star(self, rows: DataFrame) -> DataFrame:
        """Each segment's sets paired with its centre."""
        centres = _centres(rows).join(self.sizes, F.col("centre") == F.col("key")).select("hub", "centre", "size")
        centre = _hubs(rows).join(landed(centres, "ngram-centres"), "hub").select("segment", F.col("centre").alias("a"), F.col("size").alias("size_a"))
        pairs = rows.join(centre, "segment").filter("key <> a").select("a", F.col("key").alias("b"), "size_a", F.col("size").alias("size_b"))
        return landed(pairs.distinct(), "ngram-star")

    def settle_small(self, rows: DataFrame) -> DataFrame:
        """Compare all pairs of components in segments of at most SMALL_SETS sets; returns the rows of the others.

        Such sets often have nothing but the segment in common; by their differences to a centre
        they would meet on as many keys as a plain prefix has.
        """
        # a segment can hold a set twice, as one of its class and of the class below
        rows = rows.groupBy("segment", "key").agg(F.max("size").alias("size"), F.max("weight").alias("weight"), F.max("root").alias("root"))
        sets = rows.groupBy("segment").agg(F.count(F.lit(1)).alias("sets"))
        rows = landed(rows.join(sets, "segment"), "ngram-crossing-sets")
        small = rows.filter(F.col("sets") <= SMALL_SETS)
        each = small.groupBy("segment").agg(F.collect_list(F.struct("key", "size", "root")).alias("all"))
        left = small.select("segment", F.struct("key", "size", "root").alias("x"))
        # one row for each set and segment; only what can link leaves its row
        mates = left.join(each, "segment").select("x", F.explode(F.filter("all", lambda y: (
            (y["key"] > F.col("x.key")) & (y["root"] != F.col("x.root"))
            & (F.least(y["size"], F.col("x.size")) * 100 >= F.greatest(y["size"], F.col("x.size")) * self.percent)
        ))).alias("y"))
        self.link(
            mates.select(F.col("x.key").alias("a"), F.col("y.key").alias("b"), F.col("x.size").alias("size_a"), F.col("y.size").alias("size_b")), fetch=True
        )
        return rows.filter(F.col("sets") > SMALL_SETS).drop("sets", "root")

    def settle(self, rows: DataFrame) -> DataFrame:
        """Compare the most central set of each segment with those of other components.

        Returns the rows without these sets: what pairs with them is known.
        """
        hub = rows.groupBy("segment").agg(F.max(F.struct("weight", "key", "size", "root")).alias("hub"))
        others = landed(rows.join(hub, "segment").filter("key <> hub.key"), "ngram-others")
        pairs = others.filter("root <> hub.root").select(
            F.col("hub.key").alias("a"), F.col("key").alias("b"), F.col("hub.size").alias("size_a"), F.col("size").alias("size_b")
        )
        self.link(self.fits(pairs), fetch=True)
        return others.drop("hub")

    def limit(self, size: Column, other: Column) -> Column:
        """By how much two sets that link can differ."""
        return F.floor((size + other) * (100 - self.percent) / (100 + self.percent)).cast("long")

    def able(self, known: DataFrame) -> DataFrame:
        """Sets with their centre, and the classes of difference in which they can have partners.

        Of a pair one is always outside the centre's component, so the sets inside it, which can
        be most of a large group, are never paired with each other. Sets whose centre has no
        partner for them in any class of difference drop out.
        """
        spokes = (
            self.root(self.root(known, "a", "root_a"), "b", "root_b")
            .withColumn("outside", F.col("root_a") != F.col("root_b"))
            .withColumn("width", F.greatest(F.floor(self.limit(F.col("size_a"), F.col("size_a")) / CLASSES), F.lit(1)).cast("long"))
            .withColumn("class", F.floor(F.col("differ") / F.col("width")).cast("long"))
            # beyond NEAR, steps of a whole limit tell whether there is a partner at all
            .withColumn("class", F.when(F.col("class") < NEAR, F.col("class")).otherwise(NEAR + F.floor((F.col("class") - NEAR) / CLASSES).cast("long")))
        )
        spokes = landed(spokes, "ngram-spokes")
        # classes are a bounded number for each centre, however many sets it has
        there = spokes.groupBy("a", "class").agg(
            F.min("root_b").alias("low"), F.max("root_b").alias("high"), F.bool_or("outside").alias("out"),
            F.max("size_b").alias("largest"), F.min("size_b").alias("smallest"), F.count(F.lit(1)).alias("n"),
        )
        there = there.groupBy("a").agg(F.collect_list(F.struct("class", "low", "high", "out", "largest", "smallest")).alias("there"), F.sum("n").alias("n"))
        there = landed(there.withColumn("parts", F.ceil(F.col("n") / PART_SETS).cast("int")), "ngram-there")

        def limit(c, size="largest"):
            return self.limit(F.col("size_b"), c[size])

        def low(c):
            return F.when(c < NEAR, c).otherwise(NEAR + (c - NEAR) * CLASSES) * F.col("width")

        def partner(c):
            other = (c.low != F.col("root_b")) | (c.high != F.col("root_b"))
            near = (low(c["class"]) <= F.col("differ") + limit(c)) & (low(c["class"] + 1) > F.col("differ") - limit(c))
            return other & (F.col("outside") | c.out) & near

        def each_class(of):
            """The classes that keys know, and a value for each."""
            known = F.array_distinct(F.transform("partners", lambda c: F.least(c["class"], F.lit(NEAR))))
            return F.transform(known, lambda k: of(k, F.filter("partners", lambda c: F.least(c["class"], F.lit(NEAR)) == k)))

        able = spokes.join(there, "a").withColumn("partners", F.filter("there", partner)).filter(F.size("partners") > 0)
        return landed(able.select(
            "a", "b", "size_b", "differ", "root_b", "outside",
            each_class(lambda k, own: k).alias("classes"),
            each_class(lambda k, own: F.array_max(F.transform(own, lambda c: limit(c)))).alias("limits"),
            each_class(lambda k, own: F.array_min(F.transform(own, lambda c: limit(c, "smallest")))).alias("least_limits"),
            "width", "n", "parts",
            F.pmod(F.xxhash64("b"), "parts").cast("int").alias("part"),
        ), "ngram-able")

    def mixed(self, rows: DataFrame) -> DataFrame:
        """The meetings of several components, one of them not the centre's."""
        of = rows.groupBy("meeting").agg(F.min("root_b").alias("low"), F.max("root_b").alias("high"), F.bool_or("outside").alias("out"))
        return landed(rows.join(of.filter("low < high and out").select("meeting"), "meeting", "left_semi"), "ngram-meet")

    def possible(self, pairs: DataFrame) -> DataFrame:
        """Pairs (x, y) of sets of one centre that sizes and differences to it allow to link."""
        limit = self.limit(F.col("x.size_b"), F.col("y.size_b"))
        near = pairs.filter((F.abs(F.col("x.differ") - F.col("y.differ")) <= limit) & (F.col("x.root_b") != F.col("y.root_b")))
        return self.fits(near.select(F.col("x.b").alias("a"), F.col("y.b").alias("b"), F.col("x.size_b").alias("size_a"), F.col("y.size_b").alias("size_b")))

    def apart(self, rows: DataFrame) -> None:
        """Links between components, of sets whose differences to the centre they share allow them."""
        star = self.star(rows)
        self.fetch(_ends(star))
        differences = _differences(star, self.fragments)
        known = differences.select("a", "b", "size_a", "size_b", F.size("order").cast("long").alias("differ"))
        known = known.withColumn("shared", F.expr("(size_a + size_b - differ) div 2"))
        self.merge(known)
        known = self.mixed(landed(_meetings(differences, self.able(known)), "ngram-meetings"))
        # a star once more: what meets mostly belongs together
        y = F.struct("b", "size_b", "differ", "root_b")
        weights = known.groupBy("b").agg(F.count(F.lit(1)).alias("weight"))
        hubs = known.join(weights, "b").groupBy("meeting").agg(F.max(F.struct("weight", "b", "size_b", "differ", "root_b")).alias("x"))
        self.link(self.possible(known.select("meeting", y.alias("y")).join(hubs, "meeting")))
        # what is then still apart, pair by pair
        known = self.root(self.root(known.drop("root_b", "outside"), "a", "root_a"), "b", "root_b")
        known = self.mixed(known.withColumn("outside", F.col("root_a") != F.col("root_b")))
        each = known.select("meeting", y.alias("y"), "outside")
        left = each.filter("outside").select("meeting", F.col("y").alias("x"))
        self.link(self.possible(left.join(each, "meeting").filter("not outside or x.b < y.b")))

    def fetch(self, keys: DataFrame) -> None:
        """Have the fragments and sketches of some sets."""
        new = landed(keys.join(self.fragments.select("key"), "key", "left_anti"), "ngram-new")
        if not new.isEmpty():
            self.fragments = self.fragments.unionByName(_fragments(self.docs, self.index, new, self.n))

    def close(self, pairs: DataFrame) -> DataFrame:
        """Pairs that their sketches do not prove to be apart."""
        sketches = self.fragments.select("key", "sketch").filter("sketch is not null")
        both = pairs.join(sketches.select(F.col("key").alias("a"), F.col("sketch").alias("of_a")), "a").join(
            sketches.select(F.col("key").alias("b"), F.col("sketch").alias("of_b")), "b"
        )
        return both.filter(apart_by(F.col("of_a"), F.col("of_b")) <= self.limit(F.col("size_a"), F.col("size_b"))).select(*pairs.columns)

    def link(self, pairs: DataFrame, fetch: bool = False) -> None:
        """Components grow by the pairs that link; sketches spare most others the count.

        Later pairs are among the sets that the first ones have fetched.
        """
        pairs = landed(pairs.select("a", "b", "size_a", "size_b").distinct(), "ngram-pairs")
        if fetch:
            self.fetch(_ends(pairs))
        pairs = landed(self.close(pairs), "ngram-close")
        if not pairs.isEmpty():
            self.merge(landed(_counted(pairs, self.fragments), "ngram-counted"))

    def merge(self, counted: DataFrame) -> None:
        """Components that a pair (a, b, size_a, size_b, shared) links become one."""
        union = F.col("size_a") + F.col("size_b") - F.col("shared")
        links = counted.filter(F.col("shared") * 100 >= union * self.percent).select("a", "b")
        # only components are joined, so that a round costs what it finds
        ends = self.root(self.root(links, "a", "root_a"), "b", "root_b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
        ends = landed(ends.filter("a <> b").distinct(), "ngram-ends")
        if ends.isEmpty():
            return
        merged = components(ends)
        nodes = self.label.select("node").unionByName(links.select(F.col("a").alias("node"))).unionByName(links.select(F.col("b").alias("node")))
        was = self.root(nodes.distinct(), "node", "was")
        now = was.join(merged.select(F.col("node").alias("was"), "root"), "was", "left")
        self.label = landed(now.select("node", F.coalesce("root", "was").alias("root")), "ngram-labels")
