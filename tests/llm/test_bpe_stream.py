from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from batchlake.llm import bpe_stream as bs
from batchlake.llm.catalog import MERGES, QUERIES

PATH = public_tokenizers.path(MERGES)
LIBRARY = Tokenizer.from_file(PATH)
with open(PATH, "rb") as file:
    WHOLE = bs.Merges.parse(file.read())


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def streamed(text, size):
    return [int(i) for ids in bs.Encoder(WHOLE).stream(bs.chunked(text, size)) for i in ids.split(",")]


def toy(pairs):
    """A merge list over the bytes a, b, c; pairs by their strings."""
    ids = {"a": 0, "b": 1, "c": 2}
    for a, b in pairs:
        ids[a + b] = len(ids)
    return bs.Merges({i: t.encode() for t, i in ids.items()}, [(ids[a], ids[b]) for a, b in pairs], [ids[a + b] for a, b in pairs])


PARTS = st.lists(st.sampled_from([*"aehrst'  \n\t\x85　.,!=-019éñ日<|>", "<|endoftext|>", "'re", "ÃÂ"]), max_size=60).map("".join)


@given(PARTS, st.integers(1, 30))
@settings(max_examples=300, deadline=None)
def test_chunks_of_any_size_equal_the_library(text, size):
    assert streamed(text, size) == ids_of(text)


@pytest.mark.parametrize("unit", ["=", "-", " ", "a", "ab", "aab", "é", "\n", "ÃÂ", "7", "　", " \n", "日本語", "'re", "<|endoftext|>"])
def test_very_long_pieces(unit, monkeypatch):
    monkeypatch.setattr(bs, "LONG", 64)
    rng = random.Random(unit)
    for _ in range(5):
        text = unit * rng.randrange(200, 4000) + rng.choice(["", "x", " ", "\n"]) + "".join(rng.choices("abcé", k=rng.randrange(3000)))
        assert streamed(text, rng.randrange(70, 400)) == ids_of(text)


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), min_size=1, max_size=14), st.text("abc", max_size=120))
@settings(max_examples=300, deadline=None)
def test_lookahead_of_any_merge_list_is_enough(picks, text):
    """What stands so many bytes ahead of the end stays, whatever follows."""
    made, pairs = ["a", "b", "c"], []
    for i, j in picks:
        a, b = made[i % len(made)], made[j % len(made)]
        if a + b not in made:
            made.append(a + b)
            pairs.append((a, b))
    merges, data = toy(pairs), text.encode()
    whole = merges.merged(data)
    transducer, out = bs.Transducer(merges), []
    transducer.window = merges.lookahead + merges.longest
    for at in range(0, len(data), 3):
        out += transducer.feed(data[at : at + 3])
        assert len(transducer.held) < transducer.window + 3
    assert out + transducer.finish() == whole
    assert merges._by_list([merges.single[b] for b in data]) == merges._by_heap([merges.single[b] for b in data])


def test_lookahead_of_a_chain():
    """Whether a meets b hangs on whether b meets c, which hangs on the next b."""
    assert toy([]).lookahead == 0
    assert toy([("a", "b")]).lookahead == 1
    assert toy([("c", "c"), ("b", "c"), ("a", "b")]).lookahead == 3
    assert toy([("a", "b"), ("b", "c")]).lookahead == 1


def test_memory_is_bounded():
    transducer = bs.Transducer(WHOLE)
    for _ in range(300):
        transducer.feed(b"abcab" * 100)
        assert len(transducer.held) < transducer.window
    scanner = bs.Scanner()
    for _ in range(50):
        scanner.feed("x" * 5000, False)
        assert len(scanner.rest) <= bs.LONG + 5000


@given(st.lists(st.integers(0, 50256), max_size=40), st.integers(0, 40))
@settings(max_examples=300, deadline=None)
def test_decoding_in_parts_equals_the_library(ids, cut):
    decoder = bs.Decoder(WHOLE)
    parts = [",".join(map(str, x)) for x in (ids[:cut], ids[cut:])]
    assert "".join(map(decoder.feed, parts)) + decoder.finish() == LIBRARY.decode(ids, skip_special_tokens=False)


def test_query_equals_the_library(spark, sf_dir):
    rows = {r.doc_id: r for r in QUERIES["op12_bpe_stream"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for doc in docs:
        ids = ids_of(doc.text)
        back = LIBRARY.decode(ids, skip_special_tokens=False)
        row = rows[doc.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_edge_rows(spark):
    """Nulls and empty texts have no tokens; repeated rows stay; other columns do not clash; long texts."""
    texts = [(1, None), (2, ""), (3, "a<|endoftext|>b"), (3, "a<|endoftext|>b"), (None, "x" * 300_000), (5, "\x00 ﻿")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("n_tokens", F.lit("mine")).withColumn("token_ids", F.lit(7))
    rows = bs.encoded(docs, F.col("text"), PATH, ["doc_id"]).collect()
    assert [(r.doc_id, r.token_ids) for r in rows] == [(i, ids_of(t)) for i, t in texts]
    assert rows[0].n_tokens == 0 and rows[0].ids_sha256 == rows[0].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    back = bs.decoded(bs.encoded(docs, F.col("text"), PATH, ["doc_id"]), F.col("token_ids"), PATH, ["doc_id"]).collect()
    assert [r.text for r in back] == [t or "" for _, t in texts]
    assert bs.encoded(docs.limit(0), F.col("text"), PATH, ["doc_id"]).collect() == []


def test_other_models_are_refused():
    with pytest.raises(ValueError, match="not a plain"):
        with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as file:
            bs.Merges.parse(file.read())
    with pytest.raises(ValueError, match="made once"):
        bs.Merges({0: b"a", 1: b"aa", 2: b"aaa"}, [(0, 1), (0, 0)], [2, 1])
