from __future__ import annotations

import base64
import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from batchlake.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, "rb") as f:
        return bpe.Encoder(bpe.Vocabulary.parse(f.read()), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(n: int) -> list[str]:
    rnd = random.Random(3)
    alphabet = "aabbeθé'st \n\t1290!?中文re'llABC　\U0001f600"
    return ["".join(rnd.choices(alphabet, k=rnd.randint(0, 60))) for _ in range(n)]


def test_ids_are_those_of_the_library(encoder, library):
    for text in [*texts(600), "ab" * 5000, "<|endoftext|>", " " * 300, "1" * 999]:
        packed = encoder.encode(text)
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == library.encode_ordinary(text)
        assert encoder.decode(packed) == text.encode()


def test_appends_and_edits_of_a_table(encoder):
    rnd, v = random.Random(4), encoder.vocabulary
    for _ in range(200):
        data = bytes(rnd.choices(b"abcdtheinrs \xc3\xa9", k=rnd.randint(0, 120)))
        table = bpe.PrefixTable(v, data[:40]).append(data[40:])
        assert table.last == bpe.PrefixTable(v, data).last
        a = rnd.randint(0, len(data))
        b = rnd.randint(a, len(data))
        table.replace(a, b, b"then")
        assert table.last == bpe.PrefixTable(v, data[:a] + b"then" + data[b:]).last
    long = bpe.PrefixTable(v, b"the inner rest " * 2000)
    assert long.replace(100, 103, b"x") < 500


def test_appends_and_edits_of_a_text(encoder):
    rnd = random.Random(5)
    for text in texts(300):
        own = bpe.EncodedText(encoder, text)
        a = rnd.randint(0, len(text))
        b = rnd.randint(a, len(text))
        new = "".join(rnd.choices("ab' \nr1", k=rnd.randint(0, 6)))
        own.replace(a, b, new)
        own.append("e's")
        assert own.packed() == encoder.encode(text[:a] + new + text[b:] + "e's")
    assert bpe.EncodedText(encoder, "word " * 5000).replace(9000, 9003, "q") < 12


def test_rows(spark, library):
    rows = [(1, "Some téxt", "a"), (2, None, "a"), (3, "", "a"), (None, "x" * 50_000, "a"), (1, "Some téxt", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = bpe.encoded(docs, F.col("text"), PATH, public_tokenizers.PATTERN, ["doc_id"]).collect()
    want = []
    for i, text, _ in rows:
        ids = library.encode_ordinary(text or "")
        digests = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()
        want.append((i, len(ids), *digests, ids))
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)
