from __future__ import annotations

import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from batchlake.llm import licences as lc

NOTICES = {
    "Released under the MIT License.": "mit",
    "licensed under the apache license version 2.0": "apache-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "gpl",
    "Licensed under CC BY-NC 4.0.": "cc-by-nc",
    "Licensed under CC BY 4.0.": "cc-by",
    "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.": "bsd",
    "subject to the terms of the Mozilla Public License, v. 2.0.": "mpl-2.0",
}
OTHERS = [
    "My driver's license was lost and the MIT lab gave permission.",
    "The general public may apply for a license in version three of the form.",
    "licence " * 3000,
    "Copyright holders met in Apache country.",
    "plain words",
    "",
]


@pytest.fixture(scope="module")
def model(spark):
    words = [" ".join(f"w{(i * 7 + j) % 50}" for j in range(12)) for i in range(80)]
    return lc.train(spark.createDataFrame(list(enumerate(words)), "doc_id long, text string"))


def test_families_and_unknown(spark, model):
    rows = [(i, f"before\n{text}\nafter", "x") for i, text in enumerate([*NOTICES, *OTHERS])]
    rows += [(100, None, "x"), (None, "\n".join(NOTICES), "x"), (0, "Released under the MIT License.", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, families string")
    got = lc.with_licences(docs, model, [F.col("doc_id")]).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got if r.doc_id != 0}
    for i, family in list(enumerate(NOTICES.values()))[1:]:
        assert [(x.paragraph, x.family) for x in by_id[i].licences] == [(1, family)], family
    assert all(not by_id[i].licences for i in range(len(NOTICES), len(NOTICES) + len(OTHERS)))
    assert by_id[None].families == sorted(set(NOTICES.values()))
    assert by_id[100].n_paragraphs == 0 and by_id[100].families == []


STEMLESS = {
    "Distributed under the GNU GPL, version 2 or later.": "gpl",
    "Available under CC BY-SA 4.0.": "cc-by",
    "Released under Apache-2.0.": "apache-2.0",
    "Released under CC0 1.0 Universal.": "public-domain",
    "Dual MIT/Apache-2.0": "apache-2.0",
    "This file is subject to the terms of the MPL, v. 2.0.": "mpl-2.0",
}
WRAPPED = "This program is free software: you can redistribute it\nand/or modify it under the terms of the GNU General\nPublic License as published by the Free Software Foundation"


def test_notices_without_a_stem_and_wrapped_ones(spark, model):
    texts = [*STEMLESS, f"a\n\n{WRAPPED}\n\nb", "Licensed under the\nApache License,\nVersion 2.0.\n \nplain"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in lc.with_licences(docs, model, [F.col("doc_id")]).collect()}
    assert {texts[i]: r.families for i, r in got.items()} == dict(zip(texts, [[f] for f in [*STEMLESS.values(), "gpl", "apache-2.0"]]))
    assert 2 <= got[len(STEMLESS)].licences[0].paragraph <= 4 and got[len(STEMLESS)].n_paragraphs == 7


def test_the_gate_skips_nothing_that_can_be_known(spark, sf_dir, model, monkeypatch):
    given = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(60).collect()]
    texts = [*STEMLESS, *NOTICES, *OTHERS, *lc.NO_NOTICES, *(t for ts in lc.TEMPLATES.values() for t in ts), *given]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    gated = sorted(lc.with_licences(docs, model, [F.col("doc_id")]).collect())
    assert lc.gate(model)
    monkeypatch.setattr(lc, "gate", lambda model: None)
    assert gated == sorted(lc.with_licences(docs, model, [F.col("doc_id")]).collect())


def grams(text):
    w = re.findall(r"[a-z0-9]+(?:[.'-][a-z0-9]+)*", text.lower())
    return {" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)}


def plain_verdict(text, model):
    """(family, probability) of a paragraph by a plain logistic model and the templates, or None."""
    own = grams(text)
    scores = list(model["constants"])
    for gram, weights in model["weights"].items():
        if gram in own:
            scores = [a + b for a, b in zip(scores, weights)]
    powers = [math.exp((s - max(scores)) / model["temperature"]) for s in scores]
    likely = max(powers) / sum(powers)
    family = model["classes"][powers.index(max(powers))]
    if family == lc.UNKNOWN or likely < model["cut"]:
        return None
    shown = [grams(t) for t in lc.TEMPLATES[family]]
    if any(len(t & own) >= min(len(t), len(own)) * lc.LEAST_OVERLAP for t in shown):
        return family, round(likely, 6)
    return None


def plain(text, model):
    """All findings of a text: its lines, and its blocks of which no line says the same."""
    lines = text.split("\n")
    found = {i: v for i, line in enumerate(lines) if (v := plain_verdict(line, model))}
    out = [(i, *v) for i, v in found.items()]
    first = None
    for i, line in enumerate([*lines, ""]):
        if re.search(r"[^ \t\n\x0b\f\r]", line):
            first = i if first is None else first
        elif first is not None:
            v = plain_verdict(" ".join(lines[first:i]), model) if i - first > 1 else None
            if v and v[0] not in [found[j][0] for j in range(first, i) if j in found]:
                out.append((first, *v))
            first = None
    return sorted(out)


def test_equals_a_plain_scorer(spark, sf_dir, model):
    """Line by line, block by block: the tables' texts, notices cut and mixed with other words, odd spacing."""
    given = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(50).collect()]
    rng = random.Random(4)
    known = [t for ts in lc.TEMPLATES.values() for t in ts] + [*STEMLESS, *NOTICES]
    other = [w for t in lc.NO_NOTICES for w in t.split()]
    mixed = []
    for _ in range(150):
        words = rng.choice(known).split()
        at = rng.randrange(len(words))
        words[at : at + rng.randrange(3)] = rng.choices(other, k=rng.randrange(3))
        mixed.append("".join(w + rng.choice([" "] * 9 + ["\n", "\n", " \n\t\n"]) for w in words))
    texts = [*given, *known, *lc.NO_NOTICES, *mixed, *("\n".join(rng.choices(mixed, k=4)) for _ in range(40)), "", "\n", " \n\n\r\n x", *OTHERS]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.licences for r in lc.with_licences(docs, model, [F.col("doc_id")]).collect()}
    n = 0
    for i, text in enumerate(texts):
        want = plain(text, model)
        n += len(want)
        assert [(x.paragraph, x.family) for x in got[i]] == [w[:2] for w in want], text
        assert [x.probability for x in got[i]] == pytest.approx([w[2] for w in want], abs=2e-6)
    assert n > 100


def test_long_varied_paragraph_and_many_blocks(spark, model):
    """Neither 20,000 different words of notices in one line nor 5,000 blocks take more than linear time."""
    words = [w for ts in lc.TEMPLATES.values() for t in ts for w in t.split()]
    rng = random.Random(1)
    line = " ".join(rng.choice(words) + rng.choice(["", "", str(rng.randrange(999))]) for _ in range(20_000))
    blocks = "\n\n".join(["Released under the MIT License.\nplain words"] * 5000)
    docs = spark.createDataFrame([(1, line), (2, blocks)], "doc_id long, text string")
    began = time.time()
    got = {r.doc_id: r for r in lc.with_licences(docs, model, [F.col("doc_id")]).collect()}
    assert time.time() - began < 60
    assert [(x.paragraph, x.family) for x in got[1].licences] == [w[:2] for w in plain(line, model)]
    assert [x.paragraph for x in got[2].licences] == list(range(0, 15_000, 3)) and got[2].families == ["mit"]


def test_calibration(model):
    """The cut and the temperature come from held-out paragraphs, with their errors."""
    held = model["held_out"]
    assert model["temperature"] in lc.TEMPERATURES and model["cut"] >= lc.LEAST_CUT
    assert held["notices"] >= 20 and held["unknown"] >= 20
    assert held["missed"] <= 0.2 * held["notices"] and held["false"] <= 0.01 * held["unknown"] + 1


def test_held_out_lines_of_the_tables(spark, sf_dir):
    """All licence lines of the given documents are found, and nothing else."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = lc.with_licences(docs, lc.train(docs), [F.col("doc_id")]).collect()
    marks = {"Apache License": "apache-2.0", "MIT License": "mit", "GNU General": "gpl", "CC BY-NC": "cc-by-nc"}
    want = {r.doc_id: sorted(f for m, f in marks.items() if m in r.text) for r in docs.collect()}
    assert {r.doc_id: r.families for r in got} == want and any(want.values())


def test_native_and_empty(spark, model):
    docs = spark.createDataFrame([], "doc_id long, text string")
    out = lc.with_licences(docs, model, [F.col("doc_id")])
    assert "Python" not in out._jdf.queryExecution().toString() and out.count() == 0
