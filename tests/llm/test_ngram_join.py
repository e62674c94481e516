from __future__ import annotations

import random

import numpy as np
import pytest

import brute
from batchlake.llm import ngram_join as nj
from batchlake.llm.components import components


def corpus(seed: int) -> list:
    """Texts around a few bases, edited a little or a lot, with copies and shared lines."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    common = " ".join(rnd.choices(words, k=9))
    texts: list = ["", None, "one", "ONE", "two words", " \t\n", "Été été a b c d"]
    for _ in range(6):
        base = rnd.choices(words, k=rnd.choice([6, 12, 40, 90, 150]))
        for _ in range(14):
            own = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 5])):
                own[rnd.randrange(len(own))] = rnd.choice(words)
            texts.append(" ".join(own))
    texts += [common + " " + " ".join(rnd.choices(words, k=rnd.choice([2, 8, 60]))) for _ in range(20)]
    texts.append(" ".join(rnd.choices(words, k=6000)))
    texts.append("same " * 500)
    rnd.shuffle(texts)
    return texts


@pytest.mark.parametrize(("seed", "n", "percent", "hot"), [(1, 4, 85, 64), (2, 5, 80, 1), (3, 2, 70, 3)])
def test_groups_equal_brute_force(spark, monkeypatch, seed, n, percent, hot):
    if hot == 1:  # every repeated segment is salted, texts are dealt by a shuffle
        monkeypatch.setattr(nj, "BROADCAST_TEXTS", 0)
    texts = corpus(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nj.similar_documents(docs, n, percent, hot).collect()}
    root = brute.components(len(texts), brute.jaccard_links(texts, n, percent))
    assert got == {i: (len(brute.shingles(t, n)), root[i]) for i, t in enumerate(texts)}
    assert len(set(root)) < len(texts) - 20


def around_a_centre(percent: int, n: int, group: int) -> list[str]:
    """Centre, two near copies of it, and sets just outside that link with the copies only."""
    size = 200 if percent == 85 else 100
    centre = [f"g{group}c{i}" for i in range(size + n - 1)]
    texts = [centre, centre[1:], centre[:-1]]
    lost = {85: (17, 16), 80: (12, 11)}[percent]  # shingles that the outer set lacks and adds
    for other in range(2):
        cut = lost[0] + (group + other) % 2
        texts.append(centre[: len(centre) - cut] + [f"g{group}o{other}x{i}" for i in range(lost[1])])
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80)])
def test_sets_outside_a_group_link_with_near_copies_of_its_centre(spark, n, percent):
    texts = [t for group in range(12) for t in around_a_centre(percent, n, group)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in nj.similar_documents(docs, n, percent).collect()}
    links = brute.jaccard_links(texts, n, percent)
    assert got == dict(enumerate(brute.components(len(texts), links)))
    assert any(j % 5 >= 3 and i % 5 == 2 and (i - 2, j) not in links for i, j in links)


@pytest.mark.parametrize("percent", [85, 80])
@pytest.mark.parametrize("bounded", [False, True])
def test_links_meet_on_their_differences_to_a_centre(percent, bounded):
    """Triples of a centre, a near copy and a set farther off: every link has a common key."""
    rnd = random.Random(percent)
    links = signs = 0
    for _ in range(3000):
        size = rnd.randrange(20, 260)
        centre = np.arange(1, size + 1)
        p, q = 100 - percent, 100 + percent
        width = max(2 * size * p // q // nj.CLASSES, 1)

        def off(differ):
            gone = rnd.randint(0, min(differ, size // 2))
            pool = np.arange(size + 1, size + 1 + 2 * (differ - gone))
            kept = np.setdiff1d(centre, centre[max(size - 3 * gone, 0) :][rnd.sample(range(min(3 * gone, size)), gone)] if gone else centre[:0])
            return np.concatenate((kept, rnd.sample(list(pool), differ - gone))).astype(np.uint64)

        centre = centre.astype(np.uint64)
        x, y = off(rnd.randint(1, 3 * width)), off(rnd.randint(4 * width, 9 * width))
        shared = len(np.intersect1d(x, y))
        if 100 * shared < percent * (len(x) + len(y) - shared):
            continue
        links += 1
        differ = [len(np.setxor1d(s, centre)) for s in (x, y)]
        slack = rnd.randint(0, 3)  # another set of the class is larger or smaller
        keys, common = [], rnd.sample(list(range(1, 2 * size)), rnd.choice([0, size // 2]))
        common = np.array(common, np.uint64)
        for own, other, at in ((x, y, 1), (y, x, 0)):
            most = [(len(own) + len(other) + slack) * p // q]
            sure = [(len(own) + len(other) - slack) * p // q] if bounded else None
            keys.append(nj.difference_keys(nj.difference(own, centre), [nj.class_of(differ[at], width)], most, width, sure, common))
        signs += len(keys[0]) != len(keys[1])
        assert len(np.intersect1d(*keys)), (size, differ, shared)
    assert links > 100 and signs > 20


def test_one_row_of_each_group_stays(spark):
    base = " ".join(f"w{i}" for i in range(60))
    back = " ".join(base.split()[::-1])
    rows = [
        (3, base, "a"), (3, base, "a"), (5, base + " x", "b"), (None, base + " y", "c"), (None, "a lone text", "d"),
        (7, "", "e"), (7, "", "e"), (8, None, "f"), (9, "one", "g"), (9, "one", "g"), (10, back, "h"), (2, back + " q", "i"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, size string")
    kept = nj.representatives(docs, 5, 80)
    assert kept.columns == docs.columns
    names = sorted(r["size"] for r in kept.collect())
    assert names == ["a", "d", "e", "e", "f", "g", "i"]
    empty = docs.limit(0)
    assert nj.similar_documents(empty).count() == 0
    assert nj.representatives(empty).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}
    assert got == want


def test_words_are_those_of_the_contract():
    texts = ["A b c\x0bd \x1fe", "x" * 100_000 + " y", "İI"]
    for text, tokens in zip(texts, nj.Shingler(1)([t.encode() for t in texts])):
        assert len(tokens) == len(brute.shingles(text, 1))


def test_sketches_never_part_sets_that_link(spark):
    """The bound holds for sets of any sizes, and is sharp for sets that share nothing."""
    rnd = random.Random(2)
    rows = []
    for _ in range(300):
        size = rnd.choice([1, 2, 31, 32, 33, 64, 65, 200, 600])
        a = np.unique(np.array([rnd.getrandbits(64) for _ in range(size)], np.uint64))
        kept = a[[rnd.random() < 0.9 for _ in a]]
        b = np.unique(np.concatenate((kept, np.array([rnd.getrandbits(64) for _ in range(rnd.randrange(0, size // 4 + 2))], np.uint64))))
        other = np.array([rnd.getrandbits(64) for _ in range(len(a))], np.uint64)
        for x, y in ((a, b), (a, other)):
            if len(y):
                rows.append((nj.sketch(x).view(np.int64).tolist(), nj.sketch(y).view(np.int64).tolist(), len(np.setxor1d(x, y)), len(x)))
    frame = spark.createDataFrame(rows, "a array<long>, b array<long>, differ int, size int")
    got = frame.select(nj.apart_by(frame.a, frame.b).alias("least"), "differ", "size").collect()
    assert all(r.least <= r.differ for r in got)
    assert all(r.least > 0.3 * r.differ for r in got if r["size"] >= 64 and r.differ == 2 * r["size"])


def test_small_segments_of_unlinked_sets_are_settled_at_once(spark, monkeypatch):
    """Sets that share a long passage, but do not link, need no keys of their differences to a centre."""
    compared, apart = [], []
    settled = nj._Join.settle_small
    monkeypatch.setattr(nj._Join, "settle_small", lambda self, rows: compared.append(rows.count()) or settled(self, rows))
    monkeypatch.setattr(nj._Join, "apart", lambda self, rows: apart.append(rows.count()))
    texts = []
    for group in range(6):
        shared = [f"g{group}s{i}" for i in range(120)]
        texts += [" ".join(shared + [f"g{group}o{own}x{i}" for i in range(24)]) for own in range(6)]
        texts.append(" ".join([*shared, *texts[-1].split()[120:], "more"]))  # one of them with a near copy
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in nj.similar_documents(docs, 4, 85).collect()}
    assert got == dict(enumerate(brute.components(len(texts), brute.jaccard_links(texts, 4, 85))))
    assert sum(compared) > 0 and not apart
