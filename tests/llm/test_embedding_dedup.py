from __future__ import annotations

import numpy as np
import pytest

import brute
from batchlake.llm import embedding_dedup as ed


def rows_of(seed: int, n: int = 260, d: int = 16) -> list:
    rnd = np.random.default_rng(seed)
    base = rnd.normal(size=(n, d))
    for i in range(0, n, 3):
        base[i] = base[i // 2] + rnd.normal(size=d) * rnd.choice([0, 0.05, 0.2])
    rows = [(i, [float(x) for x in np.float32(v)], int(rnd.integers(0, 2))) for i, v in enumerate(base)]
    odd = [None, [], [0.0] * d, [None] + [1.0] * (d - 1), [float("nan")] * d, [float("inf")] * d, [1.0] * (d + 1), [2.0] * (d + 1), [1e-30] * d]
    rows += [(n + i, v, 1) for i, v in enumerate(odd)] + [(n + 50, rows[0][1], None), (n + 51, rows[0][1], rows[0][2])]
    return rows + [(None, rows[0][1], rows[0][2])]


@pytest.mark.parametrize("small", [False, True])
def test_links_equal_brute_force(spark, monkeypatch, small):
    if small:  # many cells, many blocks
        monkeypatch.setattr(ed, "CELL_ROWS", 20)
        monkeypatch.setattr(ed, "BLOCK_ROWS", 7)
    rows = rows_of(5)
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in ed.near_duplicates(docs, 0.93).collect()}
    good = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and None not in v and np.isfinite(v).all() and any(v):
            good[i] = (label, ed.unit(np.array([v], float))[0])
    ids = sorted(good)
    links = [
        (a, b) for a in range(len(ids)) for b in range(a + 1, len(ids))
        if good[ids[a]][0] == good[ids[b]][0] and len(good[ids[a]][1]) == len(good[ids[b]][1])
        and good[ids[a]][1] @ good[ids[b]][1] >= 0.93
    ]
    root = brute.components(len(ids), links)
    count = np.bincount(np.array(links).ravel(), minlength=len(ids))
    want = {i: (0, i, True) for i, *_ in rows if i is not None} | {None: (0, None, False)}
    want |= {i: (int(count[k]), ids[root[k]], root[k] == k) for k, i in enumerate(ids)}
    assert got == want
    assert len(links) > 30


def test_neighbours_across_cells_are_found():
    rnd = np.random.default_rng(3)
    units = ed.unit(rnd.normal(size=(3000, 64)))
    near = ed.unit(units * 0.94 + rnd.normal(size=units.shape) * 0.34 / 8)
    close = np.einsum("ij,ij->i", units, near) >= 0.93
    centres = ed.spherical_kmeans(units, 24)
    a, b = ed.cells_of(units, centres, 0.93), ed.cells_of(near, centres, 0.93)
    met = [x[0] in y or y[0] in x for x, y in zip(a, b)]
    assert close.sum() > 300
    assert np.mean(np.array(met)[close]) >= 0.999


@pytest.mark.parametrize(("d", "power"), [(64, 0.0), (64, 0.7), (64, 1.2), (256, 0.7), (256, 1.2)])
def test_no_neighbour_of_uneven_vectors_is_lost(d, power):
    rnd = np.random.default_rng(11)
    spectrum = np.arange(1, d + 1) ** -power
    raw = rnd.normal(size=(6000, d)) * spectrum
    turn = rnd.normal(size=raw.shape) * spectrum
    turn *= (np.linalg.norm(raw, axis=1) / np.linalg.norm(turn, axis=1))[:, None]
    units, near = ed.unit(raw), ed.unit(raw + turn * rnd.uniform(0.3, 0.42, size=(len(raw), 1)))
    # the worst direction: straight over to another centre
    centres = ed.spherical_kmeans(units, 16)
    dots = units @ centres.T
    over = centres[np.argsort(-dots, axis=1)[:, 1]] - centres[np.argmax(dots, axis=1)]
    over -= np.einsum("ij,ij->i", over, units)[:, None] * units
    straight = 0.9301 * units + np.sqrt(1 - 0.9301**2) * ed.unit(over)
    both = np.concatenate((near, straight))
    reach = np.minimum(ed.reach_of(units, centres), ed.reach_of(both, centres))
    close = np.einsum("ij,ij->i", np.concatenate((units, units)), both) >= 0.93
    for bound in (), (reach,):
        a, b = ed.cells_of(units, centres, 0.93, *bound), ed.cells_of(both, centres, 0.93, *bound)
        met = np.array([x[0] in y or y[0] in x for x, y in zip([*a, *a], b)])
        assert met[close].all() and close.sum() > 6000


def test_empty(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int, key string")
    assert ed.near_duplicates(none).count() == 0
