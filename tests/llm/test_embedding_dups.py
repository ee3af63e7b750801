import math
import random

import numpy as np
import pytest

from scoreloom.llm import embedding_dups as ed


def brute(rows, cosine=ed.COSINE):
    good = {}
    for r, (_, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, float)
            good[r] = (label, x / np.abs(x).max())
    near = {r: [] for r in range(len(rows))}
    for a, (la, x) in good.items():
        for b, (lb, y) in good.items():
            if a != b and la == lb and len(x) == len(y) and (x @ y) / math.sqrt((x @ x) * (y @ y)) >= cosine:
                near[a].append(b)
    out = []
    for r in range(len(rows)):
        seen, todo = {r}, [r]
        while todo:
            new = [b for b in near[todo.pop()] if b not in seen]
            seen.update(new)
            todo += new
        ids = [rows[s][0] for s in seen if rows[s][0] is not None]
        least = min(ids) if ids else None
        out.append((rows[r][0], len(near[r]), least, rows[r][0] is not None and rows[r][0] == least))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, key string, links int")
    return sorted(map(tuple, ed.classes(df).collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rnd = np.random.default_rng(4)
    out = []
    for i in range(60):
        x = rnd.normal(size=24)
        out.append(x)
        out += [x + rnd.normal(size=24) * s for s in (0.02, 0.15, 0.2, 0.21)]
    walk = rnd.normal(size=24)
    for _ in range(40):  # a chain: neighbours link, ends do not
        walk = walk + rnd.normal(size=24) * 0.12
        out.append(walk)
    rows = [(i, x.tolist(), int(i % 7 == 0)) for i, x in enumerate(out)]
    x = out[0].tolist()
    rows += [(1000, x, None), (1001, None, 1), (1002, [], 1), (1003, [0.0] * 24, 1), (1004, [None, *x[1:]], 1), (1005, [math.nan, *x[1:]], 1),
             (1006, [math.inf, *x[1:]], 1), (1007, [v * 1e-200 for v in x], 1), (1008, [v * 1e200 for v in x], 1), (1009, x[:23], 1),
             (1010, [3.0], 1), (1011, [0.5], 1), (1012, [-1.0], 1), (0, x, 1), (None, x, 1), (None, [5.0, 1.0], 1)]
    return rows + [(2000 + i, x, 1) for i in range(30)]


@pytest.mark.parametrize("tile", [ed.TILE, 7])
def test_against_brute_force(spark, rows, tile, monkeypatch):
    monkeypatch.setattr(ed, "TILE", tile)
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_rotation_keeps_distances_row_by_row():
    x = np.random.default_rng(1).normal(size=(50, 37))
    turned = ed.rotate(ed.unit(x))
    assert turned.shape == (50, 64)
    assert np.allclose(turned @ turned.T, ed.unit(x) @ ed.unit(x).T)
    assert all((ed.rotate(ed.unit(x[i:i + 1]))[0] == turned[i]).all() for i in range(50))


def test_blocks_find_what_the_budget_allows():
    rnd = random.Random(2)
    for dim in (1, 3, 8, 64, 100):
        x = np.array([[rnd.gauss(0, 1) for _ in range(dim)]])
        y = x + np.array([[rnd.gauss(0, 0.05) for _ in range(dim)]])
        a, b = ed.rotate(ed.unit(x)), ed.rotate(ed.unit(y))
        blocks, share = ed.share(dim, ed.COSINE)
        parts = np.square(a - b).reshape(blocks, ed.BLOCK).sum(axis=1)
        assert parts.sum() > 2 - 2 * ed.COSINE or parts.min() <= share + ed.SLACK
