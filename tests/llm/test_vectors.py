from __future__ import annotations

import numpy as np
import pytest

from wattledger.llm import cover_tree as C

SCHEMA = "vec_id long, embedding array<float>, label int, node long, copies long"


def _brute(rows):
    good = []
    for i, (vec_id, x, label) in enumerate(rows):
        if x and label is not None and all(v is not None and np.isfinite(v) for v in x) and any(x):
            v = np.array(x, np.float32).astype(float)
            good.append((i, label, v / np.linalg.norm(v)))
    up, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, (i, li, x) in enumerate(good):
        for j, lj, y in good[:a]:
            if li == lj and len(x) == len(y) and x @ y >= C.THRESHOLD:
                links[i] += 1
                links[j] += 1
                p, q = find(i), find(j)
                up[max(p, q)] = min(p, q)
    ids: dict[int, list] = {}
    for i, r in enumerate(rows):
        ids.setdefault(find(i), []).append(r[0])
    low = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return [(r[0], links[i], low[find(i)], r[0] == low[find(i)]) for i, r in enumerate(rows)]


def _rows(n, dim=8):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(n):
        x = rng.normal(size=dim)
        if i and rng.random() < 0.6:
            near = [r for r in rows if r[2] == i % 3]
            if near:
                x = np.array(near[rng.integers(len(near))][1]) + rng.normal(size=dim) * rng.choice([0, 0.05, 0.12, 0.2])
        rows.append((i, [float(np.float32(v)) for v in x], i % 3))
    inf, nan = float("inf"), float("nan")
    rows += [(n, None, 1), (n + 1, [], 1), (n + 2, [0.0] * dim, 1), (n + 3, [nan] * dim, 1), (n + 4, [inf] * dim, 1)]
    rows += [(n + 5, rows[0][1], None), (n + 6, [None] * dim, 0), (n + 7, [1.0, 2.0], 0), (n + 8, [2.0, 4.0], 0)]
    rows += [rows[3], (None, rows[4][1], rows[4][2]), (None, None, None)]
    return rows


@pytest.mark.parametrize("cell", [1500, 25])
def test_links_against_all_pairs(spark, monkeypatch, cell):
    monkeypatch.setattr(C, "CELL", cell)
    rows = _rows(400)
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)
    key = lambda x: tuple((v is None, v or 0) for v in x)
    got = sorted(map(tuple, C.near_vectors(df).collect()), key=key)
    assert got == sorted(_brute(rows), key=key)


def test_empty_table(spark):
    assert C.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("n, other", [(1, 1), (40, 3), (900, 500)])
def test_traversal_loses_no_pair(n, other):
    rng = np.random.default_rng(n)
    x = C.unit(rng.normal(size=(n, 16)))
    y = C.unit(np.vstack([x[: other // 2], x[: other - other // 2] + rng.normal(size=(other - other // 2, 16)) * 0.04]))
    got = {tuple(p) for p in C.close_pairs(C.CoverTree(x, 0.1), C.CoverTree(y, 0.1), 0.2)}
    assert {tuple(p) for p in np.argwhere(C.apart(x, y) <= 0.2)} <= got
    for tree in (C.CoverTree(x, 0.1),):
        for above, below in zip(tree.levels, tree.levels[1:]):
            assert set(above.centres) <= set(below.centres)
