from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiloom.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold):
    good = [k for k, (i, v, lab) in enumerate(rows) if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    unit = {k: np.array(rows[k][1], np.float64) / np.linalg.norm(np.array(rows[k][1], np.float64)) for k in good}
    n, root = [0] * len(rows), list(range(len(rows)))
    for a in good:
        for b in good:
            if a < b and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                n[a] += 1
                n[b] += 1
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    least = {}
    for k, (i, _, _) in enumerate(rows):
        least[root[k]] = min(least.get(root[k], i), i) if i is not None and least.get(root[k], i) is not None else least.get(root[k], i)
    return sorted((i, n[k], least[root[k]]) for k, (i, _, _) in enumerate(rows) if i is not None)


def vectors(seed, n, width=64, labels=3):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 6, width))
    out = [base[rng.integers(len(base))] * rng.uniform(0.1, 9) + rng.normal(size=width) * rng.choice([0, 0.1, 0.14, 0.2, 1.0]) for _ in range(n)]
    return [(int(i), [float(np.float32(x)) for x in v], int(rng.integers(labels))) for i, v in zip(rng.permutation(n * 2), out, strict=False)]


@pytest.mark.parametrize(("n", "width", "tile"), [(400, 64, 32), (300, 20, 1024), (150, 7, 8)])
def test_links_against_all_pairs(spark, monkeypatch, n, width, tile):
    monkeypatch.setattr(embeddings, "TILE", tile)
    rows = vectors(n, n, width)
    got = embeddings.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute(rows, 0.98)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_early_stops_leave_out_no_pair():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 40))
    x[150:] = x[:150] + rng.normal(size=(150, 40)) * rng.uniform(0, 0.4, (150, 1))
    rotation = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    unit = embeddings.scaled(x)
    for threshold in (0.5, 0.9, 0.98, 1 - 1e-12):
        got = set(zip(*map(np.ndarray.tolist, embeddings.close_pairs(x, x, rotation, threshold)), strict=True))
        assert got == set(zip(*np.nonzero(np.einsum("ik,jk->ij", unit, unit) >= threshold), strict=True)) or threshold > 0.99


def test_odd_vectors_copies_clashing_columns_and_no_rows(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "TILE", 8)
    one = [1.0, 2.0, 3.0]
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0, 0.0], 0), (4, [1.0, None, 0.0], 0), (5, [float("nan"), 1.0, 1.0], 0), (6, [float("inf"), 1.0, 1.0], 0),
            (7, one, None), (None, one, 0), (9, [1.0, 2.0], 0), (10, [1e30, 2e30, 3e30], 0), (11, [1e-30, 2e-30, 3e-30], 0), (12, one, 1)] + [(20 + k, one, 0) for k in range(60)] + [(20, one, 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"row": F.lit(1), "tile": F.lit("x"), "node": F.lit(0)})
    got = {}
    for r in embeddings.near_vectors(df).collect():
        got.setdefault(r.vec_id, []).append((r.n_links, r.component_id, r.kept))
    assert got[None] == [(0, None, None)] and got[20] == [(62, 10, False)] * 2 and got[10] == [(62, 10, True)] and got[11] == [(62, 10, False)]
    assert all(got[i] == [(0, i, True)] for i in (1, 2, 3, 4, 5, 6, 7, 9, 12))
    assert embeddings.near_vectors(df.limit(0)).collect() == []
