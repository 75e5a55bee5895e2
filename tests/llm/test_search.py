from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiloom.llm import search

SCHEMA = "vec_id long, embedding array<float>, label int"


def table_of(spark, x, ids=None):
    return spark.createDataFrame([(int(i), [float(np.float32(c)) for c in v], 0) for i, v in zip(range(len(x)) if ids is None else ids, x, strict=True)], SCHEMA)


def brute(x, ids, k):
    x = x.astype(np.float32).astype(np.float64)
    out = {}
    for q in np.flatnonzero(ids % search.EVERY == 0):
        score = np.einsum("ij,ij->i", np.broadcast_to(x[q], x.shape), x)
        others = np.flatnonzero(np.arange(len(x)) != q)
        out[int(ids[q])] = [(int(ids[j]), score[j]) for j in sorted(others, key=lambda j: (-score[j], ids[j]))[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


@pytest.mark.parametrize(("n", "width", "shard", "leaf"), [(700, 16, 200, 16), (90, 5, 8192, 256), (15, 3, 8192, 256)])
def test_factor_one_is_the_exact_search(spark, monkeypatch, n, width, shard, leaf):
    monkeypatch.setattr(search, "SHARD", shard)
    monkeypatch.setattr(search, "LEAF", leaf)
    monkeypatch.setattr(search, "BLOCK", 16)
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, width)) * rng.uniform(0.1, 4, (n, 1))
    x[n // 2:n // 2 + n // 5] = x[3]  # more copies than results: ties go to the smaller vec_id
    ids = rng.permutation(n)
    got, want = found(search.neighbours(table_of(spark, x, ids), F.col("vec_id") % search.EVERY == 0, factor=1.0)), brute(x, ids, search.K)
    assert {q: [i for i, _ in r] for q, r in got.items()} == {q: [i for i, _ in r] for q, r in want.items()}
    assert all(np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12) for q in want)


def test_recall_on_the_small_table(spark):
    d = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{d}/embeddings.parquet").collect()
    got = found(search.query(spark, d))
    want = brute(np.array([r.embedding for r in rows]), np.array([r.vec_id for r in rows]), search.K)
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / search.K for q in want]
    assert np.mean(hits) >= 0.95


def test_large_factors_leave_out_more_but_stay_mostly_right(monkeypatch):
    monkeypatch.setattr(search, "LEAF", 32)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 8))
    largest = float((x * x).sum(axis=1).max())
    order, nodes, ranges = search.tree_of(search.lengthened(x, largest))
    where = np.argsort(order)
    nodes[:, 3] = np.where(nodes[:, 3] >= 0, where[nodes[:, 3]], -1)
    tree = {"ids": order, "rows": order, "vectors": x[order], "nodes": nodes, "ranges": ranges}
    queries = np.arange(0, 3000, 20)
    true = np.sort(x[queries] @ x.T - 1e9 * (queries[:, None] == np.arange(3000)), axis=1)[:, :-21:-1]
    recall = []
    for factor in (1.0, 2.0, 8.0):
        got = search.searched(tree, x[queries], queries, np.full(len(queries), -np.inf), 20, factor, largest)
        recall.append((got.score >= true[:, -1:] - 1e-9).mean())
    assert recall[0] == 1.0 and recall[0] >= recall[1] >= recall[2] and recall[1] > 0.9


def test_odd_vectors_repeated_ids_clashing_columns_and_no_rows(spark):
    rows = [(0, [1.0, 0.0], 0), (0, [2.0, 0.0], 0), (1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [None, 1.0], 0), (5, [float("nan"), 1.0], 0), (None, [1.0, 1.0], 0), (7, [1.0, 1.0, 1.0], 0), (20, [-1.0, 1.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"row": F.lit(1), "shard": F.lit(0), "rank": F.lit(0)})
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in search.neighbours(df, F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 0, 2.0), (0, 1, 0, 2.0), (0, 2, 20, -2.0), (0, 2, 20, -1.0), (20, 1, 0, -1.0), (20, 2, 0, -2.0)]
    assert search.neighbours(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []
