from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from kpiloom.llm import mixing
from tests.llm.conftest import documents


def filled(sizes: dict, weights: dict, cap: int) -> dict:
    """The fixed point by repetition: clamp what is above its cap, share the rest again."""
    clamped, total = {}, sum(sizes.values())
    while True:
        rest = total - sum(clamped.values())
        open_ = {s: w for s, w in weights.items() if s not in clamped}
        got = {s: rest * w / sum(open_.values()) for s, w in open_.items()}
        above = {s: cap * sizes[s] for s in got if got[s] > cap * sizes[s]}
        if not above:
            return clamped | got
        clamped |= above


def test_targets_and_repetitions_against_the_fixed_point(spark, rng):
    sources = [rng.choice(["a", "b", "c", "d", "e", None]) for _ in range(900)]
    sources = ["b" if s == "c" and rng.random() < 0.9 else s for s in sources]
    texts = ["x " * rng.randint(0, 30) + "\x1fy\x0bz" for _ in sources]
    out = mixing.mix(documents(spark, texts, sources)).collect()
    assert len(out) == 900
    sizes = {}
    for s, t in zip(sources, texts, strict=True):
        sizes[s] = sizes.get(s, 0) + len(re.findall(mixing.WORD, t))
    order = sorted((s for s in sizes if s is not None)) + [None]
    goal = filled(sizes, {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}, 3)
    taken = dict.fromkeys(sizes, 0)
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source])
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        taken[r.source] += r.taken
    assert any(goal[s] == 3 * sizes[s] for s in goal)
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= 32
    assert out_of(mixing.mix(documents(spark, texts, sources))) == out_of_rows(out)


def out_of(df):
    return out_of_rows(df.collect())


def out_of_rows(rows):
    return sorted((r.doc_id, r.taken) for r in rows)


def test_nulls_repeated_rows_clashing_columns_and_no_rows(spark):
    docs = documents(spark, [None, "", "a b", "a b", "w " * 50_000], ["s", "s", None, None, "t"], ids=[1, 2, 3, 3, None]).withColumns({"target": F.lit("x"), "bucket": F.lit(1)})
    got = mixing.mix(docs).collect()
    assert sorted(r["size"] for r in got) == [0, 0, 2, 2, 50_000] and sum(r.taken for r in got if not r["size"]) == 0
    assert mixing.mix(docs.limit(0)).collect() == []
    assert {r.taken for r in mixing.mix(documents(spark, ["", None], ["s", "t"])).collect()} == {0}
