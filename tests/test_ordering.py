"""Positions in a global order against Python's sort; no window over all rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from kpiloom.operators.ordering import positioned
from kpiloom.plans.catalog import kpi_positions
from kpiloom.plans.kpi_spec import KPI_SPECS, sql_name

from conftest import SF_SMALL


@pytest.mark.parametrize("partitions", [None, 1, 7])
def test_positions_against_sort(spark, partitions):
    rng = random.Random(4)
    rows = [(rng.choice("aab"), rng.choice([None, *range(40)]), k) for k in range(900)]
    df = spark.createDataFrame(rows, "g string, v int, id int").repartition(5)
    key = lambda r: (r[1] is None, -(r[1] or 0), r[2])
    got = {r.id: r.position for r in positioned(df, [F.desc_nulls_last("v"), F.asc("id")], partitions=partitions).collect()}
    assert got == {r[2]: k for k, r in enumerate(sorted(rows, key=key), 1)}
    within = {r.id: r.place for r in positioned(df, [F.desc_nulls_last("v"), F.asc("id")], ("g",), "place", partitions).collect()}
    want = {}
    for g in "ab":
        want |= {r[2]: k for k, r in enumerate(sorted((r for r in rows if r[0] == g), key=key), 1)}
    assert within == want


def test_ties_null_groups_and_no_rows(spark):
    df = spark.createDataFrame([(None, 1)] * 3 + [("x", 1)] * 2 + [("x", None)], "g string, v int")
    rows = sorted((r.g or "", r.v or 0, r.position) for r in positioned(df, [F.asc("v")], ("g",)).collect())
    assert rows == [("", 1, 1), ("", 1, 2), ("", 1, 3), ("x", 0, 1), ("x", 1, 2), ("x", 1, 3)]
    assert positioned(df.limit(0), [F.asc("v")], ("g",)).collect() == []


def test_rows_are_spread_and_no_window_is_planned(spark):
    df = spark.range(100_000).withColumn("v", F.lit(1))
    out = positioned(df, [F.asc("v")], partitions=8)  # one value only: the hash of the row deals it
    assert "Window" not in out._jdf.queryExecution().toString() and out.agg(F.min("position"), F.max("position"), F.countDistinct("position")).first()[:] == (1, 100_000, 100_000)


def test_every_kpi_table_has_positions(spark):
    rows = kpi_positions(spark, SF_SMALL).collect()
    assert {r.kpi_name for r in rows} == {*KPI_SPECS, *map(sql_name, KPI_SPECS)}
    for name in {r.kpi_name for r in rows}:
        own = sorted((r for r in rows if r.kpi_name == name), key=lambda r: r.position)
        assert [r.position for r in own] == list(range(1, len(own) + 1))
        values = [r.value for r in own if r.value is not None]
        assert values == sorted(values, reverse=True)
