"""The one-pass KPI tables equal the per-KPI DataFrame and SQL definitions; batch job outputs."""

from __future__ import annotations

import os

import pytest

from kpiloom.operators import kpis
from kpiloom.operators.clean import clean_market
from kpiloom.plans.kpis_sql import SQL_KPIS, run_sql_kpi
from kpiloom.plans.shared_scan import all_kpis
from kpiloom.sources import testdata
from jobs.batch import run_batch

from conftest import SF_SMALL


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def clean(spark):
    return clean_market(testdata.market_raw(spark, SF_SMALL)).cache()


@pytest.mark.parametrize("materialize", [False, True])
def test_one_pass_equals_individual(spark, clean, materialize):
    batch, sql = all_kpis(clean, materialize=materialize)
    assert list(batch) == list(kpis.KPIS) and sorted(sql) == sorted(SQL_KPIS)
    for name, fn in kpis.KPIS.items():
        expected = fn(clean)
        assert batch[name].columns == expected.columns, name
        assert bag(batch[name]) == bag(expected), name
    for name in SQL_KPIS:
        expected = run_sql_kpi(spark, name, clean)
        assert sql[name].columns == expected.columns, name
        assert bag(sql[name]) == bag(expected), name


def test_sorted_outputs_keep_order(spark, clean):
    batch, _ = all_kpis(clean)
    totals = [r.total_revenue_usd for r in batch["kpi1_revenue_platform"].collect()]
    assert totals == sorted(totals, reverse=True)
    months = [r.year_month for r in batch["kpi8_monthly_trend"].collect()]
    assert months == sorted(months, key=lambda m: (m is not None, m))


def test_batch_job_outputs(spark, tmp_dir):
    paths = run_batch(spark, tmp_dir, sf_dir=SF_SMALL)
    assert sorted(os.listdir(paths["kpis"])) == sorted(kpis.KPIS)
    assert sorted(os.listdir(paths["kpis_sql"])) == sorted(SQL_KPIS)
    curated = spark.read.parquet(paths["curated"])
    assert curated.count() == paths["clean_rows"] == 5751
    assert curated.columns[-1] == "platform"
    export = spark.read.option("header", True).csv(paths["export"])
    assert export.select("kpi_name").distinct().count() == 8
