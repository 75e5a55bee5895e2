"""Physical-plan properties: pushdown, pruning, partial aggregation, top-k."""

from __future__ import annotations

import os
import re

import pytest

from kpiloom.operators import kpis
from kpiloom.operators.clean import clean_market
from kpiloom.sinks import writers
from kpiloom.sources import testdata
from kpiloom.sources.market import read_curated

from conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def curated_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("curated") / "c")
    writers.write_curated(clean_market(testdata.market_raw(spark, SF_SMALL)), path)
    return path


def test_curated_layout(curated_path):
    parts = [d for d in os.listdir(curated_path) if d.startswith("platform=")]
    assert len(parts) == 6


def test_revenue_filter_and_pruning_reach_scan(spark, curated_path):
    df = kpis.KPIS["kpi1_revenue_platform"](clean_market(read_curated(spark, curated_path)))
    text = formatted(df)
    assert "PushedFilters: [IsNotNull(estimated_revenue_usd), GreaterThan(estimated_revenue_usd,0.0)" in text
    read_schema = [ln for ln in text.splitlines() if "ReadSchema" in ln][0]
    assert "estimated_revenue_usd" in read_schema
    for unused in ("concurrent_players", "hype_score", "current_price_usd", "discount_pc", "holiday_sale"):
        assert unused not in read_schema


def test_partition_pruning(spark, curated_path):
    some = sorted(d.split("=", 1)[1] for d in os.listdir(curated_path) if d.startswith("platform="))[:1]
    df = kpis.KPIS["kpi1_revenue_platform"](clean_market(read_curated(spark, curated_path, platforms=some)))
    text = formatted(df)
    assert "PartitionFilters: [isnotnull(platform" in text
    assert [r.platform for r in df.collect()] == some


def test_partial_aggregation_before_shuffle(spark, curated_path):
    df = kpis.KPIS["kpi7_early_vs_full"](clean_market(read_curated(spark, curated_path)))
    text = formatted(df)
    assert "partial_sum" in text and "partial_count" in text


def test_top_k_is_take_ordered(spark, curated_path):
    df = kpis.KPIS["kpi3_top_genres_ccu"](clean_market(read_curated(spark, curated_path)))
    assert "TakeOrderedAndProject" in formatted(df)


def test_one_pass_plan_has_one_scan_and_one_exchange(spark, curated_path):
    from kpiloom.plans.shared_scan import kpi_pass

    text = formatted(kpi_pass(read_curated(spark, curated_path)))
    operators = [ln.split(" ", 1)[1].strip() for ln in text.splitlines() if re.match(r"^\(\d+\) ", ln)]
    assert operators.count("Scan parquet") == 1
    assert operators.count("Expand") == 1
    assert operators.count("Exchange") == 1
    read_schema = [ln for ln in text.splitlines() if "ReadSchema" in ln][0]
    for unused in ("hype_score", "holiday_sale"):
        assert unused not in read_schema


def test_export_reads_only_the_materialized_aggregate(spark, curated_path):
    from kpiloom.operators.export import unify_kpis
    from kpiloom.plans.shared_scan import all_kpis

    batch, _ = all_kpis(read_curated(spark, curated_path), materialize=True)
    text = formatted(unify_kpis(batch))
    assert curated_path not in text
    assert "rangepartitioning" not in text


def test_no_query_over_market_rows_reads_orders(spark):
    from kpiloom.plans.catalog import catalog

    for name in ("market_clean", "kpi1_revenue_platform", "kpi7_early_vs_full", "sql_kpi8_monthly_trend", "ml_training_set"):
        assert "orders.parquet" not in formatted(catalog()[name](spark, SF_SMALL))


def test_share_computes_its_own_measures_only(spark, curated_path):
    from kpiloom.plans.kpi_spec import kpi_pass

    df = kpi_pass(read_curated(spark, curated_path), ["kpi2_revenue_genre"], sql_form=False)
    assert df.columns == ["__genre", "rollup_genre", "sum_estimated_revenue_usd_2"]


def test_measures_are_typed_once_below_the_expansion(spark, curated_path):
    """No value is cast in an expanded row: casts to the decimal of the sums stand below Expand only."""
    from kpiloom.plans.shared_scan import kpi_pass

    tree = kpi_pass(read_curated(spark, curated_path))._jdf.queryExecution().sparkPlan().toString()
    above, _, below = tree.partition("Expand")
    assert "decimal(28,8)" not in above.replace(" ", "").lower().replace("sum(", "") or "try_cast" not in above.lower()
    assert "cast(estimated_revenue_usd" not in above.replace("try_", "") and "decimal(28,8)" in below.lower()


def test_split_reads_its_tables_once(spark):
    from kpiloom.plans.catalog import catalog

    text = formatted(catalog()["ml_split"](spark, SF_SMALL))
    assert text.count("Scan parquet") == 2 * 2  # lineitem and part, each in the tree and in the details
    assert "Union" not in text
