"""Cleaning and KPIs on hand-written CSV rows with hand-computed results."""

from __future__ import annotations

import datetime as dt

import pytest

from kpiloom.operators import kpis
from kpiloom.operators.clean import clean_market
from kpiloom.plans.kpis_sql import run_sql_kpi
from kpiloom.sources.market import read_market_csv

CSV = """obs_date,platform,genre,current_price_usd,discount_pc,is_on_sale,concurrent_players,hype_score,estimated_revenue_usd,is_early_access,holiday_sale
2024-01-05,PC,RPG,10.50,0.0,0,100,1.5,1000.25,0,1
2024-02-05,PlayStation 5,RPG,9.00,10,1,300000,2,12345678.92,1,0
2024-02-06,,RPG,9.00,10,1,300000,2,10.00,0,0
2024-02-07,Mobile,,9.00,10,1,300000,2,10.00,0,0
2024-02-08,Mobile,Puzzle,9.00,10,1,3,2,0,0,0
2024-02-08,Mobile,Puzzle,9.00,10,1,3,2,-5,0,0
2024-02-09,Mobile,Puzzle,9.00,10,1,3,2,,0,0
2024-02-09,Mobile,Puzzle,9.00,10,1,3,2,NaN,0,0
2024-02-10,Mobile,Puzzle,9.00,10,1,3,2,abc,0,0
2024-03-08,Mobile,Puzzle,,,1,,2,7.50,,0
bad-date,Mobile,RPG,5.00,0.0,0,3000000000,1.0,20.00,0,0
"""


@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("csv") / "market.csv"
    path.write_text(CSV)
    return clean_market(read_market_csv(spark, str(path))).cache()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_cleaning_keeps_expected_rows(clean):
    got = {(r.platform, r.estimated_revenue_usd) for r in clean.collect()}
    assert got == {("PC", 1000.25), ("PlayStation 5", 12345678.92), ("Mobile", 7.5), ("Mobile", 20.0)}
    bad = clean.filter("estimated_revenue_usd = 20.0").first()
    assert bad.obs_date is None and bad.year_month is None and bad.concurrent_players is None
    first = clean.filter("platform = 'PC'").first()
    assert first.obs_date == dt.date(2024, 1, 5) and first.year_month == "2024-01"
    assert clean.columns[-1] == "year_month"


def test_kpi1(clean):
    assert rows(kpis.KPIS["kpi1_revenue_platform"](clean)) == rows_of(
        [("PlayStation 5", 12345678.92), ("PC", 1000.25), ("Mobile", 27.5)])
    # sorted descending
    assert [r.platform for r in kpis.KPIS["kpi1_revenue_platform"](clean).collect()] == ["PlayStation 5", "PC", "Mobile"]


def rows_of(items):
    return sorted(items, key=repr)


def test_kpi4(clean):
    assert rows(kpis.KPIS["kpi4_avg_ccu_platform"](clean)) == rows_of(
        [("PlayStation 5", 300000.0), ("PC", 100.0), ("Mobile", None)])


def test_kpi6(clean):
    assert rows(kpis.KPIS["kpi6_discount_rate"](clean)) == rows_of([("PlayStation 5", 10.0), ("Mobile", None)])


def test_kpi7(clean):
    assert rows(kpis.KPIS["kpi7_early_vs_full"](clean)) == rows_of(
        [(0, 510.13, 1020.25, 2), (1, 12345678.92, 12345678.92, 1), (None, 7.5, 7.5, 1)])


def test_kpi7_sql_groups_by_flag(clean, spark):
    labels = sorted(r.release_type for r in run_sql_kpi(spark, "sql_kpi7_early_vs_full", clean).collect())
    assert labels == ["Early Access", "Full Release", "Full Release"]


def test_kpi8_nulls_first(clean):
    got = [tuple(r) for r in kpis.KPIS["kpi8_monthly_trend"](clean).collect()]
    assert got == [(None, 20.0), ("2024-01", 1000.25), ("2024-02", 12345678.92), ("2024-03", 7.5)]


def test_kpi3_limit_and_tie_break(spark):
    df = spark.createDataFrame(
        [(f"g{i:02d}", 100 if i < 12 else i) for i in range(15)],
        "genre string, concurrent_players int")
    got = [r.genre for r in kpis.KPIS["kpi3_top_genres_ccu"](df).collect()]
    assert got == [f"g{i:02d}" for i in range(10)]


def test_money_sum_is_exact(spark):
    df = spark.createDataFrame([("a", 0.1)] * 10 + [("a", 1.005)], "platform string, estimated_revenue_usd double")
    # 10 × 0.10 + 1.005 (→ 1.01 as cents, half-up) = 2.01 exactly
    assert kpis.KPIS["kpi1_revenue_platform"](df).first().total_revenue_usd == 2.01


def test_batch_and_sql_kpis_agree(clean, spark):
    pairs = {
        "kpi1_revenue_platform": ("sql_kpi1_revenue_platform", ["platform", "total_revenue_usd"]),
        "kpi2_revenue_genre": ("sql_kpi2_revenue_genre", ["genre", "total_revenue_usd"]),
        "kpi3_top_genres_ccu": ("sql_kpi3_top_genres_ccu", ["genre", "avg_concurrent_players"]),
        "kpi4_avg_ccu_platform": ("sql_kpi4_avg_ccu_platform", ["platform", "avg_concurrent_players"]),
        "kpi5_avg_price_platform": ("sql_kpi5_avg_price_platform", ["platform", "avg_price_usd"]),
        "kpi6_discount_rate": ("sql_kpi6_discount_rate", ["platform", "avg_discount_pct"]),
        "kpi7_early_vs_full": ("sql_kpi7_early_vs_full", ["avg_revenue_usd", "total_revenue_usd"]),
        "kpi8_monthly_trend": ("sql_kpi8_monthly_trend", ["year_month", "monthly_revenue_usd"]),
    }
    for name, (sql_name, cols) in pairs.items():
        batch = rows(kpis.KPIS[name](clean).select(*cols))
        sql = rows(run_sql_kpi(spark, sql_name, clean).select(*cols))
        assert batch == sql, name


def test_empty_input_gives_empty_kpis_and_null_summary(spark, clean):
    from kpiloom.operators.export import unify_kpis
    from kpiloom.operators.serving import serving_summary
    from kpiloom.plans.shared_scan import all_kpis

    empty = clean.filter("estimated_revenue_usd < 0")
    batch, sql = all_kpis(empty)
    assert all(df.count() == 0 for df in (*batch.values(), *sql.values()))
    assert unify_kpis(batch).count() == 0
    row = serving_summary(batch["kpi1_revenue_platform"], batch["kpi2_revenue_genre"],
                          batch["kpi6_discount_rate"]).collect()
    assert len(row) == 1 and row[0].total_revenue_usd is None and row[0].top_platform is None


def test_short_and_long_csv_rows(spark, tmp_path):
    text = CSV.splitlines()[0] + "\n" + "2024-01-05,PC,RPG,10.50\n" + "2024-01-05,PC,RPG,1,0,0,5,1,9.99,0,0,extra\n"
    path = tmp_path / "ragged.csv"
    path.write_text(text)
    rows = clean_market(read_market_csv(spark, str(path))).collect()
    # The short row has no revenue and is dropped; the long row keeps its first eleven fields.
    assert [(r.platform, r.estimated_revenue_usd, r.concurrent_players) for r in rows] == [("PC", 9.99, 5)]


def test_columns_are_found_by_header(spark, tmp_path):
    path = tmp_path / "other.csv"
    path.write_text("note,estimated_revenue_usd,genre,platform,obs_date,is_on_sale,discount_pc,concurrent_players,hype_score,current_price_usd,holiday_sale,is_early_access,more\n"
                    "n,9.99,RPG,PC,2024-01-06 00:00:00,1.0,10.0,1500.0,3.5,8.99,0.0,1.0,x\n"
                    "n,5,RPG,PC,soon,no,1,1500.7,1,1,1,,y\n")
    one, two = sorted(clean_market(read_market_csv(spark, str(path))).collect(), key=lambda r: -r.estimated_revenue_usd)
    assert (one.platform, one.year_month, one.is_on_sale, one.concurrent_players, one.is_early_access) == ("PC", "2024-01", 1, 1500, 1)
    assert (two.obs_date, two.is_on_sale, two.concurrent_players, two.is_early_access) == (None, None, 1500, None)


def test_a_file_without_a_needed_column_is_refused(spark, tmp_path):
    path = tmp_path / "less.csv"
    path.write_text("platform,genre\nPC,RPG\n")
    with pytest.raises(ValueError, match="no column obs_date"):
        read_market_csv(spark, str(path))


@pytest.mark.parametrize(("values", "total", "average"), [
    ([0.004] * 1000 + [2.344] * 1000, 2348.0, 1.17), ([0.004] * 1000, 4.0, 0.0), ([2e16, 1.25], 20000000000000001.25, 1e16),
    ([130000000000000.57, 0.01], 130000000000000.58, 65000000000000.29), ([5.0, float("inf")], float("inf"), float("inf")), ([9e18] * 4, 3.6e19, 9e18), ([3e25, 1.0], 3e25, 1.5e25)])
def test_no_amount_is_cut_and_total_and_average_agree(spark, values, total, average):
    df = spark.createDataFrame([(1, "PC", v) for v in values], "is_early_access int, platform string, estimated_revenue_usd double")
    row = kpis.KPIS["kpi7_early_vs_full"](df).first()
    assert row.total_revenue_usd == pytest.approx(total, rel=1e-15) and row.avg_revenue_usd == pytest.approx(average, rel=1e-15) and row.num_records == len(values)
    assert run_sql_kpi(spark, "sql_kpi1_revenue_platform", df).first().total_revenue_usd == row.total_revenue_usd


def test_kpi_tables_are_in_their_order(spark, clean):
    for name, column, down in (("kpi2_revenue_genre", "total_revenue_usd", True), ("kpi5_avg_price_platform", "avg_price_usd", True), ("kpi8_monthly_trend", "year_month", False)):
        for df in (kpis.KPIS[name](clean), run_sql_kpi(spark, f"sql_{name}", clean)):
            got = [r[column] for r in df.collect() if r[column] is not None]
            assert got == sorted(got, reverse=down)
