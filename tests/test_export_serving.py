"""Export: tolerant loading, union by name, numbers as text; serving figures."""

from __future__ import annotations

import os

import pytest

from kpiloom.operators import kpis
from kpiloom.operators.clean import clean_market
from kpiloom.operators.export import as_text_columns, unify_kpis
from kpiloom.operators.serving import revenue_share, serving_summary
from kpiloom.sinks import writers
from kpiloom.sources import kpi_store, testdata

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def frames(spark):
    clean = clean_market(testdata.market_raw(spark, SF_SMALL)).cache()
    return kpis.calculate_kpis(clean)


EXPECTED_ORDER = ["platform", "total_revenue_usd", "kpi_name", "genre", "avg_concurrent_players",
                  "avg_price_usd", "avg_discount_pct", "is_early_access", "avg_revenue_usd", "num_records",
                  "year_month", "monthly_revenue_usd"]


def test_unified_column_order_and_types(frames):
    unified = unify_kpis(frames)
    assert unified.columns == EXPECTED_ORDER
    assert all(t == "string" for _, t in unified.dtypes)
    counts = {r.kpi_name: r["count"] for r in unified.groupBy("kpi_name").count().collect()}
    assert set(counts) == set(kpis.KPIS)
    assert counts["kpi3_top_genres_ccu"] == 10


def test_money_text_never_scientific(spark):
    df = spark.createDataFrame([(12345678.92, 3, 7)], "v double, n int, b bigint")
    row = as_text_columns(df).first()
    assert (row.v, row.n, row.b) == ("12345678.92", "3", "7")
    assert as_text_columns(df, literal_cast=True).first().v == "1.234567892E7"


def test_missing_kpi_is_skipped_and_none_fails(spark, frames, tmp_dir):
    subset = {k: v for k, v in frames.items() if k != "kpi5_avg_price_platform"}
    paths = writers.write_kpis(subset, tmp_dir)
    paths["kpi5_avg_price_platform"] = os.path.join(tmp_dir, "kpi5_avg_price_platform")
    loaded = kpi_store.load_kpis(spark, paths)
    assert list(loaded) == [k for k in frames if k != "kpi5_avg_price_platform"]
    export = os.path.join(tmp_dir, "export")
    writers.write_csv_single(unify_kpis(loaded), export)
    csv_files = [f for f in os.listdir(export) if f.endswith(".csv")]
    assert len(csv_files) == 1
    back = kpi_store.read_export_csv(spark, export)
    assert back.filter("kpi_name = 'kpi1_revenue_platform'").count() == frames["kpi1_revenue_platform"].count()
    with pytest.raises(FileNotFoundError):
        kpi_store.load_kpis(spark, {"x": os.path.join(tmp_dir, "nope")})


def test_summary_and_share(spark, frames):
    k1 = frames["kpi1_revenue_platform"].collect()
    summary = serving_summary(frames["kpi1_revenue_platform"], frames["kpi2_revenue_genre"],
                              frames["kpi6_discount_rate"]).first()
    assert summary.top_platform == max(k1, key=lambda r: r.total_revenue_usd).platform
    assert summary.total_revenue_usd == pytest.approx(sum(r.total_revenue_usd for r in k1))
    assert summary.total_revenue_text.startswith("$") and summary.total_revenue_text.endswith("M")
    means = [r.avg_discount_pct for r in frames["kpi6_discount_rate"].collect()]
    assert summary.avg_discount_pct == pytest.approx(sum(means) / len(means), abs=0.006)
    shares = revenue_share(frames["kpi2_revenue_genre"]).collect()
    assert sum(r.revenue_share_pct for r in shares) == pytest.approx(100, abs=0.2)


def test_a_corrupt_kpi_is_skipped_by_the_export_and_ends_a_strict_load(spark, frames, tmp_dir):
    paths = writers.write_kpis({k: frames[k] for k in ("kpi1_revenue_platform", "kpi2_revenue_genre")}, tmp_dir)
    file = next(os.path.join(paths["kpi2_revenue_genre"], f) for f in os.listdir(paths["kpi2_revenue_genre"]) if f.endswith(".parquet"))
    with open(file, "r+b") as f:
        f.truncate(40)
    for name in os.listdir(paths["kpi2_revenue_genre"]):
        if name.endswith(".crc"):
            with open(os.path.join(paths["kpi2_revenue_genre"], name), "r+b") as f:
                f.write(b"x")
    assert list(kpi_store.load_kpis(spark, paths)) == ["kpi1_revenue_platform"]
    with pytest.raises(Exception, match="(?i)parquet|checksum|footer"):
        unify_kpis(kpi_store.load_kpis(spark, paths, strict=True)).collect()


def test_tables_are_written_with_snappy(spark, frames, tmp_dir):
    import pyarrow.parquet as pq

    path = writers.write_kpis({"kpi1_revenue_platform": frames["kpi1_revenue_platform"]}, tmp_dir)["kpi1_revenue_platform"]
    file = next(f for f in os.listdir(path) if f.endswith(".parquet"))
    assert pq.ParquetFile(os.path.join(path, file)).metadata.row_group(0).column(0).compression == "SNAPPY"


def test_a_tie_gives_the_first_name_and_large_numbers_stay_text(spark):
    one = spark.createDataFrame([("b", 5.0), ("a", 5.0), ("c", 1e19)], "platform string, total_revenue_usd double")
    two = spark.createDataFrame([("y", 7.0), ("x", 7.0)], "genre string, total_revenue_usd double")
    row = serving_summary(one.where("platform != 'c'"), two, spark.createDataFrame([], "platform string, avg_discount_pct double")).first()
    assert (row.top_platform, row.top_genre, row.avg_discount_pct) == ("a", "x", None)
    text = {r.platform: r.total_revenue_usd for r in as_text_columns(one.union(spark.createDataFrame([("d", float("inf"))], one.schema))).collect()}
    assert text == {"a": "5.00", "b": "5.00", "c": "10000000000000000000.00", "d": "Infinity"}
    assert revenue_share(one).count() == 3
