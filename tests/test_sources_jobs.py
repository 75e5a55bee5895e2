"""Sources' edge paths and the batch job driven by a raw CSV file."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from jobs.batch import run_batch
from kpiloom.functions.casting import iso_timestamp_text
from kpiloom.plans.kpis_sql import run_sql_kpi
from kpiloom.sources.events import read_event_stream
from kpiloom.sources.market import read_market_csv, register_curated_view

from test_clean_and_kpis import CSV


def test_event_stream_arguments(spark):
    with pytest.raises(ValueError):
        read_event_stream(spark, kafka_bootstrap="host:9092")
    with pytest.raises(ValueError):
        read_event_stream(spark)


def test_view_over_dataframe_applies_revenue_filter(spark):
    df = spark.createDataFrame([("PC", 1, 10.0, 2.0), ("PC", 1, -5.0, 4.0)],
                               "platform string, is_on_sale int, estimated_revenue_usd double, discount_pc double")
    view = register_curated_view(spark, df, "market_curated_test")
    row = run_sql_kpi(spark, "sql_kpi6_discount_rate", view).first()
    assert (row.platform, row.avg_discount_pct, row.juegos_en_oferta, row.revenue_en_oferta) == ("PC", 2.0, 1, 10.0)


def test_inferred_csv_schema_is_opt_in(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text(CSV)
    assert all(t == "string" for _, t in read_market_csv(spark, str(path)).dtypes)
    inferred = dict(read_market_csv(spark, str(path), infer_schema=True).dtypes)
    assert inferred["is_on_sale"] == "int"


def test_timestamp_text(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5, 6),)], "ts timestamp_ntz")
    assert df.select(iso_timestamp_text(F.col("ts"))).first()[0] == "2024-01-02T03:04:05.000006"


def test_batch_job_from_csv(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(CSV)
    out = str(tmp_path / "out")
    paths = run_batch(spark, out, input_csv=str(path))
    kpi1 = {r.platform: r.total_revenue_usd for r in spark.read.parquet(f"{paths['kpis']}/kpi1_revenue_platform").collect()}
    assert kpi1 == {"PlayStation 5": 12345678.92, "PC": 1000.25, "Mobile": 27.5}
    kpi7 = sorted((r.release_type, r.num_registros)
                  for r in spark.read.parquet(f"{paths['kpis_sql']}/sql_kpi7_early_vs_full").collect())
    assert kpi7 == [("Early Access", 1), ("Full Release", 1), ("Full Release", 2)]
    exported = [f for f in os.listdir(paths["export"]) if f.endswith(".csv")]
    assert len(exported) == 1
    text = open(os.path.join(paths["export"], exported[0])).read()
    assert "12345678.92" in text and "E7" not in text


def test_serving_job_outputs(spark, tmp_path):
    from jobs.serve import run_serving
    from conftest import SF_SMALL

    paths = run_batch(spark, str(tmp_path / "b"), sf_dir=SF_SMALL)
    out = str(tmp_path / "serve")
    run_serving(spark, paths["kpis"], out)
    summary = spark.read.option("header", True).csv(f"{out}/summary").first()
    assert summary.total_revenue_text.startswith("$") and summary.total_revenue_text.endswith("M")
    share = spark.read.option("header", True).csv(f"{out}/revenue_share_genre")
    assert abs(sum(float(r.revenue_share_pct) for r in share.collect()) - 100) < 0.3
    assert all(r.total_revenue_usd_text.startswith("$") for r in share.collect())
    charts = sorted(os.listdir(f"{out}/charts"))
    assert len(charts) == 8
    totals = [float(r.total_revenue_usd) for r in
              spark.read.option("header", True).csv(f"{out}/charts/kpi1_revenue_platform").collect()]
    assert totals == sorted(totals)


def test_sql_kpi_job_over_curated_folder(spark, tmp_path):
    from jobs.sql_kpis import run_sql_kpis
    from conftest import SF_SMALL
    from kpiloom.plans.kpis_sql import SQL_KPIS

    paths = run_batch(spark, str(tmp_path / "b"), sf_dir=SF_SMALL)
    written = run_sql_kpis(spark, paths["curated"], str(tmp_path / "sql"))
    assert sorted(written) == sorted(SQL_KPIS)
    for name in SQL_KPIS:
        a = sorted(tuple(r) for r in spark.read.parquet(written[name]).collect())
        b = sorted(tuple(r) for r in spark.read.parquet(f"{paths['kpis_sql']}/{name}").collect())
        assert a == b, name
