"""A platform holding a third or more of all rows is split over several tasks and files."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from kpiloom.operators import kpis
from kpiloom.operators.clean import clean_market
from kpiloom.sinks.writers import write_curated
from kpiloom.sources import testdata
from kpiloom.sources.market import read_curated

from conftest import SF_ORACLE


def test_hot_platform_is_split_on_write_and_totals_hold(spark, tmp_dir):
    clean = clean_market(testdata.market_raw(spark, SF_ORACLE))
    # Every row whose player count is not divisible by 3 goes to one platform: about 2/3 of all rows.
    skewed = clean.withColumn(
        "platform", F.when(F.col("concurrent_players") % 3 != 0, F.lit("HOT")).otherwise(F.col("platform")))
    path, rows = os.path.join(tmp_dir, "curated"), os.path.join(tmp_dir, "rows")
    # A partition is split between map tasks, and the small table is one of them: four files are four.
    skewed.repartition(4).write.parquet(rows)
    previous = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        write_curated(spark.read.parquet(rows), path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", previous)
    hot_files = [f for f in os.listdir(os.path.join(path, "platform=HOT")) if f.endswith(".parquet")]
    assert len(hot_files) > 1
    back = read_curated(spark, path)
    assert back.count() == skewed.count()
    got = {r.platform: r.total_revenue_usd for r in kpis.KPIS["kpi1_revenue_platform"](back).collect()}
    want = {r.platform: r.total_revenue_usd for r in kpis.KPIS["kpi1_revenue_platform"](skewed).collect()}
    assert got == want
