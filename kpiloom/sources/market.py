"""Market sources: raw CSV landing zone, curated Parquet, SQL view."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.schemas import CURATED_SCHEMA, MARKET_COLUMNS

CURATED_VIEW = "market_curated"


def read_market_csv(spark: SparkSession, path: str, infer_schema: bool = False) -> DataFrame:
    """Raw market CSV with a header.

    Columns are found by the names in the header, in any order; others are
    ignored, and a file that lacks one is refused. Every column is text, typed
    by ``clean_market``: that avoids the extra full pass that schema inference
    costs and makes a bad cell a NULL instead of turning the column into text.
    ``infer_schema=True`` reproduces inference for ad-hoc files.
    """
    df = spark.read.option("header", True).option("mode", "PERMISSIVE").option("inferSchema", infer_schema).csv(path)
    missing = [c for c in MARKET_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; its header has {', '.join(df.columns)}")
    return df.select(*MARKET_COLUMNS)


def read_curated(spark: SparkSession, path: str, platforms: Iterable[str] | None = None) -> DataFrame:
    """Curated Parquet partitioned by platform.

    The schema is declared, so no footer-inference job runs and a platform
    name that looks like a number stays text (partition-value type inference
    would turn it into an integer). Passing ``platforms`` adds a filter on
    the partition column, which Spark turns into directory pruning
    (``PartitionFilters`` in the scan).
    """
    df = spark.read.schema(CURATED_SCHEMA).parquet(path)
    if platforms is not None:
        df = df.filter(F.col("platform").isin(list(platforms)))
    return df


def curated_view_sql(path: str, view: str = CURATED_VIEW) -> str:
    """SQL text of the curated view over a Parquet folder (positive revenue only)."""
    return (f"CREATE OR REPLACE TEMPORARY VIEW {view} AS "
            f"SELECT * FROM parquet.`{path}` WHERE estimated_revenue_usd > 0")


def register_curated_view(spark: SparkSession, source: str | DataFrame, view: str = CURATED_VIEW) -> str:
    """Register the curated view over a Parquet folder or an existing DataFrame."""
    if isinstance(source, str):
        spark.sql(curated_view_sql(source, view))
    else:
        source.filter(F.col("estimated_revenue_usd") > 0).createOrReplaceTempView(view)
    return view
