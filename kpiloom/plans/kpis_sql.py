"""The eight KPIs as Spark SQL over the curated view (richer column set), from their one definition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.plans.kpi_spec import KPI_SPECS, kpi_sql, sql_name

SQL_KPIS: dict[str, str] = {sql_name(name): kpi_sql(name) for name in KPI_SPECS}


def run_sql_kpi(spark: SparkSession, name: str, curated: str | DataFrame) -> DataFrame:
    """Run one SQL KPI over a registered view name or a curated DataFrame.

    A DataFrame gets the view's own filter (positive revenue) before it is
    bound as a query parameter; Catalyst merges both filters into one.
    """
    text = SQL_KPIS[name]
    if isinstance(curated, str):
        return spark.sql(text.format(curated=curated))
    return spark.sql(text, curated=curated.filter(F.col("estimated_revenue_usd") > 0))


def calculate_sql_kpis(spark: SparkSession, curated: str | DataFrame) -> dict[str, DataFrame]:
    return {name: run_sql_kpi(spark, name, curated) for name in SQL_KPIS}
