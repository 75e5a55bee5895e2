"""Serving figures computed from the KPI tables: headline summary and shares."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.functions.display import dollars_text, millions_text, percent_text
from kpiloom.functions.money import money_sum, rounded_avg, sum_text


# --- Fixed values: what each chart is ordered by, whether descending, and its label column ---
CHARTS = {
    "kpi1_revenue_platform": ("total_revenue_usd", False, "platform"),
    "kpi3_top_genres_ccu": ("avg_concurrent_players", True, "genre"),
    "kpi4_avg_ccu_platform": ("avg_concurrent_players", True, "platform"),
    "kpi5_avg_price_platform": ("avg_price_usd", True, "platform"),
    "kpi6_discount_rate": ("avg_discount_pct", True, "platform"),
    "kpi8_monthly_trend": ("year_month", False, "year_month"),
}
# --- end of fixed values ---


def revenue_share(kpi: DataFrame, value: str = "total_revenue_usd",
                  out: str = "revenue_share_pct") -> DataFrame:
    """Append each row's percentage of the column total (e.g. revenue by genre).

    The total is a scalar subquery: Spark computes it as a separate one-row
    aggregation and injects it, so no single-partition window and no join
    is needed, whatever the number of rows. Give it a materialised KPI table
    (read from the store, or checkpointed): the subquery re-reads its input.
    """
    total = kpi.select(F.expr(sum_text(value))).scalar()
    # try_divide: a zero total (no revenue at all) gives NULL instead of failing under ANSI mode.
    return kpi.withColumn(out, F.round(F.try_divide(F.col(value), total) * 100, 2))


def serving_summary(kpi1: DataFrame, kpi2: DataFrame, kpi6: DataFrame) -> DataFrame:
    """One row: total revenue, top platform, top genre, mean discount (+ display text).

    The three KPI tables are stacked into one (kind, name, value) table and
    reduced by a single global aggregation with conditional aggregates.
    The mean discount is the unweighted mean of the per-platform means.
    """
    stacked = (kpi1.select(F.lit("platform").alias("kind"), F.col("platform").alias("name"),
                           F.col("total_revenue_usd").alias("value"))
               .unionByName(kpi2.select(F.lit("genre").alias("kind"), F.col("genre").alias("name"),
                                        F.col("total_revenue_usd").alias("value")))
               .unionByName(kpi6.select(F.lit("discount").alias("kind"), F.col("platform").alias("name"),
                                        F.col("avg_discount_pct").alias("value"))))

    def of(kind: str) -> str:
        return f"CASE WHEN kind = '{kind}' THEN value END"

    def top(kind: str) -> F.Column:
        # Of equal values the first name, so that a tie gives the same name each time.
        least = F.when(F.col("kind") == kind, F.struct(-F.col("value"), F.col("name").alias("name")))
        return F.min(least)["name"]

    summary = stacked.agg(
        money_sum(of("platform")).alias("total_revenue_usd"),
        top("platform").alias("top_platform"),
        top("genre").alias("top_genre"),
        rounded_avg(of("discount"), 2).alias("avg_discount_pct"),
    )
    return summary.select(
        "*",
        millions_text("total_revenue_usd").alias("total_revenue_text"),
        percent_text("avg_discount_pct").alias("avg_discount_text"),
    )


def chart_tables(kpis: dict[str, DataFrame]) -> DataFrame:
    """Every charted KPI table with the position of its rows: chart, position, label, value."""
    out = []
    for name, (value, down, label) in CHARTS.items():
        if name in kpis:
            # One row per key value: a chart's rows.
            order = Window.orderBy(F.desc(value) if down else F.asc(value), F.col(label))
            out.append(kpis[name].select(F.lit(name).alias("chart"), F.row_number().over(order).alias("position"),
                                         F.col(label).cast("string").alias("label"), F.col(_shown(name, value)).cast("double").alias("value")))
    return reduce(DataFrame.unionByName, out)


def _shown(name: str, value: str) -> str:
    return "monthly_revenue_usd" if name == "kpi8_monthly_trend" else value


def chart_orderings(kpis: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """KPI tables in the order the dashboard charts them.

    Revenue by platform ascending (horizontal bars), CCU, price and discount
    tables descending, the monthly trend by month; other tables as given.
    """
    return {name: df.orderBy(F.desc(CHARTS[name][0]) if CHARTS[name][1] else F.asc(CHARTS[name][0])) if name in CHARTS else df for name, df in kpis.items()}


def money_display(df: DataFrame, columns: list[str]) -> DataFrame:
    """Money columns additionally as ``$1,234.50`` text (``<column>_text``)."""
    return df.select("*", *[dollars_text(c).alias(f"{c}_text") for c in columns])
