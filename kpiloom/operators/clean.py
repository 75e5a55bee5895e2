"""Cleaning of raw market rows into the curated schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.casting import with_types
from kpiloom.schemas import DATE_FORMAT, MARKET_TYPES, MONTH_FORMAT, REQUIRED_COLUMNS

REVENUE = "estimated_revenue_usd"


def clean_market(df: DataFrame) -> DataFrame:
    """Type, filter and enrich raw market rows.

    * every known column is converted to its curated type; bad text → NULL;
    * rows without positive revenue go (NULL fails ``> 0``);
    * rows with NULL or NaN platform, genre or revenue go;
    * ``year_month`` (``yyyy-MM``) is appended.

    Works on text input (CSV) and on already-typed input; with typed input
    the conversions vanish and the revenue filter reaches the Parquet scan.
    """
    typed = with_types(df, MARKET_TYPES, {"obs_date": DATE_FORMAT})
    return (typed
            .filter(F.col(REVENUE) > 0)
            .na.drop(how="any", subset=REQUIRED_COLUMNS)
            .withColumn("year_month", F.date_format("obs_date", MONTH_FORMAT)))
