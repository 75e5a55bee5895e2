"""Unified KPI export: every KPI table tagged and stacked into one text table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType, NumericType

from kpiloom.functions.money import money_text


def as_text_columns(df: DataFrame, literal_cast: bool = False, keep: tuple[str, ...] = ("kpi_name",)) -> DataFrame:
    """Every numeric column as text, chosen by type from the schema.

    Integers print as such. Fractional numbers print with two fixed decimals
    (``12345678.92``, never ``1.234567892E7``); ``literal_cast=True`` uses a
    plain ``cast('string')`` instead.
    """
    cols = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if field.name in keep or not isinstance(field.dataType, NumericType):
            cols.append(c)
        elif isinstance(field.dataType, FractionalType) and not literal_cast:
            cols.append(money_text(c).alias(field.name))
        else:
            cols.append(c.cast("string").alias(field.name))
    return df.select(*cols)


def tag_kpi(df: DataFrame, kpi_name: str, literal_cast: bool = False) -> DataFrame:
    return as_text_columns(df.withColumn("kpi_name", F.lit(kpi_name)), literal_cast)


def unify_kpis(frames: dict[str, DataFrame], literal_cast: bool = False) -> DataFrame:
    """Union by column name, missing columns as NULL, in the dict's order."""
    if not frames:
        raise ValueError("no KPI tables to export")
    tagged = [tag_kpi(df, name, literal_cast) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
