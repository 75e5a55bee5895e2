"""The eight market KPIs over curated rows (DataFrame form), from their one definition."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame

from kpiloom.plans.kpi_spec import KPI_SPECS, kpi_frame

KPIS: dict[str, Callable[[DataFrame], DataFrame]] = {name: partial(kpi_frame, name=name) for name in KPI_SPECS}


def calculate_kpis(df: DataFrame) -> dict[str, DataFrame]:
    """All KPIs as lazy DataFrames, in a fixed order."""
    return {name: fn(df) for name, fn in KPIS.items()}
