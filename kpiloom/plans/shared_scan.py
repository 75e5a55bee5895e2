"""Several KPI tables from one pass over the curated rows.

One ``GROUPING SETS`` aggregation computes the measures of all wanted KPIs for
all their keys; every table is then a filter and a projection of its result,
which has one row per key value. Where several tables are consumed together
the result is written once to the shared folder, so that every consumer
reads the same files. Pre-aggregating by all four keys at once would shrink the
rows first only where few of their combinations occur, which nothing bounds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.operators.ordering import positioned
from kpiloom.plans.kpi_spec import KPI_SPECS, from_pass, kpi_pass, order_of, sql_name
from kpiloom.session import materialize as materialize_table


def some_kpis(clean: DataFrame, names: list[str], materialize: bool = False) -> dict[str, DataFrame]:
    """The named KPIs in DataFrame form; only their keys and measures are computed."""
    passed = kpi_pass(clean, names, sql_form=False)
    if materialize:
        passed = materialize_table(passed, "kpi-pass")
    return {name: from_pass(passed, name, False) for name in names}


def all_kpis(clean: DataFrame, materialize: bool = False) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """(DataFrame-form KPIs, SQL-form KPIs) from one aggregation of ``clean``.

    ``materialize=True`` runs the aggregation now and stores its result.
    """
    passed = kpi_pass(clean)
    if materialize:
        passed = materialize_table(passed, "kpi-pass")
    return ({name: from_pass(passed, name, False) for name in KPI_SPECS}, {sql_name(name): from_pass(passed, name, True) for name in KPI_SPECS})


def kpi_order(batch: dict[str, DataFrame], sql: dict[str, DataFrame]) -> DataFrame:
    """kpi_name, position, label, value: the rows of all given KPI tables in each table's order.

    label is the key, value the measure that the table is ordered by, null where that is the key; ties come
    by label, a null label first. All tables are stacked and ordered at once.
    """
    stacked = []
    for name, kpi in KPI_SPECS.items():
        for of, frames, sql_form in ((name, batch, False), (sql_name(name), sql, True)):
            if of in frames:
                df = frames[of]
                by, down = (order_of(kpi, sql_form) or [(kpi.key, False)])[0]
                value = F.lit(None).cast("double") if by == kpi.key else F.col(by).cast("double")
                stacked.append(df.select(F.lit(of).alias("kpi_name"), F.col(df.columns[0]).cast("string").alias("label"), value.alias("value"), (-value if down else value).alias("__by")))
    rows = positioned(reduce(DataFrame.unionByName, stacked), [F.asc_nulls_last("__by"), F.asc("label")], ("kpi_name",))
    return rows.select("kpi_name", "position", "label", "value")
