"""One declarative definition of every KPI.

The DataFrame form, the SQL text and the shared pass over the curated rows are
all built from ``KPI_SPECS``. A KPI groups by one key and has measures; its SQL
form has some more. All measures combine map-side, so a key with a third of
the rows costs one partial row per input partition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.derive import release_type
from kpiloom.functions.money import avg_text, exact_text, mean_text, rest_text, sum_text, total_text
from kpiloom.schemas import MONTH_FORMAT, RELEASE_EARLY, RELEASE_FULL, TOP_GENRES_LIMIT

ON_SALE = "is_on_sale = 1"


@dataclass(frozen=True)
class Measure:
    name: str
    what: str  # sum, avg, min, max, peak or rows
    column: str = ""
    digits: int = 2

    def text(self, only: str | None = None) -> str:
        """The measure as SQL, over the rows that meet ``only``."""
        c = f"CASE WHEN {only} THEN {self.column or 1} END" if only else self.column or "*"
        if self.what in ("min", "max"):
            return f"ROUND({self.what.upper()}({c}), {self.digits})"
        return {"sum": sum_text(c, self.digits), "avg": avg_text(c, self.digits), "peak": f"MAX({c})", "rows": f"COUNT({c})"}[self.what]

    def typed(self, only: str | None = None, where: str | None = None) -> tuple[dict[str, str], str]:
        """The same in two steps: columns to compute once a row, and the measure over them, as far as ``where``, as SQL."""
        if not self.column and not only:
            return {}, "COUNT(*)"
        name, taken = f"__{self.column or 'row'}", lambda c: f"CASE WHEN {where} THEN {c} END" if where else c
        chosen = lambda c: f"CASE WHEN {only} THEN {c} END" if only else c
        if only:
            name += "_on_sale"
        if self.what not in ("sum", "avg"):
            text = {"min": f"ROUND(MIN({taken(name)}), {self.digits})", "max": f"ROUND(MAX({taken(name)}), {self.digits})", "peak": f"MAX({taken(name)})", "rows": f"COUNT({taken(name)})"}
            return {name: chosen(self.column or "1")}, text[self.what]
        exact, rest = f"{name}_exact", f"{name}_rest"
        return {exact: chosen(exact_text(self.column)), rest: chosen(rest_text(self.column))}, (total_text if self.what == "sum" else mean_text)(taken(exact), taken(rest), self.digits)


@dataclass(frozen=True)
class Kpi:
    key: str
    measures: tuple[Measure, ...]
    more: tuple[Measure, ...] = ()  # of the SQL form
    order: str | None = None  # a measure, descending, or the key, ascending
    limit: int | None = None
    only: str | None = None
    sql_order: str | None = None


# --- Fixed values (names, keys, roundings and orders of the KPI tables) ---
REVENUE = Measure("total_revenue_usd", "sum", "estimated_revenue_usd")
PLAYERS = Measure("avg_concurrent_players", "avg", "concurrent_players", 0)
ROWS = Measure("num_registros", "rows")
KPI_SPECS = {
    "kpi1_revenue_platform": Kpi("platform", (REVENUE,), (ROWS,), "total_revenue_usd"),
    "kpi2_revenue_genre": Kpi("genre", (REVENUE,), (ROWS,), "total_revenue_usd"),
    "kpi3_top_genres_ccu": Kpi("genre", (PLAYERS,), (), "avg_concurrent_players", TOP_GENRES_LIMIT),
    "kpi4_avg_ccu_platform": Kpi("platform", (PLAYERS,), (Measure("peak_concurrent_players", "peak", "concurrent_players"),), "avg_concurrent_players"),
    "kpi5_avg_price_platform": Kpi("platform", (Measure("avg_price_usd", "avg", "current_price_usd"),),
                                   (Measure("min_price_usd", "min", "current_price_usd"), Measure("max_price_usd", "max", "current_price_usd")), "avg_price_usd"),
    "kpi6_discount_rate": Kpi("platform", (Measure("avg_discount_pct", "avg", "discount_pc"),),
                              (Measure("juegos_en_oferta", "rows"), Measure("revenue_en_oferta", "sum", "estimated_revenue_usd")), "avg_discount_pct", only=ON_SALE),
    "kpi7_early_vs_full": Kpi("is_early_access", (Measure("avg_revenue_usd", "avg", "estimated_revenue_usd"), REVENUE, Measure("num_records", "rows")),
                              (ROWS,), sql_order="total_revenue_usd"),
    "kpi8_monthly_trend": Kpi("year_month", (Measure("monthly_revenue_usd", "sum", "estimated_revenue_usd"),),
                              (ROWS, Measure("avg_ccu", "avg", "concurrent_players", 0)), "year_month"),
}
# --- end of fixed values ---

# What rows are grouped by, and what the key column then shows: a month is grouped as a date and formatted per result row.
GROUPED_BY = {"year_month": "TRUNC(obs_date, 'MM')"}
SHOWN = {"year_month": f"DATE_FORMAT({{key}}, '{MONTH_FORMAT}')"}


def sql_name(name: str) -> str:
    return f"sql_{name}"


def columns_of(kpi: Kpi, sql_form: bool) -> tuple[Measure, ...]:
    """KPI 7 counts under another name in its SQL form; the others only have more columns there."""
    own = tuple(m for m in kpi.measures if not sql_form or m.what != "rows")
    return own + (kpi.more if sql_form else ())


def order_of(kpi: Kpi, sql_form: bool) -> list[tuple[str, bool]]:
    """(column, descending) pairs; the key decides between the ties of a cut."""
    by = kpi.sql_order if sql_form and kpi.sql_order else kpi.order
    return [] if by is None else [(by, by != kpi.key)] + ([(kpi.key, False)] if kpi.limit else [])


def _finished(df: DataFrame, kpi: Kpi, sql_form: bool, single: bool = False) -> DataFrame:
    """df: __key and the measures. Key column, order and cut."""
    if sql_form and kpi.key == "is_early_access":
        key = release_type("__key").alias("release_type")
    else:
        key = F.expr(SHOWN.get(kpi.key, "{key}").format(key="__key")).alias(kpi.key)
    out = df.select(key, *[m.name for m in columns_of(kpi, sql_form)])
    order = [F.desc(c) if down else F.asc(c) for c, down in order_of(kpi, sql_form)]
    if kpi.limit:
        return out.orderBy(*order).limit(kpi.limit)
    if not order:
        return out.repartition(1)  # the result rows only
    return out.repartition(1).sortWithinPartitions(*order) if single else out.orderBy(*order)


def kpi_frame(df: DataFrame, name: str) -> DataFrame:
    """One KPI in DataFrame form over curated rows."""
    kpi = KPI_SPECS[name]
    rows = df.where(kpi.only) if kpi.only else df
    grouped = rows.groupBy(F.expr(GROUPED_BY.get(kpi.key, kpi.key)).alias("__key"))
    return _finished(grouped.agg(*[F.expr(m.text()).alias(m.name) for m in columns_of(kpi, False)]), kpi, False)


def kpi_sql(name: str) -> str:
    """One KPI as SQL text over ``{curated}``: a view's name, or a DataFrame given to ``spark.sql``."""
    kpi = KPI_SPECS[name]
    by = GROUPED_BY.get(kpi.key, kpi.key)
    shown, key = SHOWN.get(kpi.key, "{key}").format(key=by), kpi.key
    if key == "is_early_access":
        shown, key = f"CASE {by} WHEN 1 THEN '{RELEASE_EARLY}' ELSE '{RELEASE_FULL}' END", "release_type"
    lines = [f"SELECT {shown} AS {key}", *[f"     , {m.text()} AS {m.name}" for m in columns_of(kpi, True)], "  FROM {curated}"]
    lines += [f" WHERE {kpi.only}"] * bool(kpi.only) + [f" GROUP BY {by}"]
    lines += [" ORDER BY " + ", ".join(f"{c} {'DESC' if down else 'ASC'}" for c, down in order_of(kpi, True))]
    return "\n".join(lines + [f" LIMIT {kpi.limit}"] * bool(kpi.limit))


def kpi_pass(clean: DataFrame, names: list[str] | None = None, sql_form: bool = True) -> DataFrame:
    """One row per key and value, with the measures that the named KPIs need: one pass over the rows.

    Grouping sets expand a row once for each key and combine map-side. What a
    measure adds up (decimals, flags) is typed once a row, below the
    expansion, and added up for the keys that need it; only the keys and measures asked for are computed.
    """
    chosen = {n: KPI_SPECS[n] for n in (names or KPI_SPECS)}
    keys = list(dict.fromkeys(k.key for k in chosen.values()))
    needed: dict[str, tuple[Measure, str | None, list[str]]] = {}
    for kpi in chosen.values():
        for m in dict.fromkeys(columns_of(kpi, False) + (columns_of(kpi, True) if sql_form else ())):
            needed.setdefault(_stored(m, kpi), (m, kpi.only, []))[2].append(kpi.key)
        if kpi.only:
            needed["rows_of_" + kpi.key] = (Measure("", "rows"), kpi.only, [kpi.key])
    columns: dict[str, str] = {}
    wanted: dict[str, str] = {}
    for name, (m, only, of) in needed.items():
        own, wanted[name] = m.typed(only, None if {*keys} <= {*of} else " OR ".join(f"GROUPING(__{k}) = 0" for k in dict.fromkeys(of)))
        columns |= own
    typed = clean.select(*[F.expr(GROUPED_BY.get(k, k)).alias(f"__{k}") for k in keys], *[F.expr(text).alias(name) for name, text in columns.items()])
    return (typed.groupingSets([[F.col(f"__{k}")] for k in keys], *[f"__{k}" for k in keys])
            .agg(*[F.grouping(f"__{k}").alias(f"rollup_{k}") for k in keys], *[F.expr(text).alias(name) for name, text in wanted.items()]))


def _stored(m: Measure, kpi: Kpi) -> str:
    return f"{m.what}_{m.column or 'all'}_{m.digits}" + ("_on_sale" if kpi.only else "")


def from_pass(passed: DataFrame, name: str, sql_form: bool) -> DataFrame:
    """One KPI table out of the shared pass."""
    kpi = KPI_SPECS[name]
    own = passed.where(F.col(f"rollup_{kpi.key}") == 0)
    if kpi.only:
        own = own.where(F.col("rows_of_" + kpi.key) > 0)
    rows = own.select(F.col(f"__{kpi.key}").alias("__key"), *[F.col(_stored(m, kpi)).alias(m.name) for m in columns_of(kpi, sql_form)])
    return _finished(rows, kpi, sql_form, single=True)
