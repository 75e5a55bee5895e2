"""Serving job: KPI Parquet folders → headline summary, revenue shares and chart-ordered tables.

    spark-submit jobs/serve.py --kpis <folder holding kpi1_… … kpi8_…> --out <folder>

Writes ``summary`` (one row), ``revenue_share_genre`` and one folder per
chart-ordered KPI table as single CSV files for a dashboard to read.
"""

from __future__ import annotations

import argparse
import os
import sys

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

from kpiloom.operators.kpis import KPIS  # noqa: E402
from kpiloom.operators.serving import chart_orderings, money_display, revenue_share, serving_summary  # noqa: E402
from kpiloom.session import build_session  # noqa: E402
from kpiloom.sinks.writers import write_csv_single  # noqa: E402
from kpiloom.sources.kpi_store import load_kpis  # noqa: E402


def run_serving(spark, kpi_base: str, out: str) -> list[str]:
    """Writes what the readable KPIs allow; returns what had to be left out."""
    kpis = load_kpis(spark, {name: f"{kpi_base.rstrip('/')}/{name}" for name in KPIS})
    out = out.rstrip("/")
    needed = ("kpi1_revenue_platform", "kpi2_revenue_genre", "kpi6_discount_rate")
    left_out = [f"{name} (its KPI is missing)" for name in KPIS if name not in kpis]
    if all(n in kpis for n in needed):
        write_csv_single(serving_summary(*(kpis[n] for n in needed)), f"{out}/summary")
    else:
        left_out.append("summary")
    if "kpi2_revenue_genre" not in kpis:
        left_out.append("revenue_share_genre")
    else:
        share = money_display(revenue_share(kpis["kpi2_revenue_genre"]), ["total_revenue_usd"])
        write_csv_single(share, f"{out}/revenue_share_genre")
    for name, df in chart_orderings(kpis).items():
        write_csv_single(df, f"{out}/charts/{name}")
    return left_out


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--kpis", required=True)
    parser.add_argument("--out", required=True)
    args = parser.parse_args(argv)
    spark = build_session("kpiloom-serve")
    try:
        left_out = run_serving(spark, args.kpis, args.out)
        for what in left_out:
            print(f"left out: {what}", file=sys.stderr)
        return 2 if left_out else 0
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
