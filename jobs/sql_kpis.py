"""SQL KPI job: the eight SQL-form KPIs over a curated Parquet folder, through a view.

    spark-submit jobs/sql_kpis.py --curated <curated folder> [--out <folder>] [--show 20]

Registers ``market_curated`` (positive revenue only) over the folder, runs
each SQL text against it, shows the results and optionally writes each one
as a single Parquet file under ``--out``.
"""

from __future__ import annotations

import argparse
import os
import sys

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

from kpiloom.plans.kpis_sql import calculate_sql_kpis  # noqa: E402
from kpiloom.session import build_session  # noqa: E402
from kpiloom.sinks.writers import write_kpis  # noqa: E402
from kpiloom.sources.market import register_curated_view  # noqa: E402


def run_sql_kpis(spark, curated: str, out: str | None = None, show: int = 0) -> dict[str, str] | None:
    view = register_curated_view(spark, curated)
    results = calculate_sql_kpis(spark, view)
    if show:
        for name, df in results.items():
            print(f"--- {name} ---")
            df.show(show, truncate=False)
    return write_kpis(results, out) if out else None


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--curated", required=True)
    parser.add_argument("--out")
    parser.add_argument("--show", type=int, default=20)
    args = parser.parse_args(argv)
    spark = build_session("kpiloom-sql-kpis")
    try:
        run_sql_kpis(spark, args.curated, args.out, args.show)
        return 0
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
