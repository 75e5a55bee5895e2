"""Export job: KPI Parquet folders → one CSV with every KPI row (numbers as text).

    spark-submit jobs/export.py --kpis <folder holding kpi1_… … kpi8_…> --out <csv folder>

A KPI folder that cannot be read is skipped with a warning; the job fails
only when none can be read.
"""

from __future__ import annotations

import argparse
import os
import sys

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

from kpiloom.operators.export import unify_kpis  # noqa: E402
from kpiloom.operators.kpis import KPIS  # noqa: E402
from kpiloom.session import build_session  # noqa: E402
from kpiloom.sinks.writers import write_csv_single  # noqa: E402
from kpiloom.sources.kpi_store import load_kpis  # noqa: E402


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--kpis", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--literal-cast", action="store_true",
                        help="plain cast('string') for fractional numbers (may print 1.2E7)")
    args = parser.parse_args(argv)

    spark = build_session("kpiloom-export")
    try:
        paths = {name: f"{args.kpis.rstrip('/')}/{name}" for name in KPIS}
        combined = unify_kpis(load_kpis(spark, paths), literal_cast=args.literal_cast)
        combined.printSchema()
        combined.show(20, truncate=False)
        write_csv_single(combined, args.out)
        return 0
    except FileNotFoundError as exc:
        print(f"ERROR: {exc}", file=sys.stderr)
        return 1
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
