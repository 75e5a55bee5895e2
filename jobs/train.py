"""Training job: curated Parquet → cross-validated revenue regression → saved model.

    spark-submit jobs/train.py --curated <curated folder> --model <model folder>
"""

from __future__ import annotations

import argparse
import os
import sys

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

from kpiloom.ml import revenue_model  # noqa: E402
from kpiloom.session import build_session  # noqa: E402
from kpiloom.sources.market import read_curated  # noqa: E402


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--curated", required=True)
    parser.add_argument("--model", required=True)
    parser.add_argument("--parallelism", type=int, default=4)
    parser.add_argument("--no-persist", action="store_true",
                        help="let CV re-read the materialised training table instead of caching the split")
    args = parser.parse_args(argv)

    spark = build_session("kpiloom-train")
    try:
        data = revenue_model.training_set(read_curated(spark, args.curated))
        trained = revenue_model.train(data, parallelism=args.parallelism, persist=not args.no_persist)
        scored = trained.model.transform(trained.test)
        revenue_model.metrics(scored).show(truncate=False)
        revenue_model.coefficients(spark, trained.model).show(truncate=False)
        revenue_model.save_model(trained.model, args.model)
        revenue_model.predictions(trained.model, trained.test).show(10, truncate=False)
        return 0
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
