"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kpiloom.llm import pipeline

STAGES = pipeline.STAGES
ORACLE_SQL = None  # SQL cannot express the learnt, hashed and tokenising stages; tests/llm holds run() against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.run(spark, sf_dir, STAGES)
