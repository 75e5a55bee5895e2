"""Batch sinks: curated Parquet, KPI Parquet, CSV export, market CSV, event messages."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.schemas import EVENT_COLUMNS


def write_curated(df: DataFrame, path: str, compression: str = "snappy") -> None:
    """Curated rows as Parquet partitioned by platform, replacing ``path``.

    The rebalance hint makes AQE shuffle rows by platform into partitions of
    the advisory size (splitting a hot platform over several tasks), so each
    platform folder gets a few large files rather than one file per input
    split and platform.
    """
    (df.hint("rebalance", "platform")
       .write.mode("overwrite")
       .option("compression", compression)
       .partitionBy("platform")
       .parquet(path))


def write_kpi(df: DataFrame, path: str, compression: str = "snappy") -> None:
    """One KPI table (one row per key value) as a single Parquet file, replacing ``path``.

    KPI tables come sorted or in one partition already: there is an exchange
    of the result rows before, and ``coalesce(1)`` pulls no aggregation into one task.
    """
    df.coalesce(1).write.mode("overwrite").option("compression", compression).parquet(path)


def write_kpis(kpis: dict[str, DataFrame], base: str, parallel: int = 8) -> dict[str, str]:
    """Every KPI table into ``base/<name>``.

    Each write is a small job; submitting them from a few driver threads lets
    the scheduler run them side by side instead of one after another.
    """
    paths = {name: f"{base.rstrip('/')}/{name}" for name in kpis}
    if parallel <= 1:
        for name, df in kpis.items():
            write_kpi(df, paths[name])
        return paths
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        for done in [pool.submit(write_kpi, df, paths[name]) for name, df in kpis.items()]:
            done.result()
    return paths


def write_csv_single(df: DataFrame, path: str) -> None:
    """Small table as one CSV file with a header, replacing ``path``."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_market_csv(df: DataFrame, path: str) -> None:
    """Market rows as CSV with a header (dates as yyyy-MM-dd), in parallel files."""
    df.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)


def encode_events(df: DataFrame) -> DataFrame:
    """Event records → one JSON text ``value`` per row (the message body)."""
    present = [c for c in EVENT_COLUMNS if c in df.columns]
    return df.select(F.to_json(F.struct(*present)).alias("value"))


def write_event_messages(df: DataFrame, path: str) -> None:
    """JSON messages as text files (one message per line)."""
    encode_events(df).write.mode("overwrite").text(path)


def publish_events_kafka(df: DataFrame, bootstrap: str, topic: str) -> None:
    """JSON messages to a Kafka topic (needs the Kafka connector on the classpath)."""
    (encode_events(df).write.format("kafka")
       .option("kafka.bootstrap.servers", bootstrap)
       .option("topic", topic)
       .save())
