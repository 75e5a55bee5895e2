"""Reading KPI tables back: one folder, a tolerant set of folders, the CSV export."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)


def read_kpi(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _try_read(spark: SparkSession, name: str, path: str) -> DataFrame | None:
    try:
        df = read_kpi(spark, path)
        df.write.format("noop").mode("overwrite").save()  # a KPI has one row per key value; its files are read here, so that a corrupt one shows
        return df
    except (AnalysisException, PySparkException, Py4JError) as exc:
        log.warning("skipping KPI %s at %s: %s", name, path, str(exc).splitlines()[0])
        return None


def load_kpis(spark: SparkSession, paths: dict[str, str], parallel: int = 8, strict: bool = False) -> dict[str, DataFrame]:
    """Every readable KPI folder, in order; unreadable ones are skipped with a warning.

    Each is read once here (from a few driver threads side by side), so a
    missing, empty or corrupt folder shows now, not later. With ``strict`` the
    first such folder ends the load; else that happens only when none loads.
    """
    if strict:
        return {name: read_kpi(spark, path) for name, path in paths.items()}
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        futures = {name: pool.submit(_try_read, spark, name, path) for name, path in paths.items()}
        results = {name: f.result() for name, f in futures.items()}
    loaded = {name: df for name, df in results.items() if df is not None}
    if not loaded:
        raise FileNotFoundError(f"none of the KPI tables could be read: {list(paths.values())}")
    return loaded


def read_export_csv(spark: SparkSession, path: str) -> DataFrame:
    """The exported CSV, every column as text (as written)."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)
