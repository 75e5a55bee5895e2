"""SparkSession construction and shared-storage helpers.

No master is hard-coded: spark-submit (or the caller) decides where the job
runs. The defaults below are the ones every job relies on for correct results
(UTC session zone, snappy Parquet) plus adaptive execution, which re-plans
joins and shuffles from runtime statistics.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    # Producer timestamps carry no zone and are meant as UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Large partitions of the curated table are split instead of spilling.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def build_session(app_name: str = "kpiloom", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_test_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and local benchmarks: no UI, few shuffle partitions."""
    spark = build_session(
        "kpiloom-local",
        master=f"local[{cores}]",
        conf={
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.execution.arrow.pyspark.enabled": "true",
        },
    )
    ensure_checkpoint_dir(spark)
    return spark


class NoSharedFolder(RuntimeError):
    """A cluster names no folder that all of its machines share."""


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    return spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the configured shared checkpoint folder; set a scratch one only when unset.

    On a cluster ``spark.checkpoint.dir`` points at shared storage, and a cluster
    without it is refused: its machines would each write to a disk of their
    own, and a read would find a part of the table. Only local runs (tests,
    benchmarks) take a fresh folder under the temp dir.
    """
    root = checkpoint_root(spark)
    if root:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(root)
        return spark.sparkContext.getCheckpointDir() or root
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise NoSharedFolder("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="kpiloom-ckpt-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir() or root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under this application's checkpoint folder, removed when the application ends."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there and not empty, in whatever store the path names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(store.exists(target)) and len(store.listStatus(target)) > 0


def _store_of(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A short note (a position, a ledger entry) as a file of its own, in whatever store the path names.

    It is written under another name first and then renamed, so that a reader finds all of it or none.
    """
    store, target = _store_of(spark, path)
    part = target.suffix(f".{uuid.uuid4().hex}.part")
    out = store.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not store.rename(part, target):
        raise OSError(f"{path} could not be written")


def read_small(spark: SparkSession, path: str) -> str | None:
    """What ``write_small`` wrote, or None if there is no such file."""
    store, target = _store_of(spark, path)
    if not store.exists(target):
        return None
    source = store.open(target)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def remove_small(spark: SparkSession, path: str) -> None:
    store, target = _store_of(spark, path)
    store.delete(target, False)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it is missing."""
    store, target = _store_of(spark, path)
    return [entry.getPath().getName() for entry in store.listStatus(target)] if store.exists(target) else []


def move_files(spark: SparkSession, source: str, target: str) -> None:
    """Every data file of a folder into another one, each at once, as a producer hands over finished files."""
    store, folder = _store_of(spark, target)
    store.mkdirs(folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for name in names_in(spark, source):
        if not name.startswith(("_", ".")) and not store.rename(path(f"{source}/{name}"), path(f"{target}/{name}")):
            raise OSError(f"{name} could not be moved to {target}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and return the read-back table.

    Cuts the lineage like ``checkpoint()`` (a lost executor re-reads files
    instead of recomputing the plan), but stores columnar, compressed data
    that later scans can prune and filter.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    # The schema is known: reading it back needs no footer-inference job.
    return df.sparkSession.read.schema(df.schema).parquet(path)
