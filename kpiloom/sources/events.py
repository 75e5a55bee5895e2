"""Event message sources: Kafka topic (production) or JSON-lines files.

Both yield a DataFrame with a ``value`` column holding one JSON message per
row, so ``streaming.alerts.parse_events`` serves either of them, in a stream
or in a batch. Both know a start position and a policy for lost input: of a
topic they are offsets, of a folder the times its files were last modified.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.session import read_small, write_small

EARLIEST, LATEST = "earliest", "latest"


def read_event_stream(spark: SparkSession, *, kafka_bootstrap: str | None = None, topic: str | None = None,
                      path: str | None = None, starting_offsets: str = "latest",
                      fail_on_data_loss: bool = False, max_per_trigger: int | None = None,
                      starting_files: str | dt.datetime = EARLIEST, start_file: str | None = None) -> DataFrame:
    """Unbounded event messages from Kafka (``kafka_bootstrap`` + ``topic``) or a folder of text files.

    Kafka needs the ``spark-sql-kafka`` connector on the classpath; each Kafka
    partition becomes a Spark input partition. For files, every new file in
    ``path`` is picked up once; ``max_per_trigger`` bounds files per
    micro-batch (for Kafka: offsets per trigger).

    Files modified at or before ``starting_files`` are passed over: they are
    left out when a batch lists its files, unread. ``latest`` means the time of
    the first start, which ``start_file`` (beside the checkpoint) remembers, so
    that a restarted query keeps its start. Unless ``fail_on_data_loss``, a file that vanishes
    after its batch has listed it is passed over as well; else it ends the query. (One that is gone
    before the listing is never seen, as Spark's file source has it.)
    """
    if kafka_bootstrap:
        if not topic:
            raise ValueError("a Kafka source needs a topic")
        reader = (spark.readStream.format("kafka")
                  .option("kafka.bootstrap.servers", kafka_bootstrap)
                  .option("subscribe", topic)
                  .option("startingOffsets", starting_offsets)
                  .option("failOnDataLoss", str(fail_on_data_loss).lower()))
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        return reader.load()
    if not path:
        raise ValueError("give either kafka_bootstrap and topic, or path")
    reader = spark.readStream.format("text").option("ignoreMissingFiles", str(not fail_on_data_loss).lower())
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    stream = reader.load(path)
    start = start_position(spark, starting_files, start_file)
    return stream if start is None else stream.where(F.col("_metadata.file_modification_time") > F.lit(start)).select("value")


def start_position(spark: SparkSession, wanted: str | dt.datetime, start_file: str | None = None) -> dt.datetime | None:
    """The time that files must be newer than; None for all files.

    A remembered position holds, whatever is wanted now: the position is that
    of the query's first start.
    """
    if start_file and (known := read_small(spark, start_file)) is not None:
        return None if known == EARLIEST else dt.datetime.fromisoformat(known)
    if wanted == LATEST and not start_file:
        raise ValueError("to start at the latest files, name a start_file that a restart can read")
    start = None if wanted == EARLIEST else dt.datetime.now(dt.timezone.utc) if wanted == LATEST else wanted
    if isinstance(start, str):
        start = dt.datetime.fromisoformat(start)
    if start is not None and start.tzinfo is None:
        start = start.replace(tzinfo=dt.timezone.utc)
    if start_file:
        write_small(spark, start_file, EARLIEST if start is None else start.isoformat())
    return start


def read_event_messages(spark: SparkSession, path: str) -> DataFrame:
    """The same messages as a bounded batch (for backfills and tests)."""
    return spark.read.text(path)


def newest_file_time(spark: SparkSession, path: str) -> dt.datetime | None:
    """When the newest file of a folder was modified, by the store's own clock."""
    micros = spark.read.format("binaryFile").load(path).agg(F.unix_micros(F.max("modificationTime"))).first()[0]
    return None if micros is None else dt.datetime.fromtimestamp(micros / 1e6, dt.timezone.utc)
