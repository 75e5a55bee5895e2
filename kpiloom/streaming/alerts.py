"""Hype-spike alerts: JSON event messages → parsed events → spike rows.

The transformation is stateless (parse, project, filter), so the streaming
plan is map-only: no shuffle, no state store, and every micro-batch scales
with the number of source partitions. The same functions run on a batch
DataFrame, which is how backfills and tests reuse them.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from kpiloom.schemas import EVENT_SCHEMA
from kpiloom.session import names_in, path_exists, remove_small, write_small


def parse_events(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """``value`` (JSON text or bytes) → the eight event columns + ``event_time``.

    Parsing is PERMISSIVE: garbage gives a row of NULLs, a wrongly typed field
    gives NULL for that field only, unknown fields are ignored. ``event_time``
    is the ISO text read in the session time zone (UTC by default); bad text
    gives NULL.
    """
    return (messages
            .select(F.from_json(F.col(value_col).cast("string"), EVENT_SCHEMA).alias("data"))
            .select("data.*")
            .withColumn("event_time", F.try_to_timestamp(F.col("timestamp"))))


def hype_alerts(events: DataFrame) -> DataFrame:
    """Events flagged as hype spikes."""
    return events.filter(F.col("hype_spike") == 1)


def start_alert_queries(alerts: DataFrame, output_path: str, checkpoint_path: str, *,
                        parquet_trigger: str = "30 seconds", console: bool = False,
                        console_trigger: str = "10 seconds", available_now: bool = False,
                        query_name: str | None = None) -> list[StreamingQuery]:
    """Start the Parquet alert sink (append, checkpointed) and optionally a console sink.

    The checkpoint records source offsets and committed files, so a restart
    after a failure continues where it stopped and never writes a batch
    twice. An output folder that such a query has written to is refused
    without the checkpoint that belongs to it: the sink would take the new
    query's first batches for ones that it has, and drop them.
    ``available_now`` processes everything present and stops (catch-up
    runs, tests); otherwise micro-batches run every ``parquet_trigger``.
    """
    spark = alerts.sparkSession
    if path_exists(spark, f"{output_path.rstrip('/')}/_spark_metadata") and not path_exists(spark, f"{checkpoint_path.rstrip('/')}/offsets"):
        raise ValueError(f"{output_path} was written with another checkpoint than {checkpoint_path}; give that one, or a new output folder")

    def trigger(writer, every: str):
        return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)

    writer = (alerts.writeStream.format("parquet").outputMode("append")
              .option("path", output_path).option("checkpointLocation", checkpoint_path))
    if query_name:
        writer = writer.queryName(query_name)
    started = [trigger(writer, parquet_trigger).start()]
    if console:
        console_writer = (alerts.writeStream.format("console").outputMode("append")
                          .option("truncate", False))
        started.append(trigger(console_writer, console_trigger).start())
    return started


def await_any(spark, queries: list[StreamingQuery], finite: bool = False) -> None:
    """Wait for the queries and shut down cleanly.

    Finite runs (``availableNow``) wait for every query to drain. Continuous
    runs wait until any query ends (failure or stop) and then stop the rest,
    re-raising the failure.
    """
    if not queries:
        return
    try:
        if finite:
            for q in queries:
                q.awaitTermination()
        else:
            spark.streams.awaitAnyTermination()
    finally:
        for q in queries:
            if q.isActive:
                q.stop()


# Text formats print fractions of a second in full, else they end at milliseconds.
_TEXT_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
BATCH = "batch"  # the folder level, and the column, that tells which micro-batch wrote a row


@dataclass(frozen=True)
class Sink:
    """A folder of one sink of a stream: ``<path>/batch=<id>`` holds what a micro-batch wrote, in ``format``."""

    format: str
    path: str

    @property
    def ledger(self) -> str:
        return f"{self.path.rstrip('/')}_ledger"

    @property
    def options(self) -> dict[str, str]:
        return _TEXT_OPTIONS if self.format in ("json", "csv") else {}

    def last(self, spark: SparkSession) -> int:
        """The id of the last micro-batch that is wholly written, or -1. They come one after the other."""
        return max((int(name) for name in names_in(spark, self.ledger) if name.isdigit()), default=-1)

    def take(self, rows: DataFrame, batch_id: int) -> bool:
        """Write a micro-batch unless the ledger has it. A part of an earlier attempt is replaced."""
        spark = rows.sparkSession
        if batch_id <= (last := self.last(spark)):
            return False
        rows.write.mode("overwrite").format(self.format).options(**self.options).save(f"{self.path.rstrip('/')}/{BATCH}={batch_id}")
        write_small(spark, f"{self.ledger}/{batch_id}", "written")
        if last >= 0:
            remove_small(spark, f"{self.ledger}/{last}")  # the newest entry is enough
        return True

    def read(self, spark: SparkSession, schema: StructType) -> DataFrame:
        """The rows of all recorded micro-batches, with their ``batch``; what is half written is not read."""
        if (last := self.last(spark)) < 0:
            return spark.createDataFrame([], StructType([*schema.fields]).add(BATCH, "long"))
        rows = spark.read.schema(StructType([*schema.fields]).add(BATCH, "long")).format(self.format).options(**self.options).load(self.path)
        return rows.where(F.col(BATCH) <= last)  # prunes folders


@dataclass(frozen=True)
class ConsoleSink:
    """Shows the first rows of every micro-batch; one that is run again is shown again."""

    rows: int = 20

    def last(self, spark: SparkSession) -> int:
        return -1

    def take(self, rows: DataFrame, batch_id: int) -> bool:
        print(f"Batch {batch_id}")
        rows.show(self.rows, truncate=False)
        return True


def taken_by_all(sinks: list[Sink | ConsoleSink]) -> Callable[[DataFrame, int], None]:
    """What a stream does with a micro-batch: it is computed once, and every sink takes it once.

    A micro-batch that is run again after a failure goes only to the sinks whose
    ledger does not have it.
    """
    def take(rows: DataFrame, batch_id: int) -> None:
        missing = [sink for sink in sinks if sink.last(rows.sparkSession) < batch_id]
        if len(missing) > 1:
            rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for sink in missing:
                sink.take(rows, batch_id)
        finally:
            if len(missing) > 1:
                rows.unpersist()

    return take


def start_shared_sinks(alerts: DataFrame, sinks: list[Sink | ConsoleSink], checkpoint_path: str, *, trigger: str = "30 seconds",
                       available_now: bool = False, query_name: str | None = None) -> StreamingQuery:
    """One stream that several sinks share: the source is read once for all of them.

    A sink with batches but without the checkpoint they came from is refused,
    as the new query would count its batches from 0 and the ledger would drop them.
    """
    spark = alerts.sparkSession
    if not path_exists(spark, f"{checkpoint_path.rstrip('/')}/offsets"):
        for sink in sinks:
            if sink.last(spark) >= 0:
                raise ValueError(f"{sink} was written with another checkpoint than {checkpoint_path}; give that one, or a new output folder")
    writer = alerts.writeStream.foreachBatch(taken_by_all(sinks)).option("checkpointLocation", checkpoint_path)
    if query_name:
        writer = writer.queryName(query_name)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)).start()


def await_rows(query: StreamingQuery, rows: int, seen: dict[int, int] | None = None, timeout: float = 300.0) -> dict[int, int]:
    """Wait until a running query's progress shows that its source gave ``rows`` rows; the rows of each batch.

    ``seen`` is the result of an earlier wait on the same query. A failure of the query is raised; when the
    time is over, TimeoutError is, and the caller stops the query.
    """
    seen, until = dict(seen or {}), time.monotonic() + timeout
    while True:
        for progress in query.recentProgress:
            if progress["numInputRows"]:
                seen[progress["batchId"]] = progress["numInputRows"]
        if sum(seen.values()) >= rows:
            return seen
        if query.exception() is not None:
            raise query.exception()
        if not query.isActive or time.monotonic() > until:
            raise TimeoutError(f"the query gave {sum(seen.values())} of {rows} rows")
        query.awaitTermination(0.2)
