"""Start positions and lost files of a folder source; sinks that share one stream; timed triggers."""

from __future__ import annotations

import datetime as dt
import os
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from kpiloom.plans.catalog import hype_alerts_timed
from kpiloom.schemas import ALERT_SCHEMA
from kpiloom.session import names_in, read_small, write_small
from kpiloom.sources.events import EARLIEST, LATEST, newest_file_time, read_event_stream, start_position
from kpiloom.streaming.alerts import BATCH, Sink, await_rows, hype_alerts, parse_events, start_alert_queries, start_shared_sinks

from conftest import SF_SMALL


def message(k: int) -> str:
    return f'{{"timestamp":"2024-01-01T00:00:00","platform":"P{k}","concurrent_players":{k},"hype_spike":1}}'


def put(folder: str, name: str, *numbers: int) -> None:
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/.{name}", "w") as f:
        f.write("".join(message(k) + "\n" for k in numbers))
    os.rename(f"{folder}/.{name}", f"{folder}/{name}")


def run(spark, source, out, **options):
    stream = read_event_stream(spark, path=source, **options)
    for q in start_alert_queries(hype_alerts(parse_events(stream)), out, f"{out}-checkpoint", available_now=True):
        q.awaitTermination()
    return sorted(r.concurrent_players for r in spark.read.schema(ALERT_SCHEMA).parquet(out).collect())


def test_files_up_to_the_start_are_passed_over(spark, tmp_dir):
    source = f"{tmp_dir}/in"
    put(source, "a", 1, 2)
    os.utime(f"{source}/a", (1_700_000_000, 1_700_000_000))
    put(source, "b", 3)
    start = newest_file_time(spark, source)
    time.sleep(0.02)
    put(source, "c", 4, 5)
    old = dt.datetime.fromtimestamp(1_700_000_000, dt.timezone.utc)
    assert run(spark, source, f"{tmp_dir}/all") == [1, 2, 3, 4, 5]
    assert run(spark, source, f"{tmp_dir}/after-a", starting_files=old) == [3, 4, 5]
    assert run(spark, source, f"{tmp_dir}/after-b", starting_files=start) == [4, 5]
    assert run(spark, source, f"{tmp_dir}/text", starting_files=old.replace(tzinfo=None).isoformat()) == [3, 4, 5]


def test_files_before_the_start_are_not_read(spark, tmp_dir):
    """They are left out by their times, when the batch lists its files."""
    source = f"{tmp_dir}/in"
    put(source, "a", 1, 2)
    start = newest_file_time(spark, source)
    time.sleep(0.02)
    put(source, "c", 4, 5, 6)
    q = read_event_stream(spark, path=source, starting_files=start).writeStream.format("noop").trigger(availableNow=True).option("checkpointLocation", f"{tmp_dir}/cp").start()
    q.awaitTermination()
    assert [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]] == [3]


def test_latest_is_the_first_start_even_after_a_restart(spark, tmp_dir):
    source, out, note = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/start"
    put(source, "a", 1)
    time.sleep(0.02)
    options = {"starting_files": LATEST, "start_file": note}
    assert run(spark, source, out, **options) == []
    time.sleep(0.02)
    put(source, "b", 2)
    assert run(spark, source, out, **options) == [2]
    put(source, "c", 3)
    assert run(spark, source, out, **options) == [2, 3]
    assert start_position(spark, EARLIEST, note) == dt.datetime.fromisoformat(read_small(spark, note))
    with pytest.raises(ValueError):
        read_event_stream(spark, path=source, starting_files=LATEST)


@pytest.mark.parametrize("strict", [False, True])
def test_a_file_that_vanishes(spark, tmp_dir, strict):
    """The file of the second batch goes after the batch has listed it, before it is read."""
    source = f"{tmp_dir}/in"
    put(source, "a", 1)
    os.utime(f"{source}/a", (1_700_000_000, 1_700_000_000))
    put(source, "b", 2)
    got = []

    def take(rows, batch_id):
        if batch_id == 1:
            os.remove(f"{source}/b")
        got.extend(r.value for r in rows.collect())

    stream = read_event_stream(spark, path=source, max_per_trigger=1, fail_on_data_loss=strict)
    q = stream.writeStream.foreachBatch(take).option("checkpointLocation", f"{tmp_dir}/cp").trigger(availableNow=True).start()
    if strict:
        with pytest.raises(StreamingQueryException):
            q.awaitTermination()
    else:
        q.awaitTermination()
    assert got == [message(1)]


def shared(spark, tmp_dir, sinks, **options):
    alerts = hype_alerts(parse_events(read_event_stream(spark, path=f"{tmp_dir}/in", max_per_trigger=1)))
    return start_shared_sinks(alerts, sinks, f"{tmp_dir}/cp", **{"available_now": True, **options})


def test_two_sinks_share_one_read(spark, tmp_dir):
    sinks = [Sink("parquet", f"{tmp_dir}/p"), Sink("json", f"{tmp_dir}/j")]
    assert sinks[0].read(spark, ALERT_SCHEMA).collect() == []
    for k in range(3):
        put(f"{tmp_dir}/in", f"f{k}", 10 * k, 10 * k + 1)
    q = shared(spark, tmp_dir, sinks)
    q.awaitTermination()
    assert sum(p["numInputRows"] for p in q.recentProgress) == 6  # once for both sinks
    put(f"{tmp_dir}/in", "f3", 30)
    shared(spark, tmp_dir, sinks).awaitTermination()
    for sink in sinks:
        rows = sink.read(spark, ALERT_SCHEMA).collect()
        assert sorted(r.concurrent_players for r in rows) == [0, 1, 10, 11, 20, 21, 30]
        assert len({(r[BATCH], r.concurrent_players // 10) for r in rows}) == 4 and sink.last(spark) == 3
        assert names_in(spark, sink.ledger) == ["3"] or sorted(n for n in names_in(spark, sink.ledger) if n.isdigit()) == ["3"]
    with pytest.raises(ValueError):
        start_shared_sinks(hype_alerts(parse_events(read_event_stream(spark, path=f"{tmp_dir}/in"))), sinks, f"{tmp_dir}/other", available_now=True)


def test_a_failed_batch_goes_only_to_the_sinks_that_lack_it(spark, tmp_dir):
    class Broken(Sink):
        def take(self, rows, batch_id):
            rows.limit(1).write.mode("overwrite").format(self.format).save(f"{self.path}/{BATCH}={batch_id}")  # a part, then the failure
            raise OSError("disk full")

    good = Sink("parquet", f"{tmp_dir}/p")
    put(f"{tmp_dir}/in", "f0", 1, 2)
    with pytest.raises(StreamingQueryException):
        shared(spark, tmp_dir, [good, Broken("json", f"{tmp_dir}/j")]).awaitTermination()
    other = Sink("json", f"{tmp_dir}/j")
    assert good.last(spark) == 0 and other.last(spark) == -1 and other.read(spark, ALERT_SCHEMA).count() == 0
    before = sorted(os.listdir(f"{tmp_dir}/p/{BATCH}=0"))
    put(f"{tmp_dir}/in", "f1", 3)
    shared(spark, tmp_dir, [good, other]).awaitTermination()
    for sink in (good, other):
        assert sorted((r[BATCH], r.concurrent_players) for r in sink.read(spark, ALERT_SCHEMA).collect()) == [(0, 1), (0, 2), (1, 3)]
    assert sorted(os.listdir(f"{tmp_dir}/p/{BATCH}=0")) == before  # not written again


def test_a_batch_without_its_ledger_entry_is_not_read(spark, tmp_dir):
    sink = Sink("parquet", f"{tmp_dir}/p")
    rows = parse_events(spark.createDataFrame([(message(k),) for k in (1, 2)], "value string"))
    assert sink.take(rows, 0) and not sink.take(rows, 0)
    rows.write.parquet(f"{tmp_dir}/p/{BATCH}=1")
    assert sink.read(spark, ALERT_SCHEMA).count() == 2
    write_small(spark, f"{sink.ledger}/1", "written")
    assert sink.read(spark, ALERT_SCHEMA).count() == 4


def test_timed_run_over_two_arrivals(spark, tmp_dir):
    put(f"{tmp_dir}/in", "a", 1, 2)
    sink = Sink("parquet", f"{tmp_dir}/p")
    q = shared(spark, tmp_dir, [sink], available_now=False, trigger="200 milliseconds")
    try:
        first = await_rows(q, 2)
        assert first == {0: 2} and q.isActive
        put(f"{tmp_dir}/in", "b", 3)
        assert await_rows(q, 3, first) == {0: 2, 1: 1}
        with pytest.raises(TimeoutError):
            await_rows(q, 4, first, timeout=0.5)
    finally:
        q.stop()
    assert sorted((r[BATCH], r.concurrent_players) for r in sink.read(spark, ALERT_SCHEMA).collect()) == [(0, 1), (0, 2), (1, 3)]


def test_timed_query_names_the_arrival_of_every_alert(spark):
    rows = hype_alerts_timed(spark, SF_SMALL)
    assert rows.where(F.col("arrival") != F.col("is_on_sale") + 1).count() == 0 and rows.select("arrival").distinct().count() == 2
