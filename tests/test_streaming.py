"""Event parsing on hand-written messages; stream equals batch; restart adds nothing."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from kpiloom.sinks import writers
from kpiloom.sources import testdata
from kpiloom.sources.events import read_event_messages, read_event_stream
from kpiloom.streaming.alerts import hype_alerts, parse_events, start_alert_queries

from conftest import SF_SMALL

MESSAGES = [
    '{"timestamp":"2024-01-01T00:00:00.123456","platform":"PC","concurrent_players":5,"hype_spike":1}',
    '{"timestamp":"2024-01-01T00:00:00","platform":"PC","concurrent_players":"5","hype_spike":1}',
    '{"platform":"PC","hype_spike":1}',
    '{"timestamp":"nope","hype_spike":1,"extra":3}',
    '{"hype_spike":1.0}',
    '{"hype_spike":true}',
    'garbage',
    '[]',
    '{"hype_spike":1',
    None,
]


def test_parse_and_alert_hand_rows(spark):
    df = spark.createDataFrame([(m,) for m in MESSAGES], "value string")
    parsed = parse_events(df)
    assert parsed.columns[-1] == "event_time" and len(parsed.columns) == 9
    alerts = hype_alerts(parsed).collect()
    assert len(alerts) == 4
    first = alerts[0]
    assert first.platform == "PC" and first.concurrent_players == 5
    assert first.event_time == dt.datetime(2024, 1, 1, 0, 0, 0, 123456)
    assert alerts[1].concurrent_players is None and alerts[1].event_time == dt.datetime(2024, 1, 1)
    assert alerts[2].timestamp is None and alerts[2].event_time is None
    assert alerts[3].event_time is None


def test_binary_value_is_decoded(spark):
    df = spark.createDataFrame([(bytearray(MESSAGES[0].encode()),)], "value binary")
    assert parse_events(df).first().platform == "PC"


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_dir):
    source = os.path.join(tmp_dir, "in")
    out = os.path.join(tmp_dir, "alerts")
    ckpt = os.path.join(tmp_dir, "ckpt")
    events = testdata.event_rows(spark, SF_SMALL)
    writers.write_event_messages(events.repartition(3), source)

    def run():
        stream = read_event_stream(spark, path=source, max_per_trigger=1)
        for q in start_alert_queries(hype_alerts(parse_events(stream)), out, ckpt, available_now=True):
            q.awaitTermination()
        return spark.read.parquet(out)

    first = run()
    batch = hype_alerts(parse_events(read_event_messages(spark, source)))
    assert first.count() == batch.count() == 40
    assert first.exceptAll(batch).count() == 0 and batch.exceptAll(first).count() == 0
    assert run().count() == 40


def test_memory_sink(spark, tmp_dir):
    source = os.path.join(tmp_dir, "in")
    spark.createDataFrame([(m,) for m in MESSAGES if m], "value string").coalesce(1).write.text(source)
    q = (hype_alerts(parse_events(read_event_stream(spark, path=source)))
         .writeStream.format("memory").queryName("alerts_mem").outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("alerts_mem").count() == 4
    assert spark.table("alerts_mem").filter(F.col("hype_spike") != 1).count() == 0


def test_two_sinks_on_one_stream_and_clean_shutdown(spark, tmp_dir, capsys):
    from kpiloom.streaming.alerts import await_any

    source = os.path.join(tmp_dir, "in")
    spark.createDataFrame([(m,) for m in MESSAGES if m], "value string").coalesce(1).write.text(source)
    alerts = hype_alerts(parse_events(read_event_stream(spark, path=source)))
    queries = start_alert_queries(alerts, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt"),
                                  console=True, available_now=True)
    assert len(queries) == 2
    await_any(spark, queries, finite=True)
    assert not any(q.isActive for q in queries)
    assert spark.read.parquet(os.path.join(tmp_dir, "out")).count() == 4
