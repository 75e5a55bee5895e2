"""Streaming job: event messages → hype-spike alerts → Parquet (append, checkpointed).

    spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:<version> jobs/stream.py \\
        --kafka <host:port> --topic <topic> --out <alerts folder> [--checkpoint <folder>] [--console]
    spark-submit jobs/stream.py --input <folder of JSON-lines files> --out <alerts folder> --available-now

Without ``--checkpoint`` the checkpoint goes beside the output folder
(``<out>_checkpoint``), so a restarted job resumes from its last committed
offsets wherever it runs.
"""

from __future__ import annotations

import argparse
import os
import sys

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

from kpiloom.session import build_session  # noqa: E402
from kpiloom.sources.events import read_event_stream  # noqa: E402
from kpiloom.streaming.alerts import ConsoleSink, Sink, await_any, hype_alerts, parse_events, start_alert_queries, start_shared_sinks  # noqa: E402


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--kafka")
    parser.add_argument("--topic")
    parser.add_argument("--input")
    parser.add_argument("--out", required=True)
    parser.add_argument("--checkpoint")
    parser.add_argument("--starting-offsets", default="latest")
    parser.add_argument("--starting-files", default="earliest", help="earliest, latest, or a time: files modified up to then are passed over")
    parser.add_argument("--fail-on-data-loss", action="store_true")
    parser.add_argument("--max-per-trigger", type=int)
    parser.add_argument("--trigger", default="30 seconds")
    parser.add_argument("--console", action="store_true")
    parser.add_argument("--available-now", action="store_true")
    parser.add_argument("--also", action="append", default=[], metavar="FORMAT=PATH",
                        help="a further sink of the same stream, read once for all of them; the console shares it, too")
    args = parser.parse_args(argv)

    spark = build_session("kpiloom-stream")
    try:
        checkpoint = args.checkpoint or args.out.rstrip("/") + "_checkpoint"
        messages = read_event_stream(spark, kafka_bootstrap=args.kafka, topic=args.topic, path=args.input,
                                     starting_offsets=args.starting_offsets, fail_on_data_loss=args.fail_on_data_loss,
                                     max_per_trigger=args.max_per_trigger, starting_files=args.starting_files,
                                     start_file=None if args.kafka else f"{checkpoint}_start")
        alerts = hype_alerts(parse_events(messages))
        if args.also:
            sinks = [Sink("parquet", args.out), *[Sink(*given.split("=", 1)) for given in args.also], *[ConsoleSink()] * args.console]
            queries = [start_shared_sinks(alerts, sinks, checkpoint, trigger=args.trigger, available_now=args.available_now)]
        else:
            queries = start_alert_queries(alerts, args.out, checkpoint, parquet_trigger=args.trigger,
                                          console=args.console, available_now=args.available_now)
        print(f"alerts → {args.out} (checkpoint {checkpoint})")
        await_any(spark, queries, finite=args.available_now)
        return 0
    except KeyboardInterrupt:
        return 0
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
