"""Publishing job: event records → JSON messages on a Kafka topic or in text files.

    spark-submit jobs/publish.py --tables <folder of benchmark tables> --kafka <host:port> --topic <topic>
    spark-submit jobs/publish.py --tables <folder of benchmark tables> --out <folder>
"""

from __future__ import annotations

import argparse
import os
import sys

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

from kpiloom.session import build_session  # noqa: E402
from kpiloom.sinks.writers import publish_events_kafka, write_event_messages  # noqa: E402
from kpiloom.sources.testdata import event_rows  # noqa: E402


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--tables", required=True)
    parser.add_argument("--kafka")
    parser.add_argument("--topic")
    parser.add_argument("--out")
    args = parser.parse_args(argv)
    spark = build_session("kpiloom-publish")
    try:
        events = event_rows(spark, args.tables)
        if args.kafka:
            publish_events_kafka(events, args.kafka, args.topic)
        elif args.out:
            write_event_messages(events, args.out)
        else:
            parser.error("give --kafka/--topic or --out")
        return 0
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
