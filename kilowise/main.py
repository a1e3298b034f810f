"""Command line: ``report`` writes one query's result, ``stream`` runs the load.

    spark-submit kilowise/main.py report monthly_billing --tables DIR --out DIR
    spark-submit kilowise/main.py stream --servers HOST:PORT --topic T --customers DIR --root DIR

Stream folders and ``spark.checkpoint.dir`` must be on storage all executors share.
"""

from __future__ import annotations

import argparse
import datetime as dt

from kilowise.functions.columns import PEAK_RULES
from kilowise.plans.registry import QUERIES
from kilowise.plans.storage import clean_up
from kilowise.session import build_session
from kilowise.sources.readers import read_topic
from kilowise.streaming import etl


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="command", required=True)
    report = commands.add_parser("report")
    report.add_argument("name", choices=sorted(QUERIES))
    report.add_argument("--tables", required=True)
    report.add_argument("--out", required=True)
    stream = commands.add_parser("stream")
    stream.add_argument("--servers", required=True)
    stream.add_argument("--topic", default="smart_meter_data")
    stream.add_argument("--customers", required=True, help="Parquet folder of the customer table")
    stream.add_argument("--root", required=True, help="folder of the store; meters must be in ROOT/meters")
    stream.add_argument("--max-offsets", default="1000000")
    stream.add_argument("--peak-rule", default="evening", choices=sorted(PEAK_RULES))
    return parser.parse_args()


def main() -> None:
    args = arguments()
    spark = build_session(f"kilowise-{args.command}")
    if args.command == "report":
        QUERIES[args.name](spark, args.tables).write.mode("overwrite").parquet(args.out)
        clean_up(spark)
        return
    raw = read_topic(
        spark,
        options={
            "kafka.bootstrap.servers": args.servers,
            "subscribe": args.topic,
            "maxOffsetsPerTrigger": args.max_offsets,
        },
    )
    customers = spark.read.parquet(args.customers)
    queries = etl.run_stream_etl(raw, customers, etl.EtlPaths(args.root), dt.date.today(), args.peak_rule)
    etl.await_all(queries)


if __name__ == "__main__":
    main()
