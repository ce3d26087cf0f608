"""Trade messages, from a topic or from parquet files, to the bronze layer."""

from __future__ import annotations

import argparse

from candlemill import schemas
from candlemill.session import build_session, streaming_session
from candlemill.sources.layers import stream_layer
from candlemill.sources.topic import read_topic
from candlemill.streaming.drain import input_rows
from candlemill.streaming.runs import run_bronze


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description=__doc__)
    source = args.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="Kafka bootstrap servers; needs --topic")
    source.add_argument("--files", help="folder of parquet files with key and value")
    args.add_argument("--topic")
    args.add_argument("--min-partitions", type=int)
    args.add_argument("--max-offsets", type=int)
    args.add_argument("--allow-data-loss", action="store_true")
    args.add_argument("--no-gather", action="store_true", help="do not gather rows by hour")
    args.add_argument("--bronze", required=True)
    args.add_argument("--checkpoint", required=True)
    opts = args.parse_args(argv)

    spark = streaming_session(build_session("bronze"))
    if opts.files:
        messages = stream_layer(spark, opts.files, schemas.MESSAGE)
    else:
        messages = read_topic(
            spark,
            opts.servers,
            opts.topic,
            fail_on_data_loss=not opts.allow_data_loss,
            min_partitions=opts.min_partitions,
            max_offsets=opts.max_offsets,
        )
    query = run_bronze(messages, opts.bronze, opts.checkpoint, gather=not opts.no_gather)
    query.awaitTermination()
    print(f"bronze: {input_rows(query)} messages")


if __name__ == "__main__":
    main()
