"""Raw exchange messages from one topic to trade records in another, rejects to a third."""

from __future__ import annotations

import argparse

from candlemill.operators.decode import normalise_envelope, route_messages
from candlemill.session import build_session, streaming_session
from candlemill.sources.topic import read_topic, stream_to_topic


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--servers", required=True)
    args.add_argument("--raw-topic", required=True)
    args.add_argument("--topic", required=True)
    args.add_argument("--dead-letter", required=True)
    args.add_argument("--checkpoint", required=True)
    args.add_argument("--source", default="exchange", help="label put on every record")
    opts = args.parse_args(argv)

    spark = streaming_session(build_session("normalise"))
    raw = read_topic(spark, opts.servers, opts.raw_topic)
    routed = route_messages(normalise_envelope(raw, source=opts.source), opts.topic, opts.dead_letter)
    stream_to_topic(routed, opts.servers, opts.checkpoint).awaitTermination()


if __name__ == "__main__":
    main()
