"""Sentiment payload files merged into the sentiment table.

Reads the current version of the table and writes the next one to a new path, so a failed run
leaves the current one as it was. A catalog table, if named, then points to the new path: readers
find the current version under its name, and the next run starts from it.
"""

from __future__ import annotations

import argparse

from candlemill import schemas
from candlemill.operators.decode import parse_sentiment
from candlemill.operators.upsert import upsert
from candlemill.session import build_session
from candlemill.sources.warehouse import point_table, read_table


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--payloads", required=True, help="text files, one JSON payload each")
    args.add_argument("--current", help="current version; left out on the first run, or with --table")
    args.add_argument("--table", help="catalog table that stands for the current version")
    args.add_argument("--next", required=True, help="path of the version to write")
    args.add_argument("--newest-only", action="store_true", help="first reading of each payload")
    opts = args.parse_args(argv)
    if opts.current and opts.table:
        args.error("--current and --table both name the current version")

    spark = build_session("sentiment")
    payloads = spark.read.text(opts.payloads, wholetext=True)
    readings = parse_sentiment(payloads, newest_only=opts.newest_only)
    if opts.table and spark.catalog.tableExists(opts.table):
        existing = read_table(spark, opts.table)
    elif opts.current:
        existing = spark.read.schema(schemas.SENTIMENT).parquet(opts.current)
    else:
        existing = spark.createDataFrame([], schemas.SENTIMENT)
    upsert(existing, readings, ["date"], "reading_time").write.parquet(opts.next)
    if opts.table:
        point_table(spark, opts.table, schemas.SENTIMENT, opts.next)


if __name__ == "__main__":
    main()
