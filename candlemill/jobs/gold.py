"""Silver trades to candles: a parquet layer by day, and a database table if one is named.

With a range of days, or the record of days that silver runs have rebuilt, only those are read and
replaced: a late trade has the candles of its day built again. Otherwise the whole history is
rebuilt.
"""

from __future__ import annotations

import argparse
from dataclasses import replace

from candlemill import schemas
from candlemill.config import DEFAULTS
from candlemill.operators.candles import candles, silver_order, width_micros
from candlemill.operators.refine import add_partitions
from candlemill.session import build_session
from candlemill.sources.layers import read_layer, write_layer
from candlemill.sources.warehouse import write_warehouse
from candlemill.streaming.rebuild import candle_days

_DAY_MICROS = 86_400_000_000


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--silver", required=True)
    args.add_argument("--candles", required=True)
    args.add_argument("--width", default=DEFAULTS.candle_width, help="must divide a day")
    args.add_argument("--start", help="first day, YYYY-MM-DD")
    args.add_argument("--end", help="last day, YYYY-MM-DD")
    args.add_argument("--days", help="record of rebuilt days, of which the new ones are taken")
    args.add_argument("--checkpoint", help="how far the record has been read")
    args.add_argument("--jdbc-url")
    args.add_argument("--jdbc-table", default="fact_market_candles")
    args.add_argument("--jdbc-option", action="append", default=[], metavar="KEY=VALUE")
    opts = args.parse_args(argv)
    width = width_micros(opts.width)
    # A window over two days would be rebuilt from the trades of one of them.
    if not width or _DAY_MICROS % width:
        args.error(f"the width must divide a day: {opts.width}")

    if bool(opts.days) != bool(opts.checkpoint) or (opts.days and (opts.start or opts.end)):
        args.error("--days and --checkpoint go together, without --start and --end")

    spark = build_session("gold")
    if opts.days:
        settings = replace(DEFAULTS, candle_width=opts.width)
        candle_days(spark, opts.days, opts.silver, opts.candles, opts.checkpoint, settings).awaitTermination()
    else:
        trades = read_layer(spark, opts.silver, schemas.SILVER, opts.start, opts.end)
        built = candles(trades, opts.width, **silver_order())
        by_day = add_partitions(built, "candle_start_time")
        write_layer(by_day, opts.candles, schemas.SILVER_PARTITIONS, replace_partitions=True)

    if opts.jdbc_url:
        # From the stored candles, so that the trades are not aggregated again.
        stored = spark.read.parquet(opts.candles).select(*schemas.CANDLES.names)
        options = dict(pair.split("=", 1) for pair in opts.jdbc_option)
        write_warehouse(stored, opts.jdbc_url, opts.jdbc_table, **options)


if __name__ == "__main__":
    main()
