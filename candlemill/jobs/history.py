"""One hour of silver (or all of it) to the history table. Running an hour again replaces it.

A database table, if named, gets the rows appended (an hour) or is replaced by them (all).
"""

from __future__ import annotations

import argparse
from datetime import datetime

from candlemill import schemas
from candlemill.operators.history import SLICE_PARTITIONS, history_slice, run_hour
from candlemill.session import build_session
from candlemill.sources.layers import read_layer, write_layer
from candlemill.sources.warehouse import write_warehouse


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--silver", required=True)
    args.add_argument("--history", required=True)
    which = args.add_mutually_exclusive_group(required=True)
    which.add_argument("--hour", type=datetime.fromisoformat, help="in UTC")
    which.add_argument("--all", action="store_true")
    args.add_argument("--jdbc-url")
    args.add_argument("--jdbc-table", default="history")
    args.add_argument("--jdbc-option", action="append", default=[], metavar="KEY=VALUE")
    opts = args.parse_args(argv)

    spark = build_session("history")
    rows = history_slice(read_layer(spark, opts.silver, schemas.SILVER), opts.hour)
    if opts.hour:
        # The hour's own folder, so that an hour without trades any more loses its old rows.
        start = run_hour(opts.hour)
        folder = f"{opts.history}/trade_date={start:%Y-%m-%d}/trade_hour={start.hour}"
        rows.drop(*SLICE_PARTITIONS).write.mode("overwrite").parquet(folder)
    else:
        folder = opts.history
        write_layer(rows, folder, SLICE_PARTITIONS, replace_partitions=True)
    if opts.jdbc_url:
        # From the stored rows, so that silver is not read again.
        stored = spark.read.schema(rows.schema).parquet(folder).drop(*SLICE_PARTITIONS)
        options = dict(pair.split("=", 1) for pair in opts.jdbc_option)
        mode = "append" if opts.hour else "overwrite"
        write_warehouse(stored, opts.jdbc_url, opts.jdbc_table, mode, **options)


if __name__ == "__main__":
    main()
