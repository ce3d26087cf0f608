"""New bronze files to clean, enriched, deduplicated silver trades.

The days that new files hold are rebuilt, so that no trade is late. ``--stream`` appends by a
watermark instead, in a folder of its own.
"""

from __future__ import annotations

import argparse
from dataclasses import replace

from candlemill.config import DEFAULTS
from candlemill.session import build_session, streaming_session
from candlemill.streaming.drain import input_rows, late_rows
from candlemill.streaming.rebuild import silver_days
from candlemill.streaming.runs import run_silver


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--bronze", required=True)
    args.add_argument("--silver", required=True)
    args.add_argument("--checkpoint", required=True)
    args.add_argument("--price-cap", type=float, default=DEFAULTS.price_cap)
    args.add_argument("--large-trade", type=float, default=DEFAULTS.large_trade)
    args.add_argument("--watermark", default=DEFAULTS.watermark)
    args.add_argument("--salts", type=int, default=DEFAULTS.dedup_salts)
    args.add_argument("--state-partitions", type=int, help="fixed by the first run")
    args.add_argument("--days", help="folder for the record of rebuilt days, which gold reads")
    args.add_argument("--max-files", type=int, help="bronze files looked at before a rebuild")
    args.add_argument("--stream", action="store_true")
    args.add_argument("--files-per-day", type=int, default=0)
    opts = args.parse_args(argv)

    spark = build_session("silver")
    settings = replace(
        DEFAULTS,
        price_cap=opts.price_cap,
        large_trade=opts.large_trade,
        watermark=opts.watermark,
        dedup_salts=opts.salts,
    )
    if not opts.stream:
        query = silver_days(
            spark, opts.bronze, opts.silver, opts.checkpoint, opts.days, settings, max_files=opts.max_files
        )
        query.awaitTermination()
        print(f"silver: {input_rows(query)} new bronze rows")
        return
    query = run_silver(
        streaming_session(spark, opts.state_partitions),
        opts.bronze,
        opts.silver,
        opts.checkpoint,
        settings,
        files_per_day=opts.files_per_day,
    )
    query.awaitTermination()
    print(f"silver: {input_rows(query)} bronze rows read, {late_rows(query)} dropped as late")


if __name__ == "__main__":
    main()
