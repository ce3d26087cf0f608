"""Data tests over the stored candles, then the marts.

Fails if a test finds bad rows, and then leaves the published marts as they were. With ``--version``
all marts are written first and published together; without, they are replaced one by one. Candles come
from a parquet layer or a database table, sentiment from a path or a catalog table.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from candlemill import schemas
from candlemill.operators import health, marts, quality
from candlemill.session import build_session
from candlemill.sources.layers import in_days
from candlemill.sources.staging import drop_staged, stage
from candlemill.sources.swaps import point_marts, publish_marts
from candlemill.sources.warehouse import read_table, read_warehouse, write_mart


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description=__doc__)
    source = args.add_mutually_exclusive_group(required=True)
    source.add_argument("--candles", help="parquet layer")
    source.add_argument("--jdbc-url", help="database that holds the candles")
    args.add_argument("--jdbc-table", default="fact_market_candles")
    args.add_argument("--jdbc-option", action="append", default=[], metavar="KEY=VALUE")
    args.add_argument("--start", help="first day of candles, YYYY-MM-DD")
    args.add_argument("--end", help="last day of candles, YYYY-MM-DD")
    readings = args.add_mutually_exclusive_group(required=True)
    readings.add_argument("--sentiment", help="parquet path")
    readings.add_argument("--sentiment-table", help="catalog table")
    args.add_argument("--out", required=True, help="folder of the mart tables")
    args.add_argument("--pair", action="append", help="pair to keep in the price mart; default all")
    args.add_argument("--version", type=int, help="publish all marts at once, as this version below --out")
    args.add_argument("--as-of", help="moment that freshness is measured at, default now")
    opts = args.parse_args(argv)

    spark = build_session("marts")
    if opts.candles:
        candles = spark.read.parquet(opts.candles)
        if opts.start or opts.end:
            candles = candles.where(in_days(opts.start, opts.end))
    else:
        options = dict(pair.split("=", 1) for pair in opts.jdbc_option)
        candles = read_warehouse(spark, opts.jdbc_url, opts.jdbc_table, **options)
        if opts.start:
            candles = candles.where(F.col("candle_start_time") >= F.lit(opts.start).cast("timestamp"))
        if opts.end:
            next_day = F.date_add(F.lit(opts.end).cast("date"), 1).cast("timestamp")
            candles = candles.where(F.col("candle_start_time") < next_day)
    candles = candles.select(*schemas.CANDLES.names)
    if opts.sentiment:
        sentiment = spark.read.schema(schemas.SENTIMENT).parquet(opts.sentiment)
    else:
        sentiment = read_table(spark, opts.sentiment_table)

    staged = []

    def kept(df):
        staged.append(stage(df, "marts"))
        return staged[-1]

    report = kept(health.ingestion_health(candles, opts.as_of, stage=kept))
    hourly = staged[0]
    checks = quality.quality_report(
        candles, quality.candle_rules(), quality.CANDLE_KEYS
    ).unionByName(quality.quality_report(report, quality.completeness_rules()))
    # One row per rule.
    failed = [row for row in checks.collect() if row.failing_rows]
    if not failed:
        built = {
            "mart_market_overview": marts.price_vs_sentiment(marts.daily_prices(candles, opts.pair), sentiment),
            "mart_hourly_ingestion": hourly,
            "mart_ingestion_health": report,
            "mart_daily_summary": health.daily_summary(candles),
        }
        if opts.version is not None:
            publish_marts(built, opts.out, opts.version)
            point_marts(spark, opts.out, *built)
        else:
            for table, mart in built.items():
                write_mart(mart, table, f"{opts.out}/{table}")
    for df in staged:
        drop_staged(df)
    if failed:
        raise SystemExit("\n".join(f"{r.rule}: {r.failing_rows} of {r.checked_rows}" for r in failed))


if __name__ == "__main__":
    main()
