"""Every operator run over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill import schemas
from candlemill.config import Settings
from candlemill.operators import active, decode, health, history, marts, partials, quality, refine
from candlemill.operators.candles import candles, silver_order
from candlemill.operators.upsert import latest_per_key, upsert
from candlemill.plans import views
from candlemill.session import streaming_session
from candlemill.sources import layers, staging, swaps, warehouse
from candlemill.streaming import marks as symbol_marks
from candlemill.streaming import rebuild, runs

Query = Callable[[SparkSession, str], DataFrame]

# The pairs of the price mart; candles of the others are left out of it.
PAIRS = ["clickusdt", "errorusdt", "purchaseusdt"]


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({name: F.round(name, d) for name, d in digits.items()})


# -- decoding ---------------------------------------------------------------------------------


def envelope_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope to record, record to keyed message, message back to record."""
    found, _ = decode.decode_envelope(views.envelopes(spark, sf_dir), as_of=views.BUILT_AT)
    return decode.decode_records(decode.to_messages(found)).drop("rejected_value")


def envelope_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = decode.normalise_envelope(views.envelopes(spark, sf_dir), as_of=views.BUILT_AT)
    outcome = F.coalesce("reject_reason", F.lit("accepted")).alias("outcome")
    return both.groupBy(outcome, "rejected_value").agg(F.count("*").alias("messages"))


def message_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = decode.normalise_envelope(views.envelopes(spark, sf_dir), as_of=views.BUILT_AT)
    return decode.route_messages(both, "trades", "rejects")


def sentiment_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readings of all payloads, then the newest per date."""
    readings = decode.parse_sentiment(views.sentiment_payloads(spark, sf_dir))
    return latest_per_key(readings, ["date"], "reading_time").drop("reading_time")


def sentiment_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first reading of each payload, which is its newest."""
    readings = decode.parse_sentiment(views.sentiment_payloads(spark, sf_dir), newest_only=True)
    return readings.drop("reading_time")


# -- layers -----------------------------------------------------------------------------------


def bronze_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.naive(refine.bronze(views.records(spark, sf_dir)))


def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refine.clean_trades(views.dirty_records(spark, sf_dir))


def silver_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    raw = views.sized_events(spark, sf_dir).select(
        "event_id",
        F.col("event_type").alias("symbol"),
        (F.col("value") / 3).alias("price"),
        k.cast("double").alias("quantity"),
        F.when(k % 7 != 0, F.col("user_id") % 2 == 0).alias("is_buyer_maker"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("trade_time"),
        F.when(k % 9 == 0, F.lit("no time"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .alias("ingested_at"),
    )
    typed = refine.type_trades(raw)
    return views.naive(refine.enrich_trades(typed, large=5_000.0, as_of=views.BUILT_AT))


def dedup_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each trade twice, the copy with a later ingest time and the opposite flag."""
    first = views.trades(spark, sf_dir).drop("trade_id")
    time = F.col("trade_timestamp")
    first = first.withColumn("ingest_timestamp", time + F.expr("interval 1 second"))
    copy = first.withColumns(
        {
            "ingest_timestamp": time + F.expr("interval 2 seconds"),
            "is_buyer_maker": ~F.col("is_buyer_maker"),
        }
    )
    return views.naive(refine.dedup_trades(first.unionByName(copy)))


def dedup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = views.table(spark, sf_dir, "lineitem", views.LINEITEM)
    return refine.dedup_trades(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def layer_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver written by day, every day replaced by a second run, read back by a range of days."""
    raw = views.records(spark, sf_dir)
    trades = refine.silver(raw, as_of=views.BUILT_AT).select(*schemas.SILVER.names)
    path = staging.new_folder(spark, "silver")
    for _ in range(2):
        layers.write_layer(trades, path, schemas.SILVER_PARTITIONS, replace_partitions=True)
    return views.naive(layers.read_layer(spark, path, schemas.SILVER, start="2024-01-05", end="2024-01-20"))


def history_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hour loaded, from frames of which one lacks a column; then one hour run again."""
    trades = views.trades(spark, sf_dir).drop("trade_id")
    complete = trades.where("is_buyer_maker").withColumn(
        "ingest_timestamp", F.col("trade_timestamp") + F.expr("interval 1 second")
    )
    older = trades.where("not is_buyer_maker")
    silver = history.concat_frames([older, complete])
    path = staging.new_folder(spark, "history")
    for hour in (None, datetime(2024, 1, 10, 7)):
        rows = history.history_slice(silver, hour)
        layers.write_layer(rows, path, history.SLICE_PARTITIONS, replace_partitions=True)
    return views.naive(history.history_columns(spark.read.schema(rows.schema).parquet(path)))


def sentiment_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekday readings, with those of Wednesday to Sunday replaced or added."""
    payloads = views.sentiment_payloads(spark, sf_dir).where(F.weekday("date").between(2, 6))
    new = decode.parse_sentiment(payloads)
    merged = upsert(
        views.sentiment_table(spark, sf_dir), new, ["date"], "reading_time", as_of=views.BUILT_AT
    )
    return views.naive(merged)


# -- candles ----------------------------------------------------------------------------------


def _candle_query(width: str) -> Query:
    return lambda spark, sf_dir: views.naive(views.trade_candles(spark, sf_dir, width))


def candles_7h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A width that divides no day, times of microseconds, prices far above silver's cap."""
    number = F.col("trade_id")
    micros = F.timestamp_micros(F.unix_micros("trade_timestamp") + number % 1000)
    trades = views.trades(spark, sf_dir).withColumns(
        {
            "price": F.col("price") * F.when(number % 10 == 0, 1_000_000.0).otherwise(1.0),
            "trade_timestamp": micros,
        }
    )
    return views.naive(candles(trades, "7 hours", **silver_order(), as_of=views.BUILT_AT))


def candles_by_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades of the same time ranked by price, as when the feed carries no sequence number.

    Times are cut to the second, so that ties occur.
    """
    trades = views.trades(spark, sf_dir).withColumns(
        {
            "trade_timestamp": F.date_trunc("second", "trade_timestamp"),
            "ingest_timestamp": F.col("trade_timestamp"),
        }
    )
    built = candles(trades, "5 minutes", as_of=views.BUILT_AT, ingest="ingest_timestamp")
    return views.naive(built)


# -- marts ------------------------------------------------------------------------------------


def daily_price_vs_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = marts.daily_prices(views.pair_candles(spark, sf_dir), PAIRS)
    mart = marts.price_vs_sentiment(daily, views.sentiment_table(spark, sf_dir))
    return marts.newest_days_first(_rounded(mart, avg_price=9, total_volume=2))


def hourly_ingestion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.naive(health.hourly_ingestion(views.trade_candles(spark, sf_dir)))


def hourly_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly summary with a row for every hour up to a fixed moment."""
    report = health.hourly_ingestion(
        views.trade_candles(spark, sf_dir), fill_gaps=True, until=views.AS_OF, stage=staging.stage
    )
    return views.naive(report)


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = health.freshness(views.trade_candles(spark, sf_dir), views.AS_OF)
    return views.naive(_rounded(report, minutes_since_last_candle=9))


def daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = health.daily_summary(views.trade_candles(spark, sf_dir))
    return views.naive(_rounded(report, avg_trades_per_candle=9))


def ingestion_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = health.ingestion_health(
        views.trade_candles(spark, sf_dir), views.AS_OF, stage=staging.stage
    )
    report = health.newest_hours_first(report)
    return views.naive(_rounded(report, minutes_since_last_candle=9))


def chart_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.naive(marts.close_series(views.trade_candles(spark, sf_dir)))


def chart_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.volume_by_symbol(views.trade_candles(spark, sf_dir))


def chart_pressure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.naive(_rounded(marts.pressure(views.trade_candles(spark, sf_dir)), buy_share=9))


def chart_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.activity_heatmap(views.trade_candles(spark, sf_dir))


def quality_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candle rules over candles of which some break each of them."""
    rules = quality.candle_rules() | quality.completeness_rules()
    return quality.quality_report(views.dirty_candles(spark, sf_dir), rules, quality.CANDLE_KEYS)


def quality_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that fail, over records with known dirt."""
    rules = {
        "symbol_not_null": F.col("symbol").isNull(),
        "price_positive": F.col("price") <= 0,
        "price_below_cap": F.col("price") >= 1_000_000,
        "trade_time_not_null": F.col("trade_time").isNull(),
    }
    return quality.quality_report(views.dirty_records(spark, sf_dir), rules, ["symbol", "trade_time"])


def warehouse_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly candles stored as a catalog table and read back by name."""
    path = staging.new_folder(spark, "candle_mart")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    warehouse.write_mart(views.trade_candles(spark, sf_dir, "1 hour"), table, path)
    return views.naive(warehouse.read_table(spark, table))


# -- streams ----------------------------------------------------------------------------------


def stream_bronze_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages, each sent twice, drained into bronze and on into silver."""
    work = staging.new_folder(spark, "stream")
    sent = decode.to_messages(views.records(spark, sf_dir))
    sent.unionByName(sent).write.parquet(f"{work}/topic")

    session = streaming_session(spark, spark.sparkContext.defaultParallelism)
    messages = session.readStream.schema(schemas.MESSAGE).parquet(f"{work}/topic")
    runs.run_bronze(messages, f"{work}/bronze", f"{work}/bronze_checkpoint").awaitTermination()
    runs.run_silver(
        session,
        f"{work}/bronze",
        f"{work}/silver",
        f"{work}/silver_checkpoint",
        as_of=views.BUILT_AT,
        files_per_day=1,
    ).awaitTermination()
    return views.naive(layers.read_layer(spark, f"{work}/silver", schemas.SILVER))


def _two_loads(spark: SparkSession, sf_dir: str, gold: bool) -> str:
    """Layers of two loads on the same checkpoints. The second holds late trades of every day.

    Every message is sent twice, and each load looks at its bronze files in several micro-batches.
    """
    work = staging.new_folder(spark, "days")
    records = views.records(spark, sf_dir)
    session = streaming_session(spark)
    for late in (False, True):
        sent = decode.to_messages(records.where((F.col("quantity") % 3 == 0) == late))
        sent.unionByName(sent).write.mode("append").parquet(f"{work}/topic")
        messages = session.readStream.schema(schemas.MESSAGE).parquet(f"{work}/topic")
        runs.run_bronze(messages, f"{work}/bronze", f"{work}/c/bronze").awaitTermination()
        rebuild.silver_days(
            spark,
            f"{work}/bronze",
            f"{work}/silver",
            f"{work}/c/silver",
            f"{work}/changed",
            as_of=views.BUILT_AT,
            max_files=500,
        ).awaitTermination()
        if gold:
            rebuild.candle_days(
                spark,
                f"{work}/changed",
                f"{work}/silver",
                f"{work}/candles",
                f"{work}/c/candles",
                Settings(candle_width="1 hour"),
                as_of=views.BUILT_AT,
            ).awaitTermination()
    return work


def silver_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver of two loads, the days of new files rebuilt."""
    work = _two_loads(spark, sf_dir, gold=False)
    return views.naive(layers.read_layer(spark, f"{work}/silver", schemas.SILVER))


def gold_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles of two loads, the days that silver rebuilt made anew."""
    work = _two_loads(spark, sf_dir, gold=True)
    built = spark.read.schema(schemas.CANDLES).parquet(f"{work}/candles")
    return views.naive(built.select(*schemas.CANDLES.names))


def stream_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly candles of a drained stream: the windows it has closed, and those still open."""
    work = staging.new_folder(spark, "stream")
    typed = refine.type_trades(views.records(spark, sf_dir))
    trades = refine.add_partitions(refine.enrich_trades(typed, as_of=views.BUILT_AT), "trade_timestamp")
    layers.write_layer(trades, f"{work}/silver", schemas.SILVER_PARTITIONS)

    session = streaming_session(spark, spark.sparkContext.defaultParallelism)
    layer, built, settings = f"{work}/silver", f"{work}/candles", Settings(candle_width="1 hour")
    runs.run_candles(
        session, layer, built, f"{work}/checkpoint", settings, as_of=views.BUILT_AT
    ).awaitTermination()
    return views.naive(runs.current_candles(spark, layer, built, settings, as_of=views.BUILT_AT))


# -- kept and merged --------------------------------------------------------------------------


def _table_name(path: str) -> str:
    return path.rsplit("/", 1)[1].replace("-", "_")


def silver_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver by day in a catalog table, loaded twice and read between the second write and its swap.

    The second load has days 5 to 20 with a lower price cap; nothing of day 9 is usable any more.
    """
    work = staging.new_folder(spark, "swap")
    table = _table_name(work)
    raw = views.records(spark, sf_dir)
    swaps.create_day_table(spark, table, schemas.SILVER, f"{work}/none")

    def load(records: DataFrame, settings: Settings) -> str:
        return swaps.write_days(refine.silver(records, settings, views.BUILT_AT).select(*schemas.SILVER.names), work)

    def daily(phase: str) -> DataFrame:
        return (
            spark.table(table)
            .groupBy(F.make_date("year", "month", "day").alias("date"))
            .agg(F.count("*").alias("trades"), F.sum("quantity").alias("volume"), F.max("price").alias("top_price"))
            .withColumn("phase", F.lit(phase))
        )

    day = F.to_date(F.timestamp_millis("trade_time"))
    days = refine.add_partitions(refine.add_event_time(raw), "timestamp").select(*layers.DAY).distinct()
    swaps.swap_days(spark, table, load(raw, Settings()), days)
    some = raw.where(day.between(F.lit("2024-01-05").cast("date"), F.lit("2024-01-20").cast("date")))
    broken = F.when(day == F.lit("2024-01-09").cast("date"), -F.col("quantity")).otherwise(F.col("quantity"))
    folder = load(some.withColumn("quantity", broken), Settings(price_cap=100.0))
    between = staging.stage(daily("written"))
    swaps.swap_days(spark, table, folder, days.where("month = 1 AND day BETWEEN 5 AND 20"))
    return between.unionByName(daily("swapped"))


def marts_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two marts published twice, a third version written in part only: both are read as of the second."""
    path = staging.new_folder(spark, "marts")
    built = staging.stage(views.trade_candles(spark, sf_dir, "1 hour"))
    for version, symbols in ((1, ["view"]), (2, ["click", "error", "purchase", "view"])):
        some = built.where(F.col("symbol").isin(symbols))
        both = {"volume": marts.volume_by_symbol(some), "heatmap": marts.activity_heatmap(some)}
        swaps.publish_marts(both, path, version)
    both["volume"].where("false").write.parquet(f"{path}/volume/version=3")
    volume, heatmap = swaps.read_marts(spark, path, "volume", "heatmap")
    return volume.unionByName(heatmap, allowMissingColumns=True)


def _late_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute partials kept by day; late trades merged into those of their minutes alone."""
    path = staging.new_folder(spark, "partials")
    trades = views.trades(spark, sf_dir)
    for late in (False, True):
        new = partials.partial_candles(trades.where((F.col("quantity") % 3 == 0) == late))
        new = refine.add_partitions(new, "candle_start_time")
        if late:
            kept = spark.read.schema(new.schema).parquet(path)
            merged = partials.merge_candles(layers.of_days(kept, new).unionByName(new))
            new = staging.stage(refine.add_partitions(merged, "candle_start_time"))
        layers.write_layer(new, path, layers.DAY, replace_partitions=True)
    return spark.read.schema(new.schema).parquet(path)


def candles_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _late_partials(spark, sf_dir).select(*partials.COLUMNS)
    return views.naive(partials.finish_candles(kept, views.BUILT_AT))


def _rollup_query(*widths: str) -> Query:
    """Candles of the last width, merged from those of each width before it and from minutes."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        kept = _late_partials(spark, sf_dir)
        for width in widths:
            kept = partials.merge_candles(kept, width)
        return views.naive(partials.finish_candles(kept, views.BUILT_AT))

    return run


def silver_by_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver and late trades of two runs on one checkpoint, with a symbol far ahead in the first.

    The first run has half of the month, but all of ``view``; a third of the trades come with the
    second, most of them late.
    """
    work = staging.new_folder(spark, "by_symbol")
    raw = views.records(spark, sf_dir)
    early = F.timestamp_millis("trade_time") < F.lit("2024-01-16").cast("timestamp")
    first = (F.col("quantity") % 3 != 0) & (early | (F.col("symbol") == "view"))
    session = streaming_session(spark)
    for load in (raw.where(first), raw.where(~first)):
        layers.write_layer(refine.bronze(decode.decode_records(decode.to_messages(load))), f"{work}/bronze", schemas.BRONZE_PARTITIONS)
        stream = layers.stream_layer(session, f"{work}/bronze", schemas.BRONZE)
        symbol_marks.run_silver_by_symbol(
            spark, stream, f"{work}/out", f"{work}/checkpoint", as_of=views.BUILT_AT
        ).awaitTermination()
    on_time = symbol_marks.read_by_symbol(spark, f"{work}/out").withColumn("late", F.lit(False))
    late = symbol_marks.read_late(spark, f"{work}/out").drop("batch").withColumn("late", F.lit(True))
    return views.naive(on_time.unionByName(late, allowMissingColumns=True))


def health_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The health report from hourly rows kept by day, after a second load that touches one day."""
    work = staging.new_folder(spark, "health")
    trades = views.trades(spark, sf_dir)
    day = F.to_date("trade_timestamp")
    late = (F.col("quantity") % 3 == 0) & (day == F.lit("2024-01-10").cast("date"))
    session = streaming_session(spark)
    for number, load in enumerate((trades.where(~late), trades.where(day == F.lit("2024-01-10").cast("date")))):
        built = candles(load, "1 minute", tie="trade_id", as_of=views.BUILT_AT)
        by_day = staging.stage(refine.add_partitions(built, "candle_start_time"))
        layers.write_layer(by_day, f"{work}/candles", layers.DAY, replace_partitions=True)
        by_day.select(*layers.DAY).distinct().coalesce(1).write.parquet(f"{work}/days/run={number}")
        rebuild.hour_days(
            spark, f"{work}/days", f"{work}/candles", f"{work}/hours", f"{work}/checkpoint", stream=session
        ).awaitTermination()
    hourly = spark.read.parquet(f"{work}/hours").drop(*layers.DAY)
    report = health.newest_hours_first(health.health_from_hours(hourly, views.AS_OF))
    return views.naive(_rounded(report, minutes_since_last_candle=9))


def active_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact numbers of symbols by day, week and month, from bitmaps kept by hour."""
    built = views.trade_candles(spark, sf_dir, "5 minutes")
    known = active.number_symbols(built.where("minute(candle_start_time) < 30"))
    known = staging.stage(active.number_symbols(built, known), "symbols")
    hours = staging.stage(active.hourly_symbols(built, known), "bitmaps")
    counts = [active.count_symbols(hours, unit).withColumn("unit", F.lit(unit)) for unit in ("day", "week", "month")]
    return views.naive(counts[0].unionByName(counts[1]).unionByName(counts[2]))


QUERIES: dict[str, Query] = {
    "envelope_normalise": envelope_normalise,
    "envelope_rejects": envelope_rejects,
    "message_routing": message_routing,
    "sentiment_newest": sentiment_newest,
    "bronze_partitions": bronze_partitions,
    "silver_clean": silver_clean,
    "silver_enrich": silver_enrich,
    "dedup_trades": dedup_trades,
    "dedup_lines": dedup_lines,
    "layer_replace": layer_replace,
    "candles_1m": _candle_query("1 minute"),
    "candles_1h": _candle_query("1 hour"),
    "candles_7h": candles_7h,
    "candles_by_price": candles_by_price,
    "daily_price_vs_sentiment": daily_price_vs_sentiment,
    "hourly_ingestion": hourly_ingestion,
    "hourly_gaps": hourly_gaps,
    "freshness": freshness,
    "daily_summary": daily_summary,
    "ingestion_health": ingestion_health,
    "sentiment_parse": sentiment_parse,
    "sentiment_upsert": sentiment_upsert,
    "history_load": history_load,
    "chart_close": chart_close,
    "chart_volume": chart_volume,
    "chart_pressure": chart_pressure,
    "chart_heatmap": chart_heatmap,
    "quality_candles": quality_candles,
    "quality_trades": quality_trades,
    "warehouse_roundtrip": warehouse_roundtrip,
    "stream_bronze_to_silver": stream_bronze_to_silver,
    "stream_candles": stream_candles,
    "silver_days": silver_days,
    "gold_increment": gold_increment,
    "silver_swap": silver_swap,
    "marts_published": marts_published,
    "candles_late": candles_late,
    "candles_rolled_1h": _rollup_query("1 hour"),
    "candles_rolled_1d": _rollup_query("15 minutes", "1 hour", "1 day"),
    "silver_by_symbol": silver_by_symbol,
    "health_maintained": health_maintained,
    "active_symbols": active_symbols,
}
