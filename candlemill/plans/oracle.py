"""The same results in SQL for DuckDB, from the raw tables."""

from __future__ import annotations

BUILT_AT = "TIMESTAMP '2024-02-01 00:00:00'"
AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

TRADES = f"""
trades AS (
  SELECT event_type AS symbol, value AS price, CAST({K} AS DOUBLE) AS quantity,
         user_id % 2 = 0 AS is_buyer_maker, ts AS trade_timestamp, event_id AS trade_id
  FROM events
)"""

RECORDS = f"""
records AS (
  SELECT 'exchange' AS source, event_type AS symbol, value AS price,
         CAST({K} AS DOUBLE) AS quantity, epoch_us(ts) // 1000 AS trade_time,
         user_id % 2 = 0 AS is_buyer_maker,
         strftime(ts + to_seconds({K}), '%Y-%m-%dT%H:%M:%S.%f') AS ingested_at
  FROM events
)"""


def _candles(width: str, source: str = "trades", tie: str = "trade_id") -> str:
    """Candle columns over ``source``, open and close by time and then ``tie``."""
    start = f"time_bucket(INTERVAL '{width}', trade_timestamp, TIMESTAMP '1970-01-01')"
    return f"""
  SELECT {start} AS candle_start_time, symbol,
         first(price ORDER BY trade_timestamp, {tie}) AS open_price,
         max(price) AS high_price, min(price) AS low_price,
         last(price ORDER BY trade_timestamp, {tie}) AS close_price,
         sum(quantity) AS total_volume,
         sum(CASE WHEN NOT is_buyer_maker THEN quantity ELSE 0 END) AS buy_volume_taker,
         sum(CASE WHEN is_buyer_maker THEN quantity ELSE 0 END) AS sell_volume_maker,
         count(*) AS trade_count, {BUILT_AT} AS ingested_at
  FROM {source} GROUP BY ALL"""


CANDLES = f"WITH {TRADES}, candles AS ({_candles('1 minute')})"

# The messages as text, as the exchange sends them.
BODY = f"""'{{"stream":"' || event_type || '@trade","data":{{"s":"' || event_type || '","p":"'
  || CASE WHEN {K} % 17 = 0 THEN 'n/a' ELSE value::VARCHAR END || '","q":"' || {K}
  || '","T":' || epoch_us(ts) // 1000 || ',"m":' || (user_id % 2 = 0) || '}}}}'"""

ENVELOPES = f"""
WITH bodies AS (SELECT *, {BODY} AS body FROM events),
envelopes AS (
  SELECT *, {K} AS k,
         CASE WHEN {K} % 11 = 0 THEN '{{"stream":"status"}}' WHEN {K} % 13 = 0 THEN left(body, length(body) - 1)
              ELSE body END AS message,
         CASE WHEN {K} % 11 = 0 THEN 'no data' WHEN {K} % 13 = 0 THEN 'malformed'
              WHEN {K} % 17 = 0 THEN 'price is not a number' ELSE 'accepted' END AS outcome
  FROM bodies
)"""

HOURLY = """
  SELECT date_trunc('hour', candle_start_time) AS ingestion_hour, symbol,
         count(*) AS candles_count, CAST(sum(trade_count) AS BIGINT) AS total_trades,
         sum(total_volume) AS total_volume, max(ingested_at) AS last_ingested_at,
         min(candle_start_time) AS earliest_candle, max(candle_start_time) AS latest_candle,
         round(count(*) * CAST(100 AS DOUBLE) / 60, 1) AS completeness_pct,
         60 - count(*) AS missing_candles
  FROM candles GROUP BY ALL"""

FRESHNESS = f"""
  SELECT symbol, max(candle_start_time) AS latest_candle_time,
         max(ingested_at) AS latest_ingestion_time,
         round(date_diff('microsecond', max(candle_start_time), {AS_OF}) / CAST(60000000 AS DOUBLE), 9)
           AS minutes_since_last_candle,
         CASE WHEN date_diff('microsecond', max(candle_start_time), {AS_OF}) <= 5 * 60000000
                THEN 'Fresh ✅'
              WHEN date_diff('microsecond', max(candle_start_time), {AS_OF}) <= 30 * 60000000
                THEN 'Stale ⚠️'
              ELSE 'Dead ❌' END AS freshness_status
  FROM candles GROUP BY symbol"""

DAILY = """
  SELECT date_trunc('day', candle_start_time)::TIMESTAMP AS date, count(*) AS total_candles,
         count(DISTINCT symbol) AS active_symbols,
         CAST(sum(trade_count) AS BIGINT) AS total_trades, sum(total_volume) AS total_volume,
         round(avg(trade_count), 9) AS avg_trades_per_candle,
         round(count(*) * CAST(100 AS DOUBLE) / nullif(count(DISTINCT symbol) * 1440, 0), 1)
           AS daily_completeness_pct
  FROM candles GROUP BY ALL"""


def _class(value: str) -> str:
    return f"""CASE WHEN {value} < 25 THEN 'Extreme Fear' WHEN {value} < 45 THEN 'Fear'
      WHEN {value} < 55 THEN 'Neutral' WHEN {value} < 75 THEN 'Greed' ELSE 'Extreme Greed' END"""


SENTIMENT = f"""
counted AS (
  SELECT CAST(ts AS DATE) AS date,
         CAST(count(*) FILTER (event_type = 'error') % 101 AS INTEGER) AS fng_value
  FROM events GROUP BY ALL
),
sentiment AS (
  SELECT date, fng_value, {_class('fng_value')} AS fng_classification
  FROM counted WHERE isodow(date) <= 5
)"""

# The afternoon's reading is the newest of its day.
PAYLOADS = f"""
afternoons AS (
  SELECT CAST(ts AS DATE) AS date,
         CAST(count(*) FILTER (event_type = 'purchase' AND hour(ts) >= 12) % 101 AS INTEGER)
           AS fng_value
  FROM events GROUP BY ALL
),
newest AS (
  SELECT date, fng_value, {_class('fng_value')} AS fng_classification FROM afternoons
)"""

DIRTY = f"""
WITH dirty AS (
  SELECT event_id,
         CASE WHEN {K} % 10 = 5 THEN NULL ELSE event_type END AS symbol,
         CASE {K} % 10 WHEN 0 THEN NULL WHEN 1 THEN -value WHEN 2 THEN value * 10000 ELSE value END
           AS price,
         CASE {K} % 10 WHEN 3 THEN 0.0::DOUBLE WHEN 4 THEN 'inf'::DOUBLE WHEN 7 THEN 'nan'::DOUBLE
              ELSE {K} + 1 END AS quantity,
         CASE WHEN {K} % 10 = 6 THEN NULL ELSE epoch_us(ts) // 1000 END AS trade_time
  FROM events
)"""


def _parts(ts: str, *names: str) -> str:
    return ", ".join(f"CAST({n}({ts}) AS INTEGER) AS {n}" for n in names)


def _report(rules: dict[str, str], source: str) -> str:
    """One row per rule, each with its own count."""
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, ({count}) AS failing_rows, (SELECT count(*) FROM {source}) AS checked_rows"
        for rule, count in rules.items()
    )


def _failing(source: str, condition: str) -> str:
    return f"SELECT count(*) FROM {source} WHERE {condition}"


def _repeated(source: str, keys: str) -> str:
    return (
        f"SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM "
        f"(SELECT count(*) AS n FROM {source} GROUP BY {keys} HAVING count(*) > 1)"
    )


SILVER = f"""
WITH {RECORDS}, timed AS (
  SELECT *, make_timestamp(trade_time * 1000) AS trade_timestamp, CAST(ingested_at AS TIMESTAMP) AS ingest_timestamp
  FROM records WHERE price > 0 AND price < 1000000 AND quantity > 0
), one AS (
  SELECT * FROM timed
  QUALIFY row_number() OVER (PARTITION BY symbol, trade_timestamp, price, quantity
                             ORDER BY ingest_timestamp, is_buyer_maker) = 1
)
SELECT source, symbol, price, quantity, is_buyer_maker, trade_timestamp, ingest_timestamp,
       round(price * quantity, 8) AS trade_value, CASE WHEN is_buyer_maker THEN 'SELL' ELSE 'BUY' END AS trade_side,
       round(ln(price) / ln(10.0), 2) AS price_magnitude, round(price * quantity, 8) > 10000 AS is_large_trade,
       {BUILT_AT} AS processed_at, {_parts('trade_timestamp', 'year', 'month', 'day')}
FROM one"""

# Candles of silver's trades.
CLEAN = f"""
WITH {RECORDS}, clean AS (
  SELECT DISTINCT ON (symbol, trade_timestamp, price, quantity)
         symbol, price, quantity, is_buyer_maker, make_timestamp(trade_time * 1000) AS trade_timestamp
  FROM records WHERE price > 0 AND price < 1000000 AND quantity > 0
  ORDER BY symbol, trade_timestamp, price, quantity, ingested_at, is_buyer_maker
)"""

_FAULT = "minute(candle_start_time) % 10"
DIRTY_CANDLES = f"""
{CANDLES}, dirty AS (
  SELECT * REPLACE (
    CASE WHEN {_FAULT} = 7 THEN date_trunc('hour', candle_start_time) WHEN {_FAULT} <> 8 THEN candle_start_time END
      AS candle_start_time,
    CASE WHEN {_FAULT} <> 1 THEN symbol END AS symbol,
    CASE WHEN {_FAULT} = 2 THEN high_price + 1 ELSE open_price END AS open_price,
    CASE WHEN {_FAULT} = 3 THEN low_price - 1 ELSE close_price END AS close_price,
    CASE WHEN {_FAULT} = 4 THEN high_price + 1 ELSE low_price END AS low_price,
    CASE WHEN {_FAULT} = 5 THEN total_volume + 1 ELSE buy_volume_taker END AS buy_volume_taker,
    CASE WHEN {_FAULT} = 6 THEN 0 ELSE trade_count END AS trade_count),
    minute(candle_start_time) * 2.0 AS completeness_pct
  FROM candles
)"""

_BY_DAY = "count(*) AS trades, sum(quantity) AS volume, max(price) AS top_price"
_LATE = f"""
WITH silver AS ({SILVER}), first_run AS (
  SELECT * FROM silver WHERE quantity % 3 <> 0 AND (trade_timestamp < TIMESTAMP '2024-01-16' OR symbol = 'view')
), marks AS (SELECT symbol, max(trade_timestamp) AS mark FROM first_run GROUP BY symbol)
SELECT s.* EXCLUDE (mark), CASE WHEN late THEN mark END AS mark
FROM (SELECT s.*, m.mark,
             NOT (quantity % 3 <> 0 AND (trade_timestamp < TIMESTAMP '2024-01-16' OR s.symbol = 'view'))
               AND coalesce(trade_timestamp < mark - INTERVAL 10 MINUTE, false) AS late
      FROM silver s LEFT JOIN marks m ON s.symbol = m.symbol) s"""

ORACLE: dict[str, str] = {
    "envelope_normalise": ENVELOPES
    + """
SELECT 'exchange' AS source, event_type AS symbol, value AS price, CAST(k AS DOUBLE) AS quantity,
       epoch_us(ts) // 1000 AS trade_time, user_id % 2 = 0 AS is_buyer_maker,
       '2024-02-01T00:00:00.000000' AS ingested_at
FROM envelopes WHERE outcome = 'accepted'""",
    "envelope_rejects": ENVELOPES
    + """
SELECT outcome, CASE WHEN outcome <> 'accepted' THEN message END AS rejected_value, count(*) AS messages
FROM envelopes GROUP BY ALL""",
    "message_routing": ENVELOPES
    + """
SELECT CASE WHEN outcome = 'accepted' THEN 'trades' ELSE 'rejects' END AS topic,
       CASE WHEN outcome = 'accepted' THEN event_type END AS key,
       CASE WHEN outcome = 'accepted'
            THEN '{"source":"exchange","symbol":"' || event_type || '","price":' || value || ',"quantity":'
                 || k::DOUBLE || ',"trade_time":' || epoch_us(ts) // 1000 || ',"is_buyer_maker":' || (user_id % 2 = 0)
                 || ',"ingested_at":"2024-02-01T00:00:00.000000"}'
            ELSE message END AS value
FROM envelopes WHERE outcome <> 'no data'""",
    "sentiment_parse": f"WITH {PAYLOADS} SELECT date, fng_value, fng_classification FROM newest",
    "sentiment_newest": f"WITH {PAYLOADS} SELECT date, fng_value, fng_classification FROM newest",
    "bronze_partitions": f"""
WITH {RECORDS}, timed AS (SELECT *, make_timestamp(trade_time * 1000) AS timestamp FROM records)
SELECT *, {_parts('timestamp', 'year', 'month', 'day', 'hour')} FROM timed""",
    "silver_clean": DIRTY
    + """
SELECT * FROM dirty
WHERE price > 0 AND price < 1000000 AND quantity > 0 AND isfinite(quantity)
  AND symbol IS NOT NULL AND trade_time IS NOT NULL""",
    "silver_enrich": f"""
WITH raw AS (
  SELECT event_id, event_type AS symbol, round(value / 3, 8) AS price,
         round(CAST({K} AS DOUBLE), 8) AS quantity,
         CASE WHEN {K} % 7 <> 0 THEN user_id % 2 = 0 END AS is_buyer_maker,
         make_timestamp((epoch_us(ts) // 1000) * 1000) AS trade_timestamp,
         CASE WHEN {K} % 9 <> 0 THEN ts END AS ingest_timestamp
  FROM events
), valued AS (SELECT *, round(price * quantity, 8) AS trade_value FROM raw)
SELECT *, CASE WHEN is_buyer_maker = false THEN 'BUY' ELSE 'SELL' END AS trade_side,
       CASE WHEN price > 0 THEN round(ln(price) / ln(10.0), 2) END AS price_magnitude,
       trade_value > 5000 AS is_large_trade,
       {BUILT_AT} AS processed_at
FROM valued""",
    "dedup_trades": f"""
WITH {TRADES}
SELECT symbol, price, quantity, is_buyer_maker, trade_timestamp,
       trade_timestamp + INTERVAL 1 SECOND AS ingest_timestamp
FROM trades
QUALIFY row_number() OVER (PARTITION BY symbol, trade_timestamp, price, quantity
                           ORDER BY is_buyer_maker) = 1""",
    "dedup_lines": """
SELECT * FROM lineitem
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
           l_returnflag, l_linestatus) = 1""",
    "layer_replace": SILVER
    + " WHERE trade_timestamp >= TIMESTAMP '2024-01-05' AND trade_timestamp < TIMESTAMP '2024-01-21'",
    "history_load": f"""
WITH {TRADES}
SELECT symbol, price, quantity, is_buyer_maker, trade_timestamp,
       CASE WHEN is_buyer_maker THEN trade_timestamp + INTERVAL 1 SECOND END AS ingest_timestamp
FROM trades""",
    "sentiment_upsert": f"""
WITH {SENTIMENT}, {PAYLOADS},
new AS (SELECT * FROM newest WHERE isodow(date) BETWEEN 3 AND 7)
SELECT coalesce(n.date, s.date) AS date,
       CASE WHEN n.date IS NOT NULL THEN n.fng_value ELSE s.fng_value END AS fng_value,
       CASE WHEN n.date IS NOT NULL THEN n.fng_classification ELSE s.fng_classification END
         AS fng_classification,
       CASE WHEN n.date IS NOT NULL AND s.date IS NOT NULL THEN {BUILT_AT} END AS updated_at
FROM sentiment s FULL JOIN new n ON s.date = n.date""",
    "candles_1m": f"WITH {TRADES} {_candles('1 minute')}",
    "candles_1h": f"WITH {TRADES} {_candles('1 hour')}",
    "candles_7h": f"""
WITH {TRADES}, wild AS (
  SELECT * REPLACE (price * CASE WHEN trade_id % 10 = 0 THEN 1000000.0::DOUBLE ELSE 1 END AS price,
                    trade_timestamp + to_microseconds(trade_id % 1000) AS trade_timestamp)
  FROM trades
) {_candles('7 hours', 'wild', 'price')}""",
    "candles_by_price": f"""
WITH {TRADES}, coarse AS (
  SELECT * REPLACE (date_trunc('second', trade_timestamp) AS trade_timestamp),
         trade_timestamp AS ingest_timestamp
  FROM trades
), latest AS (
  SELECT time_bucket(INTERVAL '5 minutes', trade_timestamp, TIMESTAMP '1970-01-01') AS candle_start_time,
         symbol, max(ingest_timestamp) AS last_trade_ingest
  FROM coarse GROUP BY ALL
), built AS ({_candles('5 minutes', 'coarse', 'price')})
SELECT built.*, last_trade_ingest FROM built JOIN latest USING (candle_start_time, symbol)""",
    "daily_price_vs_sentiment": f"""
{CANDLES}, {SENTIMENT}, daily AS (
  SELECT CAST(candle_start_time AS DATE) AS date, upper(symbol) AS symbol,
         round(avg(close_price), 9) AS avg_price, max(high_price) AS max_price,
         min(low_price) AS min_price, round(sum(total_volume), 2) AS total_volume
  FROM candles WHERE symbol IN ('click', 'error', 'purchase') GROUP BY ALL
)
SELECT d.*, s.fng_value, s.fng_classification
FROM daily d LEFT JOIN sentiment s ON d.date = s.date ORDER BY d.date DESC""",
    "hourly_ingestion": f"{CANDLES} {HOURLY}",
    "hourly_gaps": f"""
{CANDLES}, hourly AS ({HOURLY}), spans AS (
  SELECT symbol, unnest(generate_series(min(ingestion_hour)::TIMESTAMP,
           greatest(max(ingestion_hour)::TIMESTAMP, {AS_OF}), INTERVAL 1 HOUR)) AS ingestion_hour
  FROM hourly GROUP BY symbol
)
SELECT s.ingestion_hour, s.symbol, coalesce(candles_count, 0) AS candles_count,
       coalesce(total_trades, 0) AS total_trades, coalesce(total_volume, 0) AS total_volume,
       last_ingested_at, earliest_candle, latest_candle,
       coalesce(completeness_pct, 0) AS completeness_pct,
       coalesce(missing_candles, 60) AS missing_candles
FROM spans s LEFT JOIN hourly h ON s.ingestion_hour = h.ingestion_hour AND s.symbol = h.symbol""",
    "freshness": f"{CANDLES} {FRESHNESS}",
    "daily_summary": f"{CANDLES} {DAILY}",
    "ingestion_health": f"""
{CANDLES}, hourly AS ({HOURLY}), fresh AS ({FRESHNESS}), days AS ({DAILY})
SELECT h.*, f.latest_candle_time, f.minutes_since_last_candle, f.freshness_status,
       d.total_candles AS day_total_candles, d.active_symbols AS day_active_symbols,
       d.daily_completeness_pct
FROM hourly h LEFT JOIN fresh f ON h.symbol = f.symbol
LEFT JOIN days d ON date_trunc('day', h.ingestion_hour) = d.date
ORDER BY h.ingestion_hour DESC, h.symbol""",
    "chart_close": f"{CANDLES} SELECT symbol, candle_start_time, close_price FROM candles",
    "chart_volume": f"{CANDLES} SELECT symbol, sum(total_volume) AS total_volume FROM candles GROUP BY symbol",
    "chart_pressure": f"""
{CANDLES}, hours AS (
  SELECT symbol, date_trunc('hour', candle_start_time) AS hour,
         sum(buy_volume_taker) AS buy_volume, sum(sell_volume_maker) AS sell_volume
  FROM candles GROUP BY ALL
)
SELECT *, round(buy_volume / nullif(buy_volume + sell_volume, 0), 9) AS buy_share FROM hours""",
    "chart_heatmap": f"""
{CANDLES}
SELECT CAST(hour(candle_start_time) AS INTEGER) AS hour_of_day, symbol,
       CAST(sum(trade_count) AS BIGINT) AS trade_count
FROM candles GROUP BY ALL""",
    "quality_candles": DIRTY_CANDLES
    + _report(
        {
            "candle_start_time_not_null": _failing("dirty", "candle_start_time IS NULL"),
            "symbol_not_null": _failing("dirty", "symbol IS NULL"),
            "open_within_range": _failing("dirty", "open_price NOT BETWEEN low_price AND high_price"),
            "close_within_range": _failing("dirty", "close_price NOT BETWEEN low_price AND high_price"),
            "low_not_above_high": _failing("dirty", "low_price > high_price"),
            "volume_parts_within_total": _failing(
                "dirty", "buy_volume_taker + sell_volume_maker > total_volume + 0.000001"
            ),
            "trade_count_positive": _failing("dirty", "trade_count < 1"),
            "completeness_pct_within_0_100": _failing("dirty", "completeness_pct NOT BETWEEN 0 AND 100"),
            "unique_candle_start_time_symbol": _repeated("dirty", "candle_start_time, symbol"),
        },
        "dirty",
    ),
    "quality_trades": DIRTY
    + _report(
        {
            "symbol_not_null": _failing("dirty", "symbol IS NULL"),
            "price_positive": _failing("dirty", "price <= 0"),
            "price_below_cap": _failing("dirty", "price >= 1000000"),
            "trade_time_not_null": _failing("dirty", "trade_time IS NULL"),
            "unique_symbol_trade_time": _repeated("dirty", "symbol, trade_time"),
        },
        "dirty",
    ),
    "warehouse_roundtrip": f"WITH {TRADES} {_candles('1 hour')}",
    "stream_bronze_to_silver": SILVER,
    "stream_candles": f"""
WITH {RECORDS}, timed AS (
  SELECT *, make_timestamp(trade_time * 1000) AS trade_timestamp FROM records
) {_candles('1 hour', 'timed', 'price')}""",
    "silver_days": SILVER,
    "gold_increment": f"{CLEAN} {_candles('1 hour', 'clean', 'price')}",
    "silver_swap": f"""
WITH silver AS ({SILVER}), dated AS (SELECT *, CAST(trade_timestamp AS DATE) AS date FROM silver)
SELECT 'written' AS phase, date, {_BY_DAY} FROM dated GROUP BY ALL
UNION ALL
SELECT 'swapped' AS phase, date, {_BY_DAY} FROM dated
WHERE date NOT BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' OR (date <> DATE '2024-01-09' AND price < 100)
GROUP BY ALL""",
    "marts_published": f"""
{CANDLES}, chosen AS (SELECT * FROM candles WHERE symbol IN ('click', 'error', 'purchase', 'view'))
SELECT symbol, sum(total_volume) AS total_volume, CAST(NULL AS INTEGER) AS hour_of_day,
       CAST(NULL AS BIGINT) AS trade_count
FROM chosen GROUP BY symbol
UNION ALL
SELECT symbol, NULL AS total_volume, CAST(hour(candle_start_time) AS INTEGER) AS hour_of_day,
       CAST(sum(trade_count) AS BIGINT) AS trade_count
FROM chosen GROUP BY ALL""",
    "candles_late": f"{CANDLES} SELECT * FROM candles",
    "candles_rolled_1h": f"WITH {TRADES} {_candles('1 hour')}",
    "candles_rolled_1d": f"WITH {TRADES} {_candles('1 day')}",
    "silver_by_symbol": _LATE,
    "active_symbols": " UNION ALL ".join(
        f"SELECT '{unit}' AS unit, date_trunc('{unit}', ts)::TIMESTAMP AS start, "
        "count(DISTINCT event_type) AS active_symbols FROM events GROUP BY ALL"
        for unit in ("day", "week", "month")
    ),
}
ORACLE["health_maintained"] = ORACLE["ingestion_health"]
