"""SQL for the registered queries, over the plain tables, to compare results with."""

from __future__ import annotations

# Ticks, the outlier filter and the sliding windows written a second time, in SQL.
TICKS = """
ticks AS (
  SELECT upper(event_type) || 'USDT' AS symbol,
         value AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume,
         epoch_us(ts) // 1000 AS timestamp,
         date_trunc('second', ts) AS event_time,
         CAST(ts AS DATE) AS ingest_date
  FROM events
)"""

ANCHORED = """
anchored AS (
  SELECT *,
         CASE symbol WHEN 'CLICKUSDT' THEN 50.0::DOUBLE
                     WHEN 'VIEWUSDT' THEN 40.0::DOUBLE
                     WHEN 'PURCHASEUSDT' THEN 60.0::DOUBLE END AS anchor_price
  FROM ticks
)"""

SANE = "price > 0 AND volume >= 0"
BAND = "(anchor_price IS NULL OR price BETWEEN anchor_price * {low}::DOUBLE AND anchor_price * {high}::DOUBLE)"
IN_BAND = BAND.format(low=0.3, high=3.0)
IN_TIGHT_BAND = BAND.format(low=0.5, high=1.5)
REPLAYED_DAY = "DATE '2024-01-15'"
TICK_COLUMNS = "symbol, price, volume, timestamp, event_time, ingest_date"

SILVER = f"""{TICKS},{ANCHORED},
silver AS (SELECT {TICK_COLUMNS} FROM anchored WHERE {SANE} AND {IN_BAND})"""


def _spread(source: str, size: int, slide: int) -> str:
    """Every tick once per sliding window that contains it."""
    inside = f"WHERE event_time < window_start + INTERVAL {size} SECOND" if size % slide else ""
    return f"""
spread AS (
  SELECT s.*, time_bucket(INTERVAL {slide} SECOND, event_time) - k * INTERVAL {slide} SECOND AS window_start
  FROM {source} s CROSS JOIN range(0, {-(-size // slide)}) steps(k) {inside}
)"""


def _windows(source: str = "silver", size: int = 60, slide: int = 10, digits: int = 6) -> str:
    return f"""{_spread(source, size, slide)},
windows AS (
  SELECT symbol, window_start,
         window_start + INTERVAL {size} SECOND AS window_end,
         round(avg(price), {digits}) AS avg_price,
         count(*) AS n_ticks,
         CAST(window_start AS DATE) AS window_date
  FROM spread GROUP BY symbol, window_start
)"""


CLOSED = "window_end <= (SELECT max(event_time) FROM silver) - INTERVAL 2 MINUTE"
GOLD = f"WITH {SILVER},{_windows()}, gold AS (SELECT * FROM windows WHERE {CLOSED})"

NORMALISED = f"WITH {TICKS} SELECT {TICK_COLUMNS} FROM ticks"
CLEANED = f"WITH {SILVER} SELECT {TICK_COLUMNS} FROM silver"
ALL_WINDOWS = f"WITH {SILVER},{_windows()} SELECT * FROM windows"
CLOSED_WINDOWS = f"{GOLD} SELECT * FROM gold"

BROKER = """
parsed AS (
  SELECT upper(event_type) || 'USDT' AS symbol, value AS price,
         epoch_us(ts) // 1000 AS timestamp, date_trunc('second', ts) AS event_time,
         ts + INTERVAL 3 SECOND AS kafka_ts, TIMESTAMP '2024-02-01 00:00:00' AS now
  FROM events
)"""

STAR = f"""
WITH {SILVER},
dim_time AS (
  SELECT DISTINCT event_time AS time_key,
         CAST(year(event_time) AS INTEGER) AS year, CAST(month(event_time) AS INTEGER) AS month,
         CAST(day(event_time) AS INTEGER) AS day, CAST(hour(event_time) AS INTEGER) AS hour,
         CAST(minute(event_time) AS INTEGER) AS minute,
         CAST(dayofweek(event_time) + 1 AS INTEGER) AS weekday
  FROM silver
),
dim_symbol AS (
  SELECT DISTINCT symbol AS symbol_key,
         left(symbol, length(symbol) - 4) AS base_asset, right(symbol, 4) AS quote_asset
  FROM silver
),
dim_market AS (
  SELECT 'BINANCE_SPOT' AS market_key, 'Binance' AS exchange, 'SPOT' AS venue_type,
         'USD' AS settlement_currency
),
fact_ticks AS (
  SELECT event_time AS time_key, symbol AS symbol_key, 'BINANCE_SPOT' AS market_key,
         price, volume, ingest_date
  FROM silver
)"""

FULL_STAR = f"""{STAR}
SELECT * FROM fact_ticks JOIN dim_symbol USING (symbol_key) JOIN dim_market USING (market_key)
JOIN dim_time USING (time_key)"""

VOLUME_BY_ASSET = f"""{STAR}
SELECT ingest_date, base_asset, round(sum(volume), 2) AS total_volume, count(*) AS n_ticks
FROM fact_ticks JOIN dim_symbol USING (symbol_key) GROUP BY ingest_date, base_asset"""

MIDDLE = """
middle AS (
  SELECT min(ts) + to_microseconds((epoch_us(max(ts)) - epoch_us(min(ts))) // 2) AS at_ts FROM events
)"""

# A row that arrives after the watermark only counts in windows that end beyond it.
LATE = f"""
WITH {SILVER},{MIDDLE},
raw AS (
  SELECT upper(event_type) || 'USDT' AS symbol, value AS price, ts >= (SELECT at_ts FROM middle) AS first_half_late,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume,
         CASE event_type WHEN 'click' THEN 50.0::DOUBLE WHEN 'view' THEN 40.0::DOUBLE
                         WHEN 'purchase' THEN 60.0::DOUBLE END AS anchor_price,
         date_trunc('second', ts) AS event_time
  FROM events
),
arrived AS (SELECT * FROM raw WHERE {SANE} AND {IN_BAND}),{_spread('arrived', 60, 10)},
taken AS (
  SELECT * FROM spread
  WHERE first_half_late
     OR window_start + INTERVAL 1 MINUTE >
        (SELECT max(event_time) FROM arrived WHERE first_half_late) - INTERVAL 2 MINUTE
)
SELECT symbol, window_start, window_start + INTERVAL 1 MINUTE AS window_end,
       round(avg(price), 6) AS avg_price, count(*) AS n_ticks, CAST(window_start AS DATE) AS window_date
FROM taken GROUP BY symbol, window_start
HAVING {CLOSED}"""


def _subtotals(kind: str) -> str:
    return f"""WITH {SILVER}
SELECT ingest_date, symbol, round(sum(volume), 2) AS total_volume, count(*) AS n_ticks,
       CAST(grouping_id(ingest_date, symbol) AS BIGINT) AS level
FROM silver GROUP BY {kind}(ingest_date, symbol)
ORDER BY ingest_date NULLS LAST, symbol NULLS LAST, level"""


VOLATILITY = f"""WITH {SILVER}
SELECT symbol, round(avg(price), 6) AS mean_price, round(stddev_samp(price), 6) AS stddev_price,
       round(stddev_samp(price) / nullif(avg(price), 0) * 100, 4) AS cv_pct, count(*) AS n_ticks
FROM silver GROUP BY symbol ORDER BY cv_pct DESC NULLS LAST, symbol"""

RUNNING = f"""WITH {SILVER}
SELECT symbol, min(price) AS min_price, max(price) AS max_price, round(avg(price), 6) AS avg_price,
       sum(volume) AS total_volume, count(*) AS n_ticks
FROM silver GROUP BY symbol"""

SYMBOLS = f"""WITH {SILVER}
SELECT symbol, round(avg(price), 6) AS avg_price, count(*) AS n_ticks FROM silver GROUP BY symbol"""


def _chart(seconds: int, measure: str) -> str:
    return f"""WITH {SILVER}
SELECT time_bucket(INTERVAL {seconds} SECOND, event_time) AS window_start, symbol, {measure}
FROM silver GROUP BY ALL"""


STEPS = """
WITH sent AS (
  SELECT CAST((length(event_type) + 4) % 3 AS INTEGER) AS "partition", event_id AS "offset" FROM events
),
steps AS (SELECT *, lag("offset") OVER (PARTITION BY "partition" ORDER BY "offset") AS before FROM sent)"""

ONCE = f"""WITH {TICKS},
twice AS (SELECT * FROM ticks UNION ALL SELECT * FROM ticks)
SELECT DISTINCT ON (symbol, timestamp) {TICK_COLUMNS} FROM twice ORDER BY symbol, timestamp, price, volume"""

ORACLE: dict[str, str] = {
    "ticks_normalise": NORMALISED,
    "message_parse": f"""WITH {TICKS},
numbered AS (SELECT *, ts + INTERVAL 3 SECOND AS kafka_ts FROM events)
SELECT upper(event_type) || 'USDT' AS symbol, value AS price,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume, epoch_us(ts) // 1000 AS timestamp,
       kafka_ts, date_trunc('second', ts) AS event_time, CAST(ts AS DATE) AS ingest_date
FROM numbered""",
    "message_parse_ms": """
SELECT upper(event_type) || 'USDT' AS symbol, date_trunc('millisecond', ts) AS event_time FROM events""",
    "anchor_lookup": f"WITH {TICKS},{ANCHORED} SELECT symbol, timestamp, price, anchor_price FROM anchored",
    "silver_clean": CLEANED,
    "silver_by_anchor_table": CLEANED,
    "silver_table": CLEANED,
    "silver_view": SYMBOLS,
    "dedup_ticks": ONCE,
    "daily_average": f"""WITH {SILVER}
SELECT ingest_date, symbol, round(avg(price), 6) AS avg_price, count(*) AS n_ticks
FROM silver GROUP BY ingest_date, symbol ORDER BY ingest_date, symbol""",
    "volatility": VOLATILITY,
    "most_volatile": VOLATILITY + " LIMIT 1",
    "peak_hours": f"""WITH {SILVER}
SELECT CAST(hour(event_time) AS INTEGER) AS hour_utc, count(*) AS n_ticks, round(sum(volume), 2) AS total_volume
FROM silver GROUP BY hour(event_time) ORDER BY total_volume DESC, hour_utc""",
    "rollup_volume": _subtotals("ROLLUP"),
    "cube_volume": _subtotals("CUBE"),
    "symbol_check": SYMBOLS,
    "layer_counts": f"""{GOLD}
SELECT 'bronze' AS layer, count(*) AS n_rows FROM ticks
UNION ALL SELECT 'silver', count(*) FROM silver
UNION ALL SELECT 'gold', count(*) FROM gold""",
    "gold_preview": f"{GOLD} SELECT * FROM gold ORDER BY window_start, symbol LIMIT 10",
    "dim_time": f"{STAR} SELECT * FROM dim_time",
    "dim_symbol": f"{STAR} SELECT * FROM dim_symbol",
    "fact_ticks": f"{STAR} SELECT * FROM fact_ticks",
    "star_volume": VOLUME_BY_ASSET,
    "star_sql": VOLUME_BY_ASSET,
    "star_full": FULL_STAR,
    "star_grown": FULL_STAR,
    "dim_time_grown": f"{STAR} SELECT * FROM dim_time",
    "star_calendar": f"""{STAR}
SELECT exchange, venue_type, settlement_currency, base_asset, quote_asset, weekday, hour,
       round(sum(volume), 2) AS total_volume, count(*) AS n_ticks
FROM fact_ticks JOIN dim_symbol USING (symbol_key) JOIN dim_market USING (market_key)
JOIN dim_time USING (time_key) GROUP BY ALL""",
    "sliding_average": ALL_WINDOWS,
    "sliding_average_hour": f"WITH {SILVER},{_windows('silver', 3600, 600, 8)} SELECT * FROM windows",
    "sliding_average_uneven": f"WITH {SILVER},{_windows('silver', 50, 20)} SELECT * FROM windows",
    "price_by_minute": _chart(60, "round(avg(price), 6) AS avg_price"),
    "volume_by_5min": _chart(300, "sum(volume) AS total_volume"),
    "gold_chart": f"""{GOLD}
SELECT window_start, symbol, round(avg(avg_price), 6) AS avg_price FROM gold GROUP BY window_start, symbol""",
    "latency_total": f"""WITH {BROKER}
SELECT symbol, price, timestamp, event_time, now,
       epoch_us(now) // 1000000 - epoch_us(event_time) // 1000000 AS lag_seconds
FROM parsed""",
    "latency_split": f"""WITH {BROKER}
SELECT symbol, price, kafka_ts, now,
       epoch_us(now) // 1000000 - epoch_us(kafka_ts) // 1000000 AS kafka_to_spark_s,
       epoch_us(kafka_ts) // 1000000 - epoch_us(event_time) // 1000000 AS api_freshness_s
FROM parsed""",
    "offset_span": """
SELECT 'financial_data' AS topic, CAST((length(event_type) + 4) % 3 AS INTEGER) AS "partition",
       min(event_id) AS first_offset, max(event_id) + 1 AS next_offset,
       max(event_id) + 1 - min(event_id) AS span
FROM events GROUP BY (length(event_type) + 4) % 3""",
    "offset_report": f"""{STEPS}
SELECT 'financial_data' AS topic, "partition", min("offset") AS first_offset, max("offset") + 1 AS next_offset,
       max("offset") + 1 - min("offset") AS span,
       CAST(sum(1 + ("offset" % 5 = 0)::INT) AS BIGINT) AS n_rows, count(*) AS n_offsets,
       count(*) FILTER ("offset" % 5 = 0) AS n_repeats,
       max("offset") + 1 - min("offset") - count(*) AS n_missing, count(*) FILTER ("offset" - before > 1) AS n_gaps
FROM steps GROUP BY "partition" """,
    "offset_gaps": f"""{STEPS}
SELECT 'financial_data' AS topic, "partition", before + 1 AS first_missing, "offset" - 1 AS last_missing
FROM steps WHERE "offset" - before > 1""",
    "tables_listed": f"""{STAR},{_windows()}
SELECT 'bronze_ticks' AS layer, count(*) AS n_rows FROM ticks
UNION ALL SELECT 'silver_ticks', count(*) FROM silver
UNION ALL SELECT 'gold_moving_avg', count(*) FROM windows WHERE {CLOSED}
UNION ALL SELECT 'fact_ticks', count(*) FROM fact_ticks
UNION ALL SELECT 'dim_time', count(*) FROM dim_time
UNION ALL SELECT 'dim_symbol', count(*) FROM dim_symbol
UNION ALL SELECT 'dim_market', count(*) FROM dim_market""",
    "compaction": CLEANED,
    "compaction_finished": f"{CLEANED} WHERE ingest_date < {REPLAYED_DAY}",
    "replay_day": f"""WITH {TICKS},{ANCHORED}
SELECT {TICK_COLUMNS} FROM anchored
WHERE {SANE} AND CASE WHEN ingest_date = {REPLAYED_DAY} THEN {IN_TIGHT_BAND} ELSE {IN_BAND} END""",
    "replay_gold_day": f"""WITH {TICKS},{ANCHORED},{_spread('anchored', 60, 10)}
SELECT symbol, window_start, window_start + INTERVAL 1 MINUTE AS window_end,
       round(avg(price), 6) AS avg_price, count(*) AS n_ticks, CAST(window_start AS DATE) AS window_date
FROM spread
WHERE {SANE} AND CASE WHEN CAST(window_start AS DATE) = {REPLAYED_DAY} THEN {IN_TIGHT_BAND} ELSE {IN_BAND} END
GROUP BY symbol, window_start""",
    "bronze_stream": NORMALISED,
    "silver_stream": CLEANED,
    "gold_stream": CLOSED_WINDOWS,
    "running_stats": RUNNING,
    "sliding_update": ALL_WINDOWS,
    "dedup_stream": ONCE,
    "dedup_settled": f"""WITH {TICKS},{MIDDLE},
first_run AS (
  SELECT max(date_trunc('second', ts)) AS latest FROM events, middle WHERE ts < at_ts
),
sent AS (
  SELECT ticks.*, to_timestamp((timestamp // 3600000 + 1) * 3600)::TIMESTAMP + INTERVAL 1 DAY AS passes FROM ticks
),
came AS (
  SELECT * FROM sent
  UNION ALL
  -- the copies that come before the tick has been passed on
  SELECT sent.* REPLACE (price - 1 AS price) FROM sent, first_run, middle
  WHERE make_timestamp(timestamp * 1000) < at_ts AND passes > latest
)
SELECT DISTINCT ON (symbol, timestamp) {TICK_COLUMNS} FROM came
WHERE passes <= (SELECT max(event_time) FROM ticks) ORDER BY symbol, timestamp, price, volume""",
    "restart_resume": CLEANED,
    "restart_gold": CLOSED_WINDOWS,
    "restart_partitions": CLOSED_WINDOWS,
    "late_rows": LATE,
    "open_windows": f"""WITH {SILVER},{_windows()}
SELECT symbol, window_start, window_end FROM windows WHERE NOT ({CLOSED})""",
    "replay_versions": f"""WITH {TICKS},{ANCHORED},
judged AS (SELECT ingest_date, {IN_BAND} AS wide, {IN_TIGHT_BAND} AS tight FROM anchored WHERE {SANE})
SELECT version, ingest_date, count(*) AS n_ticks
FROM judged, (VALUES (1::BIGINT), (2), (3)) versions(version)
WHERE CASE WHEN version = 3 OR (version = 2 AND ingest_date = {REPLAYED_DAY}) THEN tight ELSE wide END
GROUP BY version, ingest_date""",
    "compaction_ledger": f"""WITH {SILVER},{MIDDLE},
-- what gold is done with after each run
finished AS (
  SELECT max(event_time) FILTER (event_time < (SELECT date_trunc('second', at_ts) FROM middle)) - INTERVAL 2 MINUTE AS first_run,
         max(event_time) - INTERVAL 2 MINUTE AS second_run
  FROM silver
)
SELECT ingest_date, CAST(1 + (ingest_date >= CAST(first_run AS DATE))::INT AS BIGINT) AS version, count(*) AS n_ticks
FROM silver, finished WHERE ingest_date < CAST(second_run AS DATE) GROUP BY ALL""",
    "compaction_read": CLEANED,
    "progress_table": """
SELECT query, CAST(2 AS BIGINT) AS runs, (SELECT count(*) FROM events) AS input_rows
FROM (VALUES ('bronze_parquet'), ('silver_parquet'), ('gold_parquet')) names(query)""",
    "together_layers": CLEANED,
    # the watermark follows all messages of the later half, clean or not
    "late_side_table": f"""WITH {SILVER},{MIDDLE},
mark AS (SELECT max(date_trunc('second', ts)) - INTERVAL 2 MINUTE AS watermark FROM events, middle WHERE ts >= at_ts)
SELECT {TICK_COLUMNS}, make_timestamp(timestamp * 1000) < at_ts AND event_time < watermark AS late
FROM silver, middle, mark""",
    "moments_daily": f"""WITH {SILVER}
SELECT ingest_date, symbol, round(avg(price), 6) AS avg_price, count(*) AS n_ticks
FROM silver GROUP BY ingest_date, symbol ORDER BY ingest_date, symbol""",
    "moments_volatility": VOLATILITY,
    "moments_rollup": _subtotals("ROLLUP"),
    "moments_price_by_minute": _chart(60, "round(avg(price), 6) AS avg_price"),
    # one batch reads the table, and if the watermark moved one more closes windows
    "checkpoint_inventory": f"""WITH {SILVER},
batches AS (SELECT CAST(1 + max((event_time IS NOT NULL)::INT) AS BIGINT) AS n FROM silver)
SELECT 'offsets' AS folder, n FROM batches
UNION ALL SELECT 'commits', n FROM batches
UNION ALL SELECT 'state', 8""",
}
