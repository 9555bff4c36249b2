"""Adaptive windows, coverage, keyed selection and alert rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import query, rounded
from catalogue.tables import (
    CLOSES_SQL,
    EVENTS_NOW,
    ORDER_PARAMS,
    ORDER_SERIES_SQL,
    ORDERS_NOW,
    PRICE,
    candles,
    events,
    last_per_hour_sql,
    observations,
    order_series,
    orders,
)
from lagloom.functions.stats import has_spread
from lagloom.operators.alerts import daily_moves, price_spikes, sentiment_shifts, stale_series
from lagloom.operators.dedupe import in_time_order, keep_last, newest, newest_per_group
from lagloom.operators.series import (
    adaptive_windows,
    candle_coverage,
    feature_series,
    hourly_close,
    readiness,
    rows_in_window,
    source_samples,
)

DETAILS_SQL = f"""
WITH s AS ({last_per_hour_sql(ORDER_SERIES_SQL)}),
n AS (
  SELECT source, metric_name, count(*) FILTER (hour >= TIMESTAMP '2001-08-01' - INTERVAL 120 DAY) AS base_samples,
         count(*) FILTER (hour >= TIMESTAMP '2001-08-01' - INTERVAL 365 DAY) AS max_samples
  FROM s GROUP BY ALL),
details AS (
  SELECT source, metric_name, base_samples,
         CASE WHEN base_samples < 30 AND source <> 'P' THEN max_samples ELSE base_samples END AS final_samples,
         CASE WHEN base_samples < 30 AND source <> 'P' THEN 365 ELSE 120 END AS window_days,
         base_samples < 30 AND source <> 'P' AS expanded,
         base_samples < 30 AND source = 'P' AS skipped
  FROM n)"""


def _details(spark, sf_dir):
    return adaptive_windows(feature_series(order_series(spark, sf_dir)), ORDERS_NOW, ORDER_PARAMS)


@query("adaptive_windows", f"{DETAILS_SQL} SELECT * FROM details")
def _adaptive_windows(spark, sf_dir):
    return _details(spark, sf_dir)


@query(
    "rows_in_window",
    f"""{DETAILS_SQL}
SELECT s.source, s.metric_name, s.hour, s.value FROM s JOIN details d USING (source, metric_name)
WHERE NOT d.skipped AND s.hour >= TIMESTAMP '2001-08-01' - d.window_days * INTERVAL 1 DAY""",
)
def _rows_in_window(spark, sf_dir):
    return rows_in_window(
        feature_series(order_series(spark, sf_dir)), _details(spark, sf_dir), ORDERS_NOW, ORDER_PARAMS
    )


@query(
    "source_samples",
    f"""{DETAILS_SQL}
SELECT e.source, coalesce(max(final_samples), 0) AS samples
FROM (SELECT unnest(['F', 'O', 'P', 'X']) AS source) e LEFT JOIN details USING (source) GROUP BY 1""",
)
def _source_samples(spark, sf_dir):
    return source_samples(_details(spark, sf_dir), ORDER_PARAMS)


@query(
    "readiness",
    f"""{DETAILS_SQL}
SELECT source AS name, *, CASE WHEN skipped THEN 'skipped' WHEN expanded AND final_samples >= 30 THEN 'expanded_ready'
  WHEN expanded THEN 'expanded_short' ELSE 'ready' END AS state FROM details""",
)
def _readiness(spark, sf_dir):
    return readiness(_details(spark, sf_dir), ORDER_PARAMS)


@query(
    "distinct_guard",
    """SELECT o_custkey, count(*) AS orders, count(DISTINCT o_totalprice) >= 2 AS has_spread FROM orders GROUP BY 1""",
)
def _distinct_guard(spark, sf_dir):
    return orders(spark, sf_dir).groupBy("o_custkey").agg(
        F.count("*").alias("orders"), has_spread(F.col("o_totalprice")).alias("has_spread")
    )


@query(
    "keep_last",
    """SELECT o_custkey, o_orderpriority, o_orderkey, o_orderdate, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def _keep_last(spark, sf_dir):
    rows = orders(spark, sf_dir).select("o_custkey", "o_orderpriority", "o_orderkey", "o_orderdate", "o_totalprice")
    return keep_last(rows, ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"])


@query("latest_n", "SELECT event_id, event_type, ts, value FROM events ORDER BY ts DESC, event_id LIMIT 5")
def _latest_n(spark, sf_dir):
    return newest(events(spark, sf_dir).select("event_id", "event_type", "ts", "value"), 5, "ts", ["event_id"])


@query(
    "latest_n_per_source",
    """SELECT event_id, event_type, ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) <= 5""",
)
def _latest_n_per_source(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "event_type", "ts", "value")
    return newest_per_group(rows, 5, ["event_type"], "ts", ["event_id"])


@query("ordered_scan", "SELECT event_id, ts, value FROM events ORDER BY ts, event_id")
def _ordered_scan(spark, sf_dir):
    return in_time_order(events(spark, sf_dir).select("event_id", "ts", "value"), "ts", "event_id")


@query(
    "candle_coverage",
    """
WITH m AS (SELECT event_type AS symbol, date_trunc('minute', ts) AS t FROM events),
w AS (SELECT unnest(['1m', '5m', '15m']) AS "interval", unnest([60000, 300000, 900000]) AS ms),
c AS (SELECT symbol, "interval", ms, time_bucket(to_milliseconds(ms), t) AS t FROM m CROSS JOIN w),
g AS (SELECT symbol, "interval", count(DISTINCT t) AS fetched,
  greatest(1, (epoch_ms(max(t)) - epoch_ms(min(t))) // max(ms) + 1) AS expected FROM c GROUP BY 1, 2)
SELECT symbol, "interval", fetched, expected, round(least(100.0, fetched / expected * 100.0), 6) AS percent FROM g""",
)
def _candle_coverage(spark, sf_dir):
    rows = events(spark, sf_dir).select(
        F.col("event_type").alias("symbol"),
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("interval"),
                        F.timestamp_seconds(F.unix_seconds("ts") - F.unix_seconds("ts") % width).alias("timestamp"),
                    )
                    for name, width in (("1m", 60), ("5m", 300), ("15m", 900))
                ]
            )
        ).alias("c"),
    )
    return candle_coverage(rows.select("symbol", "c.*")).withColumn("percent", rounded(F.col("percent")))


@query(
    "stale_series",
    """SELECT 'events' AS source, 'user_' || user_id AS metric_name, max(ts) AS last_ts,
  round((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts))) / 3.6e9, 6) AS age_hours
FROM events GROUP BY ALL HAVING epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts)) > 7200000000""",
)
def _stale_series(spark, sf_dir):
    rows = events(spark, sf_dir).select(
        F.lit("events").alias("source"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("metric_name"),
        F.col("ts").alias("timestamp"),
    )
    return stale_series(rows, EVENTS_NOW).withColumn("age_hours", rounded(F.col("age_hours")))


@query(
    "price_spike",
    f"""WITH c AS ({CLOSES_SQL})
SELECT c.hour, c.close, p.close AS previous, round(c.close / p.close * 100.0 - 100.0, 4) AS change_pct
FROM c JOIN c p ON p.hour = c.hour - INTERVAL 1 HOUR
WHERE p.close <> 0 AND abs(c.close / p.close * 100.0 - 100.0) > 3""",
)
def _price_spike(spark, sf_dir):
    closes = hourly_close(candles(spark, sf_dir).where(F.col("symbol") == PRICE))
    return price_spikes(closes).withColumn("change_pct", rounded(F.col("change_pct"), 4))


@query(
    "sentiment_shift",
    """
WITH l AS (SELECT 'user_' || user_id AS metric_name, date_trunc('hour', ts) AS hour, event_type AS label FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts DESC, event_type DESC) = 1),
p AS (SELECT *, lag(label) OVER (PARTITION BY metric_name ORDER BY hour) AS previous_label,
  row_number() OVER (PARTITION BY metric_name ORDER BY hour) AS nth FROM l)
SELECT 'events' AS source, metric_name, hour, previous_label, label FROM p
WHERE nth > 1 AND label IS DISTINCT FROM previous_label""",
)
def _sentiment_shift(spark, sf_dir):
    rows = events(spark, sf_dir).select(
        F.lit("events").alias("source"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("metric_name"),
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("label"),
    )
    return sentiment_shifts(rows)


@query(
    "daily_move",
    """
WITH d AS (SELECT event_type, date_trunc('day', ts)::TIMESTAMP AS day, value FROM events
  QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('day', ts) ORDER BY ts DESC, value DESC) = 1),
p AS (SELECT *, lag(value) OVER (PARTITION BY event_type ORDER BY day) AS previous FROM d)
SELECT 'events' AS source, event_type AS metric_name, day, value, previous,
       round(value / previous * 100.0 - 100.0, 4) AS change_pct
FROM p WHERE previous <> 0 AND abs(value / previous * 100.0 - 100.0) > 2""",
)
def _daily_move(spark, sf_dir):
    return daily_moves(observations(spark, sf_dir)).withColumn("change_pct", rounded(F.col("change_pct"), 4))
