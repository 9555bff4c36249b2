"""Raw payloads rendered from the tables and parsed back."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import query, rounded
from catalogue.scalars import SPOILT_SQL, spoilt
from catalogue.tables import EVENT_TYPES, EVENTS_NOW, events, observations, orders
from lagloom.functions.coerce import number, since
from lagloom.session import work_path
from lagloom.sources.lake import read_features_since
from lagloom.sources.observations import (
    features_union,
    first_available,
    latest_valid_observation,
    missing_placeholders,
    with_fallback,
)
from lagloom.sources.payloads import (
    aggregate_market_volume,
    normalize_daily_close,
    normalize_klines,
    normalize_rate_csv,
    normalize_sentiment,
    normalize_wide_trends,
    payload_status,
    read_csv_text,
    read_payloads,
    typed_rows,
)

MONEY = "decimal(18,2)"


def kline_payloads(spark, sf_dir, *more):
    """Two candles per event as one response; every tenth response has an invalid close."""
    money = lambda step: (F.col("value") + step).cast(MONEY).cast("string")
    close = F.when(F.col("event_id") % 10 == 3, "oops").otherwise(money(3))
    item = lambda minute, last: F.array(
        (F.unix_millis("ts") + 60_000 * minute).cast("string"), money(0), money(1), money(2), last, money(4)
    )
    return events(spark, sf_dir).select(
        F.to_json(F.array(item(0, money(3)), item(1, close))).alias("payload"),
        F.col("event_type").alias("symbol"),
        F.lit("1m").alias("interval"),
        *more,
    )


@query(
    "normalize_klines",
    """
WITH m AS (SELECT unnest([0, 1]) AS k)
SELECT event_type AS symbol, '1m' AS "interval",
  make_timestamp((epoch_us(ts) // 1000) * 1000) + k * INTERVAL 1 MINUTE AS "timestamp",
  round(value, 6) AS open, round(value + 1, 6) AS high, round(value + 2, 6) AS low, round(value + 3, 6) AS close,
  round(value + 4, 6) AS volume
FROM events CROSS JOIN m WHERE event_id % 10 <> 3""",
)
def _normalize_klines(spark, sf_dir):
    rows = typed_rows(normalize_klines(kline_payloads(spark, sf_dir)))
    return rows.withColumns({name: rounded(F.col(name)) for name in ("open", "high", "low", "close", "volume")})


@query(
    "payload_status",
    """SELECT event_type AS symbol, CASE WHEN event_id % 10 = 3 THEN 'error' ELSE 'ok' END AS status, count(*) AS payloads,
  sum(CASE WHEN event_id % 10 = 3 THEN 0 ELSE 2 END)::BIGINT AS items FROM events GROUP BY ALL""",
)
def _payload_status(spark, sf_dir):
    return (
        payload_status(kline_payloads(spark, sf_dir), "klines")
        .groupBy("symbol", "status")
        .agg(F.count("*").alias("payloads"), F.sum("items").alias("items"))
    )


def sentiment_payloads(spark, sf_dir):
    """Two items per event; some labels missing, some responses empty, some with a bad value."""
    stamp = F.unix_seconds("ts").cast("string")
    earlier = (F.unix_seconds("ts") - 86_400).cast("string")
    whole = F.floor("value").cast("string")
    value = F.when(F.col("event_id") % 11 == 5, "x").otherwise(whole)
    label = F.when(F.col("event_id") % 3 > 0, F.col("event_type"))
    item = lambda v, at: F.struct(v.alias("value"), label.alias("value_classification"), at.alias("timestamp"))
    items = F.array(item(whole, stamp), item(value, earlier))
    empty = F.lit('{"data":[]}')
    return events(spark, sf_dir).select(
        F.when(F.col("event_id") % 13 == 7, empty).otherwise(F.to_json(F.struct(items.alias("data")))).alias("payload")
    )


SENTIMENT_SQL = """
SELECT 'fear_greed' AS source, 'index' AS metric_name,
  make_timestamp((epoch_us(ts) // 1000000) * 1000000) - k * INTERVAL 1 DAY AS "timestamp",
  CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS value, CASE WHEN event_id % 3 > 0 THEN event_type ELSE '' END AS label
FROM events CROSS JOIN (SELECT unnest({ks}) AS k) WHERE event_id % 13 <> 7 {also}"""


@query("normalize_sentiment", SENTIMENT_SQL.format(ks="[0, 1]", also="AND event_id % 11 <> 5"))
def _normalize_sentiment(spark, sf_dir):
    """Written to files as landed responses, one per line, and read back."""
    path = work_path(spark, "sentiment")
    sentiment_payloads(spark, sf_dir).write.text(path)
    return normalize_sentiment(read_payloads(spark, path))


@query("latest_sentiment", SENTIMENT_SQL.format(ks="[0]", also=""))
def _latest_sentiment(spark, sf_dir):
    return normalize_sentiment(sentiment_payloads(spark, sf_dir), latest_only=True)


@query(
    "normalize_daily_close",
    """SELECT 'dxy' AS source, 'close' AS metric_name, date_trunc('day', ts)::TIMESTAMP AS "timestamp",
  CAST(value AS VARCHAR) AS value, NULL::VARCHAR AS label FROM events WHERE event_id % 10 NOT IN (1, 2, 3, 4, 5)""",
)
def _normalize_daily_close(spark, sf_dir):
    quotes = events(spark, sf_dir).select(F.col("ts").cast("string").alias("Date"), spoilt().alias("Close"))
    return normalize_daily_close(quotes, "dxy", include_label=True)


@query(
    "normalize_rate_csv",
    """SELECT 'fred' AS source, 'treasury_10y' AS metric_name, date_trunc('day', ts)::TIMESTAMP AS "timestamp",
  CAST(value AS VARCHAR) AS value FROM events WHERE event_id % 10 NOT IN (1, 2, 3, 4, 5)""",
)
def _normalize_rate_csv(spark, sf_dir):
    path = work_path(spark, "rates")
    rates = events(spark, sf_dir).select(F.date_format("ts", "yyyy-MM-dd").alias("observation_date"), spoilt().alias("DGS10"))
    rates.write.option("header", "true").csv(path)
    return normalize_rate_csv(read_csv_text(spark, path))


@query(
    "unpivot_wide",
    """SELECT 'google_trends' AS source, event_type AS metric_name, date_trunc('hour', ts) AS "timestamp",
  CAST(count(*) AS VARCHAR) AS value FROM events GROUP BY ALL""",
)
def _unpivot_wide(spark, sf_dir):
    hours = events(spark, sf_dir).groupBy(F.date_trunc("hour", "ts").alias("timestamp"))
    wide = hours.pivot("event_type", list(EVENT_TYPES)).agg(F.count("event_id")).withColumn("isPartial", F.lit(False))
    return normalize_wide_trends(wide, EVENT_TYPES)


@query(
    "six_hour_volume",
    f"""
WITH m AS (
  SELECT date_trunc('hour', ts) AS run, ts,
    CASE WHEN event_type <> 'error' AND event_id % 4 <> 1 THEN TRY_CAST({SPOILT_SQL} AS DECIMAL(18, 2)) END AS v
  FROM events),
r AS (SELECT run, max(ts) AS fetched_at, coalesce(sum(v), 0) AS value FROM m GROUP BY 1
  HAVING run NOT IN (SELECT date_trunc('hour', ts) FROM events WHERE event_id % 499 IN (7, 8)))
SELECT time_bucket(INTERVAL 6 HOUR, fetched_at, TIMESTAMP '2000-01-01') AS "timestamp", round(value::DOUBLE, 6) AS value,
  fetched_at FROM r
QUALIFY row_number() OVER (PARTITION BY time_bucket(INTERVAL 6 HOUR, fetched_at, TIMESTAMP '2000-01-01')
  ORDER BY fetched_at DESC) = 1""",
)
def _six_hour_volume(spark, sf_dir):
    """One run per hour, some with an unreadable page; a closed flag that is absent does not close a market."""
    raw = market_pages(spark, sf_dir)
    return aggregate_market_volume(raw).select("timestamp", rounded(F.col("value")).alias("value"), "fetched_at")


@query(
    "market_status",
    """SELECT CASE WHEN event_id % 499 IN (7, 8) THEN 'error' ELSE 'ok' END AS status, count(*) AS payloads,
  sum(CASE WHEN event_id % 499 IN (7, 8) THEN 0 ELSE 1 END)::BIGINT AS items FROM events GROUP BY 1""",
)
def _market_status(spark, sf_dir):
    found = payload_status(market_pages(spark, sf_dir), "markets").groupBy("status")
    return found.agg(F.count("*").alias("payloads"), F.sum("items").alias("items"))


def market_pages(spark, sf_dir):
    """An event as a page with one market; two of 499 are an error message or no JSON at all."""
    market = F.struct(
        F.struct(
            spoilt().alias("volume24hr"),
            (F.col("event_type") != "error").alias("active"),
            F.when(F.col("event_id") % 4 < 2, F.col("event_id") % 4 == 1).alias("closed"),
        ).alias("m")
    )
    page = F.to_json(F.struct(F.array(market["m"]).alias("markets")))
    broken = F.when(F.col("event_id") % 499 == 7, '{"error": "busy"}').when(F.col("event_id") % 499 == 8, "<html>")
    return events(spark, sf_dir).select(
        F.coalesce(broken, page).alias("payload"),
        F.date_trunc("hour", "ts").cast("string").alias("run_id"),
        F.col("ts").alias("fetched_at"),
    )


@query(
    "latest_observation",
    """SELECT 'events' AS source, event_type AS metric_name, ts AS "timestamp", value FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, value DESC) = 1""",
)
def _latest_observation(spark, sf_dir):
    return latest_valid_observation(observations(spark, sf_dir))


@query(
    "missing_placeholders",
    """SELECT 'events' AS source, e.metric_name, TIMESTAMP '2024-01-31' AS "timestamp", NULL::VARCHAR AS value, 'skip' AS status
FROM (SELECT unnest(['click', 'refund', 'view', 'share']) AS metric_name) e
WHERE e.metric_name NOT IN (SELECT event_type FROM events)""",
)
def _missing_placeholders(spark, sf_dir):
    expected = [("events", name) for name in ("click", "refund", "view", "share")]
    return missing_placeholders(observations(spark, sf_dir), expected, EVENTS_NOW)


@query(
    "first_available",
    """
WITH v AS (SELECT user_id, event_type, ts, value, CASE event_type WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2 ELSE 3 END AS priority
  FROM events WHERE event_id % 10 NOT IN (1, 2, 3, 4, 5))
SELECT 'user' AS source, CAST(user_id AS VARCHAR) AS metric_name, priority, ts AS "timestamp", value FROM v
QUALIFY priority = min(priority) OVER (PARTITION BY user_id)""",
)
def _first_available(spark, sf_dir):
    rank = F.when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "signup", 2).otherwise(3)
    candidates = events(spark, sf_dir).select(
        F.lit("user").alias("source"),
        F.col("user_id").cast("string").alias("metric_name"),
        rank.alias("priority"),
        F.col("ts").alias("timestamp"),
        number(spoilt()).alias("value"),
    )
    return first_available(candidates)


def _order_observations(spark, sf_dir):
    return orders(spark, sf_dir).select(
        F.lit("orders").alias("source"),
        F.col("o_orderpriority").alias("metric_name"),
        F.col("o_orderdate").alias("timestamp"),
        F.col("o_totalprice").alias("value"),
        F.col("o_orderstatus").alias("label"),
    )


@query(
    "features_union",
    """
SELECT 'alt_data' AS dataset, 'orders' AS source, o_orderpriority AS metric_name, o_orderdate AS "timestamp",
  o_totalprice AS value, o_orderstatus AS label FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'
UNION ALL
SELECT 'macro_data', 'events', event_type, ts, value, NULL FROM events WHERE ts >= TIMESTAMP '2000-01-01'""",
)
def _features_union(spark, sf_dir):
    return read_features_since(_order_observations(spark, sf_dir), observations(spark, sf_dir), "2000-01-01")


@query(
    "fallback_source",
    """SELECT 'events' AS source, event_type AS metric_name, ts AS "timestamp", value, 'table' AS input_source FROM events""",
)
def _fallback(spark, sf_dir):
    """No observation reaches 2030, so the table is used."""
    primary = since(observations(spark, sf_dir), "2030-01-01")
    return with_fallback(primary, observations(spark, sf_dir))


@query(
    "union_missing_columns",
    """
SELECT source, label IS NULL AS without_label, count(*) AS rows FROM (
  SELECT 'orders' AS source, o_orderstatus AS label FROM orders UNION ALL SELECT 'events', NULL FROM events) GROUP BY ALL""",
)
def _union_missing(spark, sf_dir):
    both = features_union(_order_observations(spark, sf_dir), observations(spark, sf_dir))
    return both.groupBy("source", F.col("label").isNull().alias("without_label")).agg(F.count("*").alias("rows"))
