"""Counts, run summaries and the daily report."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.correlation import WITH_INPUTS, grid_sql, planted_run
from catalogue.registry import query, rounded
from catalogue.tables import CLOSES_SQL, EVENTS_NOW, PRICE, candles, events, observations, orders
from lagloom.operators.reports import (
    catalog_counts,
    close_with_change,
    count_with_fallback,
    daily_report,
    exact_count,
    hypothesis_counts,
    latest_with_change,
    run_totals,
    sample_counts,
    status_rollup,
    summary_with_total,
)
from lagloom.operators.series import hourly_close

NAMED = (
    ("alt_data", "clicks", "events", "click"),
    ("alt_data", "views", "events", "view"),
    ("macro_data", "refunds", "events", "refund"),
)


@query(
    "sample_counts",
    """
SELECT n.dataset, n.name, count(e.event_id) AS samples
FROM (VALUES ('alt_data', 'clicks', 'click'), ('alt_data', 'views', 'view'), ('macro_data', 'refunds', 'refund'))
  n(dataset, name, metric) LEFT JOIN events e ON e.event_type = n.metric GROUP BY ALL""",
)
def _sample_counts(spark, sf_dir):
    return sample_counts(observations(spark, sf_dir), NAMED)


@query("exact_count", "SELECT count(*) AS rows FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW'")
def _exact_count(spark, sf_dir):
    return exact_count(orders(spark, sf_dir), o_orderstatus="F", o_orderpriority="5-LOW")


def _day_catalog(spark, sf_dir, interval="1m"):
    """The events of each day, of all types, as one catalogued object."""
    return (
        events(spark, sf_dir)
        .groupBy(F.date_trunc("day", "ts").alias("day"))
        .agg(F.count("*").alias("row_count"))
        .select(F.lit("btc_ohlcv").alias("dataset"), F.lit(interval).alias("interval"), "row_count")
    )


@query(
    "count_fallback",
    """
SELECT '1m' AS "interval", count(*) AS rows FROM events
UNION ALL SELECT '5m', count(*) FROM events WHERE event_id % 3 > 0
UNION ALL SELECT '15m', 0""",
)
def _count_fallback(spark, sf_dir):
    """1m comes from the catalog, 5m from the table, 15m is nowhere."""
    interval = F.when(F.col("event_id") % 3 > 0, "5m").otherwise("1m").alias("interval")
    table = events(spark, sf_dir).select(F.lit(PRICE).alias("symbol"), interval)
    return count_with_fallback(_day_catalog(spark, sf_dir), table, PRICE)


@query(
    "catalog_counts",
    """SELECT event_type AS "interval", count(*) AS rows FROM events GROUP BY 1""",
)
def _catalog_counts(spark, sf_dir):
    objects = (
        events(spark, sf_dir)
        .groupBy(F.col("event_type").alias("interval"), F.date_trunc("day", "ts").alias("day"))
        .agg(F.count("*").alias("row_count"))
        .withColumn("dataset", F.lit("btc_ohlcv"))
    )
    return catalog_counts(objects)


def _run_log(spark, sf_dir):
    """Events as run entries: a run per user, a part per event type."""
    status = F.when(F.col("event_id") % 5 == 0, "error").when(F.col("event_id") % 5 < 4, "ok")
    return events(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("run_id"),
        F.col("event_type").alias("source"),
        status.alias("status"),
        F.floor("value").cast("bigint").alias("fetched"),
        F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.floor("value")).cast("bigint").alias("upserted"),
        F.col("ts").alias("finished_at"),
    )


RUN_LOG_SQL = """
  SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS source,
    CASE WHEN event_id % 5 = 0 THEN 'error' WHEN event_id % 5 < 4 THEN 'ok' END AS status,
    CAST(floor(value) AS BIGINT) AS fetched,
    CASE WHEN event_id % 3 = 0 THEN 0 ELSE CAST(floor(value) AS BIGINT) END AS upserted, ts AS finished_at
  FROM events"""


@query(
    "run_totals",
    f"""SELECT run_id, sum(fetched)::BIGINT AS fetched, sum(upserted)::BIGINT AS upserted, max(finished_at) AS finished_at
FROM ({RUN_LOG_SQL}) WHERE coalesce(status, 'ok') = 'ok' GROUP BY 1 HAVING sum(upserted) > 0""",
)
def _run_totals(spark, sf_dir):
    return run_totals(_run_log(spark, sf_dir))


@query(
    "backfill_summary",
    f"""SELECT coalesce(source, 'TOTAL') AS source, sum(fetched)::BIGINT AS fetched, sum(upserted)::BIGINT AS upserted
FROM ({RUN_LOG_SQL}) GROUP BY ROLLUP (source)""",
)
def _backfill_summary(spark, sf_dir):
    return summary_with_total(_run_log(spark, sf_dir), "fetched", "upserted")


@query(
    "status_rollup",
    """
WITH s AS (SELECT user_id, CASE WHEN user_id % 3 = 0 THEN 'ok' WHEN user_id % 3 = 1 THEN 'skip'
  WHEN event_id % 2 = 0 THEN 'ok' ELSE 'error' END AS status FROM events)
SELECT user_id, CASE WHEN bool_and(status = 'ok') THEN 'ok' WHEN bool_and(status = 'skip') THEN 'skip' ELSE 'partial' END AS status
FROM s GROUP BY 1""",
)
def _status_rollup(spark, sf_dir):
    status = (
        F.when(F.col("user_id") % 3 == 0, "ok")
        .when(F.col("user_id") % 3 == 1, "skip")
        .when(F.col("event_id") % 2 == 0, "ok")
        .otherwise("error")
    )
    return status_rollup(events(spark, sf_dir).select("user_id", status.alias("status")), ["user_id"])


LATEST_SQL = """
latest AS (
  SELECT event_type, day, value, lag(value) OVER (PARTITION BY event_type ORDER BY day) AS previous,
         row_number() OVER (PARTITION BY event_type ORDER BY day DESC) AS nth
  FROM (SELECT event_type, date_trunc('day', ts)::TIMESTAMP AS day, value FROM events
        QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('day', ts) ORDER BY ts DESC, value DESC) = 1))"""


@query(
    "latest_with_change",
    f"""WITH {LATEST_SQL}
SELECT 'events' AS source, event_type AS metric_name, day, value, NULL::VARCHAR AS label,
       round(value / previous * 100.0 - 100.0, 4) AS change_pct
FROM latest WHERE nth = 1""",
)
def _latest_with_change(spark, sf_dir):
    return latest_with_change(observations(spark, sf_dir)).withColumn("change_pct", rounded(F.col("change_pct"), 4))


DAY_BEFORE_SQL = """
price AS (SELECT c.hour, c.close, p.close AS earlier FROM closes c
  LEFT JOIN closes p ON p.hour = c.hour - INTERVAL 24 HOUR WHERE c.hour = (SELECT max(hour) FROM closes))"""


@query(
    "close_with_change",
    f"WITH closes AS ({CLOSES_SQL}), {DAY_BEFORE_SQL} SELECT hour, close, round(close / earlier * 100.0 - 100.0, 4) AS change_pct FROM price",
)
def _close_with_change(spark, sf_dir):
    closes = hourly_close(candles(spark, sf_dir).where(F.col("symbol") == PRICE))
    return close_with_change(closes).withColumn("change_pct", rounded(F.col("change_pct"), 4))


def _hypotheses(spark, sf_dir):
    state = F.when(F.col("o_orderstatus") == "F", "VALID").when(F.col("o_orderstatus") == "O", "TESTING")
    return orders(spark, sf_dir).select(state.alias("status"))


HYPOTHESES_SQL = """
states AS (SELECT s.status, count(o.o_orderkey) AS hypotheses
  FROM (SELECT unnest(['DRAFT', 'TESTING', 'VALID', 'GUGUR', 'PAUSE']) AS status) s
  LEFT JOIN orders o ON CASE o.o_orderstatus WHEN 'F' THEN 'VALID' WHEN 'O' THEN 'TESTING' ELSE 'DRAFT' END = s.status
  GROUP BY 1)"""


@query("hypothesis_counts", f"WITH {HYPOTHESES_SQL} SELECT * FROM states")
def _hypothesis_counts(spark, sf_dir):
    return hypothesis_counts(_hypotheses(spark, sf_dir))


@query(
    "daily_report",
    f"""{WITH_INPUTS}, {grid_sql("every_series")}, {DAY_BEFORE_SQL}, {LATEST_SQL}, {HYPOTHESES_SQL}
SELECT 'price' AS section, 'close' AS name, close AS value, round(close / earlier * 100.0 - 100.0, 4) AS change_pct FROM price
UNION ALL SELECT 'correlation', CASE WHEN source = 'fred' THEN 'macro_data' ELSE 'alt_data' END || '.' || source || '.' ||
  metric_name || ' lag ' || lag_hours, round(pearson_r, 6), NULL FROM judged WHERE outcome = 'significant'
UNION ALL SELECT 'metric', 'events.' || event_type, value, round(value / previous * 100.0 - 100.0, 4) FROM latest WHERE nth = 1
UNION ALL SELECT 'hypothesis', status, hypotheses::DOUBLE, NULL FROM states""",
)
def _daily_report(spark, sf_dir):
    closes = hourly_close(candles(spark, sf_dir).where(F.col("symbol") == PRICE))
    results = planted_run(spark, sf_dir).results
    report = daily_report(closes, observations(spark, sf_dir), results, _hypotheses(spark, sf_dir), EVENTS_NOW)
    return report.select(
        "section", "name", rounded(F.col("value")).alias("value"), rounded(F.col("change_pct"), 4).alias("change_pct")
    )
