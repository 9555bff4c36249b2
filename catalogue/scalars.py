"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import query
from catalogue.tables import EVENTS_NOW, events, observations, orders
from lagloom.functions import coerce, text
from lagloom.sinks.lake import normalize_value, partition_key
from lagloom.sources.payloads import stamped

# Every tenth value is spoilt in one of several ways.
SPOILT_SQL = """CASE WHEN event_id % 10 = 1 THEN 'n/a' WHEN event_id % 10 = 2 THEN '' WHEN event_id % 10 = 3 THEN 'NaN'
  WHEN event_id % 10 = 4 THEN '1d' WHEN event_id % 10 = 5 THEN '.' ELSE CAST(CAST(value AS DECIMAL(18, 2)) AS VARCHAR) END"""


def spoilt():
    plain = F.col("value").cast("decimal(18,2)").cast("string")
    kind = F.col("event_id") % 10
    return (
        F.when(kind == 1, "n/a").when(kind == 2, "").when(kind == 3, "NaN").when(kind == 4, "1d").when(kind == 5, ".")
        .otherwise(plain)
    )


@query(
    "coerce_values",
    """
SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE ts END AS parsed_ts,
       CASE WHEN event_id % 10 IN (1, 2, 3, 4, 5) THEN NULL ELSE value END AS parsed_value
FROM events""",
)
def _coerce_values(spark, sf_dir):
    raw = events(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_id") % 7 == 0, "not a time").otherwise(F.col("ts").cast("string")).alias("ts_text"),
        spoilt().alias("value_text"),
    )
    return raw.select(
        "event_id",
        coerce.utc_timestamp(F.col("ts_text")).alias("parsed_ts"),
        coerce.number_column(raw, "value_text").alias("parsed_value"),
    )


@query(
    "drop_missing",
    """SELECT event_id, ts, value FROM events WHERE event_id % 7 <> 0 AND event_id % 10 NOT IN (1, 2, 3, 4, 5)""",
)
def _drop_missing(spark, sf_dir):
    rows = _coerce_values(spark, sf_dir).select(
        "event_id", F.col("parsed_ts").alias("ts"), F.col("parsed_value").alias("value")
    )
    return coerce.has_values(rows, "ts", "value")


@query(
    "time_buckets",
    """SELECT event_id, date_trunc('hour', ts) AS hour, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2000-01-01') AS six_hours,
  strftime(ts, '%Y-%m-%d') AS day_key, strftime(ts, '%Y-%m-01') AS month_key, strftime(ts, '%Y-01-01') AS year_key
FROM events""",
)
def _time_buckets(spark, sf_dir):
    ts = F.col("ts")
    return events(spark, sf_dir).select(
        "event_id",
        coerce.floor_hour(ts).alias("hour"),
        coerce.bucket_start(ts, 6).alias("six_hours"),
        *[partition_key(ts, name).alias(f"{name}_key") for name in ("day", "month", "year")],
    )


@query(
    "epoch_times",
    """SELECT event_id, make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS from_seconds,
  make_timestamp((epoch_us(ts) // 1000) * 1000) AS from_millis FROM events""",
)
def _epoch_times(spark, sf_dir):
    raw = events(spark, sf_dir).select(
        "event_id", F.unix_seconds("ts").cast("string").alias("s"), F.unix_millis("ts").cast("string").alias("ms")
    )
    return raw.select(
        "event_id",
        coerce.epoch_seconds(F.col("s")).alias("from_seconds"),
        coerce.epoch_millis(F.col("ms")).alias("from_millis"),
    )


@query(
    "zones_and_midnight",
    """SELECT event_id, date_trunc('day', ts)::TIMESTAMP AS midnight, ts - INTERVAL 7 HOUR AS from_jakarta,
  strftime(ts, '%H:%M') AS utc_clock, strftime(ts + INTERVAL 7 HOUR, '%H:%M') AS jakarta_clock,
  strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS iso
FROM events""",
)
def _zones(spark, sf_dir):
    ts = F.col("ts")
    return events(spark, sf_dir).select(
        "event_id",
        coerce.midnight_utc(ts).alias("midnight"),
        coerce.zoned_to_utc(ts.cast("string"), "Asia/Jakarta").alias("from_jakarta"),
        text.clock_text(ts).alias("utc_clock"),
        text.clock_text(ts, "Asia/Jakarta").alias("jakarta_clock"),
        text.iso_text(ts).alias("iso"),
    )


@query(
    "equality_and_prefix",
    "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority LIKE '1-%'",
)
def _prefix(spark, sf_dir):
    found = coerce.matching(orders(spark, sf_dir), {"o_orderpriority": "1-"}, o_orderstatus="F")
    return found.select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(
    "exact_decimals",
    """SELECT event_type, CAST(sum(CAST(value AS DECIMAL(18, 2))) AS VARCHAR) AS total,
  count(*) FILTER (event_id % 10 IN (1, 2, 3, 4, 5)) AS rejected
FROM (SELECT event_id, event_type, CASE WHEN event_id % 10 IN (1, 2, 3, 4, 5) THEN NULL ELSE value END AS value FROM events)
GROUP BY 1""",
)
def _exact_decimals(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_type", coerce.exact_decimal(spoilt()).alias("exact"))
    return rows.groupBy("event_type").agg(
        F.sum("exact").cast("decimal(38,2)").cast("string").alias("total"),
        F.count_if(F.col("exact").isNull()).alias("rejected"),
    )


@query(
    "value_text",
    """SELECT event_id, CAST(value AS VARCHAR) AS float_text,
  regexp_replace(regexp_replace(CAST(CAST(value AS DECIMAL(18, 2)) AS VARCHAR), '\\.0*$', ''), '(\\.[0-9]*[1-9])0+$', '\\1') AS decimal_text,
  CASE WHEN event_id % 2 = 0 THEN 'kept 1.50' END AS kept
FROM events""",
)
def _value_text(spark, sf_dir):
    rows = events(spark, sf_dir).select(
        "event_id",
        F.col("value").alias("float_text"),
        F.col("value").cast("decimal(38,18)").alias("decimal_text"),
        F.when(F.col("event_id") % 2 == 0, "kept 1.50").alias("kept"),
    )
    return normalize_value(rows, "float_text", "decimal_text", "kept")


@query(
    "column_defaults",
    """SELECT event_type AS metric_name, count(*) AS rows, count(label) AS labels, min(dataset) AS dataset
FROM (SELECT event_type, NULL::VARCHAR AS label, 'alt_data' AS dataset FROM events) GROUP BY 1""",
)
def _column_defaults(spark, sf_dir):
    filled = coerce.with_absent(
        observations(spark, sf_dir), label=F.lit(None).cast("string"), dataset="alt_data", metric_name="not used"
    )
    return filled.groupBy("metric_name").agg(
        F.count("*").alias("rows"), F.count("label").alias("labels"), F.min("dataset").alias("dataset")
    )


@query(
    "dataset_names",
    """SELECT DISTINCT CASE WHEN o_orderstatus IN ('F') THEN 'macro_data' ELSE 'alt_data' END || '.' || o_orderstatus || '.' ||
  o_orderpriority AS dataset FROM orders""",
)
def _dataset_names(spark, sf_dir):
    name = text.dataset_name(F.col("o_orderstatus"), F.col("o_orderpriority"), ["F"])
    return orders(spark, sf_dir).select(name.alias("dataset")).distinct()


@query(
    "path_parts",
    """SELECT DISTINCT url_encode(o_orderpriority || ' / ~*' || o_orderstatus) AS part FROM orders""",
)
def _path_parts(spark, sf_dir):
    value = F.concat("o_orderpriority", F.lit(" / ~*"), "o_orderstatus")
    return orders(spark, sf_dir).select(text.path_part(value).alias("part")).distinct()


@query(
    "stamped_rows",
    """SELECT event_id, ts, value, TIMESTAMP '2024-01-31 00:00:00' AS fetched_at FROM events""",
)
def _stamped(spark, sf_dir):
    return stamped(events(spark, sf_dir).select("event_id", "ts", "value"), EVENTS_NOW)
