"""The given tables in the engine's model."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from lagloom.params import AnalysisParams

EVENT_SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
ORDER_SCHEMA = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
    "o_orderpriority string"
)

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
# The type whose values play the price.
PRICE = "purchase"

EVENTS_NOW = datetime(2024, 1, 31, tzinfo=timezone.utc)
ORDERS_NOW = datetime(2001, 8, 1, tzinfo=timezone.utc)

EVENT_PARAMS = AnalysisParams(
    price_dataset="events",
    symbol=PRICE,
    interval="1m",
    expected_sources=("events", "dxy", "polymarket", "fred", "google_trends"),
)
ORDER_PARAMS = AnalysisParams(skip_until_ready=("P",), expected_sources=("F", "O", "P", "X"), macro_sources=("F",))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENT_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(ORDER_SCHEMA).parquet(f"{sf_dir}/orders.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as an observation of the series named by its type."""
    return events(spark, sf_dir).select(
        F.lit("events").alias("source"), F.col("event_type").alias("metric_name"), F.col("ts").alias("timestamp"), "value"
    )


def candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a candle of the symbol named by its type."""
    return events(spark, sf_dir).select(
        F.col("event_type").alias("symbol"), F.lit("1m").alias("interval"), F.col("ts").alias("timestamp"),
        F.col("value").alias("close"),
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).where(F.col("metric_name") != PRICE)


def planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series that lead the price by one hour under noise of three strengths."""
    prices = events(spark, sf_dir).where(F.col("event_type") == PRICE)
    series = F.explode(
        F.array(
            *[
                F.struct(F.lit(source).alias("source"), F.lit(metric).alias("metric_name"), value.alias("value"))
                for source, metric, value in (
                    ("fred", "lead", F.col("value") + F.col("event_id") % 40),
                    ("dxy", "inverse", 100.0 - F.col("value") + F.col("event_id") % 150),
                    ("fred", "faint", F.col("value") + F.col("event_id") % 450),
                )
            ]
        )
    )
    return prices.select(F.col("ts").alias("timestamp"), series.alias("s")).select(
        "s.source", "s.metric_name", "timestamp", "s.value"
    )


def order_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as series of very different density; the source is the order status."""
    key = F.col("o_custkey")
    metric = (
        F.when(key % 200 == 1, "rare").when(key % 50 == 0, "fiftieth").when(key % 10 == 3, "tenth").otherwise("wide")
    )
    return orders(spark, sf_dir).select(
        F.col("o_orderstatus").alias("source"),
        metric.alias("metric_name"),
        F.col("o_orderdate").alias("timestamp"),
        F.col("o_totalprice").alias("value"),
    )


def daily_priority(rows: DataFrame) -> DataFrame:
    """Exact daily turnover per order priority; one row per key."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return rows.groupBy(
        F.lit("orders").alias("source"),
        F.col("o_orderpriority").alias("metric_name"),
        F.col("o_orderdate").alias("timestamp"),
    ).agg((F.sum(cents).cast("decimal(38,2)") / 100).cast("decimal(38,2)").alias("value"))


# SQL of the same adapters.
ORDER_SERIES_SQL = """
  SELECT o_orderstatus AS source,
         CASE WHEN o_custkey % 200 = 1 THEN 'rare' WHEN o_custkey % 50 = 0 THEN 'fiftieth'
              WHEN o_custkey % 10 = 3 THEN 'tenth' ELSE 'wide' END AS metric_name,
         o_orderdate AS ts, o_totalprice AS value
  FROM orders"""

PLANTED_SQL = """
  SELECT 'fred' AS source, 'lead' AS metric_name, ts, value + event_id % 40 AS value FROM events WHERE event_type = 'purchase'
  UNION ALL
  SELECT 'dxy', 'inverse', ts, 100.0::DOUBLE - value + event_id % 150 FROM events WHERE event_type = 'purchase'
  UNION ALL
  SELECT 'fred', 'faint', ts, value + event_id % 450 FROM events WHERE event_type = 'purchase'"""

FEATURES_SQL = """
  SELECT 'events' AS source, event_type AS metric_name, ts, value FROM events WHERE event_type <> 'purchase'"""


def daily_priority_sql(condition: str = "TRUE") -> str:
    return f"""
  SELECT 'orders' AS source, o_orderpriority AS metric_name, o_orderdate AS ts,
         sum(CAST(round(o_totalprice * 100) AS BIGINT)) / 100.0 AS value
  FROM orders WHERE {condition} GROUP BY ALL"""


def last_per_hour_sql(rows: str) -> str:
    """Last value per series and floored hour."""
    return f"""
  SELECT source, metric_name, date_trunc('hour', ts) AS hour, value FROM ({rows})
  QUALIFY row_number() OVER (PARTITION BY source, metric_name, date_trunc('hour', ts) ORDER BY ts DESC, value DESC) = 1"""


CLOSES_SQL = """
  SELECT date_trunc('hour', ts) + INTERVAL 1 HOUR AS hour, value AS close FROM events WHERE event_type = 'purchase'
  QUALIFY row_number() OVER (PARTITION BY date_trunc('hour', ts) ORDER BY ts DESC, value DESC) = 1"""


def p_value_sql(r: str, n: str) -> str:
    """Two-sided p-value by the power series of the incomplete beta function."""
    a = f"(({n}) - 2) / 2.0"
    y = f"({r}) * ({r})"
    x = f"(1 - {y})"
    tail = (
        f"list_sum(list_transform(range(0, 600), lambda k: exp(({a}) * ln({x}) + lgamma({a} + 0.5) - lgamma({a})"
        f" - 2 * lgamma(0.5) + lgamma(k + 0.5) - lgamma(k + 1) + k * ln({x})) / ({a} + k)))"
    )
    centre = (
        f"1 - list_sum(list_transform(range(0, 400), lambda k: exp(0.5 * ln({y}) + ({a}) * ln({x})"
        f" + lgamma({a} + 0.5 + k) - lgamma({a}) - lgamma(1.5 + k) + k * ln({y}))))"
    )
    return f"CASE WHEN abs({r}) >= 1 THEN 0.0 WHEN ({r}) = 0 THEN 1.0 WHEN abs({r}) > 0.3 THEN {tail} ELSE {centre} END"
