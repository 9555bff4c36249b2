"""Bulk parsing of landed raw payloads into rows.

Each input row holds one response as text in ``payload``. A response that cannot be read, or one item of
which is invalid, gives no rows and is reported by :func:`payload_status`; the others are unaffected.
Numbers leave as the text they came in, so that no digit is lost.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lagloom.functions.coerce import (
    bucket_start,
    epoch_millis,
    epoch_seconds,
    exact_decimal,
    has_values,
    midnight_utc,
    moment,
    number_column,
    zoned_to_utc,
)
from lagloom.functions.text import float_text
from lagloom.operators.dedupe import keep_last
from lagloom.schemas import DECIMAL, PRICE_FIELDS

#: Optional column of responses and rows: when they were polled.
ARRIVAL = "arrival"

KLINE_ITEMS = "array<array<string>>"
SENTIMENT_BODY = "data array<struct<value: string, value_classification: string, timestamp: string>>"
MARKET_BODY = "markets array<struct<volume24hr: string, active: boolean, closed: boolean>>"


def read_payloads(spark: SparkSession, *paths: str, whole_files: bool = False) -> DataFrame:
    """Landed responses, one per line or one per file."""
    return spark.read.text(list(paths), wholetext=whole_files).withColumnRenamed("value", "payload")


def _kline_items() -> Column:
    return F.from_json("payload", KLINE_ITEMS)


def _kline_valid(item: Column) -> Column:
    numbers = [exact_decimal(F.get(item, i)).isNotNull() for i in range(1, 6)]
    valid = F.get(item, 0).try_cast("bigint").isNotNull()
    for test in numbers:
        valid = valid & test
    return F.coalesce(valid, F.lit(False))


def _sentiment_items() -> Column:
    return F.from_json("payload", SENTIMENT_BODY).getField("data")


def _sentiment_valid(item: Column) -> Column:
    return F.coalesce(
        item["timestamp"].try_cast("bigint").isNotNull() & exact_decimal(item["value"]).isNotNull(), F.lit(False)
    )


def _market_items() -> Column:
    """The markets of a page; NULL if it is no such page."""
    return F.from_json("payload", MARKET_BODY).getField("markets")


def _valid_items(df: DataFrame, items: Column, valid, *keep: str) -> DataFrame:
    """One row per item of the responses that are valid throughout.

    The test and the outer explode are nested around one parse: as a filter on the parsed column, or with
    the filter an inner explode brings along, the parse would be repeated for each.
    """
    whole = F.flatten(F.filter(F.array(items), lambda found: F.forall(found, valid)))
    return df.select(*keep, F.explode_outer(whole).alias("_item")).where(F.col("_item").isNotNull())


def normalize_klines(raw: DataFrame) -> DataFrame:
    """Array-of-arrays candles to rows; ``raw`` has payload, symbol and interval, and perhaps ``arrival``.

    The arrival of a response (its poll time, say) goes to its rows: a later poll of a running candle replaces it.
    """
    kept = [name for name in (ARRIVAL,) if name in raw.columns]
    rows = _valid_items(raw, _kline_items(), _kline_valid, "symbol", "interval", *kept)
    return rows.select(
        *kept,
        "symbol",
        "interval",
        epoch_millis(F.get("_item", 0)).alias("timestamp"),
        *[F.trim(F.get("_item", i)).alias(name) for i, name in enumerate(PRICE_FIELDS, start=1)],
    )


def normalize_sentiment(raw: DataFrame, latest_only: bool = False) -> DataFrame:
    """Sentiment index responses to rows; a missing label becomes the empty string.

    ``latest_only`` takes the first item of each response, which is its newest.
    """
    items = F.slice(_sentiment_items(), 1, 1) if latest_only else _sentiment_items()
    return _valid_items(raw, items, _sentiment_valid).select(
        F.lit("fear_greed").alias("source"),
        F.lit("index").alias("metric_name"),
        epoch_seconds(F.col("_item")["timestamp"]).alias("timestamp"),
        F.trim(F.col("_item")["value"]).alias("value"),
        F.coalesce(F.col("_item")["value_classification"], F.lit("")).alias("label"),
    )


def payload_status(raw: DataFrame, kind: str) -> DataFrame:
    """Adds status (ok or error) and the item count; an empty or unreadable response is an error.

    An empty candle list or market page is a valid answer with no rows.
    """
    items, valid, least = {
        "klines": (_kline_items(), _kline_valid, 0),
        "sentiment": (_sentiment_items(), _sentiment_valid, 1),
        "markets": (_market_items(), Column.isNotNull, 0),
    }[kind]
    good = F.coalesce(F.forall("_items", valid) & (F.size("_items") >= least), F.lit(False))
    return (
        raw.withColumn("_items", items)
        .withColumn("status", F.when(good, "ok").otherwise("error"))
        .withColumn("items", F.when(good, F.size("_items")).otherwise(0))
        .drop("_items")
    )


def normalize_daily_close(
    quotes: DataFrame,
    source: str,
    metric: str = "close",
    include_label: bool = False,
    date_column: str = "Date",
    close_column: str = "Close",
) -> DataFrame:
    """Daily quotes to rows stamped midnight UTC; quotes without a valid close are left out."""
    close = number_column(quotes, close_column)
    rows = has_values(
        quotes.select(midnight_utc(F.col(date_column)).alias("timestamp"), close.alias("_close")), "timestamp", "_close"
    )
    return rows.select(
        F.lit(source).alias("source"),
        F.lit(metric).alias("metric_name"),
        "timestamp",
        float_text(F.col("_close")).alias("value"),
        *([F.lit(None).cast("string").alias("label")] if include_label else []),
    )


def read_csv_text(spark: SparkSession, *paths: str) -> DataFrame:
    """A CSV with header, all columns as text."""
    return spark.read.option("header", "true").csv(list(paths))


def normalize_rate_csv(
    table: DataFrame, series: str = "DGS10", source: str = "fred", metric: str = "treasury_10y"
) -> DataFrame:
    """Rate history: the date column is ``observation_date`` or ``DATE``; ``.`` marks a missing value."""
    date_column = "observation_date" if "observation_date" in table.columns else "DATE"
    if date_column not in table.columns or series not in table.columns:
        raise ValueError(f"expected columns observation_date or DATE, and {series}; found {table.columns}")
    return normalize_daily_close(table, source, metric, date_column=date_column, close_column=series)


def normalize_wide_trends(
    table: DataFrame,
    keywords: Sequence[str],
    time_column: str = "timestamp",
    zone: str | None = None,
    source: str = "google_trends",
) -> DataFrame:
    """One column per keyword to one row per keyword and stamp; rows of a partial period are kept."""
    missing = [name for name in keywords if name not in table.columns]
    if missing:
        raise ValueError(f"no column for keywords {missing}")
    stamped = table.select(zoned_to_utc(F.col(time_column), zone).alias("timestamp"), *keywords)
    typed = stamped.select(
        "timestamp",
        *[
            F.when(number_column(stamped, name).isNotNull(), _number_text(stamped, name)).alias(name)
            for name in keywords
        ],
    )
    long = typed.unpivot("timestamp", list(keywords), "metric_name", "value")
    return has_values(long, "timestamp", "value").select(F.lit(source).alias("source"), "metric_name", "timestamp", "value")


def _number_text(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return float_text(F.col(name).cast("double"))
    return F.trim(F.col(name).cast("string"))


def aggregate_market_volume(raw: DataFrame) -> DataFrame:
    """Exact 24h volume over all open markets, one row per six-hour bucket.

    ``raw`` has payload, run_id and fetched_at; the pages of a run are summed, and a later run replaces
    an earlier one in the same bucket. A run with a page that cannot be read gives no row. A market counts if it is active and not closed; volumes that are
    missing or no number are left out of the sum.
    """
    pages = raw.select("run_id", "fetched_at", _market_items().alias("_markets"))
    markets = pages.select(
        "run_id", "fetched_at", F.col("_markets").isNotNull().alias("_read"), F.explode_outer("_markets").alias("market")
    )
    counted = F.col("market.active").eqNullSafe(True) & ~F.col("market.closed").eqNullSafe(True)
    volume = F.when(counted, exact_decimal(F.col("market.volume24hr")))
    runs = markets.groupBy("run_id").agg(
        F.coalesce(F.sum(volume), F.lit(0).cast(DECIMAL)).cast(DECIMAL).alias("value"),
        F.max("fetched_at").alias("fetched_at"),
        F.min("_read").alias("_read"),
    )
    runs = runs.where("_read").drop("_read")
    stamped = runs.withColumn("timestamp", bucket_start(F.col("fetched_at"), 6))
    last = keep_last(stamped, ["timestamp"], ["fetched_at", "run_id"])
    return last.select(
        F.lit("polymarket").alias("source"),
        F.lit("total_volume_24h").alias("metric_name"),
        "timestamp",
        "value",
        F.lit(None).cast("string").alias("label"),
        "fetched_at",
    )


def typed_rows(rows: DataFrame, *columns: str) -> DataFrame:
    """Text numbers to the exact decimals the tables hold."""
    named = columns or tuple(name for name in (*PRICE_FIELDS, "value") if name in rows.columns)
    return rows.withColumns({name: exact_decimal(F.col(name)) for name in named})


def stamped(rows: DataFrame, run_ts: datetime | str) -> DataFrame:
    """Ingestion time, the tie-break of later merges; a parameter so that a rerun gives the same rows."""
    return rows.withColumn("fetched_at", moment(run_ts))
