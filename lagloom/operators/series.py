"""Hourly series: closes, features, windows and coverage."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from lagloom.functions.coerce import floor_hour, has_values, moment, number_column, shift_hours, utc_timestamp
from lagloom.operators.dedupe import keep_last
from lagloom.params import INTERVAL_MILLIS, AnalysisParams

SERIES = ("source", "metric_name")


def _clean(rows: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    tie = ["fetched_at"] if "fetched_at" in rows.columns else []
    typed = rows.select(
        *by, utc_timestamp(F.col("timestamp")).alias("timestamp"), number_column(rows, value).alias(value), *tie
    )
    return has_values(typed, *by, "timestamp", value)


def _last_in_hour(rows: DataFrame, by: Sequence[str], value: str, unique_stamps: bool) -> DataFrame:
    """Last value per group and ``hour``.

    Where each stamp occurs once per group, as in the tables, a hash aggregate on the stamp is enough. In
    general ties go to the later fetched, then to the larger value, which needs a sorting aggregate.
    """
    if unique_stamps:
        return rows.groupBy(*by, "hour").agg(F.max_by(value, "timestamp").alias(value))
    tie = ["fetched_at"] if "fetched_at" in rows.columns else []
    return keep_last(rows, [*by, "hour"], ["timestamp", *tie]).select(*by, "hour", value)


def hourly_close(candles: DataFrame, by: Sequence[str] = (), unique_stamps: bool = False) -> DataFrame:
    """Last close of each hour, labelled with the hour's end; hours without a candle stay absent.

    A candle stamped 10:45 belongs to [10:00, 11:00) and is labelled 11:00.
    """
    rows = _clean(candles, by, "close")
    hours = rows.withColumn("hour", shift_hours(floor_hour(F.col("timestamp")), 1))
    return _last_in_hour(hours, by, "close", unique_stamps)


def feature_series(observations: DataFrame, unique_stamps: bool = False) -> DataFrame:
    """One value per series and hour, the hour being the floor of the stamp: the last observed there."""
    rows = _clean(observations, SERIES, "value")
    hours = rows.withColumn("hour", floor_hour(F.col("timestamp")))
    return _last_in_hour(hours, SERIES, "value", unique_stamps)


def window_columns(params: AnalysisParams) -> dict:
    """The window decision as expressions over ``source``, ``base_samples`` and ``max_samples``."""
    short = F.col("base_samples") < params.min_samples
    waits = F.col("source").isin(list(params.skip_until_ready))
    expanded = short & ~waits
    return {
        "final_samples": F.when(expanded, F.col("max_samples")).otherwise(F.col("base_samples")),
        "window_days": F.when(expanded, params.max_window_days).otherwise(params.base_window_days),
        "expanded": expanded,
        "skipped": short & waits,
    }


DETAILS = (*SERIES, "base_samples", "final_samples", "window_days", "expanded", "skipped")


def adaptive_windows(series: DataFrame, now: datetime, params: AnalysisParams = AnalysisParams()) -> DataFrame:
    """Window choice per series.

    A series with fewer than the minimum of rows in the base window is read over the longest window
    instead, unless its source is one that has to wait: that one is skipped and reports its base count.
    """
    counted = series.groupBy(*SERIES).agg(
        F.count_if(F.col("hour") >= moment(params.base_cutoff(now))).alias("base_samples"),
        F.count_if(F.col("hour") >= moment(params.max_cutoff(now))).alias("max_samples"),
    )
    return counted.withColumns(window_columns(params)).select(*DETAILS)


def rows_in_window(
    series: DataFrame, details: DataFrame, now: datetime, params: AnalysisParams = AnalysisParams()
) -> DataFrame:
    """The rows of each series inside its chosen window, without skipped series."""
    chosen = details.where(~F.col("skipped")).select(*SERIES, "expanded")
    cutoff = F.when(F.col("expanded"), moment(params.max_cutoff(now))).otherwise(moment(params.base_cutoff(now)))
    recent = series.where(F.col("hour") >= moment(min(params.max_cutoff(now), params.base_cutoff(now))))
    return recent.join(chosen, list(SERIES)).where(F.col("hour") >= cutoff).drop("expanded")


def source_samples(details: DataFrame, params: AnalysisParams = AnalysisParams()) -> DataFrame:
    """Largest sample count per source; expected sources without data count 0."""
    spark = details.sparkSession
    expected = spark.createDataFrame([(name,) for name in params.expected_sources], "source string")
    found = details.groupBy("source").agg(F.max("final_samples").alias("samples"))
    return expected.join(found, "source", "full_outer").select(
        "source", F.coalesce("samples", F.lit(0)).cast("bigint").alias("samples")
    )


def readiness(details: DataFrame, params: AnalysisParams = AnalysisParams()) -> DataFrame:
    """Per series, whether it is ready, was expanded (and then suffices) or is skipped."""
    enough = F.col("final_samples") >= params.min_samples
    trend_name = F.concat_ws("_", "source", "metric_name")
    return details.select(
        F.when(F.col("source") == "google_trends", trend_name).otherwise(F.col("source")).alias("name"),
        *DETAILS,
        F.when(F.col("skipped"), "skipped")
        .when(F.col("expanded") & enough, "expanded_ready")
        .when(F.col("expanded"), "expanded_short")
        .otherwise("ready")
        .alias("state"),
    )


def candle_coverage(
    candles: DataFrame,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    by: Sequence[str] = ("symbol", "interval"),
) -> DataFrame:
    """Stored against expected candles, where expected is span // interval + 1 (at least 1).

    Without a range the span is that of the data. Distinct stamps are counted in two rounds, so one
    dominant symbol is spread over its stamps.
    """
    widths = F.create_map(*[F.lit(part) for pair in INTERVAL_MILLIS.items() for part in pair])
    inside = candles
    if start is not None:
        inside = inside.where(F.col("timestamp") >= moment(start))
    if end is not None:
        inside = inside.where(F.col("timestamp") <= moment(end))
    counted = inside.groupBy(*by).agg(
        F.count_distinct("timestamp").alias("fetched"),
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
    )
    first = F.col("first_ts") if start is None else moment(start)
    last = F.col("last_ts") if end is None else moment(end)
    span = F.unix_millis(last) - F.unix_millis(first)
    width = F.try_element_at(widths, F.col("interval"))
    expected = F.when(width.isNotNull(), F.greatest(F.lit(1), F.floor(span / width) + 1)).cast("bigint")
    return counted.withColumn("expected", expected).select(
        *by,
        "fetched",
        "expected",
        F.least(F.lit(100.0), F.col("fetched") / F.col("expected") * 100.0).alias("percent"),
    )


def expected_candles(days: int) -> int:
    """Candles of all intervals over a number of days."""
    return sum(days * 86_400_000 // width for width in INTERVAL_MILLIS.values())
