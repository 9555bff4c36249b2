"""Alert rules: stale data, price spikes, changed sentiment, daily moves."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window, functions as F

from lagloom.functions.coerce import floor_hour, has_values, moment, shift_hours
from lagloom.operators.dedupe import keep_last
from lagloom.operators.reports import daily_values

SERIES = ["source", "metric_name"]


def stale_series(observations: DataFrame, now: datetime, hours: float = 2.0) -> DataFrame:
    """Series whose newest row is more than ``hours`` old."""
    newest = observations.groupBy(*SERIES).agg(F.max("timestamp").alias("last_ts"))
    age = (F.unix_micros(moment(now)) - F.unix_micros("last_ts")) / 3.6e9
    return newest.withColumn("age_hours", age).where(F.col("age_hours") > hours)


def price_spikes(closes: DataFrame, limit_pct: float = 3.0, by: Sequence[str] = ()) -> DataFrame:
    """Hours whose close moved by more than the limit against the close exactly one hour earlier.

    An equi-join on the previous hour: a gap gives no row, and no series is gathered in one task.
    """
    earlier = closes.select(*by, shift_hours(F.col("hour"), 1).alias("hour"), F.col("close").alias("previous"))
    moved = closes.join(earlier, [*by, "hour"]).withColumn(
        "change_pct", F.try_divide("close", "previous") * 100.0 - 100.0
    )
    return moved.where(F.abs("change_pct") > limit_pct)


def sentiment_shifts(observations: DataFrame) -> DataFrame:
    """Hours at which the label of a series differs from the one before it.

    The rows are first reduced to the last label per series and hour, which bounds what one series can
    bring to the ordered step by the hours it spans.
    """
    rows = has_values(observations, "timestamp").withColumn("hour", floor_hour(F.col("timestamp")))
    last = keep_last(rows.select(*SERIES, "hour", "timestamp", "label"), [*SERIES, "hour"], ["timestamp"])
    order = Window.partitionBy(*SERIES).orderBy("hour")
    compared = last.select(
        *SERIES,
        "hour",
        F.lag("label").over(order).alias("previous_label"),
        "label",
        F.row_number().over(order).alias("_nth"),
    )
    changed = (F.col("_nth") > 1) & ~F.col("label").eqNullSafe(F.col("previous_label"))
    return compared.where(changed).drop("_nth")


def daily_moves(observations: DataFrame, limit_pct: float = 2.0) -> DataFrame:
    """Days on which a series moved by more than the limit against its previous day with data."""
    order = Window.partitionBy(*SERIES).orderBy("day")
    compared = daily_values(observations).select(
        *SERIES, "day", "value", F.lag("value").over(order).alias("previous")
    )
    moved = compared.withColumn("change_pct", F.try_divide("value", "previous") * 100.0 - 100.0)
    return moved.where(F.abs("change_pct") > limit_pct)
