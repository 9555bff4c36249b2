"""Selections over long observation tables (source, metric_name, timestamp, value)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from lagloom.functions.coerce import has_values, moment
from lagloom.operators.dedupe import keep_last

SERIES = ["source", "metric_name"]


def latest_valid_observation(observations: DataFrame) -> DataFrame:
    """The newest row with a value, per series."""
    return keep_last(has_values(observations, "timestamp", "value"), SERIES, ["timestamp"])


def missing_placeholders(
    observations: DataFrame, expected: Sequence[tuple[str, str]], now: datetime
) -> DataFrame:
    """For every expected series without a valid value, a row with NULL at midnight of the day."""
    spark = observations.sparkSession
    wanted = spark.createDataFrame(list(expected), "source string, metric_name string")
    sources = sorted({source for source, _ in expected})
    present = has_values(observations.where(F.col("source").isin(sources)), "value").select(*SERIES).distinct()
    return wanted.join(present, SERIES, "left_anti").select(
        *SERIES,
        F.date_trunc("day", moment(now)).alias("timestamp"),
        F.lit(None).cast("string").alias("value"),
        F.lit("skip").alias("status"),
    )


def with_placeholders(observations: DataFrame, expected: Sequence[tuple[str, str]], now: datetime) -> DataFrame:
    """The observations plus a placeholder for each expected series that has none."""
    added = missing_placeholders(observations, expected, now).drop("status")
    kind = observations.schema["value"].dataType
    return observations.unionByName(added.withColumn("value", F.col("value").cast(kind)), allowMissingColumns=True)


def first_available(
    candidates: DataFrame, by: Sequence[str] = ("source", "metric_name"), priority: str = "priority"
) -> DataFrame:
    """Rows of the first candidate with any valid value, per group; later candidates are fallbacks.

    The winner is found by an aggregate and joined back, so no group is gathered in one task.
    """
    valid = has_values(candidates, "value")
    winner = valid.groupBy(*by).agg(F.min(priority).alias(priority))
    return valid.join(winner, [*by, priority])


def features_union(alt: DataFrame, macro: DataFrame) -> DataFrame:
    """Both observation tables as one, tagged with their table; macro rows carry no label."""
    columns = ["dataset", *SERIES, "timestamp", "value", "label"]
    tagged_alt = alt.withColumn("dataset", F.lit("alt_data"))
    tagged_macro = macro.drop("label").withColumn("dataset", F.lit("macro_data"))
    union = tagged_alt.unionByName(tagged_macro, allowMissingColumns=True)
    if "label" not in union.columns:
        union = union.withColumn("label", F.lit(None).cast("string"))
    return union.select(*columns)


def with_fallback(primary: DataFrame, fallback: DataFrame, names: tuple[str, str] = ("lake", "table")) -> DataFrame:
    """The primary rows, or the fallback's if there is no primary row at all.

    Looks for one row of the primary, so that the source not taken is never scanned.
    """
    chosen, name = (fallback, names[1]) if primary.isEmpty() else (primary, names[0])
    return chosen.withColumn("input_source", F.lit(name))
