"""Counts, run summaries and the daily report."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window, functions as F

from lagloom.functions.coerce import has_values, matching, moment, number_column, shift_hours
from lagloom.operators.dedupe import keep_last
from lagloom.params import HYPOTHESIS_STATES, INTERVAL_MILLIS, NAMED_SERIES

SERIES = ["source", "metric_name"]


def sample_counts(
    observations: DataFrame, named: Sequence[tuple[str, str, str, str]] = NAMED_SERIES
) -> DataFrame:
    """Exact row count of each named series, zeros kept: (dataset, name, samples)."""
    spark = observations.sparkSession
    wanted = spark.createDataFrame(list(named), "dataset string, name string, source string, metric_name string")
    sources = sorted({row[2] for row in named})
    counted = (
        observations.where(F.col("source").isin(sources)).groupBy(*SERIES).agg(F.count("*").alias("samples"))
    )
    return wanted.join(counted, SERIES, "left").select(
        "dataset", "name", F.coalesce("samples", F.lit(0)).cast("bigint").alias("samples")
    )


def exact_count(table: DataFrame, **filters) -> DataFrame:
    """One row with the number of rows that equal all filters."""
    return matching(table, **filters).agg(F.count("*").alias("rows"))


def catalog_counts(catalog: DataFrame, dataset: str = "btc_ohlcv") -> DataFrame:
    """Catalogued rows per interval."""
    return (
        catalog.where(F.col("dataset") == dataset)
        .groupBy("interval")
        .agg(F.sum(F.coalesce("row_count", F.lit(0))).alias("rows"))
    )


def count_with_fallback(
    catalog: DataFrame,
    candles: DataFrame,
    symbol: str,
    dataset: str = "btc_ohlcv",
    intervals: Sequence[str] = tuple(INTERVAL_MILLIS),
) -> DataFrame:
    """Rows per interval: the catalog's figure if it is above zero, else the table's own count."""
    spark = candles.sparkSession
    wanted = spark.createDataFrame([(name,) for name in intervals], "interval string")
    catalogued = catalog_counts(catalog, dataset).withColumnRenamed("rows", "in_catalog")
    stored = (
        candles.where((F.col("symbol") == symbol) & F.col("interval").isin(list(intervals)))
        .groupBy("interval")
        .agg(F.count("*").alias("in_table"))
    )
    joined = wanted.join(catalogued, "interval", "left").join(stored, "interval", "left")
    return joined.select(
        "interval",
        F.when(F.col("in_catalog") > 0, F.col("in_catalog"))
        .otherwise(F.coalesce("in_table", F.lit(0)))
        .cast("bigint")
        .alias("rows"),
    )


def run_totals(run_log: DataFrame) -> DataFrame:
    """Fetched and upserted over the parts of a run that went well; runs that stored nothing are left out."""
    fine = F.coalesce("status", F.lit("ok")) == "ok"
    totals = (
        run_log.where(fine)
        .groupBy("run_id")
        .agg(
            F.coalesce(F.sum("fetched"), F.lit(0)).alias("fetched"),
            F.coalesce(F.sum("upserted"), F.lit(0)).alias("upserted"),
            F.max("finished_at").alias("finished_at"),
        )
    )
    return totals.where(F.col("upserted") > 0)


def summary_with_total(results: DataFrame, *measures: str) -> DataFrame:
    """Sums per source and a TOTAL row."""
    sums = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in measures]
    rolled = results.rollup("source").agg(*sums, F.grouping("source").alias("_total"))
    return rolled.select(
        F.when(F.col("_total") == 1, "TOTAL").otherwise(F.col("source")).alias("source"), *measures
    )


def status_rollup(results: DataFrame, by: Sequence[str]) -> DataFrame:
    """ok if all parts are ok, skip if all are skipped, else partial."""
    status = F.coalesce("status", F.lit(""))
    return results.groupBy(*by).agg(
        F.when(F.bool_and(status == "ok"), "ok")
        .when(F.bool_and(status == "skip"), "skip")
        .otherwise("partial")
        .alias("status")
    )


def hypothesis_counts(hypotheses: DataFrame, states: Sequence[str] = HYPOTHESIS_STATES) -> DataFrame:
    """Hypotheses per state, zeros kept; a missing state is the first one."""
    spark = hypotheses.sparkSession
    wanted = spark.createDataFrame([(name,) for name in states], "status string")
    counted = (
        hypotheses.select(F.coalesce("status", F.lit(states[0])).alias("status"))
        .groupBy("status")
        .agg(F.count("*").alias("hypotheses"))
    )
    return wanted.join(counted, "status", "left").select(
        "status", F.coalesce("hypotheses", F.lit(0)).cast("bigint").alias("hypotheses")
    )


def daily_values(observations: DataFrame) -> DataFrame:
    """Last value and label per series and calendar day."""
    label = F.col("label") if "label" in observations.columns else F.lit(None).cast("string")
    rows = has_values(
        observations.select(
            *SERIES, "timestamp", number_column(observations, "value").alias("value"), label.alias("label")
        ),
        "timestamp",
        "value",
    )
    by_day = rows.withColumn("day", F.date_trunc("day", "timestamp"))
    return keep_last(by_day, [*SERIES, "day"], ["timestamp"]).drop("timestamp")


def latest_with_change(observations: DataFrame) -> DataFrame:
    """Newest daily value per series and its change in percent against the day before it in the data.

    Days are reduced first and the rank filter keeps two of them per series and task, so the ranking
    moves two rows per series whatever its length.
    """
    order = Window.partitionBy(*SERIES).orderBy(F.col("day").desc())
    two = daily_values(observations).withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= 2)
    at = lambda rank, name: F.max(F.when(F.col("_rank") == rank, F.col(name)))
    newest = two.groupBy(*SERIES).agg(
        at(1, "day").alias("day"),
        at(1, "value").alias("value"),
        at(1, "label").alias("label"),
        at(2, "value").alias("previous"),
    )
    return newest.select(
        *SERIES, "day", "value", "label", (F.try_divide("value", "previous") * 100.0 - 100.0).alias("change_pct")
    )


def close_with_change(closes: DataFrame, hours: int = 24) -> DataFrame:
    """Newest hourly close and its change in percent against the close labelled exactly ``hours`` earlier."""
    newest = closes.orderBy(F.col("hour").desc()).limit(1)
    earlier = closes.select(shift_hours(F.col("hour"), hours).alias("hour"), F.col("close").alias("earlier"))
    return newest.join(earlier, "hour", "left").select(
        "hour", "close", (F.try_divide("close", "earlier") * 100.0 - 100.0).alias("change_pct")
    )


def daily_report(
    closes: DataFrame, observations: DataFrame, results: DataFrame, hypotheses: DataFrame, now: datetime
) -> DataFrame:
    """The daily report as rows (section, name, value, change_pct, label)."""
    none = F.lit(None).cast("double")
    text = F.lit(None).cast("string")
    price = close_with_change(closes).select(
        F.lit("price").alias("section"),
        F.lit("close").alias("name"),
        F.col("close").alias("value"),
        "change_pct",
        text.alias("label"),
    )
    metrics = latest_with_change(observations).select(
        F.lit("metric").alias("section"), F.concat_ws(".", *SERIES).alias("name"), "value", "change_pct", "label"
    )
    pairs = results.where(F.col("date_calculated") == moment(now).cast("date")).select(
        F.lit("correlation").alias("section"),
        F.concat(F.col("dataset_a"), F.lit(" lag "), F.col("lag_hours").cast("string")).alias("name"),
        F.col("pearson_r").alias("value"),
        none.alias("change_pct"),
        text.alias("label"),
    )
    states = hypothesis_counts(hypotheses).select(
        F.lit("hypothesis").alias("section"),
        F.col("status").alias("name"),
        F.col("hypotheses").cast("double").alias("value"),
        none.alias("change_pct"),
        text.alias("label"),
    )
    return price.unionByName(metrics).unionByName(pairs).unionByName(states)
