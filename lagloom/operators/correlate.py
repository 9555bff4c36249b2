"""Lagged correlation of feature series with hourly closes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from lagloom.functions.coerce import moment, shift_hours
from lagloom.functions.stats import has_spread, pearson_p, pearson_r
from lagloom.functions.text import dataset_name
from lagloom.operators.series import DETAILS, SERIES, window_columns
from lagloom.params import AnalysisParams


def lag_join(features: DataFrame, closes: DataFrame, lags: Iterable[int]) -> DataFrame:
    """Pairs of a feature at T and the close labelled T + lag, for every lag.

    The closes, at most one row per hour, are copied once per lag and moved back; the features are not
    multiplied. No broadcast hint: the adaptive plan knows the real size of the closes by then.
    """
    moved = closes.select(
        F.explode(
            F.array(*[F.struct(F.lit(lag).alias("lag_hours"), shift_hours(F.col("hour"), -lag).alias("hour")) for lag in lags])
        ).alias("at"),
        "close",
    ).select("at.*", "close")
    return features.join(moved, "hour").select(*SERIES, "hour", "lag_hours", "value", "close")


def _closes_by_lag(closes: DataFrame, lags: Sequence[int], by: Sequence[str] = ()) -> DataFrame:
    """One row per feature hour (and series) with an array of (lag, close or NULL)."""
    moved = closes.select(
        *by,
        F.explode(
            F.array(*[F.struct(F.lit(lag).alias("lag_hours"), shift_hours(F.col("hour"), -lag).alias("hour")) for lag in lags])
        ).alias("at"),
        "close",
    ).select(*by, "at.*", "close")
    wide = moved.groupBy(*by, "hour").agg(
        *[F.max(F.when(F.col("lag_hours") == lag, F.col("close"))).alias(f"close_{lag}") for lag in lags]
    )
    return wide.select(*by, "hour", *[f"close_{lag}" for lag in lags])


def _by_lag(joined: DataFrame, lags: Sequence[int], *columns: str) -> DataFrame:
    """Unfold the lag columns after an outer join, keeping rows without a close."""
    options = F.array(
        *[F.struct(F.lit(lag).alias("lag_hours"), F.col(f"close_{lag}").alias("close")) for lag in lags]
    )
    return joined.select(*columns, F.explode(options).alias("at")).select(*columns, "at.*")


def _moments(mask: Column, suffix: str) -> list[Column]:
    """Pair statistics of the rows inside a window; all of them combine before the shuffle."""
    paired = mask & F.col("close").isNotNull()
    x = F.when(paired, F.col("value"))
    y = F.when(paired, F.col("close"))
    return [
        F.count(x).alias(f"n_{suffix}"),
        (has_spread(x) & has_spread(y)).alias(f"spread_{suffix}"),
        pearson_r(x, y).alias(f"r_{suffix}"),
    ]


def lag_statistics(
    series: DataFrame, closes: DataFrame, now: datetime, params: AnalysisParams = AnalysisParams()
) -> DataFrame:
    """The full series × lag grid with window details, pair count, r and p.

    One pass: the window decision needs counts that would otherwise cost a second read of the series, so
    both candidate windows are aggregated side by side and the decision picks one afterwards. The outer
    join keeps series and lags without a single pair, which count as evaluated and insufficient.
    Skipped series stay in the grid, marked.
    """
    lags = list(params.lags)
    base, longest = moment(params.base_cutoff(now)), moment(params.max_cutoff(now))
    # Every series stays, even one whose rows are all too old to be used: it is still evaluated.
    joined = series.join(_closes_by_lag(closes, lags), "hour", "left")
    options = _by_lag(joined, lags, *SERIES, "hour", "value")
    in_base, in_longest = F.col("hour") >= base, F.col("hour") >= longest
    stats = options.groupBy(*SERIES, "lag_hours").agg(
        F.count_if(in_base).alias("base_samples"),
        F.count_if(in_longest).alias("max_samples"),
        *_moments(in_base, "base"),
        *_moments(in_longest, "max"),
    )
    decided = stats.withColumns(window_columns(params))
    pick = lambda name: F.when(F.col("expanded"), F.col(f"{name}_max")).otherwise(F.col(f"{name}_base"))
    picked = decided.select(
        *DETAILS,
        "lag_hours",
        pick("n").alias("sample_size"),
        pick("r").alias("r"),
        F.coalesce(pick("spread"), F.lit(False)).alias("spread"),
    )
    return _with_outcome(picked, params)


def _with_outcome(stats: DataFrame, params: AnalysisParams) -> DataFrame:
    """Guards, p-value and verdict from ``sample_size``, ``spread`` and ``r``."""
    usable = (F.col("sample_size") >= params.min_samples) & F.col("spread")
    guarded = stats.withColumn("usable", usable).withColumn("pearson_r", F.when(F.col("usable"), F.col("r")))
    tested = guarded.withColumn("p_value", pearson_p(F.col("pearson_r"), F.col("sample_size")))
    # A NaN compares above every number here; a NaN or missing r has no p-value, which takes it out.
    strong = (F.abs("pearson_r") > params.min_abs_r) & (F.col("p_value") < params.max_p)
    return tested.withColumn(
        "outcome",
        F.when(~F.col("usable"), "insufficient")
        .when(F.col("p_value").isNull(), "undefined")
        .when(strong, "significant")
        .otherwise("weak"),
    ).drop("r", "spread", "usable")


def evaluated(statistics: DataFrame) -> DataFrame:
    """The grid without skipped series."""
    return statistics.where(~F.col("skipped"))


def window_details(statistics: DataFrame) -> DataFrame:
    """The window decision per series, read back from the grid."""
    return statistics.groupBy(*SERIES).agg(*[F.first(name).alias(name) for name in DETAILS[2:]])


def significant(statistics: DataFrame, now: datetime, params: AnalysisParams = AnalysisParams()) -> DataFrame:
    """Result rows: |r| and p strictly beyond their limits."""
    return (
        evaluated(statistics)
        .where(F.col("outcome") == "significant")
        .select(
            dataset_name(F.col("source"), F.col("metric_name"), params.macro_sources).alias("dataset_a"),
            F.lit(params.target_name).alias("dataset_b"),
            "lag_hours",
            "pearson_r",
            "p_value",
            "sample_size",
            moment(now).cast("date").alias("date_calculated"),
        )
    )


def first_results(results: DataFrame, n: int = 10) -> DataFrame:
    """The first results in report order."""
    return results.orderBy("dataset_a", "lag_hours").limit(n)


def run_summary(statistics: DataFrame, params: AnalysisParams = AnalysisParams()) -> DataFrame:
    """One row on the run: status, counts, samples per source, and the sources that are short or still waiting.

    A waiting source that is short does not make the run insufficient; any other short source does, also
    an expected one without a row. The grid is read once, reduced per source, and then to one row; the
    lists hold source names, which do not grow with the rows.
    """
    spark = statistics.sparkSession
    used = ~F.col("skipped")
    per_source = statistics.groupBy("source").agg(
        F.max("final_samples").alias("samples"),
        F.count_if(used).alias("evaluated"),
        F.count_if(used & (F.col("outcome") == "insufficient")).alias("insufficient"),
        F.count_if(used & (F.col("outcome") == "significant")).alias("significant"),
        F.count_distinct(F.when(used, F.col("metric_name"))).alias("feature_series"),
    )
    named = sorted({*params.expected_sources, *params.skip_until_ready})
    known = spark.createDataFrame([(name,) for name in named], "source string")
    every = known.join(per_source, "source", "full_outer")
    waits = F.col("source").isin(list(params.skip_until_ready))
    samples = F.coalesce("samples", F.lit(0))
    short = samples < params.min_samples
    listed = lambda test: F.array_sort(F.collect_set(F.when(test, F.col("source"))))
    total = lambda name: F.coalesce(F.sum(name), F.lit(0)).alias(name)
    return every.agg(
        F.when(F.bool_or(short & ~waits), "insufficient_data").otherwise("ok").alias("status"),
        *[total(name) for name in ("evaluated", "insufficient", "significant", "feature_series")],
        listed(short & ~waits).alias("insufficient_sources"),
        listed(short & waits).alias("skipped_sources"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", samples.cast("bigint"))))).alias("source_samples"),
    ).select(
        "*",
        F.lit(params.base_window_days).alias("lookback_days"),
        F.lit(params.max_window_days).alias("max_lookback_days"),
        F.lit(params.interval).alias("price_interval"),
    )


def pair_statistics(
    series: DataFrame, pairs: Sequence[tuple[str, str]], params: AnalysisParams = AnalysisParams()
) -> DataFrame:
    """Lagged correlation of named pairs of series: the first at T with the second at T + lag.

    ``series`` has (name, hour, value) with one row per name and hour. The pairs are an explicit list;
    rows meet by name and hour only, so nothing is paired that was not asked for.
    """
    lags = list(params.lags)
    wanted = series.sparkSession.createDataFrame(list(pairs), "series_a string, series_b string")
    partners = _closes_by_lag(
        series.select(F.col("name").alias("series_b"), "hour", F.col("value").alias("close")), lags, ["series_b"]
    )
    first = series.select(F.col("name").alias("series_a"), "hour", "value").join(wanted, "series_a")
    joined = first.join(partners, ["series_b", "hour"], "left")
    options = _by_lag(joined, lags, "series_a", "series_b", "value")
    stats = options.groupBy("series_a", "series_b", "lag_hours").agg(*_moments(F.lit(True), "max"))
    picked = stats.select(
        "series_a",
        "series_b",
        "lag_hours",
        F.col("n_max").alias("sample_size"),
        F.col("r_max").alias("r"),
        F.coalesce("spread_max", F.lit(False)).alias("spread"),
    )
    return _with_outcome(picked, params)
