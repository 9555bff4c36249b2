"""Lagged correlation: pairs, grid, verdicts, summary, named pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import query, rounded
from catalogue.tables import (
    CLOSES_SQL,
    EVENT_PARAMS,
    EVENTS_NOW,
    FEATURES_SQL,
    PLANTED_SQL,
    PRICE,
    candles,
    events,
    features,
    last_per_hour_sql,
    observations,
    p_value_sql,
    planted,
)
from lagloom.functions.coerce import since
from lagloom.operators.correlate import evaluated, first_results, lag_join, pair_statistics
from lagloom.operators.series import feature_series, hourly_close
from lagloom.plans.jobs import correlate_stored, lag_correlation, save_results
from lagloom.schemas import ALT_DATA, CANDLES, CORRELATION_RESULTS, MACRO_DATA, candle_lake
from lagloom.session import work_path
from lagloom.sinks.lake import archive
from lagloom.sinks.merge import upsert
from lagloom.sources.lake import read_closes_since, read_table

WITH_INPUTS = f"""
WITH closes AS ({CLOSES_SQL}),
series AS ({last_per_hour_sql(FEATURES_SQL)}),
planted_series AS ({last_per_hour_sql(PLANTED_SQL)}),
every_series AS (SELECT * FROM series UNION ALL SELECT * FROM planted_series)"""


def grid_sql(series: str) -> str:
    """Statistics of every series and lag over the 120 days before 2024-01-31, which hold all events."""
    return f"""
stats AS (
  SELECT s.source, s.metric_name, l.lag AS lag_hours, count(c.close) AS sample_size,
         corr(s.value, c.close) AS r,
         coalesce(count(DISTINCT CASE WHEN c.close IS NOT NULL THEN s.value END) >= 2
                  AND count(DISTINCT c.close) >= 2, FALSE) AS spread
  FROM {series} s CROSS JOIN (SELECT unnest([0, 1, 4, 6]) AS lag) l
  LEFT JOIN closes c ON c.hour = s.hour + l.lag * INTERVAL 1 HOUR
  GROUP BY ALL),
samples AS (SELECT source, metric_name, count(*) AS n FROM {series} GROUP BY ALL),
tested AS (
  SELECT stats.*, samples.n AS base_samples,
         CASE WHEN sample_size >= 30 AND spread THEN r END AS pearson_r,
         CASE WHEN sample_size >= 30 AND spread THEN {p_value_sql("r", "sample_size")} END AS p_value
  FROM stats JOIN samples USING (source, metric_name)),
judged AS (
  SELECT *, CASE WHEN pearson_r IS NULL THEN 'insufficient'
                 WHEN abs(pearson_r) > 0.3 AND p_value < 0.05 THEN 'significant' ELSE 'weak' END AS outcome
  FROM tested)"""


def planted_run(spark, sf_dir):
    every = features(spark, sf_dir).unionByName(planted(spark, sf_dir))
    return lag_correlation(candles(spark, sf_dir), every, EVENTS_NOW, EVENT_PARAMS)


@query(
    "hourly_close",
    """
SELECT event_type AS symbol, date_trunc('hour', ts) + INTERVAL 1 HOUR AS hour, value AS close FROM events
QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY ts DESC, value DESC) = 1""",
)
def _hourly_close(spark, sf_dir):
    return hourly_close(candles(spark, sf_dir), ["symbol"])


@query(
    "feature_series",
    last_per_hour_sql("SELECT 'events' AS source, event_type AS metric_name, ts, value FROM events"),
)
def _feature_series(spark, sf_dir):
    return feature_series(observations(spark, sf_dir))


@query(
    "lag_pairs",
    f"""{WITH_INPUTS}
SELECT s.source, s.metric_name, s.hour, l.lag AS lag_hours, s.value, c.close
FROM series s CROSS JOIN (SELECT unnest([0, 1, 4, 6]) AS lag) l
JOIN closes c ON c.hour = s.hour + l.lag * INTERVAL 1 HOUR""",
)
def _lag_pairs(spark, sf_dir):
    closes = hourly_close(candles(spark, sf_dir).where(F.col("symbol") == PRICE))
    return lag_join(feature_series(features(spark, sf_dir)), closes, EVENT_PARAMS.lags)


@query(
    "lag_correlation",
    f"""{WITH_INPUTS}, {grid_sql("every_series")}
SELECT source, metric_name, lag_hours, base_samples, sample_size, round(pearson_r, 6) AS pearson_r,
       round(p_value, 6) AS p_value, outcome FROM judged""",
)
def _lag_correlation(spark, sf_dir):
    return evaluated(planted_run(spark, sf_dir).statistics).select(
        "source",
        "metric_name",
        "lag_hours",
        "base_samples",
        "sample_size",
        rounded(F.col("pearson_r")).alias("pearson_r"),
        rounded(F.col("p_value")).alias("p_value"),
        "outcome",
    )


@query(
    "significant_correlations",
    f"""{WITH_INPUTS}, {grid_sql("every_series")}
SELECT CASE WHEN source = 'fred' THEN 'macro_data' ELSE 'alt_data' END || '.' || source || '.' || metric_name AS dataset_a,
       'events.purchase.1m.close_1h' AS dataset_b, lag_hours, round(pearson_r, 6) AS pearson_r,
       round(p_value, 6) AS p_value, sample_size, '2024-01-31' AS date_calculated
FROM judged WHERE outcome = 'significant'""",
)
def _significant(spark, sf_dir):
    return planted_run(spark, sf_dir).results.withColumns(
        {
            "pearson_r": rounded(F.col("pearson_r")),
            "p_value": rounded(F.col("p_value")),
            "date_calculated": F.col("date_calculated").cast("string"),
        }
    )


@query(
    "save_results",
    f"""{WITH_INPUTS}, {grid_sql("every_series")}
SELECT CASE WHEN source = 'fred' THEN 'macro_data' ELSE 'alt_data' END || '.' || source || '.' || metric_name AS dataset_a,
       lag_hours, round(pearson_r, 6) AS pearson_r, sample_size, '2024-01' AS period
FROM judged WHERE outcome = 'significant'""",
)
def _save_results(spark, sf_dir):
    """Saved twice: the second save of a day replaces the first."""
    path = work_path(spark, "correlation_results")
    for _ in range(2):
        save_results(spark, path, planted_run(spark, sf_dir).results)
    rows = read_table(spark, path, CORRELATION_RESULTS)
    return rows.select("dataset_a", "lag_hours", rounded(F.col("pearson_r")).alias("pearson_r"), "sample_size", "period")


@query(
    "first_results",
    f"""{WITH_INPUTS}, {grid_sql("every_series")}
SELECT CASE WHEN source = 'fred' THEN 'macro_data' ELSE 'alt_data' END || '.' || source || '.' || metric_name AS dataset_a,
       lag_hours, round(pearson_r, 6) AS pearson_r
FROM judged WHERE outcome = 'significant' ORDER BY dataset_a, lag_hours LIMIT 2""",
)
def _first_results(spark, sf_dir):
    return first_results(planted_run(spark, sf_dir).results, 2).select(
        "dataset_a", "lag_hours", rounded(F.col("pearson_r")).alias("pearson_r")
    )


@query(
    "correlation_summary",
    f"""{WITH_INPUTS}, {grid_sql("every_series")},
per_source AS (SELECT e.source, coalesce(max(base_samples), 0) AS n
  FROM (SELECT unnest(['events', 'dxy', 'polymarket', 'fred', 'google_trends']) AS source) e LEFT JOIN judged USING (source)
  GROUP BY 1)
SELECT CASE WHEN (SELECT count(*) FROM per_source WHERE n < 30 AND source <> 'polymarket') > 0
            THEN 'insufficient_data' ELSE 'ok' END AS status,
       (SELECT count(*) FROM judged) AS evaluated,
       (SELECT count(*) FROM judged WHERE outcome = 'insufficient') AS insufficient,
       (SELECT count(*) FROM judged WHERE outcome = 'significant') AS significant,
       (SELECT count(*) FROM samples) AS feature_series,
       (SELECT string_agg(source, ',' ORDER BY source) FROM per_source WHERE n < 30 AND source <> 'polymarket')
         AS insufficient_sources,
       'polymarket' AS skipped_sources,
       (SELECT string_agg(source || '=' || n, ',' ORDER BY source) FROM per_source) AS source_samples,
       120 AS lookback_days, 365 AS max_lookback_days, '1m' AS price_interval, 'given' AS input_source,
       (SELECT count(*) FROM closes) AS hourly_price_samples, 0::BIGINT AS upserted""",
)
def _summary(spark, sf_dir):
    samples = F.transform(F.map_entries("source_samples"), lambda e: F.concat(e.key, F.lit("="), e.value))
    return planted_run(spark, sf_dir).summary.withColumns(
        {name: F.array_join(name, ",") for name in ("insufficient_sources", "skipped_sources")}
        | {"source_samples": F.array_join(samples, ",")}
    )


def _stored_run(spark, sf_dir, in_lake):
    """Features in the tables, prices in the lake or in the candle table; summary of the job over them."""
    base = work_path(spark, "store")
    every = features(spark, sf_dir).unionByName(planted(spark, sf_dir))
    every = every.withColumns({"fetched_at": F.col("timestamp"), "label": F.lit(None).cast("string")})
    macro = F.col("source").isin(list(EVENT_PARAMS.macro_sources))
    upsert(spark, f"{base}/tables/alt_data", every.where(~macro), ALT_DATA)
    upsert(spark, f"{base}/tables/macro_data", every.where(macro), MACRO_DATA)
    lake, prices = candle_lake("events"), candles(spark, sf_dir)
    if in_lake:
        archive(spark, prices, base, lake, EVENTS_NOW, "day", f"{base}/catalog")
    else:
        upsert(spark, f"{base}/tables/candles", prices.withColumn("fetched_at", F.col("timestamp")), CANDLES)
    with correlate_stored(spark, base, lake, f"{base}/tables", EVENTS_NOW, f"{base}/results", EVENT_PARAMS) as run:
        found = run.summary.select("input_source", "hourly_price_samples", "evaluated", "significant", "upserted")
        row = found.collect()  # one row; the grid goes with the run
    stored = read_table(spark, f"{base}/results", CORRELATION_RESULTS).agg(F.count("*").alias("stored"))
    return stored.select(*[F.lit(value).alias(name) for name, value in row[0].asDict().items()], "stored")


STORED_SQL = """{inputs}, {grid}
SELECT '{source}' AS input_source, (SELECT count(*) FROM closes) AS hourly_price_samples, count(*) AS evaluated,
  count(*) FILTER (outcome = 'significant') AS significant, count(*) FILTER (outcome = 'significant') AS upserted,
  count(*) FILTER (outcome = 'significant') AS stored FROM judged"""


@query("stored_correlation", STORED_SQL.format(inputs=WITH_INPUTS, grid=grid_sql("every_series"), source="lake"))
def _stored_correlation(spark, sf_dir):
    return _stored_run(spark, sf_dir, in_lake=True)


@query("stored_correlation_fallback", STORED_SQL.format(inputs=WITH_INPUTS, grid=grid_sql("every_series"), source="table"))
def _stored_correlation_fallback(spark, sf_dir):
    return _stored_run(spark, sf_dir, in_lake=False)


@query(
    "named_pairs_correlation",
    f"""
WITH s AS ({last_per_hour_sql("SELECT 'events' AS source, event_type AS metric_name, ts, value FROM events")}),
stats AS (
  SELECT a.metric_name AS series_a, b0.metric_name AS series_b, l.lag AS lag_hours, count(b.value) AS sample_size,
         corr(a.value, b.value) AS r
  FROM s a
  JOIN (VALUES ('click', 'purchase'), ('view', 'purchase'), ('signup', 'click')) b0 (first_name, metric_name)
    ON a.metric_name = b0.first_name
  CROSS JOIN (SELECT unnest([0, 1, 4, 6]) AS lag) l
  LEFT JOIN s b ON b.metric_name = b0.metric_name AND b.hour = a.hour + l.lag * INTERVAL 1 HOUR
  GROUP BY ALL)
SELECT series_a, series_b, lag_hours, sample_size,
       round(CASE WHEN sample_size >= 30 THEN r END, 6) AS pearson_r,
       round(CASE WHEN sample_size >= 30 THEN {p_value_sql("r", "sample_size")} END, 6) AS p_value
FROM stats""",
)
def _named_pairs(spark, sf_dir):
    pairs = [("click", "purchase"), ("view", "purchase"), ("signup", "click")]
    series = feature_series(observations(spark, sf_dir)).select(F.col("metric_name").alias("name"), "hour", "value")
    return pair_statistics(series, pairs, EVENT_PARAMS).select(
        "series_a",
        "series_b",
        "lag_hours",
        "sample_size",
        rounded(F.col("pearson_r")).alias("pearson_r"),
        rounded(F.col("p_value")).alias("p_value"),
    )


@query(
    "closes_since",
    """SELECT event_type AS symbol, '1m' AS "interval", ts AS "timestamp", value AS close FROM events
WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-10'""",
)
def _closes_since(spark, sf_dir):
    return read_closes_since(candles(spark, sf_dir), "2024-01-10", "1m", PRICE)


@query("since_filter", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-15 12:00:00'")
def _since(spark, sf_dir):
    return since(events(spark, sf_dir).select("event_id", "ts"), "2024-01-15 12:00:00", "ts")
