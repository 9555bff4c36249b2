"""Resampling, windows, lag pairing and verdicts on planted data, checked against plain Python."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from lagloom.operators.correlate import (
    evaluated,
    first_results,
    lag_join,
    lag_statistics,
    pair_statistics,
    run_summary,
    significant,
    window_details,
)
from lagloom.operators.dedupe import keep_last, newest, newest_per_group
from lagloom.operators.series import (
    adaptive_windows,
    candle_coverage,
    expected_candles,
    feature_series,
    hourly_close,
    readiness,
    rows_in_window,
    source_samples,
)
from lagloom.params import AnalysisParams
from lagloom.plans.jobs import lag_correlation, run_correlation
from lagloom.schemas import CORRELATION_RESULTS
from lagloom.sources.lake import read_table
from tests.conftest import plan_of, tuples, utc

PARAMS = AnalysisParams()
START = utc("2026-01-01T00:00:00")
NOW = utc("2026-06-09T00:00:00")


def candles(spark, rows, symbol="BTCUSDT", interval="15m"):
    data = [(symbol, interval, t if isinstance(t, str) else t.isoformat(), str(v)) for t, v in rows]
    return spark.createDataFrame(data, "symbol string, interval string, timestamp string, close string")


def observations(spark, rows):
    data = [(s, m, t if isinstance(t, str) else t.isoformat(), str(v)) for s, m, t, v in rows]
    return spark.createDataFrame(data, "source string, metric_name string, timestamp string, value string")


def hourly(spark, rows):
    return spark.createDataFrame(rows, "source string, metric_name string, hour timestamp, value double")


def closes(spark, rows):
    return spark.createDataFrame(rows, "hour timestamp, close double")


def hh(column="hour"):
    return F.date_format(column, "dd HH:mm").alias("hh")


def test_close_is_labelled_with_the_end_of_its_hour(spark):
    df = candles(
        spark,
        [
            ("2026-01-01T10:00:00+00:00", 1), ("2026-01-01T10:45:00+00:00", 2), ("2026-01-01T11:00:00+00:00", 3),
            ("2026-01-01T14:59:59+00:00", 4), ("2026-01-01T15:30:00+00:00", "NaN"), ("bad", 9), ("2026-01-01T16:00:00+00:00", "1d"),
        ],
    )
    for unique in (False, True):
        assert tuples(hourly_close(df, unique_stamps=unique), hh(), "close") == [
            ("01 11:00", 2.0), ("01 12:00", 3.0), ("01 15:00", 4.0),
        ]


def test_of_equal_stamps_the_later_fetched_wins_then_the_larger(spark):
    rows = [("10:15", 9.0, 1), ("10:15", 5.0, 2), ("10:15", 4.0, 2), ("10:10", 99.0, 3)]
    df = spark.createDataFrame(
        [(utc(f"2026-01-01T{t}:00"), c, utc(f"2026-02-0{f}T00:00:00")) for t, c, f in rows],
        "timestamp timestamp, close double, fetched_at timestamp",
    )
    assert tuples(hourly_close(df), "close") == [(5.0,)]


def test_two_symbols_stay_apart(spark):
    df = candles(spark, [("2026-01-01T10:00:00Z", 1)], "A").union(candles(spark, [("2026-01-01T10:30:00Z", 2)], "B"))
    assert tuples(hourly_close(df, ["symbol"]), "symbol", "close") == [("A", 1.0), ("B", 2.0)]


def test_features_are_floored_and_the_last_of_an_hour_is_kept(spark):
    df = observations(
        spark,
        [
            ("s", "m", "2026-01-01T10:05:00Z", 1), ("s", "m", "2026-01-01T10:55:00Z", 2), ("s", "m", "2026-01-01T11:00:00Z", "."),
            ("s", "m", "2026-01-01T12:00:00Z", 3), ("s", "n", "2026-01-01T10:00:00Z", 7), (None, "n", "2026-01-01T10:00:00Z", 8),
        ],
    )
    assert tuples(feature_series(df), "metric_name", hh(), "value") == [
        ("m", "01 10:00", 2.0), ("m", "01 12:00", 3.0), ("n", "01 10:00", 7.0),
    ]


def test_lag_pairs_the_feature_with_a_later_close(spark):
    f = hourly(spark, [("s", "m", START, 1.0), ("s", "m", START + timedelta(hours=1), 2.0)])
    c = closes(spark, [(START + timedelta(hours=h), float(h)) for h in range(3)])
    assert tuples(lag_join(f, c, [0, 1, 4]), "lag_hours", "value", "close") == [
        (0, 1.0, 0.0), (0, 2.0, 1.0), (1, 1.0, 1.0), (1, 2.0, 2.0),
    ]


def test_a_series_leading_by_one_hour_is_found(spark):
    rng = random.Random(42)
    values = [rng.uniform(0, 100) for _ in range(50)]
    c = candles(spark, [(START + timedelta(hours=i, minutes=45), v) for i, v in enumerate(values)])
    o = observations(spark, [("test_source", "signal", START + timedelta(hours=i), v) for i, v in enumerate(values)])
    run = lag_correlation(c, o, NOW, PARAMS)
    found = {r.lag_hours: r for r in run.results.collect()}
    assert found[1].pearson_r > 0.99 and found[1].sample_size == 50 and found[1].p_value < 1e-50
    assert found[1].dataset_a == "alt_data.test_source.signal" and found[1].dataset_b == "btc_ohlcv.BTCUSDT.15m.close_1h"
    assert str(found[1].date_calculated) == "2026-06-09"
    grid = {r.lag_hours: r for r in run.statistics.collect()}
    assert [grid[lag].sample_size for lag in (0, 1, 4, 6)] == [49, 50, 47, 45]
    for lag in (0, 1, 4, 6):
        # The close of candle j is labelled j + 1, so lag L pairs value i with value i + L - 1.
        pairs = [(values[i], values[i + lag - 1]) for i in range(50) if 0 <= i + lag - 1 < 50]
        assert grid[lag].pearson_r == pytest.approx(np.corrcoef(*zip(*pairs))[0, 1], abs=1e-12)


def test_a_stored_run_gives_the_same_tables(spark, tmp_path):
    rng = random.Random(4)
    values = [rng.uniform(0, 100) for _ in range(60)]
    c = candles(spark, [(START + timedelta(hours=i, minutes=45), v) for i, v in enumerate(values)])
    o = observations(spark, [("fred", "signal", START + timedelta(hours=i), v) for i, v in enumerate(values)])
    path = f"file://{tmp_path}/results"
    lazy = lag_correlation(c, o, NOW, PARAMS)
    for _ in range(2):
        run = run_correlation(spark, c, o, NOW, path, PARAMS, unique_stamps=True)
    assert run.summary.drop("upserted").collect() == lazy.summary.drop("upserted").collect() and run.closes.count() == 60
    assert tuples(run.summary, "upserted") == [(1,)] and tuples(lazy.summary, "upserted") == [(0,)]
    stored = read_table(spark, path, CORRELATION_RESULTS)
    assert tuples(stored, "dataset_a", "lag_hours", "sample_size") == [("macro_data.fred.signal", 1, 60)]
    assert tuples(run.results, "pearson_r", "p_value") == tuples(lazy.results, "pearson_r", "p_value")


def test_short_sources_make_the_run_insufficient(spark):
    o = observations(spark, [("fear_greed", "index", START + timedelta(days=i), i) for i in range(3)])
    c = candles(spark, [(START + timedelta(hours=i), 60_000 + i) for i in range(10)])
    run = lag_correlation(c, o, NOW, PARAMS)
    assert dict(run.samples.collect()) == {"fear_greed": 3, "dxy": 0, "polymarket": 0, "fred": 0, "google_trends": 0}
    summary = run.summary.first()
    assert summary.status == "insufficient_data" and summary.evaluated == 4 and summary.insufficient == 4
    assert summary.insufficient_sources == ["dxy", "fear_greed", "fred", "google_trends"]
    assert summary.skipped_sources == ["polymarket"]
    assert run.results.count() == 0
    assert run.details.first().expanded


def test_sparse_series_expand_and_waiting_ones_are_skipped(spark):
    weekly = [("google_trends", "bitcoin", NOW - timedelta(days=7 * i), float(i)) for i in range(52)]
    young = [("polymarket", "total_volume_24h", NOW - timedelta(days=i), float(i)) for i in range(3)]
    series = hourly(spark, weekly + young)
    details = {r.source: r for r in adaptive_windows(series, NOW, PARAMS).collect()}
    trends, market = details["google_trends"], details["polymarket"]
    assert trends.base_samples == 18 and trends.final_samples == 52 and trends.expanded and trends.window_days == 365
    assert market.final_samples == 3 and market.skipped and not market.expanded and market.window_days == 120
    kept = rows_in_window(series, adaptive_windows(series, NOW, PARAMS), NOW, PARAMS)
    assert tuples(kept.groupBy("source").count()) == [("google_trends", 52)]
    states = dict(readiness(adaptive_windows(series, NOW, PARAMS), PARAMS).select("name", "state").collect())
    assert states == {"google_trends_bitcoin": "expanded_ready", "polymarket": "skipped"}


@pytest.mark.parametrize("rows, skipped", [(29, True), (30, False)])
def test_waiting_source_is_ready_at_the_minimum(spark, rows, skipped):
    series = hourly(spark, [("polymarket", "v", NOW - timedelta(hours=i), float(i)) for i in range(rows)])
    assert adaptive_windows(series, NOW, PARAMS).first().skipped is skipped


def test_cutoffs_are_inclusive_and_there_is_no_upper_bound(spark):
    edge = NOW - timedelta(days=120)
    series = hourly(
        spark, [("s", "m", edge, 1.0), ("s", "m", edge - timedelta(hours=1), 1.0), ("s", "m", NOW + timedelta(days=9), 1.0)]
    )
    row = adaptive_windows(series, NOW, PARAMS).first()
    assert row.base_samples == 2 and row.final_samples == 3


def test_a_shorter_lookback_narrows_the_base_window_only(spark):
    assert AnalysisParams(lookback_days=365).base_window_days == 120
    assert AnalysisParams(lookback_days=30).base_window_days == 30


def test_extra_sources_are_counted_and_the_largest_series_stands_for_its_source(spark):
    details = spark.createDataFrame(
        [("other", 7), ("dxy", 3), ("dxy", 40)], "source string, final_samples bigint"
    )
    got = dict(source_samples(details, PARAMS).collect())
    assert got["other"] == 7 and got["dxy"] == 40 and got["fred"] == 0


def grid(spark, values, prices, params=PARAMS, source="s"):
    f = hourly(spark, [(source, "m", START + timedelta(hours=i), float(v)) for i, v in enumerate(values)])
    c = closes(spark, [(START + timedelta(hours=i), float(v)) for i, v in enumerate(prices)])
    return lag_statistics(f, c, utc("2026-02-01T00:00:00"), params)


def test_series_without_a_single_pair_still_counts(spark):
    stats = grid(spark, range(40), [], PARAMS)
    assert tuples(stats, "lag_hours", "sample_size", "outcome") == [(lag, 0, "insufficient") for lag in (0, 1, 4, 6)]
    summary = run_summary(stats, PARAMS).first()
    assert summary.evaluated == 4 and summary.insufficient == 4 and summary.feature_series == 1


@pytest.mark.parametrize("n, outcome", [(29, "insufficient"), (30, "significant")])
def test_thirty_pairs_are_enough(spark, n, outcome):
    row = grid(spark, range(n), range(n)).where("lag_hours = 0").first()
    assert (row.sample_size, row.outcome) == (n, outcome)


def test_constant_sides_are_insufficient_and_do_not_raise(spark):
    flat = [5.0] * 40
    assert {r.outcome for r in grid(spark, flat, range(40)).collect()} == {"insufficient"}
    assert {r.outcome for r in grid(spark, range(40), flat).collect()} == {"insufficient"}


def test_infinities_are_neither_insufficient_nor_significant(spark):
    row = grid(spark, [float("inf"), *range(40)], range(41)).where("lag_hours = 0").first()
    assert row.outcome == "undefined"


def test_limits_are_strict(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=200)
    y = 0.32 * x + rng.normal(size=200)
    row = grid(spark, x, y).where("lag_hours = 0").first()
    at_r = AnalysisParams(min_abs_r=abs(row.pearson_r))
    assert grid(spark, x, y, at_r).where("lag_hours = 0").first().outcome == "weak"
    below = AnalysisParams(min_abs_r=abs(row.pearson_r) - 1e-9)
    assert grid(spark, x, y, below).where("lag_hours = 0").first().outcome == "significant"
    at_p = AnalysisParams(min_abs_r=0.0, max_p=row.p_value)
    assert grid(spark, x, y, at_p).where("lag_hours = 0").first().outcome == "weak"


def test_opposite_movement_and_perfect_fit(spark):
    stats = grid(spark, range(40), [-v for v in range(40)])
    row = stats.where("lag_hours = 0").first()
    assert row.pearson_r == pytest.approx(-1.0) and row.outcome == "significant" and row.p_value < 1e-30
    results = significant(stats, NOW, PARAMS)
    assert tuples(first_results(results, 2), "lag_hours") == [(0,), (1,)]


def test_skipped_series_are_not_evaluated(spark):
    stats = grid(spark, range(10), range(10), source="polymarket")
    assert evaluated(stats).count() == 0 and window_details(stats).first().skipped
    summary = run_summary(stats, AnalysisParams(expected_sources=("polymarket",))).first()
    assert summary.status == "ok" and summary.evaluated == 0 and summary.skipped_sources == ["polymarket"]


def test_grid_agrees_with_brute_force_on_gappy_random_series(spark):
    rng = random.Random(9)
    now = utc("2026-06-01T00:00:00")
    features, prices = {}, {}
    for name, density in (("dense", 0.9), ("sparse", 0.02), ("rare", 0.004)):
        features[name] = {now - timedelta(hours=h): rng.gauss(0, 1) for h in range(9000) if rng.random() < density}
    for h in range(-10, 9000):
        if rng.random() < 0.8:
            t = now - timedelta(hours=h)
            lead = features["dense"].get(t - timedelta(hours=4), 0.0)
            prices[t] = lead * 0.8 + rng.gauss(0, 1)
    stats = lag_statistics(
        hourly(spark, [("src", name, t, v) for name, points in features.items() for t, v in points.items()]),
        closes(spark, list(prices.items())), now, PARAMS,
    )
    got = {(r.metric_name, r.lag_hours): r for r in stats.collect()}
    for name, points in features.items():
        base = [t for t in points if t >= now - timedelta(days=120)]
        used = base if len(base) >= 30 else [t for t in points if t >= now - timedelta(days=365)]
        for lag in PARAMS.lags:
            pairs = [(points[t], prices[t + timedelta(hours=lag)]) for t in used if t + timedelta(hours=lag) in prices]
            row = got[name, lag]
            assert (row.base_samples, row.final_samples, row.sample_size) == (len(base), len(used), len(pairs))
            if len(pairs) >= 30:
                assert row.pearson_r == pytest.approx(np.corrcoef(*zip(*pairs))[0, 1], abs=1e-12)
            else:
                assert row.pearson_r is None and row.outcome == "insufficient"
    assert got["dense", 4].outcome == "significant"


def test_named_pairs_only(spark):
    rows = [(name, START + timedelta(hours=h), float(h * k % 17)) for name, k in (("a", 3), ("b", 5), ("c", 7)) for h in range(60)]
    series = spark.createDataFrame(rows, "name string, hour timestamp, value double")
    got = {(r.series_a, r.series_b, r.lag_hours): r for r in pair_statistics(series, [("a", "b"), ("c", "a")], PARAMS).collect()}
    assert len(got) == 8
    for (a, b, lag), row in got.items():
        k = {"a": 3, "b": 5, "c": 7}
        pairs = [(h * k[a] % 17, (h + lag) * k[b] % 17) for h in range(60 - lag)]
        assert row.sample_size == len(pairs)
        assert row.pearson_r == pytest.approx(np.corrcoef(*zip(*pairs))[0, 1], abs=1e-12)


def test_keep_last_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(rng.choice("abc") if rng.random() < 0.9 else None, rng.randint(0, 5), rng.randint(0, 3), rng.random()) for _ in range(500)]
    best = {}
    for row in rows:
        if row[0] not in best or row[1:] > best[row[0]][1:]:
            best[row[0]] = row
    df = spark.createDataFrame(rows, "k string, a int, b int, v double").repartition(7)
    got = {row.k: tuple(row) for row in keep_last(df, ["k"], ["a", "b"]).collect()}
    assert got == best


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("t"), F.rand(1).alias("v")
    )
    last = keep_last(rows, ["k"], ["t"])
    assert "Window" not in plan_of(last)
    assert "partial_max" in plan_of(last)
    assert last.where("k = 0").first().t == 29_997


def test_newest_rows(spark):
    df = spark.createDataFrame([(i % 2, i // 4, i) for i in range(12)], "g int, timestamp int, id int")
    assert tuples(newest(df, 3, ties=["id"]), "id") == [(8,), (9,), (10,)]
    top = newest_per_group(df, 2, ["g"], ties=["id"])
    assert tuples(top, "g", "id") == [(0, 8), (0, 10), (1, 9), (1, 11)]
    assert plan_of(top).count("WindowGroupLimit") == 2


def test_coverage(spark):
    rows = [("A", "15m", START + timedelta(minutes=15 * i)) for i in (0, 1, 1, 3)] + [("A", "1w", START)]
    df = spark.createDataFrame(rows, "symbol string, interval string, timestamp timestamp")
    got = {r.interval: r for r in candle_coverage(df).collect()}
    assert (got["15m"].fetched, got["15m"].expected, got["15m"].percent) == (3, 4, 75.0)
    assert got["1w"].expected is None
    wide = {r.interval: r for r in candle_coverage(df, START, START + timedelta(days=1)).collect()}
    assert wide["15m"].expected == 97
    assert expected_candles(730) == 730 * 24 * (60 + 12 + 4)


def test_correlation_plan_prunes_and_has_no_cartesian_product(spark, tmp_path):
    path = f"file://{tmp_path}/c"
    candles(spark, [(START + timedelta(hours=i), i) for i in range(5)]).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp")
    ).withColumn("open", F.lit("1")).write.parquet(path)
    o = observations(spark, [("dxy", "close", START, 1)])
    plan = plan_of(lag_correlation(spark.read.parquet(path), o, NOW, PARAMS).statistics, "formatted")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Window" not in plan
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(timestamp" in pushed and "EqualTo(symbol,BTCUSDT)" in pushed
    assert "ReadSchema: struct<symbol:string,interval:string,timestamp:timestamp,close:string>" in plan
