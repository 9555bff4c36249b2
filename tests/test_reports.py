from datetime import timedelta

import pytest

from lagloom.operators.alerts import daily_moves, price_spikes, sentiment_shifts, stale_series
from lagloom.operators.reports import (
    close_with_change,
    daily_report,
    exact_count,
    hypothesis_counts,
    latest_with_change,
    run_totals,
    sample_counts,
    status_rollup,
    summary_with_total,
)
from lagloom.schemas import CORRELATION_RESULTS, RUN_LOG_COLUMNS
from tests.conftest import tuples, utc

NOW = utc("2026-06-09T10:00:00")


def observations(spark, *rows):
    return spark.createDataFrame(rows, "source string, metric_name string, timestamp timestamp, value double, label string")


def closes(spark, *rows):
    return spark.createDataFrame([(NOW + timedelta(hours=h), float(c)) for h, c in rows], "hour timestamp, close double")


def test_run_totals(spark):
    rows = [("r", "1m", "ok", 60, 60), ("r", "5m", "ok", 60, 60), ("r", "15m", None, 60, 60), ("e", "1m", "ok", 60, 0), ("e", "5m", "error", 0, 9)]
    log = spark.createDataFrame([(*row, "", NOW) for row in rows], RUN_LOG_COLUMNS)
    assert tuples(run_totals(log), "run_id", "fetched", "upserted") == [("r", 180, 180)]


def test_summary_has_a_total(spark):
    df = spark.createDataFrame([("a", 1, 2), ("b", 3, None), ("a", 5, 6)], "source string, fetched bigint, archived bigint")
    assert tuples(summary_with_total(df, "fetched", "archived")) == [("TOTAL", 9, 8), ("a", 6, 8), ("b", 3, 0)]


def test_status_rollup(spark):
    rows = [("x", "ok"), ("x", "ok"), ("y", "skip"), ("z", "ok"), ("z", "skip"), ("w", "error"), ("v", None)]
    df = spark.createDataFrame(rows, "run string, status string")
    assert dict(status_rollup(df, ["run"]).collect()) == {"x": "ok", "y": "skip", "z": "partial", "w": "partial", "v": "partial"}


def test_counts_keep_zeros(spark):
    df = observations(spark, ("dxy", "close", NOW, 1.0, None), ("dxy", "close", NOW, 2.0, None), ("dxy", "open", NOW, 2.0, None))
    got = {r.name: r.samples for r in sample_counts(df).collect()}
    assert got["dxy"] == 2 and got["bdi"] == 0 and len(got) == 7
    assert exact_count(df, source="dxy", metric_name="open").first().rows == 1
    assert exact_count(df, source="none").first().rows == 0


def test_stale_means_more_than_the_limit(spark):
    df = observations(
        spark, ("a", "m", NOW - timedelta(hours=2), 1.0, None), ("b", "m", NOW - timedelta(hours=2, seconds=1), 1.0, None),
        ("b", "m", NOW - timedelta(days=3), 1.0, None),
    )
    assert tuples(stale_series(df, NOW), "source") == [("b",)]


def test_price_spikes_need_the_hour_before(spark):
    got = price_spikes(closes(spark, (0, 100), (1, 103.0), (2, 107), (4, 50), (5, 48)))
    assert [(r.hour - NOW.replace(tzinfo=None)).total_seconds() / 3600 for r in got.orderBy("hour").collect()] == [2, 5]
    assert price_spikes(closes(spark, (0, 0), (1, 5))).count() == 0


def test_sentiment_shift_compares_with_the_row_before(spark):
    labels = ["Fear", "Fear", "Greed", None, None, "Greed"]
    df = observations(spark, *[("fear_greed", "index", NOW + timedelta(hours=6 * i), 1.0, v) for i, v in enumerate(labels)])
    assert tuples(sentiment_shifts(df), "previous_label", "label") == [(None, "Greed"), ("Fear", "Greed"), ("Greed", None)]


def test_daily_move_uses_the_previous_day_with_data(spark):
    days = [(0, 100.0), (0.2, 100.0), (3, 103.0), (4, 105.0), (5, 102.0)]
    df = observations(spark, *[("bdi", "close", NOW.replace(hour=0) + timedelta(days=d), v, None) for d, v in days])
    assert [round(r.change_pct, 2) for r in daily_moves(df).orderBy("day").collect()] == [3.0, -2.86]


def test_latest_with_change_and_price(spark):
    df = observations(
        spark, ("dxy", "close", NOW, 103.0, None), ("dxy", "close", NOW - timedelta(days=3), 100.0, None),
        ("fear_greed", "index", NOW, 72.0, "Greed"), ("zero", "m", NOW, 1.0, None), ("zero", "m", NOW - timedelta(days=1), 0.0, None),
    )
    got = {r.source: (r.value, r.label, r.change_pct) for r in latest_with_change(df).collect()}
    assert got["dxy"] == (103.0, None, pytest.approx(3.0)) and got["fear_greed"] == (72.0, "Greed", None) and got["zero"][2] is None
    assert close_with_change(closes(spark, (-24, 100), (-1, 5), (0, 101))).first().change_pct == pytest.approx(1.0)
    assert close_with_change(closes(spark, (-23, 100), (0, 101))).first().change_pct is None


def test_daily_report(spark):
    results = spark.createDataFrame(
        [("alt_data.dxy.close", "b", 0, -0.71, 0.002, 40, NOW.date()), ("old", "b", 0, 0.5, 0.0, 40, (NOW - timedelta(days=1)).date())],
        CORRELATION_RESULTS.columns,
    )
    states = spark.createDataFrame([("VALID",), ("TESTING",), ("TESTING",), (None,)], "status string")
    assert dict(hypothesis_counts(states).collect()) == {"DRAFT": 1, "TESTING": 2, "VALID": 1, "GUGUR": 0, "PAUSE": 0}
    report = daily_report(
        closes(spark, (-24, 100), (0, 101)), observations(spark, ("dxy", "close", NOW, 103.0, None)), results, states, NOW
    )
    rows = {(r.section, r.name): r for r in report.collect()}
    assert rows["price", "close"].value == 101 and rows["metric", "dxy.close"].value == 103
    assert rows["correlation", "alt_data.dxy.close lag 0"].value == -0.71 and ("correlation", "old lag 0") not in rows
    assert rows["hypothesis", "TESTING"].value == 2
