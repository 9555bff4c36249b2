import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lagloom.sources.observations import (
    features_union,
    first_available,
    latest_valid_observation,
    missing_placeholders,
    with_fallback,
    with_placeholders,
)
from lagloom.sources.payloads import (
    aggregate_market_volume,
    normalize_daily_close,
    normalize_klines,
    normalize_rate_csv,
    normalize_sentiment,
    normalize_wide_trends,
    payload_status,
    read_csv_text,
    read_payloads,
    stamped,
    typed_rows,
)
from tests.conftest import tuples, utc


def raw(spark, *payloads):
    return spark.createDataFrame([(p if isinstance(p, str) else json.dumps(p),) for p in payloads], "payload string")


def at(column="timestamp"):
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss").alias("at")


def klines(spark, *payloads):
    return raw(spark, *payloads).withColumns({"symbol": F.lit("BTCUSDT"), "interval": F.lit("1m")})


def test_klines_become_rows_with_their_text(spark):
    good = [[1780999200000, "100.10", "101", "99", "100.5000", "12.3", 1], [1780999260000, "1", "2", "3", "4", "5", 2]]
    rows = normalize_klines(klines(spark, good))
    assert tuples(rows, at(), "open", "close", "volume") == [
        ("2026-06-09T10:00:00", "100.10", "100.5000", "12.3"),
        ("2026-06-09T10:01:00", "1", "4", "5"),
    ]
    assert typed_rows(rows).schema["close"].dataType.simpleString() == "decimal(38,18)"


def test_one_bad_candle_rejects_its_response_only(spark):
    good = [[1780999200000, "1", "2", "3", "4", "5"]]
    bad = [[1780999260000, "1", "2", "3", "4", "5"], [1780999320000, "1", "2", "3", "x", "5"]]
    frame = klines(spark, good, bad, [[1]], "{not json", [])
    assert normalize_klines(frame).count() == 1
    assert sorted(r.status for r in payload_status(frame, "klines").collect()) == ["error", "error", "error", "ok", "ok"]


def test_sentiment_history(spark):
    payload = {
        "data": [
            {"value": "72", "value_classification": "Greed", "timestamp": "1780876800"},
            {"value": "10", "timestamp": "1780790400"},
        ]
    }
    assert tuples(normalize_sentiment(raw(spark, payload)), "source", "metric_name", at(), "value", "label") == [
        ("fear_greed", "index", "2026-06-07T00:00:00", "10", ""),
        ("fear_greed", "index", "2026-06-08T00:00:00", "72", "Greed"),
    ]
    assert tuples(normalize_sentiment(raw(spark, payload), latest_only=True), "value", "label") == [("72", "Greed")]


def test_sentiment_without_data_is_an_error(spark):
    frame = raw(spark, {"data": []}, {"other": 1}, {"data": [{"value": "x", "timestamp": "1"}]})
    assert normalize_sentiment(frame).count() == 0
    assert {r.status for r in payload_status(frame, "sentiment").collect()} == {"error"}


def test_payload_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"data": [{"value": "1", "timestamp": "86400"}]}, indent=1))
    (tmp_path / "b.json").write_text(json.dumps({"data": [{"value": "2", "timestamp": "0"}]}))
    frame = read_payloads(spark, f"file://{tmp_path}", whole_files=True)
    assert tuples(normalize_sentiment(frame), "value") == [("1",), ("2",)]


def test_daily_close_at_midnight_without_invalid_quotes(spark):
    quotes = spark.createDataFrame(
        [("2026-06-05 13:30:00", "98.25"), ("2026-06-08", "98.75"), ("2026-06-09", "n/a"), ("never", "1")],
        "Date string, Close string",
    )
    rows = normalize_daily_close(quotes, "dxy", include_label=True)
    assert tuples(rows, "source", "metric_name", at(), "value", "label") == [
        ("dxy", "close", "2026-06-05T00:00:00", "98.25", None),
        ("dxy", "close", "2026-06-08T00:00:00", "98.75", None),
    ]
    assert tuples(latest_valid_observation(rows), "value") == [("98.75",)]


@pytest.mark.parametrize("header", ["observation_date", "DATE"])
def test_rate_csv(spark, tmp_path, header):
    (tmp_path / "r.csv").write_text(f"{header},DGS10\n2026-06-04,4.55\n2026-06-05,.\n2026-06-08,4.50\n")
    rows = normalize_rate_csv(read_csv_text(spark, f"file://{tmp_path}/r.csv"))
    assert tuples(rows, "source", "metric_name", at(), "value") == [
        ("fred", "treasury_10y", "2026-06-04T00:00:00", "4.55"),
        ("fred", "treasury_10y", "2026-06-08T00:00:00", "4.5"),
    ]


def test_rate_csv_with_other_columns_is_refused(spark):
    with pytest.raises(ValueError):
        normalize_rate_csv(spark.createDataFrame([("a", "b")], "day string, DGS10 string"))


def test_wide_trends(spark):
    wide = spark.createDataFrame(
        [("2026-06-09T00:00:00Z", 70, None, False), ("2026-06-09T01:00:00Z", 72, 5, True)],
        "timestamp string, bitcoin int, crypto int, isPartial boolean",
    )
    rows = normalize_wide_trends(wide, ["bitcoin", "crypto"])
    assert tuples(rows, "metric_name", at(), "value") == [
        ("bitcoin", "2026-06-09T00:00:00", "70"),
        ("bitcoin", "2026-06-09T01:00:00", "72"),
        ("crypto", "2026-06-09T01:00:00", "5"),
    ]
    with pytest.raises(ValueError):
        normalize_wide_trends(wide, ["solana"])


def test_market_volume_is_exact_and_skips_what_is_no_number(spark):
    def page(*volumes, **flags):
        return {"markets": [{"volume24hr": v, "active": True, **flags} for v in volumes]}

    frame = spark.createDataFrame(
        [
            (json.dumps(page(10.5, "2.25")), "r1", utc("2026-06-09T07:00:00")),
            (json.dumps(page(None, "invalid", "")), "r1", utc("2026-06-09T07:00:05")),
            (json.dumps(page("1000", closed=True)), "r1", utc("2026-06-09T07:00:06")),
            (json.dumps({"markets": [{"volume24hr": "9"}, {"volume24hr": "9", "active": False}]}), "r1", utc("2026-06-09T07:00:07")),
            (json.dumps(page("0.1", "0.2")), "r0", utc("2026-06-09T06:30:00")),
            (json.dumps(page("0.1", "0.2")), "r2", utc("2026-06-09T13:00:00")),
            (json.dumps({"markets": []}), "r3", utc("2026-06-09T19:00:00")),
        ],
        "payload string, run_id string, fetched_at timestamp",
    )
    assert tuples(aggregate_market_volume(frame), at(), "value") == [
        ("2026-06-09T06:00:00", Decimal("12.75")),
        ("2026-06-09T12:00:00", Decimal("0.3")),
        ("2026-06-09T18:00:00", Decimal("0")),
    ]


def observations(spark, *rows):
    return spark.createDataFrame(
        [(s, m, utc(t), v) for s, m, t, v in rows], "source string, metric_name string, timestamp timestamp, value double"
    )


def test_placeholders_for_expected_series(spark):
    obs = observations(
        spark, ("google_trends", "bitcoin", "2026-06-09T00:00:00", 72.0), ("google_trends", "crypto", "2026-06-09T00:00:00", None)
    )
    expected = [("google_trends", "bitcoin"), ("google_trends", "crypto"), ("bdi", "close")]
    added = missing_placeholders(obs, expected, utc("2026-06-09T10:30:00"))
    assert tuples(added, "source", "metric_name", at(), "value", "status") == [
        ("bdi", "close", "2026-06-09T00:00:00", None, "skip"),
        ("google_trends", "crypto", "2026-06-09T00:00:00", None, "skip"),
    ]
    assert with_placeholders(obs, expected, utc("2026-06-09T10:30:00")).count() == 4


def test_first_candidate_with_data_wins_as_a_whole(spark):
    rows = [("bdi", "close", 2, 5.0), ("bdi", "close", 2, 6.0), ("bdi", "close", 1, None), ("dxy", "close", 1, 1.0), ("dxy", "close", 2, 2.0)]
    frame = spark.createDataFrame(rows, "source string, metric_name string, priority int, value double")
    assert tuples(first_available(frame), "source", "priority", "value") == [("bdi", 2, 5.0), ("bdi", 2, 6.0), ("dxy", 1, 1.0)]


def test_union_and_fallback(spark):
    alt = observations(spark, ("dxy", "close", "2026-06-09T00:00:00", 1.0)).withColumn("label", F.lit("x"))
    macro = observations(spark, ("fred", "t", "2026-06-09T00:00:00", 2.0)).withColumn("label", F.lit("dropped"))
    both = features_union(alt, macro)
    assert tuples(both, "dataset", "source", "label") == [("alt_data", "dxy", "x"), ("macro_data", "fred", None)]
    assert tuples(features_union(macro.drop("label"), macro), "label") == [(None,), (None,)]
    assert tuples(with_fallback(alt.where("value > 5"), alt), "input_source") == [("table",)]
    assert tuples(with_fallback(alt, macro), "input_source", "source") == [("lake", "dxy")]


def test_stamp_is_a_parameter(spark):
    assert tuples(stamped(spark.range(1), utc("2026-06-09T00:00:01")), at("fetched_at")) == [("2026-06-09T00:00:01",)]
