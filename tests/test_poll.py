from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lagloom.plans.poll import (
    POLL_STATUS,
    RESPONSE_COLUMNS,
    PollKind,
    poll_ingest,
    poll_states,
    quote_responses,
    rate_responses,
    repair_kind,
    trend_responses,
)
from lagloom.schemas import MACRO_DATA, observation_lake
from lagloom.sources.lake import read_table, scan_dataset
from lagloom.streaming.ingest import landing_stream, read_log
from tests.conftest import tuples, utc

AT = utc("2026-06-09T06:00:00")
RATES = PollKind("rates", "fred", ("treasury_10y",), rate_responses(), required=True)
TRENDS = PollKind("trends", "google_trends", ("a", "b"), trend_responses, placeholders=True)
QUOTES = PollKind("quotes", "freight", ("close",), quote_responses(("X", "Y")))
POINTS = '{"points":[{"timestamp":"2026-06-09T03:00:00+00:00","value":"7"},{"timestamp":"2026-06-09T04:00:00+00:00","value":" 8.50 "},{"timestamp":"2026-06-09T05:00:00+00:00","value":"none"}]}'
CLOSE = '{"quotes":[{"date":"2026-06-07","close":"%s"},{"date":"2026-06-08","close":null}]}'


def responses(spark, *rows, run="r1", at=AT):
    return spark.createDataFrame([(run, at, *row) for row in rows], RESPONSE_COLUMNS)


def states(frame, kind):
    return tuples(poll_states(frame, kind), "metric_name", F.date_format("timestamp", "MM-dd HH").alias("t"), "value", "status")


@pytest.mark.parametrize(
    "payload,want",
    [
        ("observation_date,DGS10\r\n2026-06-04,4.1\r\n2026-06-05,4.25\r\n2026-06-08,.", ("treasury_10y", "06-05 00", "4.25", "ok")),
        ("DATE,OTHER,DGS10\n2026-06-05,9,4.30\n", ("treasury_10y", "06-05 00", "4.30", "ok")),
        ("DATE,OTHER\n2026-06-05,9", ("treasury_10y", None, None, "error")),
        ("observation_date,DGS10", ("treasury_10y", None, None, "error")),
        ("", ("treasury_10y", None, None, "error")),
        (None, ("treasury_10y", None, None, "error")),
    ],
)
def test_rates_take_the_last_valid_row_of_either_header(spark, payload, want):
    assert states(responses(spark, ("rates", "DGS10", payload)), RATES) == [want]


def test_a_missing_or_broken_series_is_a_skip(spark):
    frame = responses(spark, ("trends", "a", POINTS), ("trends", "b", '{"points": [{'), ("rates", "DGS10", "x"))
    assert states(frame, TRENDS) == [("a", "06-09 04", "8.50", "ok"), ("b", None, None, "skip")]
    assert states(responses(spark, ("rates", "DGS10", "x")), TRENDS) == [("a", None, None, "skip"), ("b", None, None, "skip")]
    assert states(responses(spark), TRENDS) == []


def test_the_first_candidate_with_a_value_counts(spark):
    both = responses(spark, ("quotes", "Y", CLOSE % 5), ("quotes", "X", CLOSE % 6), ("quotes", "Z", CLOSE % 7))
    assert states(both, QUOTES) == [("close", "06-07 00", "6", "ok")]
    fallback = responses(spark, ("quotes", "Y", CLOSE % 5), ("quotes", "X", CLOSE % "n/a"))
    assert states(fallback, QUOTES) == [("close", "06-07 00", "5", "ok")]


def test_kinds_are_isolated_and_a_lost_one_is_repaired(spark, root):
    landing, tables, log = f"{root}/landing", f"{root}/tables", f"{root}/log"

    def failing(_):
        raise ValueError("no such format")

    frame = responses(spark, ("rates", "DGS10", "DATE,DGS10\n2026-06-05,4.3"), ("trends", "a", POINTS), ("quotes", "X", CLOSE % 6))
    frame.coalesce(1).write.parquet(landing)
    kinds = [RATES, TRENDS, replace(QUOTES, parse=failing)]
    poll_ingest(landing_stream(spark, landing, RESPONSE_COLUMNS), kinds, tables, root, log, f"{root}/offsets", AT).awaitTermination()
    found = tuples(read_log(spark, log), "source", "status", "fetched", "upserted", "error")
    assert found == [
        ("quotes", "error", 3, 0, "ValueError: no such format"),
        ("rates", "ok", 1, 1, ""),
        ("trends", "partial", 1, 2, "without b"),
    ]
    stored = lambda: tuples(
        read_table(spark, f"{tables}/macro_data", MACRO_DATA), "source", "metric_name", F.date_format("timestamp", "MM-dd HH").alias("t"), F.col("value").cast("double").alias("v")
    )
    rows = [("fred", "treasury_10y", "06-05 00", 4.3), ("google_trends", "a", "06-09 04", 8.5), ("google_trends", "b", "06-09 00", None)]
    assert stored() == rows
    lake = scan_dataset(spark, root, observation_lake("google_trends", "macro"))
    assert tuples(lake, "metric_name", F.col("value").cast("double").alias("v")) == [("a", 8.5), ("b", None)]
    assert repair_kind(spark, QUOTES, tables, root, log, AT) == 1
    assert stored() == [rows[0], ("freight", "close", "06-07 00", 6.0), *rows[1:]]
    told = tuples(read_table(spark, f"{tables}/poll_status", POLL_STATUS), "kind", "metric_name", "status")
    assert told == [("quotes", "close", "ok"), ("rates", "treasury_10y", "ok"), ("trends", "a", "ok"), ("trends", "b", "skip")]
