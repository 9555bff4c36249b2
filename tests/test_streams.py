from datetime import timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from lagloom.operators.series import hourly_close
from lagloom.schemas import ALT_DATA, CANDLES, HOURLY_CLOSES, candle_lake, observation_lake
from lagloom.sinks.lake import archive
from lagloom.sinks.merge import upsert
from lagloom.sources.lake import read_table, scan_dataset
from lagloom.streaming.ingest import distinct_stream, dual_write, ingest_stream, landing_stream, read_log, repair_sink
from lagloom.streaming.series import hourly_close_stream
from tests.conftest import tuples, utc

SCHEMA = "symbol string, interval string, timestamp timestamp, close string, fetched_at timestamp"
START = utc("2026-06-09T00:00:00")


def land(spark, path, rows, run):
    spark.createDataFrame(
        [("BTCUSDT", "1m", START + timedelta(minutes=m), str(c), START + timedelta(hours=run)) for m, c in rows], SCHEMA
    ).coalesce(1).write.mode("append").parquet(path)


def closes_of(df):
    return tuples(df, F.date_format("timestamp", "HH:mm").alias("t"), F.col("close").cast("int").alias("c"))


def test_overlapping_polls_merge_and_reruns_add_nothing(spark, root):
    landing, table, offsets = f"{root}/landing", f"{root}/table", f"{root}/offsets"
    run = lambda: ingest_stream(landing_stream(spark, landing, SCHEMA, files_per_batch=1), table, CANDLES, offsets).awaitTermination()
    land(spark, landing, [(0, 100), (1, 101)], 1)
    run()
    land(spark, landing, [(1, 102), (2, 103)], 2)
    land(spark, landing, [(2, 104), (70, 5)], 3)
    run()
    want = [("00:00", 100), ("00:01", 102), ("00:02", 104), ("01:10", 5)]
    assert closes_of(read_table(spark, table, CANDLES)) == want
    run()
    assert closes_of(read_table(spark, table, CANDLES)) == want
    # The same files taken in from the start, as after a lost checkpoint.
    ingest_stream(landing_stream(spark, landing, SCHEMA), table, CANDLES, f"{root}/other").awaitTermination()
    assert closes_of(read_table(spark, table, CANDLES)) == want
    assert read_table(spark, table, CANDLES).schema["close"].dataType.simpleString() == "decimal(38,18)"


def test_hourly_closes_follow_late_and_revised_candles(spark, root):
    landing = f"{root}/landing"
    runs = [
        [(i * 7, 1000 + i) for i in range(20)],
        [(300, 5), (301, 6)],
        [(10, 77)],  # hours later: a revised candle
        [(200, 88), (59, 99)],  # and one of an hour that was empty, one at the end of a published hour
    ]
    for run, rows in enumerate(runs):
        land(spark, landing, rows, run)
        stream = landing_stream(spark, landing, SCHEMA, files_per_batch=1)
        hourly_close_stream(stream, f"{root}/candles", f"{root}/closes", f"{root}/offsets").awaitTermination()
        got = read_table(spark, f"{root}/closes", HOURLY_CLOSES).select("symbol", "hour", "close")
        want = hourly_close(spark.read.schema(SCHEMA).parquet(landing), ["symbol"])
        assert tuples(got) == tuples(want)
    assert got.count() == 5


def test_repeated_keys_are_dropped_however_late(spark, root):
    landing = f"{root}/landing"
    for rows in ([(0, 1), (1, 2)], [(600, 3)], [(1, 2), (2, 3)]):
        land(spark, landing, rows, 1)
        stream = landing_stream(spark, landing, SCHEMA, files_per_batch=1)
        distinct_stream(stream, f"{root}/table", CANDLES, f"{root}/offsets").awaitTermination()
    assert closes_of(read_table(spark, f"{root}/table", CANDLES)) == [("00:00", 1), ("00:01", 2), ("00:02", 3), ("10:00", 3)]


def flaky(write, failures):
    """Fails so many times, then writes."""
    left = [failures]

    def sink(batch):
        left[0] -= 1
        if left[0] >= 0:
            raise OSError("not reachable")
        write(batch)

    return sink


def test_neither_sink_loses_a_batch(spark, root):
    landing, spec = f"{root}/landing", candle_lake()
    land(spark, landing, [(0, 1), (1, 2)], 1)
    table = flaky(lambda b: upsert(spark, f"{root}/table", b, CANDLES), 1)
    write_lake = lambda b: archive(spark, b, root, spec, utc("2026-06-10T00:00:00"))
    lake = flaky(write_lake, 2)

    def run():
        sinks = {"table": table, "lake": lake}
        stream = landing_stream(spark, landing, SCHEMA)
        dual_write(stream, sinks, f"{root}/log", f"{root}/offsets", utc("2026-06-10T00:00:00")).awaitTermination()

    with pytest.raises(StreamingQueryException):
        run()
    assert read_table(spark, f"{root}/table", CANDLES).count() == 0
    run()  # the same batch again: the table takes it, the lake does not
    land(spark, landing, [(2, 3)], 2)
    run()
    assert read_table(spark, f"{root}/table", CANDLES).count() == 3
    assert scan_dataset(spark, root, spec).count() == 1
    columns = ("run_id", "source", "status", "fetched", "upserted")
    log = [("ingest-0", "lake", "error", 2, 0), ("ingest-0", "table", "ok", 2, 2), ("ingest-1", "lake", "ok", 1, 1), ("ingest-1", "table", "ok", 1, 1)]
    assert tuples(read_log(spark, f"{root}/log"), *columns) == log
    assert repair_sink(spark, "lake", write_lake, f"{root}/log", utc("2026-06-11T00:00:00")) == 1
    assert scan_dataset(spark, root, spec).count() == 3
    assert tuples(read_log(spark, f"{root}/log"), *columns) == sorted([*log, ("ingest-0", "lake", "repaired", 2, 2)])
    assert repair_sink(spark, "lake", write_lake, f"{root}/log", utc("2026-06-11T00:00:00")) == 0


def test_a_later_poll_replaces_higher_and_longer_numbers(spark, root):
    """Of one batch the last to arrive is kept, in the table and in the lake; without arrivals the larger number."""
    at, run = START, utc("2026-06-10T00:00:00")
    rows = [("BTCUSDT", "1m", at, "99", "100", 1), ("BTCUSDT", "1m", at, "95", "96", 2)]
    batch = spark.createDataFrame(rows, "symbol string, interval string, timestamp timestamp, low string, close string, arrival int")
    upsert(spark, f"{root}/table", batch.withColumn("fetched_at", F.lit(run)), CANDLES, ["arrival"])
    archive(spark, batch, root, candle_lake(), run, order=["arrival"])
    for found in (read_table(spark, f"{root}/table", CANDLES), scan_dataset(spark, root, candle_lake())):
        assert [(int(float(r.low)), int(float(r.close))) for r in found.collect()] == [(95, 96)]
    ties = spark.createDataFrame([("s", "m", at, v) for v in ("9.5", "10.1")], "source string, metric_name string, timestamp timestamp, value string")
    archive(spark, ties, root, observation_lake("s"), run)
    assert [r.value for r in scan_dataset(spark, root, observation_lake("s")).collect()] == ["10.1"]


def test_directories_do_not_follow_the_session_zone(spark, root):
    row = spark.createDataFrame([("s", "m", utc("2024-02-01T02:00:00"), "1")], "source string, metric_name string, timestamp timestamp, value string")
    for zone in ("America/New_York", "UTC"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            upsert(spark, f"{root}/table", row.withColumn("fetched_at", F.lit(START)), ALT_DATA)
            archive(spark, row, root, observation_lake("s"), START)
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r.period for r in read_table(spark, f"{root}/table", ALT_DATA).collect()] == ["2024-02"]
    assert spark.read.parquet(f"{root}/raw/alternative/s").select("year", "month", "day").distinct().count() == 1
