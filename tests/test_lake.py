"""Lake and tables: merges, replays, granularities, catalog, loading, checking."""

from datetime import datetime
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lagloom.plans.jobs import BackfillSource, backfill, load_tables, sample_report, save_results
from lagloom.schemas import (
    ALT_DATA,
    CANDLES,
    CORRELATION_RESULTS,
    LAKE_CATALOG,
    MACRO_DATA,
    candle_lake,
    observation_lake,
)
from lagloom.session import remove_path, shared_dir, work_path
from lagloom.sinks import merge
from lagloom.sinks.lake import (
    LOADS,
    LoadSpec,
    archive,
    build_catalog,
    lake_rows,
    lake_to_table,
    load_rows,
    partition_key,
    validate_and_fill,
    verify_write,
)
from lagloom.sinks.merge import Touched, merge_into, publish, upsert
from lagloom.sources.foreign import read_time_ranges
from lagloom.sources.lake import (
    catalog_objects_since,
    partitions_since,
    read_closes_since,
    read_existing,
    read_features_since,
    read_table,
    scan_catalogued,
    scan_dataset,
    scan_features_since,
    scan_files,
    scan_lake,
    stored_rows,
)
from lagloom.sources.observations import with_placeholders
from tests.conftest import plan_of, tuples, utc

RUN1, RUN2 = utc("2026-06-10T00:00:00"), utc("2026-06-11T00:00:00")


def candles(spark, *rows, symbol="BTCUSDT", interval="1m"):
    return spark.createDataFrame(
        [(symbol, interval, t, c) for t, c in rows], "symbol string, interval string, timestamp string, close string"
    )


def observations(spark, *rows, kind="string"):
    return spark.createDataFrame(rows, f"source string, metric_name string, timestamp string, value {kind}")


def hm(column="timestamp"):
    return F.date_format(column, "HH:mm").alias("hm")


BATCH1 = (("2026-06-09T10:00:00+00:00", "100"), ("2026-06-09T10:01:00+00:00", "101"))
BATCH2 = (("2026-06-09T10:01:00+00:00", "102"), ("2026-06-09T10:02:00+00:00", "103"))


def test_overlapping_batches_merge_and_a_replay_changes_nothing(spark, root):
    spec = candle_lake()
    first = archive(spark, candles(spark, *BATCH1), root, spec, RUN1, catalog_path=f"{root}/catalog")
    second = archive(spark, candles(spark, *BATCH2), root, spec, RUN2, catalog_path=f"{root}/catalog")
    assert (first.rows, second.rows, second.files) == (2, 3, 1)
    want = [("10:00", "100"), ("10:01", "102"), ("10:02", "103")]
    assert tuples(scan_files(spark, root, spec), hm(), "close") == want
    assert archive(spark, candles(spark, *BATCH2), root, spec, RUN2).rows == 3
    assert tuples(scan_files(spark, root, spec), hm(), "close") == want
    catalog = read_table(spark, f"{root}/catalog", LAKE_CATALOG).collect()
    assert [(c.object_key, c.row_count, c.symbol, c.interval) for c in catalog] == [
        ("raw/market/btc_ohlcv/symbol=BTCUSDT/interval=1m/year=2026/month=06/day=09", 3, "BTCUSDT", "1m")
    ]
    assert catalog[0].size_bytes > 0 and catalog[0].etag is None


def test_an_older_fetch_does_not_replace_a_newer_one_in_the_lake(spark, root):
    spec = candle_lake()
    archive(spark, candles(spark, BATCH2[0]), root, spec, RUN2)
    archive(spark, candles(spark, BATCH1[1]), root, spec, RUN1)
    assert tuples(scan_dataset(spark, root, spec), "close") == [("102",)]


def test_untouched_partitions_keep_their_files(spark, root):
    spec = candle_lake()
    archive(spark, candles(spark, ("2026-06-08T10:00:00Z", "1"), ("2026-06-09T10:00:00Z", "2")), root, spec, RUN1)
    files = lambda: {p for (p,) in tuples(scan_files(spark, root, spec).where("day = '08'").select("_metadata.file_path"))}
    before = files()
    archive(spark, candles(spark, ("2026-06-09T11:00:00Z", "3")), root, spec, RUN2)
    assert files() == before and scan_files(spark, root, spec).count() == 3


def test_mixed_values_become_text_without_loss(spark, root):
    spec = observation_lake("polymarket")
    archive(spark, observations(spark, ("polymarket", "v", "2026-06-09T12:00:00Z", 138677529.125854), kind="double"), root, spec, RUN1)
    archive(spark, observations(spark, ("polymarket", "v", "2026-06-09T18:00:00Z", "155627413.3720149719851917")), root, spec, RUN2)
    archive(spark, observations(spark, ("polymarket", "v", "2026-06-09T19:00:00Z", float("nan")), kind="double"), root, spec, RUN2)
    assert tuples(scan_dataset(spark, root, spec), hm(), "value") == [
        ("12:00", "138677529.125854"), ("18:00", "155627413.3720149719851917"), ("19:00", None),
    ]


def test_empty_input_is_skipped_and_bad_input_refused(spark, root):
    spec = candle_lake()
    assert archive(spark, candles(spark, *BATCH1).limit(0), root, spec, RUN1).status == "skip"
    with pytest.raises(ValueError, match="no valid timestamps"):
        archive(spark, candles(spark, ("never", "1")), root, spec, RUN1)
    with pytest.raises(ValueError, match="timestamp column"):
        archive(spark, candles(spark, *BATCH1).drop("timestamp"), root, spec, RUN1)
    with pytest.raises(ValueError, match="unique keys"):
        archive(spark, candles(spark, *BATCH1).drop("interval"), root, spec, RUN1)
    with pytest.raises(ValueError, match="granularity"):
        partition_key(F.col("timestamp"), "week")
    assert archive(spark, candles(spark, *BATCH1, ("never", "1")), root, spec, RUN1).rows == 2


def test_day_and_year_partitions_lie_side_by_side(spark, root):
    spec = observation_lake("dxy")
    history = [("dxy", "close", f"2026-0{m}-09T00:00:00Z", str(m)) for m in (1, 5, 6)]
    archive(spark, observations(spark, *history), root, spec, RUN1, "year")
    archive(spark, observations(spark, ("dxy", "close", "2026-06-09T00:00:00Z", "60")), root, spec, RUN2, "day")
    archive(spark, observations(spark, ("dxy", "close", "2026-07-09T00:00:00Z", "7")), root, spec, RUN2, "month")
    assert scan_files(spark, root, spec).count() == 5
    assert tuples(scan_dataset(spark, root, spec), "value") == [("1",), ("5",), ("60",), ("7",)]
    recent = scan_dataset(spark, root, spec, utc("2026-06-01T00:00:00"))
    assert tuples(recent, "value") == [("60",), ("7",)]
    archive(spark, observations(spark, ("dxy", "close", "2026-02-09T00:00:00Z", "2")), root, spec, RUN2, "year")
    assert scan_dataset(spark, root, spec).count() == 5


def test_year_month_and_day_directories_of_other_writers(spark, root):
    spec = candle_lake()
    base = f"{spec.path(root)}/symbol=BTCUSDT/interval=1m"
    rows = lambda day, close: lake_rows(candles(spark, (f"{day}T10:00:00Z", close)), spec, "day", RUN1).drop(*spec.partition_by)
    rows("2023-05-01", "1").write.parquet(f"{base}/year=2023")
    rows("2024-02-01", "2").write.parquet(f"{base}/year=2024/month=02")
    rows("2024-03-05", "3").write.parquet(f"{base}/year=2024/month=03/day=05")
    found = scan_files(spark, root, spec)
    assert tuples(found, "symbol", "interval", "year", "month", "day", "close") == [
        ("BTCUSDT", "1m", "2023", "00", "00", "1"), ("BTCUSDT", "1m", "2024", "02", "00", "2"), ("BTCUSDT", "1m", "2024", "03", "05", "3"),
    ]
    assert tuples(scan_dataset(spark, root, spec, utc("2024-02-01T10:00:00")), "close") == [("2",), ("3",)]


def mixed_lake(spark, root):
    """Files of another writer in year, month and day directories."""
    spec = candle_lake()
    base = f"{spec.path(root)}/symbol=BTCUSDT/interval=1m"
    rows = lambda *stamps: lake_rows(candles(spark, *stamps), spec, "day", RUN1).drop(*spec.partition_by)
    rows(("2023-05-01T10:00:00Z", "1"), ("2023-06-01T10:00:00Z", "1.5")).write.parquet(f"{base}/year=2023")
    rows(("2024-02-01T10:00:00Z", "2")).write.parquet(f"{base}/year=2024/month=02")
    rows(("2024-03-05T10:00:00Z", "3")).write.parquet(f"{base}/year=2024/month=03/day=05")
    return spec


def test_each_depth_of_a_mixed_layout_prunes_its_directories(spark, root):
    spec = mixed_lake(spark, root)
    found = scan_files(spark, root, spec, utc("2024-03-01T00:00:00"))
    assert tuples(found, "close") == [("3",)]
    plan = plan_of(found, "formatted")
    assert plan.count("PartitionFilters: [") == 3 and plan.count("PushedFilters: [") == 3
    recent = stored_rows(spark, root, spec, files=True).where(partitions_since(utc("2024-03-01T00:00:00")))
    assert recent.select("_path").distinct().count() == 1


@pytest.mark.parametrize("granularity", ["day", "month", "year"])
def test_archive_into_a_mixed_layout(spark, root, granularity):
    spec = mixed_lake(spark, root)
    new = [("2023-05-01T10:00:00Z", "9"), ("2024-02-01T10:00:00Z", "8"), ("2024-03-05T11:00:00Z", "7")]
    for _ in range(2):
        result = archive(spark, candles(spark, *new), root, spec, RUN2, granularity, f"{root}/catalog")
        assert result.status == "ok" and result.fetched == 3
    want = [("9",), ("1.5",), ("8",), ("3",), ("7",)]
    assert tuples(scan_dataset(spark, root, spec).orderBy("timestamp"), "close") == sorted(want)
    # files of a rewritten partition are replaced, wherever they lay
    stored = stored_rows(spark, root, spec, files=True)
    levels = {row[0] for row in tuples(stored.selectExpr("size(split(_path, '/(year|month|day)='))").distinct())}
    assert levels == {"day": {2, 3, 4}, "month": {2, 4}, "year": {3, 4}}[granularity]
    whole = build_catalog(spark, root, spec, RUN2)
    assert whole.agg(F.sum("row_count")).first()[0] == stored.count()
    assert whole.agg(F.min("min_timestamp"), F.max("max_timestamp")).first() == stored.agg(F.min("timestamp"), F.max("timestamp")).first()
    catalog = read_table(spark, f"{root}/catalog", LAKE_CATALOG)
    found = scan_catalogued(spark, root, spec, catalog, utc("2024-02-01T00:00:00"))
    assert {("8",), ("7",)} <= set(tuples(found, "close"))


def test_footers_tell_the_range_without_reading_pages(spark, root):
    spec = candle_lake()
    archive(spark, candles(spark, *BATCH1, ("2026-06-10T10:00:00Z", "1")), root, spec, RUN1)
    files = stored_rows(spark, root, spec, files=True).select(F.col("_path").alias("object_path")).distinct()
    ranges = read_time_ranges(files)
    assert "ReadSchema: struct<>" in plan_of(files, "formatted")
    assert sorted(r.complete for r in ranges.collect()) == [True, True]
    before = spark.conf.get("spark.sql.parquet.outputTimestampType")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "INT96")
    try:  # stamps without statistics
        rows = lake_rows(candles(spark, ("2026-06-11T10:00:00Z", "4"), ("2026-06-11T12:00:00Z", "5")), spec, "day", RUN1)
        spark.conf.set("spark.sql.parquet.outputTimestampType", "INT96")
        rows.write.mode("append").partitionBy(*spec.partition_by).parquet(spec.path(root))
    finally:
        spark.conf.set("spark.sql.parquet.outputTimestampType", before)
    assert ranges.where("not complete").count() == 0
    catalog = build_catalog(spark, root, spec, RUN1)
    assert tuples(catalog, hm("min_timestamp"), hm("max_timestamp"), "row_count")[-1] == ("10:00", "12:00", 2)


def test_writers_of_different_partitions_both_survive(spark, root, monkeypatch):
    spec = candle_lake()
    archive(spark, candles(spark, ("2026-06-08T10:00:00Z", "1"), ("2026-06-09T10:00:00Z", "1")), root, spec, RUN1)
    real = merge.publish

    def other_first(*args):
        monkeypatch.setattr(merge, "publish", real)
        archive(spark, candles(spark, ("2026-06-09T11:00:00Z", "3")), root, spec, RUN2)
        real(*args)

    monkeypatch.setattr(merge, "publish", other_first)
    archive(spark, candles(spark, ("2026-06-08T11:00:00Z", "2")), root, spec, RUN2)
    assert tuples(scan_files(spark, root, spec), "day", "close") == [("08", "1"), ("08", "2"), ("09", "1"), ("09", "3")]


def test_the_cutoff_prunes_directories(spark, root):
    spec = observation_lake("dxy")
    rows = [("dxy", "close", f"20{y}-06-{d:02d}T00:00:00Z", "1") for y in (24, 25, 26) for d in (1, 9, 20)]
    archive(spark, observations(spark, *rows), root, spec, RUN1)
    scan = scan_files(spark, root, spec, utc("2026-06-09T00:00:00"))
    assert "PartitionFilters: [" in plan_of(scan, "formatted") and scan.count() == 2
    kept = scan_files(spark, root, spec).where(partitions_since(utc("2025-06-09T00:00:00")))
    assert kept.select("year", "month", "day").distinct().count() == 5


def test_awkward_names_survive_the_directories(spark, root):
    spec = candle_lake()
    archive(spark, candles(spark, *BATCH1, symbol="A B/C=é%"), root, spec, RUN1, catalog_path=f"{root}/catalog")
    archive(spark, candles(spark, *BATCH2, symbol="A B/C=é%"), root, spec, RUN2, catalog_path=f"{root}/catalog")
    assert tuples(scan_dataset(spark, root, spec).select("symbol").distinct()) == [("A B/C=é%",)]
    catalog = read_table(spark, f"{root}/catalog", LAKE_CATALOG)
    assert catalog.count() == 1
    found = scan_catalogued(spark, root, spec, catalog, utc("2026-06-01T00:00:00"), "1m")
    assert found.count() == 3


def test_reader_through_the_catalog(spark, root):
    spec = candle_lake()
    days = [(f"2026-06-{d:02d}T10:00:00Z", str(d)) for d in range(1, 10)]
    archive(spark, candles(spark, *days, interval="15m"), root, spec, RUN1, catalog_path=f"{root}/catalog")
    archive(spark, candles(spark, *days, interval="1m"), root, spec, RUN1, catalog_path=f"{root}/catalog")
    catalog = read_table(spark, f"{root}/catalog", LAKE_CATALOG)
    cutoff = utc("2026-06-08T10:00:00")
    assert catalog_objects_since(catalog, cutoff, "btc_ohlcv", "15m").count() == 2
    assert catalog_objects_since(catalog, cutoff, prefix="raw/other/").count() == 0
    rows = scan_catalogued(spark, root, spec, catalog, cutoff, "15m")
    assert tuples(rows, "interval", "close") == [("15m", "8"), ("15m", "9")]
    assert scan_catalogued(spark, root, spec, catalog, utc("2030-01-01T00:00:00")).count() == 0
    closes = read_closes_since(scan_dataset(spark, root, spec), cutoff, "1m", "BTCUSDT")
    assert tuples(closes, "close") == [("8",), ("9",)]
    assert read_closes_since(scan_dataset(spark, root, spec), cutoff, "1m", "ETHUSDT").count() == 0


def test_rebuilt_catalog_counts_the_files(spark, root):
    spec = candle_lake()
    archive(spark, candles(spark, *BATCH1, ("2026-06-10T10:00:00Z", "1")), root, spec, RUN1)
    rows = build_catalog(spark, root, spec, RUN1)
    assert tuples(rows, hm("min_timestamp"), "row_count") == [("10:00", 1), ("10:00", 2)]
    assert build_catalog(spark, f"{root}/none", spec, RUN1).count() == 0


def test_verify_write_reports_missing_rows(spark, root):
    spec = candle_lake()
    rows = candles(spark, *BATCH1, ("2026-06-10T10:00:00Z", "1"))
    archive(spark, rows.limit(2), root, spec, RUN1)
    check = verify_write(lake_rows(rows, spec, "day", RUN1), scan_files(spark, root, spec), spec.partition_by)
    assert tuples(check, "day", "expected_rows", "stored_rows", "matches") == [("09", 2, 2, True), ("10", 1, 0, False)]


def test_verify_write_finds_a_changed_value_at_an_equal_count(spark, root):
    spec = candle_lake()
    rows = candles(spark, *BATCH1, ("2026-06-10T10:00:00Z", "5"))
    archive(spark, rows, root, spec, RUN1)
    changed = lake_rows(candles(spark, BATCH1[0], (BATCH1[1][0], "999"), ("2026-06-10T10:00:00Z", "5")), spec, "day", RUN1)
    stored = scan_files(spark, root, spec)
    check = verify_write(changed.repartition(3), stored, spec.partition_by)
    assert tuples(check, "day", "expected_rows", "stored_rows", "matches") == [("09", 2, 2, False), ("10", 1, 1, True)]
    same = verify_write(lake_rows(rows, spec, "day", RUN1).repartition(3), stored, spec.partition_by)
    assert tuples(same, "day", "matches") == [("09", True), ("10", True)]


def test_features_by_prefix_through_the_catalog(spark, root):
    day = "2026-06-09T00:00:00Z"
    labelled = observations(spark, ("fear_greed", "index", day, "10"), ("fear_greed", "index", "2026-05-01T00:00:00Z", "9"))
    archive(spark, labelled.withColumn("label", F.lit("Extreme Fear")), root, observation_lake("fear_greed"), RUN1, catalog_path=f"{root}/catalog")
    macro = observations(spark, ("fred", "treasury_10y", day, "4.5"), ("fred", "treasury_10y", "2026-06-08T00:00:00Z", "4.4"))
    archive(spark, macro, root, observation_lake("fred", "macro"), RUN1, "year", catalog_path=f"{root}/catalog")
    archive(spark, candles(spark, *BATCH1), root, candle_lake(), RUN1, catalog_path=f"{root}/catalog")
    catalog = read_table(spark, f"{root}/catalog", LAKE_CATALOG)
    found = scan_features_since(spark, root, catalog, utc("2026-06-08T12:00:00"))
    assert tuples(found, "dataset", "source", "value", "label") == [
        ("alt_data", "fear_greed", "10", "Extreme Fear"), ("macro_data", "fred", "4.5", None)
    ]
    # the catalog decides: what it does not have is not read
    only = scan_features_since(spark, root, catalog.where("dataset = 'fred'"), utc("2026-06-01T00:00:00"))
    assert only.count() == 2
    assert scan_features_since(spark, root, catalog, utc("2030-01-01T00:00:00")).count() == 0


def test_prefix_scan_takes_parquet_files_of_any_layout(spark, root, tmp_path):
    one = spark.createDataFrame([(1,)], "v int")
    one.write.parquet(f"{root}/dxy/year=2026")
    one.write.parquet(f"{root}/dxy/a/b")
    one.write.parquet(f"{root}/fear_greed")
    (tmp_path / "lake" / "dxy" / "notes.txt").write_text("no parquet")
    assert scan_lake(spark, [f"{root}/dxy", f"{root}/absent"], "v int").count() == 2


def alt(spark, *rows):
    return spark.createDataFrame(
        [(s, m, utc(t), v, lb) for s, m, t, v, lb in rows], "source string, metric_name string, timestamp timestamp, value string, label string"
    )


def test_upsert_last_write_wins(spark, root):
    upsert(spark, root, alt(spark, ("dxy", "close", "2026-06-09T00:00:00", "1.5", None), ("dxy", "close", "2026-05-09T00:00:00", "9", "x")), ALT_DATA)
    upsert(spark, root, alt(spark, ("dxy", "close", "2026-06-09T00:00:00", "155627413.3720149719851917", "new")), ALT_DATA)
    assert tuples(read_table(spark, root, ALT_DATA), "value", "label") == [
        (Decimal("9"), "x"), (Decimal("155627413.3720149719851917"), "new"),
    ]
    with pytest.raises(ValueError, match="missing key"):
        upsert(spark, root, alt(spark).drop("source"), ALT_DATA)


def test_a_placeholder_replaces_a_value_as_the_last_write(spark, root):
    now = utc("2026-06-09T12:00:00")
    upsert(spark, root, alt(spark, ("google_trends", "bitcoin", "2026-06-09T00:00:00", "72", None)).drop("label"), MACRO_DATA)
    empty = alt(spark).drop("label")
    upsert(spark, root, with_placeholders(empty, [("google_trends", "bitcoin")], now), MACRO_DATA)
    assert tuples(read_table(spark, root, MACRO_DATA), "value") == [(None,)]


def test_results_of_a_rerun_replace_those_of_the_day(spark, root):
    row = ("a", "b", 1, 0.5, 0.01, 40, "2026-06-09")
    columns = "dataset_a string, dataset_b string, lag_hours int, pearson_r double, p_value double, sample_size bigint, date_calculated string"
    day = lambda *rows: spark.createDataFrame(rows, columns).withColumn("date_calculated", F.col("date_calculated").cast("date"))
    save_results(spark, root, day(row))
    save_results(spark, root, day((*row[:3], 0.7, *row[4:]), (*row[:6], "2026-06-10")))
    assert tuples(read_table(spark, root, CORRELATION_RESULTS), "pearson_r") == [(0.5,), (0.7,)]


@pytest.mark.parametrize("listed", [500, 2, 0])
def test_merge_selects_exactly_the_touched_partitions(spark, root, listed):
    schema, keys = "k int, v int, a string, b string", ["k"]
    stored = [(i, i, f"a{i % 5}", f"b{i % 3}") for i in range(30)]
    merge_into(spark, root, spark.createDataFrame(stored, schema), schema, keys, ["a", "b"])
    update = [(0, 100, "a0", "b0"), (7, 107, "a2", "b1"), (100, 1, None, "b1")]
    new = spark.createDataFrame(update, schema)
    table = spark.read.schema(schema).parquet(root)
    exact = Touched.by(new, ["a", "b"], listed).select(table)
    assert {(r.a, r.b) for r in exact.collect()} == {("a0", "b0"), ("a2", "b1")}
    merge_into(spark, root, new, schema, keys, ["a", "b"], listed=listed)
    want = {row[0]: row for row in stored} | {row[0]: row for row in update}
    assert {r.k: tuple(r) for r in spark.read.schema(schema).parquet(root).collect()} == want


def test_publishing_twice_is_harmless(spark, root):
    schema = "k int, v int, a string"
    rows = spark.createDataFrame([(1, 1, "x"), (2, 2, "y")], schema)
    for _ in range(2):
        publish(rows, f"{root}/table", ["a"])
    assert spark.read.schema(schema).parquet(f"{root}/table").count() == 2


def test_a_failed_publish_keeps_the_merged_rows(spark, root, monkeypatch):
    upsert(spark, root, alt(spark, ("dxy", "close", "2026-06-09T00:00:00", "1", None)), ALT_DATA)
    kept = []
    real = merge.work_path
    monkeypatch.setattr(merge, "work_path", lambda *args: kept.append(real(*args)) or kept[-1])

    def lost(*args):
        raise OSError("driver lost")

    with monkeypatch.context() as patch, pytest.raises(OSError):
        patch.setattr(merge, "publish", lost)
        upsert(spark, root, alt(spark, ("dxy", "close", "2026-06-09T00:00:00", "2", None)), ALT_DATA)
    assert tuples(read_table(spark, root, ALT_DATA), "value") == [(Decimal(1),)]
    rows = spark.read.schema(ALT_DATA.schema).parquet(next(path for path in kept if "/merge-" in path))
    publish(rows, root, ALT_DATA.partition_by)
    assert tuples(read_table(spark, root, ALT_DATA), "value") == [(Decimal(2),)]


def test_a_small_upsert_does_not_shuffle_the_stored_rows(spark, root):
    upsert(spark, root, alt(spark, *[("dxy", "close", f"2026-06-{d:02d}T00:00:00", "1", None) for d in range(1, 29)]), ALT_DATA)
    stored = read_table(spark, root, ALT_DATA)
    new = merge.conformed(merge.with_period(alt(spark, ("dxy", "close", "2026-06-09T00:00:00", "2", None)), ALT_DATA), ALT_DATA.schema)
    touched = Touched.by(new, ALT_DATA.partition_by)
    merged = merge.merged_rows(touched.select(stored), new, ALT_DATA.keys, incoming_rows=touched.total)
    assert touched.total == 1 and merged.count() == 28 and merged.where("value = 2").count() == 1
    plan = plan_of(merged)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_staging_lies_in_the_shared_folder_and_is_removed(spark, root, monkeypatch):
    staged = []
    real = merge.work_path
    monkeypatch.setattr(merge, "work_path", lambda *args: staged.append(real(*args)) or staged[-1])
    for _ in range(2):
        upsert(spark, root, alt(spark, ("dxy", "close", "2026-06-09T00:00:00", "1", None)), ALT_DATA)
    # The rows of both upserts, and the merged partitions of the second.
    assert len(staged) == 3 and all(path.startswith(shared_dir(spark)) for path in staged)
    assert all(read_existing(spark, "source string", path) is None for path in staged)


def test_the_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert named is None or shared_dir(spark) == named.rstrip("/")
    assert work_path(spark, "x") != work_path(spark, "x")


FILE = "source string, metric_name string, timestamp string, value string, label string, fetched_at string"


def test_load_normalises_and_upserts(spark, root):
    spark.createDataFrame(
        [("fear_greed", "index", "2026-06-09T00:00:00Z", "10", "Extreme Fear", "2026-06-09T01:00:00Z")], FILE
    ).withColumn("timestamp", F.col("timestamp").cast("timestamp")).write.parquet(f"{root}/raw/alternative/fear_greed/year=2026")
    dry = lake_to_table(spark, root, LOADS[0], f"{root}/t", RUN1, dry_run=True)
    assert (dry["rows"], dry["upserted"]) == (1, 0) and read_table(spark, f"{root}/t", ALT_DATA).count() == 0
    done = lake_to_table(spark, root, LOADS[0], f"{root}/t", RUN1)
    assert (done["status"], done["rows"], done["upserted"]) == ("ok", 1, 1)
    assert tuples(read_table(spark, f"{root}/t", ALT_DATA), "source", "value", "label") == [("fear_greed", Decimal(10), "Extreme Fear")]


def test_load_is_partial_when_a_file_fails_and_defaults_absent_names(spark, root, tmp_path):
    base = f"{root}/raw/alternative/fear_greed"
    good = spark.createDataFrame([("2026-06-09T00:00:00Z", "1"), ("2026-06-10T00:00:00Z", "x")], "timestamp string, value string")
    stamped = good.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    stamped.coalesce(1).write.parquet(f"{base}/a")
    stamped.where("value = '1'").withColumn("value", F.lit("2")).coalesce(1).write.parquet(f"{root}/raw/market/alt_data/fear_greed/z")
    stamped.drop("value").coalesce(1).write.parquet(f"{base}/b")
    broken = tmp_path / "lake" / "raw" / "alternative" / "fear_greed" / "c"
    broken.mkdir()
    (broken / "part.parquet").write_bytes(b"not parquet at all")
    done = lake_to_table(spark, root, LOADS[0], f"{root}/t", RUN1)
    assert (done["status"], done["files"], done["failed_files"], done["rows"]) == ("partial", 4, 2, 1)
    assert tuples(read_table(spark, f"{root}/t", ALT_DATA), "source", "metric_name", "value") == [("fear_greed", "index", Decimal(2))]


def test_files_written_by_pandas_are_loaded(spark, root, tmp_path):
    """Nanosecond stamps, a typeless label, numbers in one file and text in another, no source column."""
    folder = tmp_path / "lake" / "raw" / "alternative" / "dxy"
    folder.mkdir(parents=True)
    stamps = pd.to_datetime(["2026-06-09T00:00:00Z", "2026-06-10T00:00:00Z"], utc=True).astype("datetime64[ns, UTC]")
    pd.DataFrame({"source": "dxy", "metric_name": "close", "timestamp": stamps, "value": [1.5, float("nan")], "label": None}).to_parquet(folder / "a.parquet")
    pd.DataFrame({"timestamp": stamps[:1], "value": ["2.50"], "label": ["x"]}).to_parquet(folder / "b.parquet")
    pd.DataFrame({"timestamp": stamps[:0], "value": []}).to_parquet(folder / "empty.parquet")
    pd.DataFrame({"timestamp": stamps}).to_parquet(folder / "lacking.parquet")
    micros = stamps[:1].astype("datetime64[us, UTC]") + pd.Timedelta(days=5)
    pd.DataFrame({"source": "dxy", "metric_name": "close", "timestamp": micros, "value": ["7"], "label": None}).to_parquet(folder / "micros.parquet")
    (folder / "broken.parquet").write_bytes(b"PAR1 no more PAR1")
    load = load_rows(spark, root, LOADS[1], RUN1)
    assert (load.files, load.failed_files) == (6, 2)
    day = F.date_format("timestamp", "yyyy-MM-dd HH:mm").alias("day")
    assert tuples(load.rows, day, "source", "metric_name", "value", "label") == [
        ("2026-06-09 00:00", "dxy", "close", 2.5, "x"), ("2026-06-14 00:00", "dxy", "close", 7.0, None),
    ]


def test_a_file_damaged_in_the_middle_counts_for_nothing(spark, root, tmp_path):
    folder = tmp_path / "lake" / "raw" / "alternative" / "dxy"
    folder.mkdir(parents=True)
    stamps = pd.date_range("2026-01-01", periods=4000, freq="min", tz="UTC")
    rows = pd.DataFrame({"timestamp": stamps, "value": [str(i) for i in range(4000)]})
    rows.to_parquet(folder / "whole.parquet", row_group_size=1000)
    later = rows.assign(timestamp=stamps + pd.Timedelta(days=30))
    later.to_parquet(folder / "damaged.parquet", row_group_size=1000)
    content = bytearray((folder / "damaged.parquet").read_bytes())
    content[len(content) // 2 : len(content) * 3 // 4] = bytes(len(content) * 3 // 4 - len(content) // 2)
    (folder / "damaged.parquet").write_bytes(content)
    rows.assign(timestamp=stamps + pd.Timedelta(days=60), source=None).to_parquet(folder / "unnamed.parquet")
    load = load_rows(spark, root, LOADS[1], RUN1)
    assert (load.files, load.failed_files, load.rows.count()) == (3, 1, 4000)
    assert load.rows.agg(F.max("timestamp")).first()[0] < datetime(2026, 1, 4)
    done = lake_to_table(spark, root, LOADS[1], f"{root}/t", RUN1)
    assert (done["status"], done["upserted"]) == ("partial", 4000)


def test_the_catalog_decides_whatever_directories_there_are(spark, root):
    spec = candle_lake()
    for days, recorded in ((range(1, 5), True), (range(5, 8), False)):
        for day in days:
            rows = candles(spark, (f"2026-06-0{day}T00:00:00Z", str(day)), interval="15m")
            archive(spark, rows, root, spec, RUN1, catalog_path=f"{root}/catalog" if recorded else None)
    gone = f"{spec.path(root)}/symbol=BTCUSDT/interval=15m/year=2026/month=06/day=04"
    remove_path(spark, gone)
    found = scan_catalogued(spark, root, spec, read_table(spark, f"{root}/catalog", LAKE_CATALOG), utc("2026-06-02T00:00:00"))
    assert tuples(found, "close") == [("2",), ("3",)]


def test_required_columns_are_checked(spark):
    spec = LoadSpec("google_trends", MACRO_DATA, (), "google_trends")
    rows = observations(spark, ("google_trends", "bitcoin", "2026-06-09T00:00:00Z", "1"))
    assert validate_and_fill(rows, spec).columns == ["source", "metric_name", "timestamp", "value"]
    with pytest.raises(ValueError, match="metric_name"):
        validate_and_fill(rows.drop("metric_name"), spec)
    kept = validate_and_fill(rows.withColumn("source", F.lit(None).cast("string")), spec)
    assert kept.count() == 0


def test_one_failing_load_does_not_stop_the_others(spark, root, monkeypatch):
    observations(spark, ("dxy", "close", "2026-06-09T00:00:00Z", "1")).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp")
    ).write.parquet(f"{root}/raw/alternative/dxy/a")
    broken = LoadSpec("broken", ALT_DATA.__class__("x", "source string", ("nope",), ()), ("raw/alternative/dxy/",), "dxy", "close")
    got = {r.source: r for r in load_tables(spark, root, f"{root}/tables", RUN1, (broken, LOADS[1])).collect()}
    assert got["broken"].status == "error" and "nope" in got["broken"].error
    assert got["dxy"].status == "ok" and got["dxy"].upserted == 1


def test_backfill_isolates_sources_and_sums_up(spark, root):
    good = observations(spark, ("dxy", "close", "2026-06-09T00:00:00Z", "1"), ("dxy", "close", "2025-06-09T00:00:00Z", "2"))

    def fails():
        raise OSError("source is down")

    sources = {
        "dxy": BackfillSource(lambda: good, observation_lake("dxy")),
        "down": BackfillSource(fails, observation_lake("down")),
        "btc_1m": BackfillSource(lambda: candles(spark, *BATCH1), candle_lake(), "day"),
    }
    results, summary = backfill(spark, sources, root, RUN1, f"{root}/catalog")
    got = {r.source: tuple(r)[1:] for r in results.collect()}
    assert got["dxy"] == ("ok", 2, 2, "") and got["btc_1m"] == ("ok", 2, 2, "")
    assert got["down"][:3] == ("error", 0, 0) and "source is down" in got["down"][3]
    assert {r.source: (r.fetched, r.archived) for r in summary.collect()}["TOTAL"] == (4, 4)
    catalog = read_table(spark, f"{root}/catalog", LAKE_CATALOG)
    assert {k.split("year=")[1] for (k,) in tuples(catalog, "object_key")} == {
        "2025/month=00/day=00", "2026/month=00/day=00", "2026/month=06/day=09",
    }


def test_sample_report_takes_the_catalog_first(spark, root):
    upsert(spark, f"{root}/candles", candles(spark, *BATCH1, interval="5m").withColumn("timestamp", F.col("timestamp").cast("timestamp")), CANDLES)
    archive(spark, candles(spark, *BATCH1), root, candle_lake(), RUN1, catalog_path=f"{root}/catalog")
    obs = alt(spark, ("fear_greed", "index", "2026-06-09T00:00:00", "1", ""), ("polymarket", "total_volume_24h", "2026-06-09T00:00:00", "1", None))
    report = sample_report(obs, read_table(spark, f"{root}/catalog", LAKE_CATALOG), read_table(spark, f"{root}/candles", CANDLES))
    got = {r.name: (r.samples, r.pending) for r in report.collect()}
    assert got == {
        "fear_greed": (1, False), "dxy": (0, False), "polymarket": (1, True), "treasury_10y": (0, False),
        "google_trends_btc": (0, False), "google_trends_crypto": (0, False), "bdi": (0, False),
        "1m": (2, False), "5m": (2, False), "15m": (0, False),
    }


def test_a_table_read_from_a_cutoff_skips_earlier_months(spark, root):
    rows = [("dxy", "close", f"2026-0{m}-09T00:00:00", str(m), None) for m in (4, 5, 6)]
    upsert(spark, root, alt(spark, *rows, ("dxy", "close", "2026-05-20T00:00:00", "9", None)), ALT_DATA)
    recent = read_table(spark, root, ALT_DATA, utc("2026-05-10T00:00:00"))
    assert tuples(recent.select(F.col("value").cast("int"))) == [(6,), (9,)]
    assert "period" in next(line for line in plan_of(recent, "formatted").splitlines() if "PartitionFilters" in line)


def test_features_since(spark, root):
    upsert(spark, f"{root}/alt", alt(spark, ("dxy", "close", "2026-06-09T00:00:00", "1", "L"), ("dxy", "close", "2026-01-09T00:00:00", "1", None)), ALT_DATA)
    upsert(spark, f"{root}/macro", alt(spark, ("fred", "t", "2026-06-09T00:00:00", "2", None)).drop("label"), MACRO_DATA)
    rows = read_features_since(read_table(spark, f"{root}/alt", ALT_DATA), read_table(spark, f"{root}/macro", MACRO_DATA), "2026-06-01")
    assert tuples(rows, "dataset", "source", "label") == [("alt_data", "dxy", "L"), ("macro_data", "fred", None)]
