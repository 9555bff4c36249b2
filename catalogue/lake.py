"""Lake and table writes, read back."""

from __future__ import annotations

from datetime import datetime, timezone

from pyarrow.fs import FileSelector, FileSystem
from pyspark.sql import functions as F

from catalogue.registry import query, rounded
from catalogue.tables import (
    EVENT_PARAMS,
    EVENT_TYPES,
    candles,
    daily_priority,
    daily_priority_sql,
    events,
    observations,
    orders,
)
from lagloom.operators.dedupe import keep_last
from lagloom.params import NAMED_SERIES
from lagloom.plans.jobs import BackfillSource, backfill, load_tables, sample_report
from lagloom.schemas import (
    ALT_DATA,
    CANDLES,
    LAKE_CATALOG,
    LAKE_OBSERVATION_COLUMNS,
    OBSERVATION_KEYS,
    LakeSpec,
    candle_lake,
    observation_lake,
)
from lagloom.session import work_path
from lagloom.sinks.lake import LOADS, archive, build_catalog, lake_rows, load_rows, verify_write
from lagloom.sinks.merge import upsert
from lagloom.sources.lake import read_table, scan_catalogued, scan_dataset, scan_features_since, scan_files, scan_lake

FIRST = datetime(2024, 2, 1, tzinfo=timezone.utc)
SECOND = datetime(2024, 2, 2, tzinfo=timezone.utc)

# Daily turnover, replaced on the days that have a finished order.
MERGED_SQL = f"""
WITH a AS ({daily_priority_sql()}), b AS ({daily_priority_sql("o_orderstatus = 'F'")})
SELECT a.metric_name, a.ts AS "timestamp", round(coalesce(b.value, a.value), 6) AS value,
       CASE WHEN b.value IS NULL THEN 1 ELSE 2 END AS batch
FROM a LEFT JOIN b USING (metric_name, ts)"""


def _two_batches(spark, sf_dir):
    rows = orders(spark, sf_dir)
    return daily_priority(rows), daily_priority(rows.where(F.col("o_orderstatus") == "F"))


def _with_batch(rows):
    batch = F.when(F.col("fetched_at") == F.lit(SECOND.isoformat()).cast("timestamp"), 2).otherwise(1)
    return rows.select("metric_name", "timestamp", rounded(F.col("value")).alias("value"), batch.alias("batch"))


@query("merge_partitions", MERGED_SQL)
def _merge_partitions(spark, sf_dir):
    """Two overlapping batches archived by year; the later wins."""
    root = work_path(spark, "lake")
    spec = observation_lake("orders")
    first, second = _two_batches(spark, sf_dir)
    archive(spark, first, root, spec, FIRST, "year")
    archive(spark, second, root, spec, SECOND, "year")
    return _with_batch(scan_dataset(spark, root, spec))


@query("upsert", MERGED_SQL)
def _upsert(spark, sf_dir):
    """The same batches into the keyed table, split by month."""
    path = work_path(spark, "alt_data")
    first, second = _two_batches(spark, sf_dir)
    upsert(spark, path, first.withColumn("fetched_at", F.lit(FIRST.isoformat()).cast("timestamp")), ALT_DATA)
    upsert(spark, path, second.withColumn("fetched_at", F.lit(SECOND.isoformat()).cast("timestamp")), ALT_DATA)
    return _with_batch(read_table(spark, path, ALT_DATA))


@query("mixed_granularity", MERGED_SQL)
def _mixed_granularity(spark, sf_dir):
    """History by year, updates by month: a key in both is read once, the later one."""
    root = work_path(spark, "lake")
    spec = LakeSpec("alternative", "orders", LAKE_OBSERVATION_COLUMNS, OBSERVATION_KEYS, ())
    first, second = _two_batches(spark, sf_dir)
    archive(spark, first, root, spec, FIRST, "year")
    archive(spark, second, root, spec, SECOND, "month")
    return _with_batch(scan_dataset(spark, root, spec))


@query(
    "mixed_layout",
    """SELECT event_type AS metric_name, ts AS "timestamp", value,
  CASE event_id % 3 WHEN 0 THEN 'year' WHEN 1 THEN 'month' ELSE 'day' END AS level FROM events
QUALIFY row_number() OVER (PARTITION BY event_type, ts ORDER BY event_id % 3 DESC, value DESC) = 1""",
)
def _mixed_layout(spark, sf_dir):
    """A lake of other writers: year files, month files and day files of one dataset side by side."""
    root, spec = _mixed_lake(spark, sf_dir)
    return _with_level(scan_dataset(spark, root, spec))


LEVELS = ("year", "month", "day")


def _with_level(found):
    """What a row was stored as, by its ingestion time: the epoch's first seconds, or an archive's."""
    seconds = F.unix_seconds("fetched_at")
    level = F.when(seconds == 0, LEVELS[0]).when(seconds == 1, LEVELS[1]).when(seconds == 2, LEVELS[2]).otherwise("archived")
    return found.select("metric_name", "timestamp", rounded(F.col("value")).alias("value"), level.alias("level"))


def _mixed_lake(spark, sf_dir):
    root = work_path(spark, "lake")
    spec = observation_lake("events")
    rows = lake_rows(with_id(spark, sf_dir), spec, "day", FIRST)
    third = F.col("event_id") % 3
    # a later level was fetched later
    rows = rows.withColumn("fetched_at", F.timestamp_seconds(third))
    for number in range(3):
        levels = LEVELS[: number + 1]
        part = rows.where(third == number).drop("event_id", *[name for name in LEVELS if name not in levels])
        part.write.mode("append").partitionBy("metric", *levels).parquet(spec.path(root))
    return root, spec


@query(
    "mixed_layout_archive",
    """WITH lake AS (SELECT event_type, ts, value, CASE event_id % 3 WHEN 0 THEN 'year' WHEN 1 THEN 'month' ELSE 'day' END AS level
  FROM events QUALIFY row_number() OVER (PARTITION BY event_type, ts ORDER BY event_id % 3 DESC, value DESC) = 1
), fresh AS (SELECT event_type, ts, max(value + 1) AS value FROM events WHERE event_id % 5 = 0 GROUP BY ALL)
SELECT l.event_type AS metric_name, l.ts AS "timestamp", round(coalesce(f.value, l.value), 6) AS value,
  CASE WHEN f.value IS NULL THEN l.level ELSE 'archived' END AS level
FROM lake l LEFT JOIN fresh f USING (event_type, ts) WHERE l.ts >= TIMESTAMP '2024-01-10 12:00:00'""",
)
def _mixed_layout_archive(spark, sf_dir):
    """Revised values archived by month into a lake of year, month and day files, read from a cutoff on."""
    root, spec = _mixed_lake(spark, sf_dir)
    revised = with_id(spark, sf_dir).where("event_id % 5 = 0").withColumn("value", F.col("value") + 1).drop("event_id")
    archive(spark, revised, root, spec, FIRST, "month", f"{root}/catalog")
    found = scan_dataset(spark, root, spec, datetime(2024, 1, 10, 12, tzinfo=timezone.utc))
    return _with_level(found)


@query(
    "catalogued_features",
    f"""SELECT 'alt_data' AS dataset, 'events' AS source, event_type AS metric_name, ts AS "timestamp", round(max(value), 6) AS value,
  'L' || event_type AS label
FROM events WHERE ts >= TIMESTAMP '2001-01-15 12:00:00' GROUP BY ALL
UNION ALL
SELECT 'macro_data', 'orders', metric_name, ts, round(value, 6), NULL FROM ({daily_priority_sql()})
WHERE ts >= TIMESTAMP '2001-01-15 12:00:00'""",
)
def _catalogued_features(spark, sf_dir):
    """Two datasets, one split by metric and labelled, one neither, found and read through the catalog from a cutoff on."""
    root = work_path(spark, "lake")
    labelled = observations(spark, sf_dir).withColumn("label", F.concat(F.lit("L"), "metric_name"))
    archive(spark, labelled, root, observation_lake("events"), FIRST, "day", f"{root}/catalog")
    plain = LakeSpec("macro", "orders", LAKE_OBSERVATION_COLUMNS, OBSERVATION_KEYS, ())
    archive(spark, daily_priority(orders(spark, sf_dir)), root, plain, FIRST, "year", f"{root}/catalog")
    archive(spark, candles(spark, sf_dir), root, candle_lake(), FIRST, "month", f"{root}/catalog")  # not a feature
    catalog = read_table(spark, f"{root}/catalog", LAKE_CATALOG)
    found = scan_features_since(spark, root, catalog, datetime(2001, 1, 15, 12, tzinfo=timezone.utc))
    return found.withColumn("value", rounded(F.col("value")))


def with_id(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id", F.lit("events").alias("source"), F.col("event_type").alias("metric_name"), F.col("ts").alias("timestamp"), "value"
    )


def _archived_events(spark, sf_dir, granularity="day"):
    root = work_path(spark, "lake")
    spec = observation_lake("events")
    archive(spark, observations(spark, sf_dir), root, spec, FIRST, granularity, f"{root}/catalog")
    return root, spec


CATALOG_SQL = """
SELECT 'events' AS dataset, 'raw/alternative/events/metric=' || event_type || strftime(ts, '/year=%Y/month=%m/day=%d') AS object_key,
  min(ts) AS min_timestamp, max(ts) AS max_timestamp, count(DISTINCT ts) AS row_count, TRUE AS has_size, TRUE AS no_etag
FROM events GROUP BY ALL"""


def _catalog_rows(objects):
    return objects.select(
        "dataset",
        "object_key",
        "min_timestamp",
        "max_timestamp",
        "row_count",
        (F.col("size_bytes") > 0).alias("has_size"),
        F.col("etag").isNull().alias("no_etag"),
    )


@query("archive_partitions", CATALOG_SQL)
def _archive_partitions(spark, sf_dir):
    """Archive by day; the catalog as the archive recorded it."""
    root, _ = _archived_events(spark, sf_dir)
    return _catalog_rows(read_table(spark, f"{root}/catalog", LAKE_CATALOG))


@query("lake_catalog", CATALOG_SQL)
def _lake_catalog(spark, sf_dir):
    """The catalog rebuilt from the files."""
    root, spec = _archived_events(spark, sf_dir)
    return _catalog_rows(build_catalog(spark, root, spec, SECOND))


@query(
    "catalog_pruned_scan",
    """SELECT event_type AS symbol, ts AS "timestamp", CAST(value AS VARCHAR) AS close FROM events
WHERE ts >= TIMESTAMP '2024-01-20 06:00:00'
QUALIFY row_number() OVER (PARTITION BY event_type, ts ORDER BY value DESC) = 1""",
)
def _catalog_pruned_scan(spark, sf_dir):
    """Candles archived by day, read through the catalog from a cutoff on."""
    root = work_path(spark, "lake")
    spec = candle_lake()
    archive(spark, candles(spark, sf_dir), root, spec, FIRST, "day", f"{root}/catalog")
    catalog = read_table(spark, f"{root}/catalog", LAKE_CATALOG)
    cutoff = datetime(2024, 1, 20, 6, tzinfo=timezone.utc)
    return scan_catalogued(spark, root, spec, catalog, cutoff, "1m").select("symbol", "timestamp", "close")


@query(
    "partition_pruned_scan",
    """SELECT event_type AS metric_name, ts AS "timestamp", CAST(value AS VARCHAR) AS value FROM events
WHERE ts >= TIMESTAMP '2024-01-25 12:00:00'
QUALIFY row_number() OVER (PARTITION BY event_type, ts ORDER BY value DESC) = 1""",
)
def _partition_pruned_scan(spark, sf_dir):
    root, spec = _archived_events(spark, sf_dir)
    rows = scan_dataset(spark, root, spec, datetime(2024, 1, 25, 12, tzinfo=timezone.utc))
    return rows.select("metric_name", "timestamp", "value")


# Every fifth event lies in a file of its own kind; the others in usable files, half of them in an older place.
KINDS = {"damaged": 0, "lacking": 1, "unnamed": 2, "new": 3, "old": 4}


def _loadable_lake(spark, sf_dir):
    """All events as lake files: without names under the current prefix, with names under an older one, with a
    name column that is NULL, without values, and in a file damaged in the middle."""
    root = work_path(spark, "lake")
    current, older = f"{root}/raw/alternative/fear_greed", f"{root}/raw/market/alt_data/fear_greed"
    value = F.when((F.col("event_id") % 10 == 9), "bad").otherwise(F.col("value").cast("string"))
    rows = events(spark, sf_dir).select(F.col("ts").alias("timestamp"), value.alias("value"), (F.col("event_id") % 5).alias("kind"))
    kind = {name: rows.where(F.col("kind") == number).drop("kind") for name, number in KINDS.items()}
    # rows of one stamp share a file, so that the path decides between places only
    kind["new"].repartition(3, "timestamp").write.parquet(f"{current}/year=2024")
    named = kind["old"].withColumns({"source": F.lit("fear_greed"), "metric_name": F.lit("index"), "label": F.lit("old")})
    named.repartition(3, "timestamp").write.parquet(f"{older}/2024/01")
    kind["unnamed"].withColumn("source", F.lit(None).cast("string")).repartition(1).write.parquet(f"{current}/unnamed")
    kind["lacking"].drop("value").repartition(1).write.parquet(f"{current}/lacking")
    kind["damaged"].repartition(1).write.parquet(f"{root}/whole")
    system, folder = FileSystem.from_uri(root if "://" in root else f"file://{root}")
    whole = [f for f in system.get_file_info(FileSelector(f"{folder}/whole")) if f.base_name.endswith(".parquet")]
    content = bytearray(system.open_input_file(whole[0].path).read())
    middle = slice(len(content) // 4, len(content) // 2)
    content[middle] = bytes(len(content[middle]))
    place = FileSystem.from_uri(f"{current}/damaged" if "://" in root else f"file://{current}/damaged")[1]
    system.create_dir(place)
    with system.open_output_stream(f"{place}/part.parquet") as out:
        out.write(bytes(content))
    return root


LOADED_SQL = """
WITH f AS (
  SELECT ts, value, CASE WHEN event_id % 5 = 4 THEN 'old' END AS label, event_id % 5 AS path FROM events
  WHERE event_id % 5 IN (3, 4) AND event_id % 10 <> 9),
k AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY ts ORDER BY path DESC, value DESC) = 1)"""


@query(
    "validate_and_fill",
    f"""{LOADED_SQL}
SELECT 'fear_greed' AS source, 'index' AS metric_name, ts AS "timestamp", value, label FROM k""",
)
def _validate_and_fill(spark, sf_dir):
    return load_rows(spark, _loadable_lake(spark, sf_dir), LOADS[0], SECOND).rows.drop("fetched_at")


@query(
    "lake_to_table",
    f"""{LOADED_SQL}
SELECT 'fear_greed' AS source, 'partial' AS status, 9::BIGINT AS files, 2::BIGINT AS failed_files, count(*) AS rows,
  count(*) AS upserted, '' AS error FROM k
UNION ALL SELECT 'dxy', 'ok', 0, 0, 0, 0, '' UNION ALL SELECT 'treasury_10y', 'ok', 0, 0, 0, 0, ''
UNION ALL SELECT 'google_trends', 'ok', 0, 0, 0, 0, ''""",
)
def _lake_to_table(spark, sf_dir):
    root = _loadable_lake(spark, sf_dir)
    return load_tables(spark, root, f"{root}/tables", SECOND).drop("table")


@query(
    "scan_lake",
    """SELECT event_type AS folder, count(*) AS rows, min(ts) AS first_ts FROM events GROUP BY 1""",
)
def _scan_lake(spark, sf_dir):
    """Two layouts below a lake, and a prefix that does not exist."""
    root = work_path(spark, "lake")
    rows = events(spark, sf_dir)
    for number, layout in enumerate(("new/year=2024", "old/2024/01")):
        part = rows.where(F.col("event_id") % 2 == number)
        part.select("ts", "event_type").write.parquet(f"{root}/{layout}")
    found = scan_lake(spark, [f"{root}/new", f"{root}/old", f"{root}/nothing"], "ts timestamp, event_type string")
    return found.groupBy(F.col("event_type").alias("folder")).agg(
        F.count("*").alias("rows"), F.min("ts").alias("first_ts")
    )


@query(
    "verify_write",
    """SELECT event_type AS metric, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, '00' AS day,
  count(DISTINCT ts) AS expected_rows, count(DISTINCT ts) AS stored_rows, TRUE AS matches FROM events GROUP BY ALL""",
)
def _verify_write(spark, sf_dir):
    root, spec = _archived_events(spark, sf_dir, "month")
    written = keep_last(lake_rows(observations(spark, sf_dir), spec, "month", FIRST), list(spec.unique_keys))
    return verify_write(written, scan_files(spark, root, spec), spec.partition_by)


@query(
    "backfill",
    """
WITH n AS (SELECT event_type, count(*) AS fetched, count(DISTINCT ts) AS archived FROM events GROUP BY 1)
SELECT event_type AS source, 'ok' AS status, fetched, archived FROM n
UNION ALL SELECT 'broken', 'error', 0, 0
UNION ALL SELECT 'TOTAL', NULL, sum(fetched)::BIGINT, sum(archived)::BIGINT FROM n""",
)
def _backfill(spark, sf_dir):
    """Every event type as a source, and one without stamps."""
    rows = observations(spark, sf_dir)

    def one(event_type):
        return BackfillSource(lambda: rows.where(F.col("metric_name") == event_type), observation_lake(event_type))

    sources = {name: one(name) for name in EVENT_TYPES}
    sources["broken"] = BackfillSource(lambda: rows.drop("timestamp"), observation_lake("broken"))
    results, summary = backfill(spark, sources, work_path(spark, "lake"), FIRST)
    total = summary.where(F.col("source") == "TOTAL").withColumn("status", F.lit(None).cast("string"))
    return results.drop("error").unionByName(total)


@query(
    "sample_report",
    """
SELECT n.dataset, n.name, count(e.event_id) AS samples, n.name = 'polymarket' AND count(e.event_id) < 30 AS pending
FROM (VALUES ('alt_data', 'fear_greed', 'click'), ('alt_data', 'dxy', 'error'), ('alt_data', 'polymarket', 'purchase'),
  ('macro_data', 'treasury_10y', 'signup'), ('macro_data', 'google_trends_btc', 'view'),
  ('macro_data', 'google_trends_crypto', 'none'), ('macro_data', 'bdi', 'none')) n (dataset, name, event_type)
LEFT JOIN events e USING (event_type) GROUP BY n.dataset, n.name
UNION ALL SELECT 'events', '1m', count(DISTINCT ts), FALSE FROM events
UNION ALL SELECT 'events', unnest(['5m', '15m']), 0, FALSE""",
)
def _sample_report(spark, sf_dir):
    """Candles of one symbol archived and catalogued; five of the named series are the event types."""
    root = work_path(spark, "lake")
    spec = candle_lake("events")
    one_symbol = candles(spark, sf_dir).withColumn("symbol", F.lit("purchase"))
    archive(spark, one_symbol, root, spec, FIRST, "month", f"{root}/catalog")
    catalog = read_table(spark, f"{root}/catalog", LAKE_CATALOG)
    found = zip(EVENT_TYPES, NAMED_SERIES)
    names = spark.createDataFrame([(kind, s, m) for kind, (_, _, s, m) in found], "kind string, source string, metric string")
    rows = observations(spark, sf_dir).drop("source").join(names, F.col("metric_name") == F.col("kind"))
    rows = rows.select("source", F.col("metric").alias("metric_name"), "timestamp", "value")
    return sample_report(rows, catalog, read_table(spark, f"{root}/candles", CANDLES), EVENT_PARAMS)
