"""The lake: date-partitioned archive, file catalog, table load and write check."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lagloom.functions.coerce import has_values, moment, number_column, utc_timestamp, with_absent
from lagloom.functions.text import value_text
from lagloom.operators.dedupe import keep_last
from lagloom.schemas import ALT_DATA, LAKE_CATALOG, MACRO_DATA, LakeSpec, TableSpec
from lagloom.session import remove_path, use_utc
from lagloom.sinks.merge import Touched, last_by_outside, merge_into, staged, upsert
from lagloom.sources.foreign import read_footers, read_row_groups, read_time_ranges
from lagloom.sources.lake import stored_rows

GRANULARITIES = ("day", "month", "year")


def partition_key(timestamp: Column, granularity: str) -> Column:
    """First day of the partition a stamp falls into, as yyyy-MM-dd."""
    patterns = {"day": "yyyy-MM-dd", "month": "yyyy-MM-01", "year": "yyyy-01-01"}
    if granularity not in patterns:
        raise ValueError(f"partition granularity must be one of {', '.join(GRANULARITIES)}")
    return F.date_format(timestamp, patterns[granularity])


def date_directories(timestamp: Column, granularity: str) -> dict[str, Column]:
    """Directory values; ``00`` marks a whole year or month.

    All three levels are always there, so that day and year partitions of one dataset can lie side by
    side: without the markers a year directory would contain the day directories and replace them.
    """
    key = partition_key(timestamp, granularity)
    whole = {"day": 3, "month": 2, "year": 1}[granularity]
    return {
        name: F.split_part(key, F.lit("-"), F.lit(i + 1)) if i < whole else F.lit("00")
        for i, name in enumerate(("year", "month", "day"))
    }


def normalize_value(df: DataFrame, *columns: str) -> DataFrame:
    """Number columns as lake text, NaN as NULL."""
    return df.withColumns({name: value_text(F.col(name), df.schema[name].dataType) for name in columns})


def lake_rows(rows: DataFrame, spec: LakeSpec, granularity: str, run_ts: datetime | str) -> DataFrame:
    """Rows as the lake stores them: typed stamp, text numbers, ingestion time, directory columns."""
    if "timestamp" not in rows.columns:
        raise ValueError(f"{spec.dataset} rows require a timestamp column")
    missing = [name for name in spec.unique_keys if name not in rows.columns]
    if missing:
        raise ValueError(f"missing unique keys {missing} for {spec.dataset}")
    text = [name for name in ("open", "high", "low", "close", "volume", "value") if name in rows.columns]
    stamped = normalize_value(rows, *text).withColumns(
        {"timestamp": utc_timestamp(F.col("timestamp")), "fetched_at": moment(run_ts)}
    )
    if "metric" in spec.split_by:
        stamped = with_absent(stamped, metric=F.col("metric_name"))
    return stamped.where(F.col("timestamp").isNotNull()).withColumns(
        date_directories(F.col("timestamp"), granularity)
    )


@dataclass(frozen=True)
class ArchiveResult:
    """What an archive did; files and rows are of the touched partitions after the merge."""

    status: str
    fetched: int
    files: int
    rows: int


def archive(
    spark: SparkSession,
    rows: DataFrame,
    root: str,
    spec: LakeSpec,
    run_ts: datetime | str,
    granularity: str = "day",
    catalog_path: str | None = None,
    order: Sequence[str] = (),
) -> ArchiveResult:
    """Merge rows into a lake dataset and record the touched partitions in the catalog.

    Of rows with one key the later fetched wins, and within ``rows`` the last by ``order``, such as their arrival. No rows at all is ``skip``; rows without a single valid
    stamp are an error. The incoming rows are used several times, so they are parsed once and staged.
    """
    use_utc(spark)
    parsed = lake_rows(rows, spec, granularity, run_ts)
    incoming, staging = staged(spark, last_by_outside(parsed, spec.unique_keys, order, spec.schema), "incoming")
    try:
        fetched = incoming.count()
        if not fetched:
            if rows.isEmpty():
                return ArchiveResult("skip", 0, 0, 0)
            raise ValueError(f"{spec.dataset} has no valid timestamps")
        touched = merge_into(
            spark,
            spec.path(root),
            incoming,
            spec.schema,
            spec.unique_keys,
            spec.partition_by,
            ["fetched_at"],
            incoming_wins=False,
            sort_by=["timestamp"],
            lake=(root, spec),
        )
        # One row per touched partition.
        objects, figures = staged(spark, build_catalog(spark, root, spec, run_ts, touched), "catalog")
        totals = objects.agg(F.count("*").alias("files"), F.sum("row_count").alias("rows")).first()
        if catalog_path is not None:
            upsert(spark, catalog_path, objects, LAKE_CATALOG, cheap_to_reread=True)
        remove_path(spark, figures)
    finally:
        remove_path(spark, staging)
    return ArchiveResult("ok", fetched, totals["files"], totals["rows"])


def build_catalog(
    spark: SparkSession, root: str, spec: LakeSpec, run_ts: datetime | str, touched: Touched | None = None
) -> DataFrame:
    """One row per partition directory: time range, rows and bytes. Parquet has no etag; it stays NULL.

    Rows are counted by a scan without columns, time ranges taken from the footers, both of the touched files only. The
    stamps of a file are read only if its footer has no range.
    """
    stored = stored_rows(spark, root, spec, files=True)
    if stored is None:
        return spark.createDataFrame([], LAKE_CATALOG.schema)
    rows = stored if touched is None else touched.select(stored)
    counted = rows.groupBy("_path", *spec.partition_by).agg(F.count("*").alias("row_count"), F.first("_size").alias("size_bytes"))
    counted, staging = staged(spark, counted, "catalog-files")
    ranges = read_time_ranges(counted.select(F.col("_path").alias("object_path"))).withColumnRenamed("object_path", "_path")
    files, _ = staged(spark, counted.join(ranges, "_path"), "catalog-ranges")  # a row per file, read lazily by the result
    remove_path(spark, staging)
    unknown = files.where("not complete").select("_path")
    if not unknown.isEmpty():
        scanned = rows.select("_path", "timestamp").join(unknown, "_path").groupBy("_path")
        scanned = scanned.agg(F.min("timestamp").alias("_low"), F.max("timestamp").alias("_high"))
        files = files.join(scanned, "_path", "left").withColumns({"low": F.coalesce("low", "_low"), "high": F.coalesce("high", "_high")})
    # The metadata column holds a URI; the directory itself is its decoded form.
    plain = F.url_decode(F.replace("_path", F.lit("+"), F.lit("%2B")))
    folder = F.regexp_extract(plain, r"(raw/.*)/[^/]+$", 1)
    objects = files.groupBy(folder.alias("object_key"), *spec.partition_by).agg(
        F.min("low").alias("min_timestamp"),
        F.max("high").alias("max_timestamp"),
        F.sum("row_count").alias("row_count"),
        F.sum("size_bytes").alias("size_bytes"),
    )
    split = lambda name: F.col(name) if name in spec.split_by else F.lit(None).cast("string")
    return objects.select(
        F.lit(spec.dataset).alias("dataset"),
        split("symbol").alias("symbol"),
        split("interval").alias("interval"),
        "object_key",
        "min_timestamp",
        "max_timestamp",
        "row_count",
        "size_bytes",
        F.lit(None).cast("string").alias("etag"),
        moment(run_ts).alias("updated_at"),
    )


def verify_write(expected: DataFrame, stored: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows per partition, expected against stored; ``matches`` is false where their number or their values differ.

    Values are compared by the sum of a hash of every row, over the columns that both sides have: order doesn't
    matter, and both sides are read once, side by side.
    """
    values = [name for name in expected.columns if name in stored.columns and name not in partition_by]
    parts = [part for name in values for part in (F.col(name).cast("string"), F.col(name).isNull())]
    content = F.xxhash64(*parts, F.lit(0)).cast("decimal(20,0)").alias("_content")
    sides = [rows.select(*partition_by, content, F.lit(wrote).alias("_wrote")) for rows, wrote in ((expected, 1), (stored, 0))]
    wrote = F.col("_wrote") == 1
    counted = sides[0].unionByName(sides[1]).groupBy(*partition_by).agg(
        F.sum("_wrote").alias("expected_rows"),
        F.count_if(~wrote).alias("stored_rows"),
        F.sum(F.when(wrote, F.col("_content")).otherwise(-F.col("_content"))).alias("_difference"),
    )
    equal = (F.col("expected_rows") == F.col("stored_rows")) & (F.col("_difference") == 0)
    return counted.withColumn("matches", equal).drop("_difference")


@dataclass(frozen=True)
class LoadSpec:
    """Which lake prefixes feed which table, and the names to assume where a file lacks them."""

    name: str
    table: TableSpec
    prefixes: tuple[str, ...]
    source: str
    metric: str | None = None


# The datasets loaded into the tables, with the older prefixes they may still lie under.
LOADS = (
    LoadSpec("fear_greed", ALT_DATA, ("raw/alternative/fear_greed/", "raw/market/alt_data/fear_greed/"), "fear_greed", "index"),
    LoadSpec("dxy", ALT_DATA, ("raw/alternative/dxy/", "raw/market/alt_data/dxy/"), "dxy", "close"),
    LoadSpec("treasury_10y", MACRO_DATA, ("raw/macro/fred/", "raw/market/macro_data/treasury_10y/"), "fred", "treasury_10y"),
    LoadSpec("google_trends", MACRO_DATA, ("raw/macro/google_trends/", "raw/market/macro_data/google_trends/"), "google_trends"),
)

def validate_and_fill(rows: DataFrame, spec: LoadSpec) -> DataFrame:
    """Name columns defaulted where absent, required columns checked, invalid rows left out."""
    filled = with_absent(rows, source=spec.source)
    if spec.metric is not None:
        filled = with_absent(filled, metric_name=spec.metric)
    missing = sorted({"source", "metric_name", "timestamp", "value"} - set(filled.columns))
    if missing:
        raise ValueError(f"missing required columns {missing}")
    if spec.table is ALT_DATA:
        filled = with_absent(filled, label=F.lit(None).cast("string"))
    columns = ["source", "metric_name", "timestamp", "value", *(["label"] if spec.table is ALT_DATA else [])]
    kept = [name for name in ("object_path",) if name in rows.columns]
    typed = filled.withColumns(
        {"timestamp": utc_timestamp(F.col("timestamp")), "value": number_column(filled, "value")}
    )
    return has_values(typed, "source", "metric_name", "timestamp", "value").select(*columns, *kept)


def _required(spec: LoadSpec) -> list[str]:
    return ["timestamp", "value", *([] if spec.metric is not None else ["metric_name"])]


def _fill_absent(rows: DataFrame, spec: LoadSpec) -> DataFrame:
    """Names filled in where the row's file has no such column; a NULL in a column it has stays one."""
    lacks = lambda name: ~F.array_contains("columns", name)
    filled = rows.withColumn("source", F.when(lacks("source"), spec.source).otherwise(F.col("source")))
    if spec.metric is not None:
        metric = F.when(lacks("metric_name"), spec.metric).otherwise(F.col("metric_name"))
        filled = filled.withColumn("metric_name", metric)
    return filled.drop("columns", "failure")


def list_files(spark: SparkSession, prefixes: Sequence[str]) -> DataFrame | None:
    """Paths of the Parquet files below the prefixes, None if no prefix exists; no content is read."""
    found = None
    for prefix in prefixes:
        try:
            files = (
                spark.read.format("binaryFile")
                .option("pathGlobFilter", "*.parquet")
                .option("recursiveFileLookup", "true")
                .load(prefix)
            )
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        files = files.select(F.col("_metadata.file_path").alias("object_path"))
        found = files if found is None else found.unionByName(files)
    return found


@dataclass(frozen=True)
class LakeLoad:
    """Valid rows of a load, one per key, staged at a path, and what happened to its files."""

    rows: DataFrame
    files: int
    failed_files: int
    staging: str | None


def load_rows(spark: SparkSession, root: str, spec: LoadSpec, run_ts: datetime | str) -> LakeLoad:
    """All files of a load; of rows with one key the file whose path sorts last wins.

    A file counts whole or not at all: its footer says which columns it has, its row groups are dealt out and
    decoded in tasks, and if one of them fails no row of the file is taken.
    """
    use_utc(spark)
    files = list_files(spark, [f"{root.rstrip('/')}/{prefix}" for prefix in spec.prefixes])
    if files is None:
        return LakeLoad(spark.createDataFrame([], spec.table.columns), 0, 0, None)
    footers, read_from = staged(spark, read_footers(files.repartition(F.xxhash64("object_path"))), "footers")
    scratch = [read_from]
    try:
        usable = F.col("failure").isNull() & F.forall(F.array(*map(F.lit, _required(spec))), lambda c: F.array_contains("columns", c))
        groups = footers.where(usable & F.col("row_group").isNotNull())
        spread = groups.repartition(F.xxhash64("object_path", "row_group"))
        scan, scanned = staged(spark, read_row_groups(spread), "scan")
        scratch.append(scanned)
        broken = scan.where(F.col("failure").isNotNull()).select("object_path").distinct()
        counts = footers.agg(
            F.count_distinct("object_path").alias("files"), F.count_distinct(F.when(~usable, F.col("object_path"))).alias("failed")
        ).first()
        rows = scan.join(broken, "object_path", "left_anti")
        valid = validate_and_fill(_fill_absent(rows, spec), spec)
        kept = keep_last(valid, ["source", "metric_name", "timestamp"], ["object_path"]).drop("object_path")
        loaded, staging = staged(spark, kept.withColumn("fetched_at", moment(run_ts)), "load")
        failed = counts["failed"] + broken.count()
    finally:
        for path in scratch:
            remove_path(spark, path)
    return LakeLoad(loaded, counts["files"], failed, staging)


def lake_to_table(
    spark: SparkSession, root: str, spec: LoadSpec, table_path: str, run_ts: datetime | str, dry_run: bool = False
) -> dict:
    """Load one dataset from the lake into its table; a dry run only counts.

    Status is ``partial`` if a file could not be read or lacks a required column.
    """
    load = load_rows(spark, root, spec, run_ts)
    try:
        total = load.rows.count()
        if total and not dry_run:
            upsert(spark, table_path, load.rows, spec.table, cheap_to_reread=True)
    finally:
        if load.staging is not None:
            remove_path(spark, load.staging)
    return {
        "source": spec.name,
        "table": spec.table.name,
        "status": "partial" if load.failed_files else "ok",
        "files": load.files,
        "failed_files": load.failed_files,
        "rows": total,
        "upserted": 0 if dry_run else total,
    }
