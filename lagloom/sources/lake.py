"""Reading the lake and the tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lagloom.functions.coerce import matching, moment, since
from lagloom.operators.dedupe import keep_last
from lagloom.schemas import LAKE_OBSERVATION_COLUMNS, OBSERVATION_KEYS, LakeSpec, TableSpec
from lagloom.sources.observations import features_union


def read_existing(spark: SparkSession, schema: str, path: str, **options) -> DataFrame | None:
    """Parquet under a path, or None if there is nothing at that path yet."""
    try:
        return spark.read.schema(schema).options(**options).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_or_empty(spark: SparkSession, schema: str, path: str) -> DataFrame:
    rows = read_existing(spark, schema, path)
    return spark.createDataFrame([], schema) if rows is None else rows


def scan_lake(
    spark: SparkSession,
    prefixes: Iterable[str],
    schema: str,
    cutoff: datetime | str | None = None,
) -> DataFrame:
    """All ``*.parquet`` files below the prefixes, whatever their directory layout, with their path.

    Prefixes that do not exist count as empty; a damaged file fails the read.
    """
    options = {"recursiveFileLookup": "true", "pathGlobFilter": "*.parquet", "ignoreCorruptFiles": "false"}
    rows = spark.createDataFrame([], f"{schema}, object_path string")
    for prefix in prefixes:
        found = read_existing(spark, schema, prefix, **options)
        if found is not None:
            rows = rows.unionByName(found.withColumn("object_path", F.col("_metadata.file_path")))
    return rows if cutoff is None else since(rows, cutoff)


def read_table(spark: SparkSession, path: str, spec: TableSpec, cutoff: datetime | None = None) -> DataFrame:
    """A keyed table, from the cutoff on if one is given; earlier month directories are not read."""
    rows = read_or_empty(spark, spec.schema, path)
    if cutoff is None:
        return rows
    moment_utc = cutoff.astimezone(timezone.utc) if cutoff.tzinfo else cutoff
    return since(rows.where(F.col("period") >= f"{moment_utc:%Y-%m}"), cutoff, spec.time_column)


def partitions_since(cutoff: datetime) -> Column:
    """Directories that can hold rows from the cutoff on.

    The date directories are text; ``00`` as month or day stands for a whole year or month. Spark does
    not derive this from a filter on the timestamp, so it is stated.
    """
    moment_utc = cutoff.astimezone(timezone.utc) if cutoff.tzinfo else cutoff
    year, month, day = f"{moment_utc:%Y}", f"{moment_utc:%m}", f"{moment_utc:%d}"
    same_month = (F.col("month") == month) & ((F.col("day") == "00") | (F.col("day") >= day))
    same_year = (F.col("year") == year) & ((F.col("month") == "00") | (F.col("month") > month) | same_month)
    return (F.col("year") > year) | same_year


def scan_dataset(
    spark: SparkSession, root: str, spec: LakeSpec, cutoff: datetime | None = None
) -> DataFrame:
    """Rows of one dataset, one per natural key even if a day file and a year file both hold it."""
    return _latest_rows(scan_files(spark, root, spec, cutoff), spec)


def scan_files(
    spark: SparkSession, root: str, spec: LakeSpec, cutoff: datetime | None = None
) -> DataFrame:
    """Rows of one dataset as stored, partition columns included.

    A dataset may hold whole years or months as files of a ``year=`` or ``month=`` directory beside day directories.
    """
    rows = stored_rows(spark, root, spec)
    if rows is None:
        return spark.createDataFrame([], spec.schema)
    if cutoff is None:
        return rows
    return rows.where(partitions_since(cutoff)).where(F.col("timestamp") >= moment(cutoff))


DATE_LEVELS = ("year", "month", "day")


def shallow_levels(spark: SparkSession, root: str, spec: LakeSpec) -> tuple[int, ...]:
    """The levels above the day (1 year, 2 month) whose directories hold files themselves.

    Only year and month directories are listed for that, by the driver, as Spark lists directories to find partitions.
    """
    found = []
    for level in (1, 2):
        pattern = spark._jvm.org.apache.hadoop.fs.Path(_file_pattern(root, spec, level))
        if spark._jvm.org.apache.hadoop.fs.Path(spec.path(root)).getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern):
            found.append(level)
    return tuple(found)


def _file_pattern(root: str, spec: LakeSpec, level: int) -> str:
    directories = [*spec.split_by, *DATE_LEVELS[:level]]
    return "/".join([spec.path(root), *[f"{name}=*" for name in directories], "*.parquet"])


def stored_rows(spark: SparkSession, root: str, spec: LakeSpec, files: bool = False) -> DataFrame | None:
    """All rows of a dataset with their partition columns, or None if nothing is there; with ``files`` also _path and _size.

    Spark's partition discovery takes one depth of directories. Where files lie at several, each depth is a scan of its own
    that prunes its directories, and the scans are united by name; date levels that a depth lacks are ``00``.
    """
    shallow = shallow_levels(spark, root, spec)
    if not shallow:
        rows = read_existing(spark, spec.schema, spec.path(root))
        return None if rows is None else _with_files(rows, files)
    scans = []
    for level in (*shallow, 3):
        directories = [*spec.split_by, *DATE_LEVELS[:level]]
        schema = ", ".join([spec.columns, *[f"{name} string" for name in directories]])
        found = read_existing(spark, schema, _file_pattern(root, spec, level), basePath=spec.path(root))
        if found is not None:
            absent = {name: F.lit("00") for name in DATE_LEVELS[level:]}
            scans.append(_with_files(found, files).withColumns(absent))
    return reduce(DataFrame.unionByName, scans)


def _with_files(rows: DataFrame, files: bool) -> DataFrame:
    if not files:
        return rows
    return rows.withColumns({"_path": F.col("_metadata.file_path"), "_size": F.col("_metadata.file_size")})


def _latest_rows(rows: DataFrame, spec: LakeSpec) -> DataFrame:
    flat = rows.drop("year", "month", "day")
    return keep_last(flat, list(spec.unique_keys), ["fetched_at"])


def read_closes_since(
    candles: DataFrame, cutoff: datetime | str, interval: str, symbol: str
) -> DataFrame:
    """Closes of one symbol and interval; all three conditions reach the scan."""
    wanted = candles.where((F.col("symbol") == symbol) & (F.col("interval") == interval))
    tie = ["fetched_at"] if "fetched_at" in candles.columns else []
    return since(wanted, cutoff).select("symbol", "interval", "timestamp", "close", *tie)


def read_features_since(alt: DataFrame, macro: DataFrame, cutoff: datetime | str) -> DataFrame:
    """Observations of both tables from the cutoff on."""
    return features_union(since(alt, cutoff), since(macro, cutoff))


def catalog_objects_since(
    catalog: DataFrame,
    cutoff: datetime | str,
    dataset: str | None = None,
    interval: str | None = None,
    prefix: str | None = None,
) -> DataFrame:
    """Catalogued objects that reach the cutoff, oldest first."""
    found = catalog.where(F.col("max_timestamp") >= moment(cutoff))
    equal = {name: value for name, value in (("dataset", dataset), ("interval", interval)) if value}
    found = matching(found, {"object_key": prefix} if prefix else None, **equal)
    return found.select(
        "dataset", "symbol", "interval", "object_key", "min_timestamp", "max_timestamp", "row_count", "size_bytes"
    ).orderBy("min_timestamp", "object_key")


def scan_catalogued(
    spark: SparkSession,
    root: str,
    spec: LakeSpec,
    catalog: DataFrame,
    cutoff: datetime,
    interval: str | None = None,
    prefix: str | None = None,
) -> DataFrame:
    """Read only the objects the catalog says reach the cutoff.

    An object is a partition directory. Its values are taken from the key and matched with the scan's partition
    columns, the same plan for any number of objects: the date predicate prunes directories at planning, the match
    at run time. A directory that has vanished gives no rows, one that is not in the catalog is not read.
    """
    objects = catalog_objects_since(catalog, cutoff, spec.dataset, interval, prefix).select("object_key")
    values = {name: _directory_value("object_key", name) for name in spec.partition_by}
    values |= {name: F.when(values[name] == "", "00").otherwise(values[name]) for name in DATE_LEVELS}
    wanted = objects.select(*[value.alias(f"_{name}") for name, value in values.items()]).distinct()
    rows = scan_files(spark, root, spec, cutoff)
    same = [rows[name].eqNullSafe(wanted[f"_{name}"]) for name in spec.partition_by]
    return _latest_rows(rows.join(wanted, reduce(Column.__and__, same), "left_semi"), spec)


#: The prefixes that features are catalogued under, and the table that each stands for.
FEATURE_PREFIXES = {"raw/alternative/": "alt_data", "raw/macro/": "macro_data"}


def scan_features_since(
    spark: SparkSession,
    root: str,
    catalog: DataFrame,
    cutoff: datetime,
    prefixes: Mapping[str, str] = FEATURE_PREFIXES,
) -> DataFrame:
    """Observations from the cutoff on of all datasets that the catalog has below the prefixes, one per natural key.

    The catalog says which datasets there are, how their directories are split, and which objects reach the cutoff;
    only these are read. Datasets are aligned by name: ``label`` is NULL where files have none. What reaches the
    driver is a row per dataset.
    """
    found = None
    for prefix, name in prefixes.items():
        objects = catalog_objects_since(catalog, cutoff, prefix=prefix).select("object_key")
        parts = F.split("object_key", "/")
        named = F.filter(F.transform(parts, lambda part: F.regexp_extract(part, "^([^=]+)=", 1)), lambda n: ~n.isin("", *DATE_LEVELS))
        layouts = objects.select(parts[1].alias("namespace"), parts[2].alias("dataset"), named.alias("split_by")).distinct()
        for row in layouts.orderBy("namespace", "dataset").collect():
            spec = LakeSpec(row.namespace, row.dataset, LAKE_OBSERVATION_COLUMNS, OBSERVATION_KEYS, tuple(row.split_by))
            rows = scan_catalogued(spark, root, spec, catalog, cutoff, prefix=f"raw/{row.namespace}/{row.dataset}/")
            rows = rows.select(F.lit(name).alias("dataset"), *FEATURES)
            found = rows if found is None else found.unionByName(rows)
    if found is None:
        return spark.createDataFrame([], f"dataset string, {LAKE_OBSERVATION_COLUMNS}").select("dataset", *FEATURES)
    return found


FEATURES = ("source", "metric_name", "timestamp", "value", "label")


def _directory_value(key: str, name: str) -> Column:
    """The value of a partition column in an object key, as the directory name has it escaped."""
    text = F.regexp_extract(key, f"(?:^|/){name}=([^/]*)", 1)
    decoded = F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
    return F.when(text != "__HIVE_DEFAULT_PARTITION__", decoded)
