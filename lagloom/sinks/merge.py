"""Keyed last-write-wins merge into a partitioned Parquet directory."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from math import prod

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

from lagloom.operators.dedupe import keep_last
from lagloom.schemas import LakeSpec, TableSpec
from lagloom.session import remove_path, use_utc, work_path
from lagloom.sources.lake import read_existing, stored_rows

log = logging.getLogger(__name__)

# Partitions named one by one in the read filter; beyond this a range and a semi join select them.
LISTED_PARTITIONS = 500

# Most counted rows of a few names and a stamp that are broadcast: some tens of MB.
BROADCAST_ROWS = 200_000


def with_period(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Adds the month directory of a table that is split by month."""
    if "period" not in spec.partition_by or "period" in df.columns:
        return df
    return df.withColumn("period", F.date_format(spec.time_column, "yyyy-MM"))


def merged_rows(
    existing: DataFrame | None,
    incoming: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    incoming_wins: bool = True,
    incoming_rows: int | None = None,
) -> DataFrame:
    """One row per key out of both sides; the existing side has one row per key already.

    With ``incoming_wins`` a new row replaces an old one whatever its stamps, as an upsert does. Then the
    old rows are only checked against the new keys, and if the batch is known to be small its keys are
    broadcast, so that the old rows need no shuffle. Otherwise ``order`` decides first, and the new row
    wins a tie.
    """
    if existing is None:
        return keep_last(incoming, keys, order)
    if incoming_wins:
        new = keep_last(incoming, keys, order)
        known = new.select(*[F.col(name).alias(f"_{name}") for name in keys])
        if incoming_rows is not None and incoming_rows <= BROADCAST_ROWS:
            known = F.broadcast(known)
        same = _all_of([existing[name].eqNullSafe(known[f"_{name}"]) for name in keys])
        return existing.join(known, same, "left_anti").unionByName(new)
    tagged = existing.withColumn("_incoming", F.lit(0)).unionByName(incoming.withColumn("_incoming", F.lit(1)))
    return keep_last(tagged, keys, [*order, "_incoming"]).drop("_incoming")


def conformed(df: DataFrame, schema: str) -> DataFrame:
    """The declared columns in their declared types; absent ones are NULL, others are left out."""
    fields = df.sparkSession.createDataFrame([], schema).schema.fields
    return df.select(
        *[
            (F.col(field.name) if field.name in df.columns else F.lit(None)).cast(field.dataType).alias(field.name)
            for field in fields
        ]
    )


@dataclass(frozen=True)
class Touched:
    """The partitions a batch falls into; named one by one, with the row total, if they are few."""

    rows: DataFrame
    partition_by: tuple[str, ...]
    named: tuple[Row, ...] | None

    @classmethod
    def by(cls, incoming: DataFrame, partition_by: Sequence[str], listed: int = LISTED_PARTITIONS) -> Touched:
        rows = incoming.groupBy(*partition_by).agg(F.count("*").alias("_rows"))
        named = rows.limit(listed + 1).collect()
        return cls(rows, tuple(partition_by), tuple(named) if len(named) <= listed else None)

    @property
    def total(self) -> int | None:
        return None if self.named is None else sum(row["_rows"] for row in self.named)

    def select(self, stored: DataFrame) -> DataFrame:
        """The stored rows of these partitions, read from few other directories.

        The values of each column are named in the filter, or bounded by their smallest and largest if there
        are too many partitions. Either prunes directories. Unless the named values admit these partitions
        and no others, a semi join keeps exactly these.
        """
        if self.named is not None:
            values = {name: {row[name] for row in self.named} for name in self.partition_by}
            admitted = stored.where(_all_of([_is_one_of(name, found) for name, found in values.items()]))
            if len(self.named) == prod(len(found) for found in values.values()):
                return admitted
        else:
            ends = [f(name).alias(f"{tag}_{name}") for name in self.partition_by for tag, f in (("lo", F.min), ("hi", F.max))]
            bounds = self.rows.agg(*ends).first()
            inside = [
                F.col(name).isNull() | F.col(name).between(bounds[f"lo_{name}"], bounds[f"hi_{name}"])
                for name in self.partition_by
            ]
            admitted = stored.where(_all_of(inside))
        wanted = self.rows.select(*[F.col(name).alias(f"_{name}") for name in self.partition_by])
        same = _all_of([admitted[name].eqNullSafe(wanted[f"_{name}"]) for name in self.partition_by])
        return admitted.join(wanted, same, "left_semi")


def _is_one_of(name: str, values: set) -> Column:
    present = F.col(name).isin([value for value in values if value is not None])
    return present | F.col(name).isNull() if None in values else present


def _all_of(tests: list[Column]) -> Column:
    return reduce(Column.__and__, tests)


def write_partitions(df: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str] = ()) -> None:
    """zstd Parquet, replacing exactly the partitions that occur in ``df``.

    The rebalance hint lets the adaptive plan split a partition that is too large for one task and join
    those that are too small, so a hot directory is written by many tasks.
    """
    balanced = df.hint("rebalance", *partition_by)
    ordered = balanced.sortWithinPartitions(*partition_by, *sort_by)
    (
        ordered.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def staged(spark: SparkSession, rows: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Rows written to the shared folder and read back, for results that are used several times."""
    path = work_path(spark, label)
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path), path


def merge_into(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    schema: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    order: Sequence[str] = (),
    incoming_wins: bool = True,
    sort_by: Sequence[str] = (),
    listed: int = LISTED_PARTITIONS,
    lake: tuple[str, LakeSpec] | None = None,
) -> Touched:
    """Merge rows into a partitioned directory, rewriting only the partitions they touch.

    The merged partitions are written once, to the shared folder, and then change places with the files that were
    read: a run that dies half way leaves either the old partitions or a complete staged copy, and repeating the
    merge gives the same rows. Files that another writer adds meanwhile stay. For a ``lake`` (root and dataset) the
    files read may also lie in year or month directories.
    """
    use_utc(spark)
    if lake is None:
        found = read_existing(spark, schema, path)
        stored = None if found is None else found.withColumn("_path", F.col("_metadata.file_path"))
    else:
        stored = stored_rows(spark, *lake, files=True)
    new = conformed(incoming, schema)
    touched = Touched.by(new, partition_by, listed)
    if stored is None:
        # Nothing to lose yet: the first write goes straight to its place.
        write_partitions(merged_rows(None, new, keys, order), path, partition_by, sort_by)
        return touched
    admitted = touched.select(stored)
    replaced = admitted.select("_path").distinct()
    merged = merged_rows(admitted.select(*new.columns), new, keys, order, incoming_wins, touched.total)
    staging = work_path(spark, "merge")
    write_partitions(merged, staging, partition_by, sort_by)
    replaced.write.parquet(f"{staging}/{REPLACED}")
    rows = spark.read.schema(schema).parquet(staging)
    try:
        publish(rows, path, partition_by, sort_by, staging)
    except Exception:
        log.error("publishing to %s failed; the merged partitions are kept at %s", path, staging)
        raise
    remove_path(spark, staging)
    return touched


#: Beside staged partitions, hidden from readers: the files that they replace.
REPLACED = "_replaced"


def publish(
    rows: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str] = (), staging: str | None = None
) -> None:
    """Replace the partitions of ``path`` that occur in the staged rows; may be repeated.

    With the folder they are staged in, files change places and no row is written again, unless the two folders
    lie in different file systems.
    """
    spark = rows.sparkSession
    if staging is None:
        write_partitions(rows, path, partition_by, sort_by)
        return
    hadoop = spark._jvm.org.apache.hadoop.fs
    configuration = spark._jsc.hadoopConfiguration()
    source, target = hadoop.Path(staging), hadoop.Path(path)
    system = target.getFileSystem(configuration)
    together = system.getUri().equals(source.getFileSystem(configuration).getUri())
    if not together:
        write_partitions(rows, path, partition_by, sort_by)
    for row in spark.read.schema("_path string").parquet(f"{staging}/{REPLACED}").toLocalIterator():
        system.delete(hadoop.Path(spark._jvm.java.net.URI(row[0])), False)
    if not together:
        return
    base = system.makeQualified(source).toString()
    files = system.listFiles(source, True)
    while files.hasNext():
        found = files.next().getPath()
        inside = found.toString().removeprefix(base).lstrip("/")
        if "=" not in inside.split("/")[0] or not inside.endswith(".parquet"):
            continue  # markers, and the list of replaced files
        place = hadoop.Path(target, inside)
        system.mkdirs(place.getParent())
        if not system.rename(found, place):
            raise OSError(f"could not move {found.toString()} to {place.toString()}")


def last_by_outside(rows: DataFrame, keys: Sequence[str], order: Sequence[str], schema: str) -> DataFrame:
    """The last row per key if the order names columns that are not stored; else the merge decides."""
    stored = {field.name for field in StructType.fromDDL(schema).fields}
    return rows if stored.issuperset(order) else keep_last(rows, keys, order)


def upsert(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    spec: TableSpec,
    order: Sequence[str] = (),
    cheap_to_reread: bool = False,
) -> None:
    """Insert or replace by the table's natural key; of several new rows with one key the last by ``order``.

    ``order`` may name columns the table does not hold, such as the arrival of a row. A merge reads its rows more
    than once, so they are staged first, unless they already are stored or cached.
    """
    use_utc(spark)
    missing = [name for name in spec.keys if name not in rows.columns]
    if missing:
        raise ValueError(f"{spec.name}: missing key columns {missing}")
    rows = last_by_outside(rows, spec.keys, order, spec.schema)
    incoming, staging = (rows, None) if cheap_to_reread else staged(spark, rows, "incoming")
    try:
        merge_into(
            spark,
            path,
            with_period(incoming, spec),
            spec.schema,
            spec.keys,
            spec.partition_by,
            [name for name in order if name in StructType.fromDDL(spec.schema).fieldNames()],
            sort_by=[spec.time_column] if spec.time_column else (),
        )
    finally:
        if staging is not None:
            remove_path(spark, staging)
