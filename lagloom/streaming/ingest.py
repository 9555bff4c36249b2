"""Incremental ingest of overlapping batches."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lagloom.functions.coerce import moment
from lagloom.schemas import RUN_LOG_COLUMNS, TableSpec
from lagloom.session import remove_path
from lagloom.sinks.merge import staged, upsert

log = logging.getLogger(__name__)

# Files of a batch unless told otherwise: bounds the first run over a backlog.
FILES_PER_BATCH = 1000


def landing_stream(
    spark: SparkSession, path: str, schema: str, files: str = "*.parquet", files_per_batch: int | None = FILES_PER_BATCH
) -> DataFrame:
    """New Parquet files below a path, as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files).option("recursiveFileLookup", "true")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def payload_stream(spark: SparkSession, path: str, files_per_batch: int | None = FILES_PER_BATCH) -> DataFrame:
    """Newly landed response files as a stream, one response per line, for the parsers of sources.payloads."""
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path).withColumnRenamed("value", "payload")


def ingest_stream(
    stream: DataFrame, table_path: str, spec: TableSpec, checkpoint: str, order: Sequence[str] = ("fetched_at",)
) -> StreamingQuery:
    """Merge everything that has landed into a keyed table, then stop.

    A batch replayed after a failure merges to the same rows, so delivery at least once is enough.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        upsert(batch.sparkSession, table_path, batch, spec, order)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def distinct_stream(stream: DataFrame, table_path: str, spec: TableSpec, checkpoint: str) -> StreamingQuery:
    """Rows without repeated keys, however late a repetition comes: the keyed table is what is remembered."""
    return ingest_stream(stream, table_path, spec, checkpoint, ())


@dataclass(frozen=True)
class SinkOutcome:
    """What a sink tells the run log about a batch, if all rows stored is not the whole truth."""

    status: str
    fetched: int
    upserted: int
    error: str = ""


def dual_write(
    stream: DataFrame,
    sinks: dict[str, Callable[[DataFrame], SinkOutcome | None]],
    run_log_path: str,
    checkpoint: str,
    run_ts: datetime | str,
    name: str = "ingest",
    required: Sequence[str] = ("table",),
) -> StreamingQuery:
    """Write every batch to all sinks; one that fails is logged and does not hold up the others.

    If a required sink fails, the stream fails after the other sinks and the log are written, and the next run
    takes the batch again: the merges make that harmless. A batch that another sink lost is kept in the shared
    folder ``<run_log_path>_kept`` until :func:`repair_sink` has written it. The log has one row per stream, batch
    and sink, also if a batch is repeated. A batch is staged once and read from there by all sinks. A sink that returns
    a :class:`SinkOutcome` is logged with it, else as ``ok`` with all rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows, staging = staged(spark, batch, "batch")
        entries, lost = [], None
        try:
            fetched = rows.count()
            for sink_name, sink in sinks.items():
                try:
                    told = sink(rows)
                    if not isinstance(told, SinkOutcome):
                        told = SinkOutcome("ok", fetched, fetched)
                    entries.append((f"{name}-{batch_id}", sink_name, told.status, told.fetched, told.upserted, told.error))
                except Exception as error:  # the other sinks must still be written
                    log.exception("sink %s failed for batch %s", sink_name, batch_id)
                    reason = f"{type(error).__name__}: {error}".splitlines()[0]
                    entries.append((f"{name}-{batch_id}", sink_name, "error", fetched, 0, reason))
                    if sink_name in required:
                        lost = error
                    else:
                        rows.write.mode("overwrite").parquet(f"{run_log_path}_kept/{name}/{sink_name}/{batch_id}")
            write_log(spark, entries, f"{run_log_path}/{name}/{batch_id}", run_ts)
        finally:
            remove_path(spark, staging)
        if lost is not None:
            raise lost

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_log(spark: SparkSession, entries: list[tuple], path: str, run_ts: datetime | str) -> None:
    """The log rows of one batch in a directory of their own, replaced if the batch is repeated."""
    columns = RUN_LOG_COLUMNS.rpartition(", ")[0]
    rows = spark.createDataFrame(entries, columns).withColumn("finished_at", moment(run_ts))
    rows.coalesce(1).write.mode("overwrite").parquet(path)


def read_log(spark: SparkSession, run_log_path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG_COLUMNS).option("recursiveFileLookup", "true").parquet(run_log_path)


def repair_sink(
    spark: SparkSession,
    sink_name: str,
    sink: Callable[[DataFrame], None],
    run_log_path: str,
    run_ts: datetime | str,
    name: str = "ingest",
) -> int:
    """Write the batches a sink lost, oldest first, and log each as repaired; returns how many."""
    failed = read_log(spark, run_log_path).where((F.col("source") == sink_name) & (F.col("status") == "error"))
    failed = failed.where(F.col("run_id").startswith(f"{name}-")).select("run_id", "fetched").distinct()
    batches = sorted((int(row.run_id.rpartition("-")[2]), row.fetched) for row in failed.toLocalIterator())
    done = 0
    for batch_id, fetched in batches:
        kept = f"{run_log_path}_kept/{name}/{sink_name}/{batch_id}"
        try:
            rows = spark.read.parquet(kept)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue  # repaired before
        sink(rows)
        entry = (f"{name}-{batch_id}", sink_name, "repaired", fetched, fetched, "")
        write_log(spark, [entry], f"{run_log_path}/{name}/{batch_id}-{sink_name}", run_ts)
        remove_path(spark, kept)
        done += 1
    return done
