"""The jobs a user calls: correlation, archive, backfill, table load, sample report."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lagloom.functions.coerce import since
from lagloom.operators.correlate import lag_statistics, run_summary, significant, window_details
from lagloom.operators.reports import count_with_fallback, sample_counts, summary_with_total
from lagloom.operators.series import feature_series, hourly_close, source_samples
from lagloom.params import AnalysisParams
from lagloom.schemas import ALT_DATA, CANDLES, CORRELATION_RESULTS, LAKE_CATALOG, MACRO_DATA, LakeSpec, TableSpec
from lagloom.session import remove_path, use_utc
from lagloom.sinks.lake import LOADS, LoadSpec, archive, lake_to_table
from lagloom.sinks.merge import staged, upsert
from lagloom.sources.lake import read_closes_since, read_table, scan_catalogued
from lagloom.sources.observations import features_union
from lagloom.sources.payloads import ARRIVAL, stamped
from lagloom.streaming.ingest import dual_write, repair_sink

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class CorrelationRun:
    """One run: the hourly closes, the statistics grid and the tables read off it, all of them lazy.

    A run that has staged its grid is a context: leaving it removes the grid.
    """

    closes: DataFrame
    statistics: DataFrame
    now: datetime
    params: AnalysisParams
    input_source: str = "given"
    staging: str | None = None

    def __enter__(self) -> CorrelationRun:
        return self

    def __exit__(self, *_) -> None:
        if self.staging is not None:
            remove_path(self.statistics.sparkSession, self.staging)

    @property
    def results(self) -> DataFrame:
        return significant(self.statistics, self.now, self.params)

    @property
    def details(self) -> DataFrame:
        return window_details(self.statistics)

    @property
    def samples(self) -> DataFrame:
        return source_samples(self.details, self.params)

    @property
    def summary(self) -> DataFrame:
        """The grid's summary, where the closes came from, how many hours they have, and the stored results."""
        hours = self.closes.agg(F.count("*")).scalar()
        stored = F.col("significant") if self.staging is not None else F.lit(0)
        return run_summary(self.statistics, self.params).select(
            "*",
            F.lit(self.input_source).alias("input_source"),
            hours.alias("hourly_price_samples"),
            stored.cast("bigint").alias("upserted"),
        )


def lag_correlation(
    candles: DataFrame,
    observations: DataFrame,
    now: datetime,
    params: AnalysisParams = AnalysisParams(),
    unique_stamps: bool = False,
) -> CorrelationRun:
    """Lagged correlation of every feature series with the hourly close of one symbol.

    Both inputs are cut to the longest window first, which prunes their scans. Set ``unique_stamps`` for
    rows that come from the keyed tables or from scan_dataset.
    """
    use_utc(candles.sparkSession)
    cutoff = params.max_cutoff(now)
    closes = hourly_close(
        read_closes_since(candles, cutoff, params.interval, params.symbol), unique_stamps=unique_stamps
    )
    series = feature_series(since(observations, cutoff), unique_stamps)
    return CorrelationRun(closes, lag_statistics(series, closes, now, params), now, params)


def run_correlation(
    spark: SparkSession,
    candles: DataFrame,
    observations: DataFrame,
    now: datetime,
    results_path: str,
    params: AnalysisParams = AnalysisParams(),
    unique_stamps: bool = False,
) -> CorrelationRun:
    """Compute, store the results, and hand back the run, as a context.

    The statistics grid, a row per series and lag, is staged in the shared folder: results, details and
    summary then read it there instead of running the whole job once each.
    """
    use_utc(spark)
    run = lag_correlation(candles, observations, now, params, unique_stamps)
    grid, staging = staged(spark, run.statistics, "grid")
    run = replace(run, statistics=grid, staging=staging)
    upsert(spark, results_path, run.results, CORRELATION_RESULTS, cheap_to_reread=True)
    return run


def correlate_stored(
    spark: SparkSession,
    root: str,
    prices: LakeSpec,
    tables: str,
    now: datetime,
    results_path: str,
    params: AnalysisParams = AnalysisParams(),
) -> CorrelationRun:
    """The job over what is stored: closes from the lake, through its catalog, or else from the candle table.

    The table is taken only if the lake has no close of the symbol and interval in the longest window; the run's
    ``input_source`` says which it was. Features come from the tables.
    """
    use_utc(spark)
    cutoff = params.max_cutoff(now)
    catalog = read_table(spark, f"{root}/catalog", LAKE_CATALOG)
    candles, source = scan_catalogued(spark, root, prices, catalog, cutoff, params.interval), "lake"
    if read_closes_since(candles, cutoff, params.interval, params.symbol).isEmpty():
        log.warning("the lake has no closes of %s since %s; the candle table is used", params.symbol, cutoff)
        candles, source = read_table(spark, f"{tables}/{CANDLES.name}", CANDLES, cutoff), "table"
    features = features_union(*(read_table(spark, f"{tables}/{spec.name}", spec, cutoff) for spec in (ALT_DATA, MACRO_DATA)))
    run = run_correlation(spark, candles, features, now, results_path, params, unique_stamps=True)
    return replace(run, input_source=source)


def save_results(spark: SparkSession, path: str, results: DataFrame) -> None:
    """Store result rows; a rerun on the same day replaces them."""
    upsert(spark, path, results, CORRELATION_RESULTS)


def isolated(source: str, job: Callable[[], tuple[int, int]]) -> tuple:
    """Run one source; a failure is recorded and does not stop the others."""
    try:
        fetched, archived = job()
        return (source, "ok", fetched, archived, "")
    except Exception as error:  # the next source must still run
        log.exception("%s failed", source)
        return (source, "error", 0, 0, f"{type(error).__name__}: {error}")


RESULT_COLUMNS = "source string, status string, fetched bigint, archived bigint, error string"


@dataclass(frozen=True)
class BackfillSource:
    """One historical source: its parsed rows and where they go."""

    rows: Callable[[], DataFrame]
    lake: LakeSpec
    granularity: str = "year"


def backfill(
    spark: SparkSession,
    sources: Mapping[str, BackfillSource],
    root: str,
    run_ts: datetime | str,
    catalog_path: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Archive every source on its own; returns the results per source and the sums with a TOTAL row."""
    use_utc(spark)

    def run(source: BackfillSource) -> tuple[int, int]:
        outcome = archive(spark, source.rows(), root, source.lake, run_ts, source.granularity, catalog_path)
        return outcome.fetched, outcome.rows

    results = [isolated(name, lambda source=source: run(source)) for name, source in sources.items()]
    table = spark.createDataFrame(results, RESULT_COLUMNS)
    return table, summary_with_total(table, "fetched", "archived")


LOAD_RESULT_COLUMNS = (
    "source string, table string, status string, files bigint, failed_files bigint, rows bigint, upserted bigint, "
    "error string"
)


def load_tables(
    spark: SparkSession,
    root: str,
    tables: str,
    run_ts: datetime | str,
    specs: tuple[LoadSpec, ...] = LOADS,
    dry_run: bool = False,
) -> DataFrame:
    """Load all lake datasets into their tables below ``tables``; one row per dataset."""
    use_utc(spark)
    results = []
    for spec in specs:
        try:
            counts = lake_to_table(spark, root, spec, f"{tables.rstrip('/')}/{spec.table.name}", run_ts, dry_run)
            results.append((*counts.values(), ""))
        except Exception as error:  # the next dataset must still run
            log.exception("%s failed", spec.name)
            results.append((spec.name, spec.table.name, "error", 0, 0, 0, 0, f"{type(error).__name__}: {error}"))
    return spark.createDataFrame(results, LOAD_RESULT_COLUMNS)


def sample_report(
    observations: DataFrame, catalog: DataFrame, candles: DataFrame, params: AnalysisParams = AnalysisParams()
) -> DataFrame:
    """Sample counts of the named series and of the candle intervals: (dataset, name, samples, pending)."""
    candle_rows = count_with_fallback(catalog, candles, params.symbol, params.price_dataset).select(
        F.lit(params.price_dataset).alias("dataset"), F.col("interval").alias("name"), F.col("rows").alias("samples")
    )
    counts = sample_counts(observations).unionByName(candle_rows)
    waits = F.col("name").isin(list(params.skip_until_ready))
    return counts.withColumn("pending", waits & (F.col("samples") < params.min_samples))


def incremental_ingest(
    rows: DataFrame,
    table_path: str,
    table: TableSpec,
    root: str,
    lake: LakeSpec,
    run_log_path: str,
    checkpoint: str,
    run_ts: datetime | str,
) -> StreamingQuery:
    """Take in everything that has landed since the last run: into the table, and on its own into the lake.

    ``rows`` is a stream of parsed rows. Polls may overlap and batches may be repeated; both sides merge by
    key; of rows with one key the one that arrived last is kept, if the rows have an ``arrival``. The run log has
    one row per batch and side, which run_totals sums up. A table that can't be written fails the run, and the next
    one takes the batch again; what only the lake missed is kept for :func:`repair_lake`.
    """
    order = [ARRIVAL] if ARRIVAL in rows.columns else []
    sinks = {
        "table": lambda batch: upsert(
            batch.sparkSession, table_path, stamped(batch, run_ts), table, order, cheap_to_reread=not order
        ),
        "lake": lake_sink(root, lake, run_ts, order),
    }
    return dual_write(rows, sinks, run_log_path, checkpoint, run_ts)


def lake_sink(root: str, lake: LakeSpec, run_ts: datetime | str, order: Sequence[str] = ()) -> Callable[[DataFrame], None]:
    def write(batch: DataFrame) -> None:
        archive(batch.sparkSession, batch, root, lake, run_ts, catalog_path=f"{root}/catalog", order=order)

    return write


def repair_lake(spark: SparkSession, root: str, lake: LakeSpec, run_log_path: str, run_ts: datetime | str) -> int:
    """Archive the batches that incremental_ingest could write to the table only; returns how many."""
    use_utc(spark)

    def write(batch: DataFrame) -> None:
        lake_sink(root, lake, run_ts, [ARRIVAL] if ARRIVAL in batch.columns else [])(batch)

    return repair_sink(spark, "lake", write, run_log_path, run_ts)
