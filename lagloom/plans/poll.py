"""The poll job of the slow sources: one stream of landed responses, routed by kind to parsers and tables.

A response row has ``run_id``, ``fetched_at``, ``kind``, ``symbol`` (series, keyword or ticker) and ``payload``. Every poll
run should bring the newest observation of each series a kind expects. A series without one is a ``skip``: it gets a
NULL placeholder at midnight where the kind asks for them. Candidates of a series are asked in their order, the first
with a value counts. A kind that fails, whatever the reason, is logged and does not hold up the others.

The responses of a run land in one file, so that one batch has them all. A run was fetched when the last of its responses
was; responses without a run or a time are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lagloom.functions.coerce import exact_decimal, has_values, midnight_utc, utc_timestamp
from lagloom.operators.dedupe import keep_last
from lagloom.operators.reports import status_rollup
from lagloom.schemas import MACRO_DATA, TableSpec, observation_lake
from lagloom.session import remove_path, use_utc
from lagloom.sinks.lake import archive
from lagloom.sinks.merge import staged, upsert
from lagloom.sources.observations import first_available
from lagloom.streaming.ingest import SinkOutcome, dual_write, repair_sink

RESPONSE_COLUMNS = "run_id string, fetched_at timestamp, kind string, symbol string, payload string"

#: State of every expected series in every poll run.
POLL_STATUS = TableSpec(
    "poll_status",
    "kind string, run_id string, metric_name string, status string, timestamp timestamp, fetched_at timestamp",
    ("kind", "run_id", "metric_name"),
    ("kind",),
    "fetched_at",
)

#: What parsers make of responses.
PARSED = ("run_id", "metric_name", "timestamp", "value", "priority")


@dataclass(frozen=True)
class PollKind:
    """A kind of response: its parser, the series expected of it and how a missing one is taken.

    ``parse`` turns responses into the columns of PARSED. If the kind is ``required``, a run without one of its series
    is an error and no skip. With ``placeholders`` a skipped series is stored as NULL. A source of few rows a day may be
    archived in directories of a month or year (``granularity``).
    """

    name: str
    source: str
    expected: tuple[str, ...]
    parse: Callable[[DataFrame], DataFrame]
    required: bool = False
    placeholders: bool = False
    table: TableSpec = MACRO_DATA
    namespace: str = "macro"
    granularity: str = "day"


def _observed(rows: DataFrame, metric: Column, stamp: Column, value: Column, priority: Column | None = None) -> DataFrame:
    """The columns of PARSED; rows without a stamp or a number are left out."""
    found = rows.select(
        "run_id",
        metric.alias("metric_name"),
        stamp.alias("timestamp"),
        F.when(exact_decimal(value).isNotNull(), F.trim(value)).alias("value"),
        (F.lit(0) if priority is None else priority).cast("int").alias("priority"),
    )
    return has_values(found, "metric_name", "timestamp", "value")


def rate_responses(series: str = "DGS10", metric: str = "treasury_10y") -> Callable[[DataFrame], DataFrame]:
    """A CSV with header per response; the date column is ``observation_date`` or ``DATE``."""

    def parse(responses: DataFrame) -> DataFrame:
        lines = F.split(F.trim("payload"), r"\r?\n")
        header = F.split(F.get(lines, 0), ",")
        place = lambda name: F.nullif(F.array_position(header, name), F.lit(0).cast("bigint")).cast("int") - 1
        rows = responses.select(
            "run_id",
            F.coalesce(place("observation_date"), place("DATE")).alias("_date"),
            place(series).alias("_value"),
            F.explode(F.slice(lines, 2, F.greatest(F.size(lines), F.lit(1)))).alias("_line"),
        )
        cell = lambda at: F.get(F.split("_line", ","), F.col(at))
        return _observed(rows, F.lit(metric), midnight_utc(cell("_date")), cell("_value"))

    return parse


def trend_responses(responses: DataFrame) -> DataFrame:
    """``{"points": [{"timestamp", "value"}]}`` per response, the keyword in ``symbol``."""
    points = F.from_json("payload", "points array<struct<timestamp: string, value: string>>").getField("points")
    rows = responses.select("run_id", "symbol", F.explode(points).alias("_point"))
    return _observed(rows, F.col("symbol"), utc_timestamp(F.col("_point.timestamp")), F.col("_point.value"))


def quote_responses(tickers: Sequence[str], metric: str = "close") -> Callable[[DataFrame], DataFrame]:
    """``{"quotes": [{"date", "close"}]}`` per response; the tickers are candidates for one series, best first."""

    def parse(responses: DataFrame) -> DataFrame:
        quotes = F.from_json("payload", "quotes array<struct<date: string, close: string>>").getField("quotes")
        rank = F.array_position(F.lit(list(tickers)), F.col("symbol"))
        rows = responses.select("run_id", rank.alias("_rank"), F.explode(quotes).alias("_quote")).where("_rank > 0")
        return _observed(rows, F.lit(metric), midnight_utc(F.col("_quote.date")), F.col("_quote.close"), F.col("_rank"))

    return parse


def newest_of_run(parsed: DataFrame) -> DataFrame:
    """Per run and series the newest row of the first candidate that has any."""
    series = ["run_id", "metric_name"]
    return keep_last(first_available(parsed, series), series, ["timestamp"]).drop("priority")


def poll_states(responses: DataFrame, kind: PollKind) -> DataFrame:
    """One row per run and expected series: run_id, fetched_at, metric_name, timestamp, value, status.

    Runs are those of all responses, of whatever kind, so that one without any response of this kind counts as well.
    A series that is found though it isn't expected comes along.
    """
    known = has_values(responses, "run_id", "fetched_at")
    runs = known.groupBy("run_id").agg(F.max("fetched_at").alias("fetched_at"))
    expected = runs.select("run_id", F.explode(F.lit(list(kind.expected))).alias("metric_name"))
    found = newest_of_run(kind.parse(known.where(F.col("kind") == kind.name)).select(*PARSED))
    states = expected.join(found, ["run_id", "metric_name"], "full_outer").join(runs, "run_id")
    missing = "error" if kind.required else "skip"
    return states.withColumn("status", F.when(F.col("value").isNull(), missing).otherwise("ok"))


def observations_of(states: DataFrame, kind: PollKind) -> DataFrame:
    """What the states leave to store: the values found, and placeholders if the kind has them."""
    midnight = F.date_trunc("day", "fetched_at")
    rows = states.select(
        F.lit(kind.source).alias("source"),
        "metric_name",
        F.when(F.col("status") == "skip", midnight).otherwise(F.col("timestamp")).alias("timestamp"),
        "value",
        "fetched_at",
        F.col("run_id").alias("_run"),
        F.col("fetched_at").alias("polled"),
        "status",
    )
    stored = ("ok", "skip") if kind.placeholders else ("ok",)
    return rows.where(F.col("status").isin(*stored)).drop("status")


def kind_sink(kind: PollKind, tables: str, root: str, run_ts: datetime | str) -> Callable[[DataFrame], SinkOutcome]:
    """Writes one kind of a batch to its table, to the lake and to the table of states."""

    def write(batch: DataFrame) -> SinkOutcome:
        spark = use_utc(batch.sparkSession)
        states, staging = staged(spark, poll_states(batch, kind), "poll")
        try:
            # of rows with one stamp that of the later run, and of runs fetched at one time that of the greater id
            rows = keep_last(observations_of(states, kind), kind.table.keys, ["polled", "_run"])
            rows, kept = staged(spark, rows, "polled")
            try:
                stored = rows.count()
                if stored:
                    upsert(spark, f"{tables}/{kind.table.name}", rows, kind.table, cheap_to_reread=True)
                    lake = observation_lake(kind.source, kind.namespace)
                    archive(spark, rows, root, lake, run_ts, kind.granularity, f"{root}/catalog")
            finally:
                remove_path(spark, kept)
            told = states.withColumn("kind", F.lit(kind.name))
            upsert(spark, f"{tables}/{POLL_STATUS.name}", told, POLL_STATUS, cheap_to_reread=True)
            rolled = status_rollup(told, ["kind"]).first()
            lacks = F.when(F.col("status") != "ok", F.col("metric_name"))  # at most the expected series
            found, lacking = states.agg(F.count_if(F.col("status") == "ok"), F.array_sort(F.collect_set(lacks))).first()
        finally:
            remove_path(spark, staging)
        status = "skip" if rolled is None else rolled["status"]
        if kind.required and lacking and not found:
            status = "error"
        return SinkOutcome(status, found, stored, f"without {', '.join(lacking)}" if lacking else "")

    return write


def poll_ingest(
    responses: DataFrame,
    kinds: Sequence[PollKind],
    tables: str,
    root: str,
    run_log_path: str,
    checkpoint: str,
    run_ts: datetime | str,
) -> StreamingQuery:
    """Take in all landed responses; ``responses`` is a stream with RESPONSE_COLUMNS.

    The run log has a row per batch and kind: ``ok``, ``skip`` or ``partial`` by the states of its series, ``error`` if a
    required kind found nothing, or if the kind could not be written. Such a batch is kept for :func:`repair_kind`. Kinds
    that nobody expects are left alone.
    """
    sinks = {kind.name: kind_sink(kind, tables, root, run_ts) for kind in kinds}
    return dual_write(responses, sinks, run_log_path, checkpoint, run_ts, "poll", required=())


def repair_kind(
    spark: SparkSession, kind: PollKind, tables: str, root: str, run_log_path: str, run_ts: datetime | str
) -> int:
    """Write the batches whose rows of this kind were lost; returns how many."""
    return repair_sink(spark, kind.name, kind_sink(kind, tables, root, run_ts), run_log_path, run_ts, "poll")
