"""Streaming forms; each reads the events as a file stream until everything has been read."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from catalogue.raw import kline_payloads
from catalogue.registry import query, rounded
from catalogue.tables import EVENT_SCHEMA, EVENTS_NOW, events
from lagloom.operators.dedupe import keep_last
from lagloom.plans.jobs import incremental_ingest
from lagloom.plans.poll import (
    RESPONSE_COLUMNS,
    PollKind,
    poll_ingest,
    poll_states,
    quote_responses,
    rate_responses,
    trend_responses,
)
from lagloom.schemas import (
    ALT_DATA,
    CANDLES,
    HOURLY_CLOSES,
    MACRO_DATA,
    PRICE_FIELDS,
    TableSpec,
    candle_lake,
    observation_lake,
)
from lagloom.session import work_path
from lagloom.sinks.lake import archive
from lagloom.sinks.merge import upsert
from lagloom.sources.lake import read_table, scan_dataset
from lagloom.sources.payloads import normalize_klines
from lagloom.streaming.ingest import (
    distinct_stream,
    dual_write,
    ingest_stream,
    landing_stream,
    payload_stream,
    read_log,
    repair_sink,
)
from lagloom.streaming.series import hourly_close_stream


def _events(spark, sf_dir):
    return landing_stream(spark, sf_dir, EVENT_SCHEMA, "events.parquet")


def _minute_observations(stream):
    """Several events of a minute share a key; the last of them is kept."""
    return stream.select(
        F.lit("events").alias("source"),
        F.col("event_type").alias("metric_name"),
        F.date_trunc("minute", "ts").alias("timestamp"),
        "value",
        F.col("ts").alias("fetched_at"),
    )


@query(
    "stream_ingest",
    """SELECT event_type AS metric_name, date_trunc('minute', ts) AS "timestamp", value FROM events
QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('minute', ts) ORDER BY ts DESC, value DESC) = 1""",
)
def _stream_ingest(spark, sf_dir):
    table, checkpoint = work_path(spark, "alt_data"), work_path(spark, "offsets")
    ingest_stream(_minute_observations(_events(spark, sf_dir)), table, ALT_DATA, checkpoint).awaitTermination()
    rows = read_table(spark, table, ALT_DATA)
    return rows.select("metric_name", "timestamp", rounded(F.col("value")).alias("value"))


@query(
    "incremental_ingest",
    """
WITH k AS (SELECT event_type, make_timestamp((epoch_us(ts) // 1000) * 1000) + m * INTERVAL 1 MINUTE AS stamp,
    value, (event_id * 7919) % 10007 AS arrival
  FROM events CROSS JOIN (SELECT unnest([0, 1]) AS m) WHERE event_id % 10 <> 3),
l AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY event_type, stamp ORDER BY arrival DESC, value DESC) = 1)
SELECT event_type AS symbol, stamp AS "timestamp", s.stored, round(value, 2) AS open, round(value + 1, 2) AS high,
  round(value + 2, 2) AS low, round(value + 3, 2) AS close, round(value + 4, 2) AS volume
FROM l CROSS JOIN (SELECT unnest(['lake', 'table']) AS stored) s""",
)
def _incremental_ingest(spark, sf_dir):
    """Candle responses landed as files, parsed on the stream, merged into the table and the lake.

    Polls overlap, and arrive in another order than their stamps have: every price is that of the last arrival.
    """
    base = work_path(spark, "ingest")
    polls = kline_payloads(spark, sf_dir, (F.col("event_id") * 7919 % 10007).alias("arrival"))
    polls.select(F.to_json(F.struct(*polls.columns))).write.text(f"{base}/landing")
    fields = F.from_json("payload", "payload string, symbol string, interval string, arrival bigint")
    rows = normalize_klines(payload_stream(spark, f"{base}/landing").select(fields.alias("f")).select("f.*"))
    lake = candle_lake()
    incremental_ingest(
        rows, f"{base}/table", CANDLES, f"{base}/lake", lake, f"{base}/log", f"{base}/offsets", EVENTS_NOW
    ).awaitTermination()
    sides = {"table": read_table(spark, f"{base}/table", CANDLES), "lake": scan_dataset(spark, f"{base}/lake", lake)}
    both = None
    for name, side in sides.items():
        prices = [rounded(F.col(price), 2).alias(price) for price in PRICE_FIELDS]
        side = side.select("symbol", "timestamp", F.lit(name).alias("stored"), *prices)
        both = side if both is None else both.unionByName(side)
    return both


@query(
    "stream_hourly_close",
    """
SELECT event_type AS symbol, date_trunc('hour', ts) + INTERVAL 1 HOUR AS hour, value AS close FROM events
QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY ts DESC, value DESC) = 1""",
)
def _stream_hourly_close(spark, sf_dir):
    """Several batches, dealt by number and not by time, so that most hours are revised; open hours included."""
    base = work_path(spark, "closes")
    rows = events(spark, sf_dir).select(
        F.col("event_type").alias("symbol"),
        F.lit("1m").alias("interval"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("close"),
        (F.col("event_id") % 3).alias("part"),
    )
    # of candles with one stamp the largest close, as the batch form has it
    rows = keep_last(rows, ["symbol", "interval", "timestamp"], ["close"])
    schema = "symbol string, interval string, timestamp timestamp, close double"
    for part in range(3):
        rows.where(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(f"{base}/landing")
        stream = landing_stream(spark, f"{base}/landing", schema, files_per_batch=1)
        hourly_close_stream(stream, f"{base}/candles", f"{base}/hours", f"{base}/offsets", ()).awaitTermination()
    return read_table(spark, f"{base}/hours", HOURLY_CLOSES).select("symbol", "hour", "close")


@query("stream_dedupe", """SELECT DISTINCT event_type, date_trunc('minute', ts) AS "timestamp" FROM events""")
def _stream_dedupe(spark, sf_dir):
    """The events in two batches, the second repeating the first."""
    minutes = TableSpec("minutes", "event_type string, timestamp timestamp", ("event_type", "timestamp"), ("event_type", "period"))
    base = work_path(spark, "minutes")
    rows = events(spark, sf_dir).select("event_type", F.date_trunc("minute", "ts").alias("timestamp"))
    for part in (rows.where(F.minute("timestamp") < 30), rows):
        part.write.mode("append").parquet(f"{base}/landing")
        stream = landing_stream(spark, f"{base}/landing", minutes.columns)
        distinct_stream(stream, f"{base}/table", minutes, f"{base}/offsets").awaitTermination()
    return read_table(spark, f"{base}/table", minutes).select("event_type", "timestamp")


STORED_SQL = "(SELECT count(*) FROM (SELECT DISTINCT event_type, date_trunc('minute', ts) FROM events))"


@query(
    "dual_write",
    f"""SELECT 'lake' AS sink, unnest(['error', 'repaired']) AS status, count(*) AS fetched,
  {STORED_SQL} AS table_rows, {STORED_SQL} AS lake_rows FROM events
UNION ALL SELECT 'table', 'ok', count(*), {STORED_SQL}, {STORED_SQL} FROM events""",
)
def _dual_write(spark, sf_dir):
    """Each sink fails once: the lost table batch is taken again, the lost lake batch repaired."""
    base = work_path(spark, "dual")
    lake = observation_lake("events")
    failures = {"table": 1, "lake": 2}

    def flaky(name, write):
        def sink(batch):
            failures[name] -= 1
            if failures[name] >= 0:
                raise OSError(f"{name} not reachable")
            write(batch)

        return sink

    def archived(batch):
        archive(spark, batch, base, lake, EVENTS_NOW, order=["polled"])

    sinks = {
        "table": flaky("table", lambda batch: upsert(spark, f"{base}/table", batch, ALT_DATA, ["fetched_at"])),
        "lake": flaky("lake", archived),
    }
    rows = _minute_observations(_events(spark, sf_dir)).withColumn("polled", F.col("fetched_at"))
    for lost in (True, False):
        try:
            dual_write(rows, sinks, f"{base}/log", f"{base}/offsets", EVENTS_NOW).awaitTermination()
        except StreamingQueryException:
            if not lost:
                raise
    repair_sink(spark, "lake", archived, f"{base}/log", EVENTS_NOW)
    counts = {"table_rows": read_table(spark, f"{base}/table", ALT_DATA), "lake_rows": scan_dataset(spark, base, lake)}
    log = read_log(spark, f"{base}/log").groupBy(F.col("source").alias("sink"), "status")
    found = log.agg(F.sum("fetched").alias("fetched"))
    return found.withColumns({name: F.lit(side.count()).cast("bigint") for name, side in counts.items()})


POLL_KINDS = (
    PollKind("rates", "fred", ("treasury_10y",), rate_responses(), required=True, granularity="month"),
    PollKind("trends", "google_trends", ("click", "error", "absent"), trend_responses, placeholders=True, granularity="month"),
    PollKind("quotes", "freight", ("close",), quote_responses(("signup", "purchase")), granularity="month"),
    PollKind("index", "broken", ("level",), rate_responses(metric="level"), required=True),
)

POLL_SQL = """
WITH r AS (SELECT *, date_trunc('hour', ts) AS run, date_trunc('day', ts)::TIMESTAMP AS day FROM events),
f AS (SELECT run, max(ts) AS fetched_at FROM r GROUP BY run),
p AS (SELECT run, 'rates' AS kind, 'treasury_10y' AS metric_name, day AS stamp, value, 0 AS place FROM r WHERE event_type = 'view'
  UNION ALL SELECT run, 'trends', event_type, ts, value, 0 FROM r
    WHERE (event_type = 'click' AND event_id % 4 <> 0) OR (event_type = 'error' AND event_id % 2 <> 0)
  UNION ALL SELECT run, 'quotes', 'close', day, value, 2 FROM r WHERE event_type = 'purchase'
  UNION ALL SELECT run, 'quotes', 'close', day, value, 1 FROM r WHERE event_type = 'signup' AND event_id % 3 <> 0),
n AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY run, kind, metric_name ORDER BY place, stamp DESC, value DESC) = 1),
e(kind, metric_name, source) AS (VALUES ('rates', 'treasury_10y', 'fred'), ('trends', 'click', 'google_trends'),
  ('trends', 'error', 'google_trends'), ('trends', 'absent', 'google_trends'), ('quotes', 'close', 'freight'), ('index', 'level', 'broken')),
s AS (SELECT f.run, f.fetched_at, e.kind, e.metric_name, e.source, n.stamp, n.value,
    CASE WHEN n.value IS NOT NULL THEN 'ok' WHEN e.kind IN ('rates', 'index') THEN 'error' ELSE 'skip' END AS status
  FROM f CROSS JOIN e LEFT JOIN n ON n.run = f.run AND n.kind = e.kind AND n.metric_name = e.metric_name)"""


def _responses(spark, sf_dir):
    """Hourly poll runs made of the events: one kind is never readable, one series never there."""
    text = lambda column: column.cast("string")
    point = F.struct(text(F.col("ts")).alias("timestamp"), F.when(
        (F.col("event_type") == "click") | (F.col("event_id") % 2 != 0), text(F.col("value"))).otherwise("none").alias("value"))
    quote = F.struct(F.date_format("ts", "yyyy-MM-dd").alias("date"), text(F.col("value")).alias("close"))
    rates = F.format_string(
        "observation_date,DGS10\r\n%s,%s\r\n%s,.", F.date_format("ts", "yyyy-MM-dd"), text(F.col("value")),
        F.date_format(F.date_add("ts", 1), "yyyy-MM-dd"))
    broken = F.lit('{"cut')
    of = lambda kind, payload, *types: F.when(
        F.col("event_type").isin(*types), F.struct(F.lit(kind).alias("kind"), payload.alias("payload")))
    trends = F.when((F.col("event_type") == "click") & (F.col("event_id") % 4 == 0), broken).otherwise(
        F.to_json(F.struct(F.array(point).alias("points"))))
    quotes = F.when((F.col("event_type") == "signup") & (F.col("event_id") % 3 == 0), broken).otherwise(
        F.to_json(F.struct(F.array(quote).alias("quotes"))))
    responses = F.array_compact(F.array(
        of("rates", rates, "view"), of("trends", trends, "click", "error"), of("quotes", quotes, "signup", "purchase"),
        of("index", broken, "view", "click")))
    rows = events(spark, sf_dir).select(
        text(F.date_trunc("hour", "ts")).alias("run_id"), F.col("ts").alias("fetched_at"),
        F.col("event_type").alias("symbol"), F.explode(responses).alias("_response"))
    return rows.select("run_id", "fetched_at", "_response.kind", "symbol", "_response.payload")


@query(
    "poll_ingest",
    POLL_SQL + """,
o AS (SELECT source, metric_name, CASE WHEN status = 'skip' THEN date_trunc('day', fetched_at)::TIMESTAMP ELSE stamp END AS "timestamp",
    value, fetched_at FROM s WHERE status = 'ok' OR (status = 'skip' AND kind = 'trends')),
l AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY source, metric_name, "timestamp" ORDER BY fetched_at DESC) = 1)
SELECT source, metric_name, "timestamp", round(value, 6) AS value, k.stored FROM l CROSS JOIN (SELECT unnest(['lake', 'table']) AS stored) k""",
)
def _poll_ingest(spark, sf_dir):
    """Landed in two parts, each run in one file."""
    base = work_path(spark, "poll")
    rows = _responses(spark, sf_dir)
    early = F.col("fetched_at") < F.lit("2024-01-15").cast("timestamp")
    for part in (rows.where(early), rows.where(~early)):
        part.repartition("run_id").write.mode("append").parquet(f"{base}/landing")
        stream = landing_stream(spark, f"{base}/landing", RESPONSE_COLUMNS)
        poll_ingest(
            stream, POLL_KINDS, f"{base}/tables", f"{base}/lake", f"{base}/log", f"{base}/offsets", EVENTS_NOW
        ).awaitTermination()
    both = read_table(spark, f"{base}/tables/macro_data", MACRO_DATA).select(
        "source", "metric_name", "timestamp", "value", F.lit("table").alias("stored"))
    for source in ("fred", "google_trends", "freight"):
        side = scan_dataset(spark, f"{base}/lake", observation_lake(source, "macro"))
        both = both.unionByName(side.select(*both.columns[:-1], F.lit("lake").alias("stored")))
    return both.withColumn("value", rounded(F.col("value")))


@query(
    "poll_status",
    POLL_SQL + """
SELECT kind, metric_name, status, count(*) AS runs, min(fetched_at) AS first_run, max(fetched_at) AS last_run FROM s GROUP BY ALL""",
)
def _poll_status(spark, sf_dir):
    states = None
    for kind in POLL_KINDS:
        own = poll_states(_responses(spark, sf_dir), kind).withColumn("kind", F.lit(kind.name))
        states = own if states is None else states.unionByName(own)
    return states.groupBy("kind", "metric_name", "status").agg(
        F.count("*").alias("runs"), F.min("fetched_at").alias("first_run"), F.max("fetched_at").alias("last_run"))
