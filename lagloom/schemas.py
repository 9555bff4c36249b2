"""Declared schemas of the stored tables, and their natural keys."""

from __future__ import annotations

from dataclasses import dataclass

CANDLE_KEYS = ("symbol", "interval", "timestamp")
OBSERVATION_KEYS = ("source", "metric_name", "timestamp")
CORRELATION_KEYS = ("dataset_a", "dataset_b", "lag_hours", "date_calculated")
CATALOG_KEYS = ("object_key",)

DECIMAL = "decimal(38,18)"
PRICE_FIELDS = ("open", "high", "low", "close", "volume")

# Lake rows keep numbers as the text they arrived in, so that no digit is lost on the way.
LAKE_CANDLE_COLUMNS = (
    "timestamp timestamp, open string, high string, low string, close string, volume string, fetched_at timestamp"
)
LAKE_OBSERVATION_COLUMNS = (
    "source string, metric_name string, timestamp timestamp, value string, label string, fetched_at timestamp"
)
CATALOG_COLUMNS = (
    "dataset string, symbol string, interval string, object_key string, min_timestamp timestamp, "
    "max_timestamp timestamp, row_count bigint, size_bytes bigint, etag string, updated_at timestamp"
)
RUN_LOG_COLUMNS = (
    "run_id string, source string, status string, fetched bigint, upserted bigint, error string, finished_at timestamp"
)


@dataclass(frozen=True)
class TableSpec:
    """A keyed table: its columns, its key and the columns its directories are split by.

    The partition columns must follow from the key, so that a key never moves between directories.
    """

    name: str
    columns: str
    keys: tuple[str, ...]
    partition_by: tuple[str, ...]
    time_column: str | None = "timestamp"

    @property
    def schema(self) -> str:
        held = {part.split()[0] for part in self.columns.split(", ")}
        extra = [f"{name} string" for name in self.partition_by if name not in held]
        return ", ".join([self.columns, *extra])


# `period` is the month of the time column (yyyy-MM), see sinks.merge.with_period.
CANDLES = TableSpec(
    "candles",
    f"symbol string, interval string, timestamp timestamp, open {DECIMAL}, high {DECIMAL}, low {DECIMAL}, "
    f"close {DECIMAL}, volume {DECIMAL}, fetched_at timestamp",
    CANDLE_KEYS,
    ("symbol", "interval", "period"),
)
ALT_DATA = TableSpec(
    "alt_data",
    f"source string, metric_name string, timestamp timestamp, value {DECIMAL}, label string, fetched_at timestamp",
    OBSERVATION_KEYS,
    ("source", "period"),
)
HOURLY_CLOSES = TableSpec(
    "hourly_closes", "symbol string, hour timestamp, close double", ("symbol", "hour"), ("symbol", "period"), "hour"
)
MACRO_DATA = TableSpec(
    "macro_data",
    f"source string, metric_name string, timestamp timestamp, value {DECIMAL}, fetched_at timestamp",
    OBSERVATION_KEYS,
    ("source", "period"),
)
CORRELATION_RESULTS = TableSpec(
    "correlation_results",
    "dataset_a string, dataset_b string, lag_hours int, pearson_r double, p_value double, sample_size bigint, "
    "date_calculated date",
    CORRELATION_KEYS,
    ("period",),
    "date_calculated",
)
LAKE_CATALOG = TableSpec("lake_catalog", CATALOG_COLUMNS, CATALOG_KEYS, ("dataset",), None)


@dataclass(frozen=True)
class LakeSpec:
    """A lake dataset: where it lies under the root and how its directories are split above the date."""

    namespace: str
    dataset: str
    columns: str
    unique_keys: tuple[str, ...]
    split_by: tuple[str, ...]

    @property
    def partition_by(self) -> tuple[str, ...]:
        return (*self.split_by, "year", "month", "day")

    @property
    def schema(self) -> str:
        return ", ".join([self.columns, *[f"{name} string" for name in self.partition_by]])

    def path(self, root: str) -> str:
        return f"{root.rstrip('/')}/raw/{self.namespace}/{self.dataset}"


def candle_lake(dataset: str = "btc_ohlcv", namespace: str = "market") -> LakeSpec:
    return LakeSpec(namespace, dataset, LAKE_CANDLE_COLUMNS, CANDLE_KEYS, ("symbol", "interval"))


def observation_lake(source: str, namespace: str = "alternative") -> LakeSpec:
    return LakeSpec(namespace, source, LAKE_OBSERVATION_COLUMNS, OBSERVATION_KEYS, ("metric",))
