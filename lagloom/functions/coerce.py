"""Lenient parsing and time bucketing. Bad input becomes NULL; nothing here raises on data."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lagloom.schemas import DECIMAL

# What counts as a number in text: decimal or exponent notation, or an infinity. Words such as
# "1d" or "0x1f" are rejected here because a plain cast would accept some of them.
NUMBER_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)\s*$"


def utc_timestamp(column: Column) -> Column:
    """Timestamp in UTC, NULL if unparsable; text without a zone is taken as UTC."""
    return column.try_cast("timestamp")


def number(column: Column, data_type: T.DataType | None = None) -> Column:
    """Double, NULL if it is not a number or is NaN. Pass the type when it is known to be numeric."""
    if isinstance(data_type, T.NumericType):
        value = column.cast("double")
    else:
        text = column.cast("string")
        value = F.when(text.rlike(NUMBER_TEXT), F.trim(text).try_cast("double"))
    return F.when(~F.isnan(value), value)


def number_column(df: DataFrame, name: str) -> Column:
    return number(F.col(name), df.schema[name].dataType)


def exact_decimal(column: Column) -> Column:
    """Exact decimal of a text or number; NULL if it is not one."""
    return column.cast("string").try_cast(DECIMAL)


def epoch_seconds(column: Column) -> Column:
    return F.timestamp_seconds(column.try_cast("bigint"))


def epoch_millis(column: Column) -> Column:
    return F.timestamp_millis(column.try_cast("bigint"))


def midnight_utc(column: Column) -> Column:
    """Midnight UTC of the calendar date."""
    return column.try_cast("timestamp").cast("date").cast("timestamp")


def zoned_to_utc(column: Column, zone: str | None = None) -> Column:
    """A wall-clock time read in ``zone`` as UTC; without a zone it already is UTC."""
    moment = column.try_cast("timestamp")
    return F.to_utc_timestamp(moment, zone) if zone else moment


def floor_hour(column: Column) -> Column:
    return F.date_trunc("hour", column)


def bucket_start(column: Column, hours: int = 6) -> Column:
    """Start of the fixed bucket of ``hours`` hours, counted from midnight UTC."""
    width = hours * 3600
    seconds = F.unix_seconds(column)
    return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(width)))


def shift_hours(column: Column, hours: int) -> Column:
    return column + F.expr(f"INTERVAL {int(hours)} HOURS")


def moment(value: datetime | str) -> Column:
    """A timestamp literal; a datetime without zone is taken as UTC."""
    if isinstance(value, str):
        return F.lit(value).cast("timestamp")
    if value.tzinfo is None:
        value = value.replace(tzinfo=timezone.utc)
    return F.lit(value.astimezone(timezone.utc).isoformat()).cast("timestamp")


def since(df: DataFrame, cutoff: datetime | str, column: str = "timestamp") -> DataFrame:
    """Rows at or after the cutoff; on a typed column the filter reaches the Parquet scan."""
    return df.where(F.col(column) >= moment(cutoff))


def matching(df: DataFrame, prefixes: dict[str, str] | None = None, **equal) -> DataFrame:
    """Rows that equal all given values and begin with all given prefixes; both reach the scan."""
    for name, value in equal.items():
        df = df.where(F.col(name) == value)
    for name, prefix in (prefixes or {}).items():
        df = df.where(F.col(name).startswith(prefix))
    return df


def has_values(df: DataFrame, *columns: str) -> DataFrame:
    """Drop rows that miss any of the named fields."""
    return df.na.drop(subset=list(columns))


def with_absent(df: DataFrame, **defaults) -> DataFrame:
    """Add the named columns where the frame lacks them; columns that exist stay as they are."""
    absent = {
        name: value if isinstance(value, Column) else F.lit(value)
        for name, value in defaults.items()
        if name not in df.columns
    }
    return df.withColumns(absent) if absent else df
