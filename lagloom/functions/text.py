"""Text renderings: exact number text, names, times and path parts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F, types as T

ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ssxxx"


def float_text(column: Column) -> Column:
    """Shortest text that reads back as the same double: plain from 1e-4 up to 1e16, else with exponent."""
    text = column.cast("string")
    size = F.abs(column)
    whole = F.concat(column.try_cast("decimal(38,0)").cast("string"), F.lit(".0"))
    fraction = F.regexp_replace(column.try_cast("decimal(38,21)").cast("string"), r"0+$", "")
    mantissa = F.regexp_replace(F.split_part(text, F.lit("E"), F.lit(1)), r"\.0$", "")
    power = F.split_part(text, F.lit("E"), F.lit(2))
    sign = F.when(power.startswith("-"), "-").otherwise("+")
    digits = F.regexp_replace(power, "^-", "")
    digits = F.when(F.length(digits) < 2, F.concat(F.lit("0"), digits)).otherwise(digits)
    return (
        F.when(column.isNull() | F.isnan(column), F.lit(None).cast("string"))
        .when(size == float("inf"), F.when(column > 0, "inf").otherwise("-inf"))
        .when(~text.contains("E"), text)
        .when((size >= 1e-4) & (size < 1e16) & (column == F.floor(column)), whole)
        .when((size >= 1e-4) & (size < 1e16), fraction)
        .otherwise(F.concat(mantissa, F.lit("e"), sign, digits))
    )


def value_text(column: Column, data_type: T.DataType) -> Column:
    """Lake text of a value column: text stays as it is, numbers are written out, NaN becomes NULL."""
    if isinstance(data_type, T.StringType):
        return column
    if isinstance(data_type, T.DecimalType):
        plain = F.regexp_replace(column.cast("string"), r"\.0*$", "")
        return F.when(plain.contains("."), F.regexp_replace(plain, r"0+$", "")).otherwise(plain)
    if isinstance(data_type, T.FractionalType):
        return float_text(column.cast("double"))
    return column.cast("string")


def dataset_name(source: Column, metric: Column, macro_sources: Iterable[str]) -> Column:
    """``<alt_data or macro_data>.<source>.<metric>``."""
    family = F.when(source.isin(list(macro_sources)), "macro_data").otherwise("alt_data")
    return F.concat_ws(".", family, source, metric)


def path_part(column: Column) -> Column:
    """Percent-encode everything but letters, digits and ``_.-~``."""
    text = F.url_encode(column)
    for found, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        text = F.replace(text, F.lit(found), F.lit(wanted))
    return text


def iso_text(column: Column) -> Column:
    return F.date_format(column, ISO_PATTERN)


def clock_text(column: Column, zone: str = "UTC") -> Column:
    """HH:mm in the given zone."""
    return F.date_format(F.from_utc_timestamp(column, zone), "HH:mm")
