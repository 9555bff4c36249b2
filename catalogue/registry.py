"""Registration of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lagloom.session import use_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``f(spark, sf_dir)``; its result leaves with zoneless timestamps, as the tables have them."""

    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return zoneless(build(use_utc(spark), sf_dir))

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def zoneless(df: DataFrame) -> DataFrame:
    casts = {
        field.name: F.col(field.name).cast("timestamp_ntz")
        for field in df.schema.fields
        if isinstance(field.dataType, T.TimestampType)
    }
    return df.withColumns(casts) if casts else df


def rounded(column, digits: int = 6):
    """Rounded double; -0.0 becomes 0.0."""
    return F.round(column.cast("double"), digits) + F.lit(0.0)
