"""Keyed selection of rows: the last per key, the newest few."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest by ``order``, then by the remaining columns, texts of numbers as numbers.

    An aggregate rather than a ranking window: each task reduces its own rows before the shuffle, so a
    key with a third of all rows costs no more than any other. Ordering by every column makes the
    outcome independent of task order. NULL keys form a group of their own.
    """
    rest = [name for name in df.columns if name not in keys]
    ranked = [*order, *[name for name in rest if name not in order]]
    if not rest:
        return df.distinct()
    # Key columns named in the order are constant within a group, so they need not be carried.
    carried = [name for name in ranked if name not in keys]
    texts = {field.name for field in df.schema.fields if field.dataType.simpleString() == "string"}
    ranks = []
    for name in carried:
        if name in texts:  # "10.1" is more than "9.5", in the lake as in the tables
            ranks.append(F.col(name).try_cast("double").alias(f"_number_{name}"))
        ranks.append(F.col(name))
    last = df.groupBy(*keys).agg(F.max(F.struct(*ranks)).alias("_last"))
    picked = {name: F.col("_last").getField(name).alias(name) for name in rest}
    return last.select(*[picked.get(name, F.col(name)) for name in df.columns])


def newest(df: DataFrame, n: int, time: str = "timestamp", ties: Sequence[str] = ()) -> DataFrame:
    """The n newest rows overall; every task keeps n rows, one merges them."""
    return df.orderBy(F.col(time).desc(), *ties).limit(n)


def newest_per_group(
    df: DataFrame, n: int, by: Sequence[str], time: str = "timestamp", ties: Sequence[str | Column] = ()
) -> DataFrame:
    """The n newest rows of each group.

    The rank filter lets Spark cut each group to n rows per task before the shuffle, so a large group
    does not travel.
    """
    order = Window.partitionBy(*by).orderBy(F.col(time).desc(), *ties)
    return df.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n).drop("_rank")


def in_time_order(df: DataFrame, *columns: str) -> DataFrame:
    """Rows sorted for output: range-partitioned, never gathered in one task."""
    return df.orderBy(*columns)
