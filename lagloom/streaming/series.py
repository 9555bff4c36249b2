"""Hourly closes kept up to date by a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from lagloom.functions.coerce import floor_hour
from lagloom.operators.series import hourly_close
from lagloom.schemas import CANDLES, HOURLY_CLOSES
from lagloom.session import use_utc
from lagloom.sinks.merge import Touched, upsert, with_period
from lagloom.sources.lake import read_table


def hourly_close_stream(
    candles: DataFrame, candles_path: str, closes_path: str, checkpoint: str, order: tuple[str, ...] = ("fetched_at",)
) -> StreamingQuery:
    """Take candles into their table and bring the closes of the hours they fall into up to date.

    The closes of a touched hour are computed anew from all stored candles of it, so late and revised candles
    count whenever they come, and the open hour is there as well. Repeating a batch changes nothing.
    """

    def update(batch: DataFrame, batch_id: int) -> None:
        spark = use_utc(batch.sparkSession)
        upsert(spark, candles_path, batch, CANDLES, order)
        months = with_period(batch.select("symbol", "interval", "timestamp"), CANDLES).where("timestamp is not null")
        touched = months.select("symbol", floor_hour(F.col("timestamp")).alias("_hour")).distinct()
        stored = Touched.by(months, CANDLES.partition_by).select(read_table(spark, candles_path, CANDLES))
        stored = stored.withColumn("_hour", floor_hour(F.col("timestamp")))
        closes = hourly_close(stored.join(touched, ["symbol", "_hour"], "left_semi"), ["symbol"])
        upsert(spark, closes_path, closes, HOURLY_CLOSES)

    return (
        candles.writeStream.foreachBatch(update)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
