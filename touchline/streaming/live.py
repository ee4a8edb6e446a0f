"""Incremental loads as streams, and windowed live prices."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from touchline.operators.ordered import dedup_latest
from touchline.schemas import RAW
from touchline.sources.tables import upsert_table


def raw_stream(spark: SparkSession, path: str, schema: str | StructType = RAW, files_per_trigger: int | None = None) -> DataFrame:
    """A raw table directory as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def stream_upsert(
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    path: str,
    keys: Sequence[str],
    checkpoint: str,
    partition_by: Sequence[str] = (),
    version: str | None = None,
) -> StreamingQuery:
    """Load all available raw rows batch by batch into an upserted table.

    ``transform`` must leave one row per key. A replayed batch writes the same rows, so the table is
    the same after a restart. ``version`` names a column by which an older row never replaces a newer one.
    """

    def load(batch: DataFrame, _: int) -> None:
        upsert_table(transform(batch), path, keys, partition_by, version=version)

    return (
        stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def stream_dedup(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """First row per key within the watermark; state older than ``delay`` is dropped."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([*keys])


def odds_windows(
    stream: DataFrame,
    by: Sequence[str] = ("fixture_id", "bet_id", "outcome"),
    ts: str = "ts",
    price: str = "odd",
    width: str = "5 minutes",
    delay: str = "10 minutes",
    order: Sequence[str] = (),
) -> DataFrame:
    """Last, lowest, highest and mean price per key and tumbling window.

    Works on a stream (rows later than the watermark are dropped) and on a table alike.
    """
    timed = stream.withWatermark(ts, delay) if stream.isStreaming else stream
    return (
        timed.groupBy(F.window(ts, width).alias("w"), *by)
        .agg(
            F.max(F.struct(ts, *order, price)).getField(price).alias("last_odd"),
            F.min(price).alias("min_odd"),
            F.max(price).alias("max_odd"),
            F.avg(price).alias("avg_odd"),
            F.count(F.lit(1)).alias("quotes"),
        )
        .select(F.col("w.start").alias("window_start"), *by, "last_odd", "min_odd", "max_odd", "avg_odd", "quotes")
    )


def run_to_table(df: DataFrame, path: str, checkpoint: str) -> None:
    """Drain an append-mode stream into a parquet directory."""
    query = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def latest_in_batch(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Key-unique source for an upsert."""
    return dedup_latest(batch, keys, order)
