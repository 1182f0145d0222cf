"""Incremental ingestion with Structured Streaming: upserts, late data, de-duplication, expiry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from indexloom.operators.upsert import read_version, upsert, write_version


def files(spark: SparkSession, path: str, schema: str, max_files: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def upserting(stream: DataFrame, table: str, keys: list[str], update: list[str], seq: list[str], checkpoint: str) -> StreamingQuery:
    """Each micro-batch is upserted into a versioned table.  A batch replayed after a failure changes nothing."""

    def write(batch: DataFrame, _: int) -> None:
        write_version(upsert(read_version(batch.sparkSession, table), batch, keys, update, [F.col(s).desc_nulls_last() for s in seq]), table)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def deduplicated(stream: DataFrame, keys: list[str], time: str, late: str = "7 days") -> DataFrame:
    """First row of a key within the watermark."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def windowed(stream: DataFrame, time: str, by: list[str], value: str, size: str = "1 hour", slide: str | None = None, late: str = "1 day") -> DataFrame:
    """Count, sum and mean by window (tumbling, or sliding with ``slide``); also on a batch table."""
    w = F.window(time, size, slide) if slide else F.window(time, size)
    out = stream.withWatermark(time, late) if stream.isStreaming else stream
    agg = out.groupBy(w.alias("w"), *by).agg(F.count("*").alias("n"), F.round(F.sum(value), 4).alias("total"), F.round(F.avg(value), 6).alias("mean"))
    return agg.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n", "total", "mean")


def sessions(stream: DataFrame, time: str, by: list[str], gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    """Sessions that end after a ``gap`` without rows."""
    out = stream.withWatermark(time, late) if stream.isStreaming else stream
    agg = out.groupBy(F.session_window(time, gap).alias("w"), *by).agg(F.count("*").alias("n"))
    return agg.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n")


def unexpired(df: DataFrame, at: str, now: Column, ttl_seconds: int) -> DataFrame:
    return df.where(F.unix_timestamp(now) - F.unix_timestamp(at) <= ttl_seconds)
