"""Incremental diff sync over a landing folder (S2 + D2 + K8 as a stream).

The source pulls "the diff since a date" again and again; here each
landed feed file is a micro-batch of a Structured Streaming file source.
Every batch keeps the newest row per id (D2) and upserts it into the
maintained stock (K8: the changed row wins).

The stock is kept in hash buckets of the id (:mod:`footlink.sources.stock`):
a batch rewrites the buckets it touches and publishes them with one pointer
row, so it never overwrites what it reads. A replayed epoch re-applies the
same changes, which yields the same stock: the sink is idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footlink.operators.diff import latest_per_key
from footlink.sources.feed import feed_header, feed_options
from footlink.sources.stock import BUCKETS, current_stock, upsert_stock

__all__ = ["current_stock", "start"]

STOCK_DROP = ["pos", "first_pos"]


def _apply_batch(stock_dir: str, buckets: int = BUCKETS):
    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        feed = batch.withColumn("pos", F.struct(F.col("_file").alias("file"), F.col("_block").alias("block"),
                                                F.monotonically_increasing_id().alias("row"))) \
                    .drop("_file", "_block")
        changes = latest_per_key(feed).drop(*STOCK_DROP)
        upsert_stock(spark, stock_dir, changes, epoch=str(epoch), buckets=buckets)
    return run


def start(spark: SparkSession, landing: str, stock_dir: str, checkpoint: str,
          available_now: bool = True, files_per_batch: int | None = None, buckets: int = BUCKETS):
    """Start the landing stream; with ``available_now`` it processes what
    has landed and stops (a scheduled incremental run)."""
    reader = feed_options(spark.readStream, feed_header(spark, landing))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    src = reader.csv(landing).na.fill("").select("*", F.col("_metadata.file_path").alias("_file"),
                                     F.col("_metadata.file_block_start").alias("_block"))
    w = src.writeStream.foreachBatch(_apply_batch(stock_dir, buckets)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
