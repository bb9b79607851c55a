from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import functions as fn, schema
from ..plans import warehouse as wh_mod
from ..plans.warehouse import Warehouse
from ..sources import readers, storage


def raw_stream(spark: SparkSession, landing: str) -> DataFrame:
    """New ticket files of a landing folder, each read once per checkpoint."""
    stream = spark.readStream.schema(schema.RAW).option("recursiveFileLookup", "true")
    return stream.parquet(landing)


def feed_stream(spark: SparkSession, landing: str) -> DataFrame:
    return (spark.readStream.schema("value string").option("recursiveFileLookup", "true")
            .text(landing))


def drain(df: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Run `handle` on everything that is available, then stop."""
    query = (df.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps with a checkpoint: the same after a restart, another one for a
    checkpoint made anew, also in the same place."""
    meta = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(meta)["id"].replace("-", "")


def drain_ingest(spark: SparkSession, landing: str, target: str, rejects: str,
                 checkpoint: str) -> StreamingQuery:
    """Feed messages -> typed raw rows; unreadable rows go to `rejects`.

    Both sides write under the checkpoint's id and the batch number, so a batch that is retried
    after a failure replaces its own output, and never that of another checkpoint.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        judged = readers.judge_feed(batch).persist()
        try:
            number = f"{stream_id(spark, checkpoint)}-{batch_id}"
            for rows, path in ((readers.accepted(judged), target), (readers.rejected(judged), rejects)):
                storage.overwrite_partitions(rows.withColumn("ingest_batch", F.lit(number)), path,
                                             ["ingest_batch"], placed=True)
        finally:
            judged.unpersist()
    return drain(feed_stream(spark, landing), checkpoint, handle)


def drain_chain(spark: SparkSession, landing: str, wh: Warehouse, checkpoint: str,
                as_of: datetime, heal_days: int | None = None) -> StreamingQuery:
    """Micro-batches through bronze, silver, facts and marts."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        wh_mod.run_batch(spark, wh, batch, as_of, f"stream-{stream_id(spark, checkpoint)}-{batch_id}", heal_days)
    return drain(raw_stream(spark, landing), checkpoint, handle)


def deduplicated(stream: DataFrame, delay: str) -> DataFrame:
    """One row per ticket version. State is dropped once the delay has passed."""
    return (stream.withWatermark("ingested_at", delay)
            .dropDuplicatesWithinWatermark(["prblm_code", "prblm_updateddate"]))


def hourly_counts(stream: DataFrame, delay: str) -> DataFrame:
    """Tumbling hours over creation time; the watermark bounds the state."""
    return (stream.withWatermark("prblm_sysdate", delay)
            .groupBy(F.window("prblm_sysdate", "1 hour"), "catsub_id")
            .agg(F.count("*").alias("total_tickets"),
                 F.sum(fn.is_complain(F.col("prblm_complain_id"))).alias("complain_tickets"))
            .select(F.col("window.start").alias("hour_start"), "catsub_id", "total_tickets",
                    "complain_tickets"))


def append_to(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Exactly-once append through the file sink."""
    query = (df.writeStream.format("parquet").outputMode("append").option("path", path)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def keep_latest(df: DataFrame, path: str, keys: list[str], partition_col: str,
                checkpoint: str) -> StreamingQuery:
    """Update-mode aggregates merged into a stored table by key."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        # Used twice below; without this the stateful batch would run twice.
        batch.persist()
        try:
            storage.upsert(batch, path, keys, partition_col)
        finally:
            batch.unpersist()
    query = (df.writeStream.outputMode("update").foreachBatch(handle)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query
