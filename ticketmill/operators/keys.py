"""Managed surrogate keys: a stored map from natural keys to ids, for what hashing cannot tell apart.

Hash keys are never negative. Managed ids are, and dense: -1, -2, ... in the order in which natural
keys came, so that both kinds fit one column. A natural key that has an id keeps it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import utc_instant
from ..session import scratch_path
from ..sources import storage
from .quality import hash_collisions

MAP = "natural_key string, managed_sk bigint, batch_id string"
INCIDENTS = "entity_sk bigint, natural_key_count bigint, natural_keys array<string>, detected_at timestamp, batch_id string"
# Natural keys that an incident lists; its count has all of them.
LISTED = 20


def key_map(spark: SparkSession, path: str) -> DataFrame:
    if not storage.exists(spark, path):
        return spark.createDataFrame([], MAP)
    return storage.read(spark, path, spark.createDataFrame([], MAP).schema)


def numbered(rows: DataFrame, order: str) -> DataFrame:
    """Adds `position`, from 0 without gaps, in the order of a column. Rows are sorted over all tasks;
    what is summed up in one place is a row per task."""
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "numbered")
    rows.repartitionByRange(order).sortWithinPartitions(order).withColumn(
        "_id", F.monotonically_increasing_id()).write.parquet(path)
    stored = spark.read.parquet(path).withColumn("_part", F.shiftright("_id", 33))
    sizes = stored.groupBy("_part").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"), "_first")
    return stored.join(base, "_part").withColumn(
        "position", F.col("_base") + F.col("_id") - F.col("_first")).drop("_part", "_id", "_base", "_first")


def assign(naturals: DataFrame, path: str, batch_id: str) -> DataFrame:
    """Gives ids to the natural keys (natural_key) that have none; returns the map. A batch that is
    retried under its id replaces its own rows."""
    spark = naturals.sparkSession
    known = key_map(spark, path).where(F.col("batch_id") != batch_id)
    new = naturals.select("natural_key").where("natural_key is not null").distinct().join(known, "natural_key", "left_anti")
    lowest = known.agg(F.coalesce(F.min("managed_sk"), F.lit(0))).first()[0]
    rows = numbered(new.select("natural_key"), "natural_key").select(
        "natural_key", (F.lit(lowest) - 1 - F.col("position")).alias("managed_sk"), F.lit(batch_id).alias("batch_id"))
    storage.overwrite_partitions(rows, path, ["batch_id"])
    return key_map(spark, path)


def incidents(dim: DataFrame, key: str, natural: str, at: datetime, batch_id: str) -> DataFrame:
    """One row per hash key that several natural keys share."""
    clash = hash_collisions(dim, key, natural).select(F.col(key).alias("entity_sk"), "natural_key_count")
    members = dim.select(F.col(key).alias("entity_sk"), F.col(natural).cast("string").alias("natural_key")).distinct()
    rank = F.row_number().over(Window.partitionBy("entity_sk").orderBy("natural_key"))
    first = members.withColumn("_rank", rank).where(F.col("_rank") <= LISTED).groupBy("entity_sk").agg(
        F.array_sort(F.collect_list("natural_key")).alias("natural_keys"))
    return clash.join(first, "entity_sk").withColumns({"detected_at": utc_instant(at), "batch_id": F.lit(batch_id)})


def manage(dim: DataFrame, key: str, natural: str, root: str, at: datetime, batch_id: str) -> DataFrame:
    """Logs the collisions of a dimension's hash keys, moves their members to the key map and returns
    the dimension with keys of its own for each natural key.

    The log (`incidents`) and the map (`keys`) lie under `root`.
    """
    spark = dim.sparkSession
    storage.overwrite_partitions(incidents(dim, key, natural, at, batch_id), f"{root}/incidents", ["batch_id"])
    found = storage.read(spark, f"{root}/incidents", spark.createDataFrame([], INCIDENTS).schema).where(F.col("batch_id") == batch_id)
    shared = found.select(F.col("entity_sk").alias(key))
    members = dim.join(shared, key, "left_semi").select(F.col(natural).cast("string").alias("natural_key"))
    return resolved(dim, key, F.col(natural), assign(members, f"{root}/keys", batch_id))


def resolved(rows: DataFrame, key: str, natural: Column, mapped: DataFrame) -> DataFrame:
    """Rows whose key is the managed one where the map has their natural key; for dimensions and
    facts alike."""
    columns = rows.columns
    ids = mapped.select(F.col("natural_key").alias("_natural"), "managed_sk")
    joined = rows.withColumn("_own", natural.cast("string")).join(ids, F.col("_own") == F.col("_natural"), "left")
    return joined.withColumn(key, F.coalesce("managed_sk", key)).select(columns)
