from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Best row per key.

    The rank filter lets Spark place a group limit in front of the shuffle: each
    map task sends at most one row per key, so a key with very many versions
    does not gather in one task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def latest_cdc(df: DataFrame, keys: list[str], order: list[Column],
               op: str = "_cdc_op", delete: str = "d") -> DataFrame:
    """Latest change per key, then without the keys whose latest change deletes."""
    return latest_per_key(df, keys, order).where(F.col(op) != delete)


def ticket_version_order() -> list[Column]:
    """Total order over versions of one ticket, newest first."""
    return [F.col("prblm_updateddate").desc_nulls_last(), F.col("ingested_at").desc_nulls_last(),
            F.col("prblm_status_id").desc_nulls_last(), F.col("prblm_donedate").desc_nulls_last()]
