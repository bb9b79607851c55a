"""Entity facts and dimensions as bucketed tables, which join on their key without a shuffle.

Rows of a key lie in the bucket of its hash, sorted, in every partition. Spark reads a bucket of the fact
and the same bucket of the dimension in one task; a fact at hour or day grain has a bounded number of rows
of an entity in each partition, so that no bucket follows the busiest entity's raw rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from ..sources import storage


DYNAMIC = ("partitionOverwriteMode", "dynamic")


@dataclass(frozen=True)
class Bucketed:
    """A table of the session's catalog over a folder. Tables that are to be joined need the same number
    of buckets, or one that divides the other."""
    name: str
    path: str
    key: str
    buckets: int
    partition_by: tuple[str, ...] = ()

    def store(self, df: DataFrame) -> None:
        """Replace the whole table. One task writes a bucket, so that each has one file per partition."""
        dealt = df.repartition(self.buckets, self.key).sortWithinPartitions(*self.partition_by, self.key)
        # The option stays with the table and holds for every later insert.
        writer = dealt.write.mode("overwrite").option("path", self.path).option(*DYNAMIC).bucketBy(self.buckets, self.key).sortBy(self.key)
        (writer.partitionBy(*self.partition_by) if self.partition_by else writer).saveAsTable(self.name)

    def refresh(self, df: DataFrame) -> None:
        """Swap in the partitions that `df` has; the others stay as they are."""
        spark = df.sparkSession
        order = self.read(spark).columns
        dealt = df.select(order).repartition(self.buckets, self.key).sortWithinPartitions(*self.partition_by, self.key)
        dealt.write.insertInto(self.name, overwrite=True)

    def attach(self, spark: SparkSession, schema: T.StructType) -> None:
        """Name a folder that another session stored in this session's catalog."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        parts = f"PARTITIONED BY ({', '.join(self.partition_by)})" if self.partition_by else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet OPTIONS ('{DYNAMIC[0]}' '{DYNAMIC[1]}') {parts} CLUSTERED BY ({self.key}) "
                  f"SORTED BY ({self.key}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        if self.partition_by:
            spark.sql(f"MSCK REPAIR TABLE {self.name}")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)

    def drop(self, spark: SparkSession) -> None:
        spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        if storage.exists(spark, self.path):
            storage.remove(spark, self.path)
