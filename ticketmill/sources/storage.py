"""Table writes on plain Parquet directories.

Writes that replace data are partition-scoped dynamic overwrites: task output is
staged and swapped in at job commit, so a job may read the partitions it is
about to replace, survives lost executors, and can be rerun.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from datetime import date, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ..operators.dedup import latest_per_key


# Fixed value: the folder of rows without a partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

# What a write does with the frame that goes to the files, to count or note what passes.
Watch = Callable[[DataFrame], DataFrame]

# Files that a task keeps open; only rows of further partition values are sorted before they are written.
OPEN_FILES = 16


# -- file system ----------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(conf), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def size_bytes(spark: SparkSession, path: str) -> int:
    fs, target = _fs(spark, path)
    return fs.getContentSummary(target).getLength()


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def _folder(path: str, column: str, value) -> str:
    return f"{path}/{column}={NULL_PARTITION if value is None else value}"


def drop_partition(spark: SparkSession, path: str, column: str, value) -> None:
    fs, target = _fs(spark, _folder(path, column, value))
    fs.delete(target, True)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Partition directories of the first level; metadata only, no data is read."""
    fs, target = _fs(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


# -- plain writes -----------------------------------------------------------------

def read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def _spread(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """One shuffle on the partition columns; AQE splits a partition value that holds
    too many rows over several tasks and merges the small ones."""
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def _clustered(df: DataFrame, partition_by: list[str], cluster_by: list[str], placed: bool = False) -> DataFrame:
    """Rows sorted inside each file, so that row-group statistics of the cluster
    columns are narrow. Every file gets its rows in that order, so that the
    partition columns need no place in it."""
    spread = df if placed else _spread(df, partition_by)
    return spread.sortWithinPartitions(*cluster_by) if cluster_by else spread


@contextmanager
def _open_files(spark: SparkSession) -> Iterator[None]:
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def append(df: DataFrame, path: str, partition_by: list[str] = ()) -> None:
    """Append a batch. An empty one still leaves a typed table; where the table is
    partitioned it has no file yet and is read with its schema."""
    with _open_files(df.sparkSession):
        _writer(_spread(df, list(partition_by)), list(partition_by)).mode("append").parquet(path)


def replace(df: DataFrame, path: str, partition_by: list[str] = (), cluster_by: list[str] = (),
            watch: Watch | None = None) -> None:
    rows = _clustered(df, list(partition_by), list(cluster_by))
    with _open_files(df.sparkSession):
        _writer(watch(rows) if watch else rows, list(partition_by)).mode("overwrite").parquet(path)


def _writer(df: DataFrame, partition_by: list[str]):
    return df.write.partitionBy(*partition_by) if partition_by else df.write


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str],
                         cluster_by: list[str] = (), watch: Watch | None = None, placed: bool = False) -> None:
    """Replace the partitions that `df` has. Rows that were read from files of these partitions, or all
    belong to one, are `placed`: they are written where they are, without a shuffle."""
    rows = _clustered(df, partition_by, list(cluster_by), placed)
    with _open_files(df.sparkSession):
        ((watch(rows) if watch else rows).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))


def replace_slice(df: DataFrame, path: str, column: str, values: list, watch: Watch | None = None) -> None:
    """Delete the given partition values, then insert the recomputed rows.

    A value without new rows ends up empty, which dynamic overwrite alone would
    leave untouched.
    """
    spark = df.sparkSession
    before = _listing(spark, path, column, values)
    overwrite_partitions(df.where(among(F.col(column), values)), path, [column], watch=watch)
    _drop_unwritten(spark, path, column, before)


def _listing(spark: SparkSession, path: str, column: str, values) -> dict:
    fs, _ = _fs(spark, path)
    out = {}
    for value in values:
        folder = spark._jvm.org.apache.hadoop.fs.Path(_folder(path, column, value))
        if fs.exists(folder):
            out[value] = frozenset(s.getPath().getName() for s in fs.listStatus(folder))
    return out


def _drop_unwritten(spark: SparkSession, path: str, column: str, before: dict) -> None:
    """Partitions whose files did not change got no rows from the last overwrite."""
    after = _listing(spark, path, column, before)
    for value, names in before.items():
        if after.get(value) == names:
            drop_partition(spark, path, column, value)


def publish(df: DataFrame, lake_path: str, partition_by: list[str],
            hot_path: str | None = None, jdbc: dict[str, str] | None = None) -> list:
    """Lake first, then the hot tier from the lake copy, so both show the same rows.

    Only the partitions that `df` has are written, in either tier; a JDBC table loses those slices
    before they are inserted, so that publishing again adds nothing. Returns their values.
    """
    spark, column = df.sparkSession, partition_by[0]
    noted = Noted(column, df.schema[column].dataType)
    overwrite_partitions(df, lake_path, partition_by, watch=noted)
    values = noted.values()
    stored = read(spark, lake_path, df.schema).where(among(F.col(column), values))
    if hot_path:
        overwrite_partitions(stored, hot_path, partition_by)
    if jdbc:
        _delete_rows(spark, jdbc, column, values)
        options = {"batchsize": "5000", **jdbc}
        stored.write.format("jdbc").options(**options).mode("append").save()
    return values


def _delete_rows(spark: SparkSession, jdbc: dict[str, str], column: str, values: list) -> None:
    """Removes the slices of a database table over one connection of the driver."""
    login = spark._jvm.java.util.Properties()
    for key in ("user", "password"):
        if key in jdbc:
            login.setProperty(key, jdbc[key])
    connection = spark._jvm.java.sql.DriverManager.getConnection(jdbc["url"], login)
    try:
        delete = connection.prepareStatement(f"DELETE FROM {jdbc['dbtable']} WHERE {column} = ?")
        for value in values:
            delete.setString(1, str(value))
            delete.addBatch()
        delete.executeBatch()
    finally:
        connection.close()


# -- keyed writes -----------------------------------------------------------------

def touched_values(df: DataFrame, column: str) -> list:
    """Distinct partition values of a batch: as many as directories to rewrite."""
    return [r[0] for r in df.select(column).distinct().collect()]


def observed(seen: Observation) -> dict:
    """The counts of an observation; nothing where no row came to it, in which case adaptive
    execution may leave the place it stood at out of the plan."""
    try:
        return seen.get
    except Py4JJavaError:
        return {}


class Noted:
    """Notes the partition values of what a write stores, while it is written."""

    def __init__(self, column: str, kind: T.DataType):
        self.column, self.kind, self.seen = column, kind, Observation()

    def __call__(self, df: DataFrame) -> DataFrame:
        value = F.col(self.column)
        return df.observe(self.seen, F.to_json(F.collect_set(value.cast("string"))).alias("found"),
                          F.count_if(value.isNull()).alias("missing"))

    def values(self) -> list:
        seen = observed(self.seen)
        read_back = {"date": date.fromisoformat, "string": str}.get(self.kind.simpleString(), int)
        found = sorted(read_back(v) for v in json.loads(seen.get("found") or "[]"))
        return ([None] if seen.get("missing") else []) + found


def among(column: Column, values: Iterable) -> Column:
    """True for the given partition values, NULL being one where it is given."""
    known = [v for v in values if v is not None]
    found = F.coalesce(column.isin(known), F.lit(False))
    return found | column.isNull() if len(known) < len(list(values)) else found


def upsert(source: DataFrame, path: str, keys: list[str], partition_col: str,
           order: list[Column] | None = None, keys_may_move: bool = False,
           watch: Watch | None = None, also: tuple = ()) -> list:
    """Insert-or-replace on `keys`, rewriting only the partitions it touches.

    Without `order` a source row always wins. With `order` (a total order, best
    first) the best version of stored and incoming rows wins, so an old version
    that arrives late changes nothing and a rerun changes nothing. Rows without a
    partition value have a partition of their own. Partitions in `also` take part in any case.
    """
    spark = source.sparkSession
    if not exists(spark, path):
        fresh = latest_per_key(source, keys, order) if order else source
        noted = Noted(partition_col, source.schema[partition_col].dataType)
        replace(fresh, path, [partition_col], watch=lambda df: noted(watch(df) if watch else df))
        return noted.values()
    stored = read(spark, path, source.schema)
    touched = {*touched_values(source, partition_col), *also}
    if keys_may_move:
        held = stored.join(source.select(*keys).distinct(), keys, "left_semi")
        touched |= set(touched_values(held, partition_col))
    affected = stored.where(among(F.col(partition_col), list(touched)))
    if order:
        merged = latest_per_key(affected.unionByName(source), keys, order)
    else:
        merged = affected.join(source.select(*keys), keys, "left_anti").unionByName(source)
    before = _listing(spark, path, partition_col, touched if keys_may_move else also)
    overwrite_partitions(merged.select(source.columns), path, [partition_col], watch=watch)
    _drop_unwritten(spark, path, partition_col, before)
    return sorted(touched, key=lambda v: (v is not None, v))


# -- change streams with deletes ----------------------------------------------------

def merge_changes(changes: DataFrame, path: str, keys: list[str], partition_col: str, order: list[Column],
                  clock: list[str], op: str = "_cdc_op", delete: str = "d", watch: Watch | None = None) -> list:
    """Merge change rows, deletes among them, in whatever order the batches arrive.

    The deleting version of a key stays in the table as a tombstone of its keys, partition, operation
    and the columns of its clock, which `order` ranks by; nothing else of the row is kept. An older version that comes
    late loses against it and cannot bring the key back; a newer one does. A key's partition never changes.
    A delete may come without it: it goes where the key is stored, or, before its key is known, to the
    partition without a value, which every merge reads. Read the table through `live`.
    """
    spark = changes.sparkSession
    kept = [*keys, partition_col, op, *clock]
    rows = changes.select([F.col(n) if n in kept else F.when(F.col(op) != delete, F.col(n)).alias(n) for n in changes.columns])
    homeless = F.col(partition_col).isNull() & (F.col(op) == delete)
    if exists(spark, path) and not rows.where(homeless).isEmpty():
        stored = read(spark, path, rows.schema).select(*keys, F.col(partition_col).alias("_home"))
        lost = rows.where(homeless).select(*keys).distinct()
        homes = stored.join(lost, keys, "left_semi").groupBy(*keys).agg(F.max("_home").alias("_home"))
        rows = rows.join(homes, keys, "left").withColumn(
            partition_col, F.when(homeless, F.col("_home")).otherwise(F.col(partition_col))).select(changes.columns)
    return upsert(rows, path, keys, partition_col, order, watch=watch, also=(None,))


def live(table: DataFrame, op: str = "_cdc_op", delete: str = "d") -> DataFrame:
    """A merged table without its tombstones."""
    return table.where(F.col(op).isNull() | (F.col(op) != delete))


def purge_tombstones(spark: SparkSession, path: str, partition_col: str, clock: str, before: Column,
                     op: str = "_cdc_op", delete: str = "d", schema: T.StructType | None = None) -> list:
    """Drop the tombstones older than `before`, the time after which no older version can still
    arrive; only partitions that hold such are rewritten. Returns those."""
    table = read(spark, path, schema)
    old = (F.col(op) == delete) & (F.col(clock) < before)
    values = touched_values(table.where(old), partition_col)
    if values:
        replace_slice(table.where(among(F.col(partition_col), values) & ~F.coalesce(old, F.lit(False))), path, partition_col, values)
    return sorted(values, key=lambda v: (v is not None, v))


# -- schema evolution -------------------------------------------------------------

def align(df: DataFrame, target: T.StructType, policy: str) -> DataFrame:
    """Fit a batch to a stored schema.

    append_new_columns: stored columns first, then the new ones.
    sync_all_columns:   the batch decides; columns gone from it are dropped.
    ignore:             stored columns only.
    """
    have = {f.name for f in df.schema}
    stored = [(F.col(f.name).cast(f.dataType) if f.name in have
               else F.lit(None).cast(f.dataType)).alias(f.name) for f in target]
    known = {f.name for f in target}
    if policy == "append_new_columns":
        return df.select(*stored, *[c for c in df.columns if c not in known])
    if policy == "sync_all_columns":
        return df
    if policy == "ignore":
        return df.select(*stored)
    raise ValueError(f"unknown schema policy {policy!r}")


def union_evolved(stored: DataFrame, batch: DataFrame, policy: str) -> DataFrame:
    """Stored rows plus an evolved batch under the resulting schema."""
    fitted = align(batch, stored.schema, policy)
    if policy == "sync_all_columns":
        return align(stored, fitted.schema, "ignore").unionByName(fitted)
    return stored.unionByName(fitted, allowMissingColumns=True)


def append_evolved(batch: DataFrame, path: str, policy: str) -> DataFrame:
    """Store an evolved batch beside what is there. Only `sync_all_columns` can drop or retype stored
    columns, so only it rewrites the table, into a new folder that replaces the old one, which is moved
    aside first and deleted last; the others add files. Returns the table under its resulting schema."""
    spark = batch.sparkSession
    stored = read(spark, path)
    if policy == "sync_all_columns":
        fresh = f"{path}-{uuid.uuid4().hex[:8]}"
        replace(union_evolved(stored, batch, policy), fresh)
        fs, place = _fs(spark, path)
        new, aside = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (fresh, f"{fresh}-old"))
        for source, target in ((place, aside), (new, place)):
            if not fs.rename(source, target):
                raise OSError(f"{source} could not be renamed to {target}")
        fs.delete(aside, True)
        return read(spark, path)
    schema = union_evolved(stored, batch, policy).schema
    append(align(batch, stored.schema, policy), path)
    return read(spark, path, schema)


# -- maintenance ------------------------------------------------------------------

def expire(spark: SparkSession, path: str, column: str, as_of: date, retain_days: int = 730,
           buffer_days: int = 30, dry_run: bool = False) -> list[str]:
    """Drop the date partitions that end before the first day to keep; only directories are touched.

    The buffer lengthens the time that is kept, so it cannot be negative. Rows without a partition
    value have no last day and stay.
    """
    if buffer_days < 0:
        raise ValueError(f"buffer_days must not be negative, got {buffer_days}")
    keep_from = as_of - timedelta(days=retain_days + buffer_days)
    gone = []
    for value in partition_values(spark, path, column):
        if value != NULL_PARTITION and _last_day(value) < keep_from:
            gone.append(value)
            if not dry_run:
                drop_partition(spark, path, column, value)
    return gone


def _last_day(value: str) -> date:
    """Last calendar day of a day (2024-05-01) or month (202405) partition."""
    if "-" in value:
        return date.fromisoformat(value)
    year, month = int(value[:4]), int(value[4:])
    return date(year + month // 12, month % 12 + 1, 1) - timedelta(days=1)


def files_of(spark: SparkSession, path: str, column: str) -> dict[str, tuple[int, int]]:
    """{partition value: (files, bytes)}; read from metadata."""
    out = {}
    for value in partition_values(spark, path, column):
        fs, folder = _fs(spark, f"{path}/{column}={value}")
        summary = fs.getContentSummary(folder)
        out[value] = summary.getFileCount(), summary.getLength()
    return out


def files_needed(size: int, target_mb: int) -> int:
    return max(1, -(-size // (target_mb << 20)))


def fragmented(spark: SparkSession, path: str, column: str, target_mb: int = 384) -> list[str]:
    """Partitions that hold more files than their bytes need."""
    return [v for v, (files, size) in files_of(spark, path, column).items() if files > files_needed(size, target_mb)]


def compact(spark: SparkSession, path: str, partition_col: str, values: list,
            target_mb: int = 384, schema: T.StructType | None = None) -> None:
    """Rewrite partitions into as many files as their bytes need.

    Every file is one task: a partition's rows go to its files by a hash of the row, and no setting
    of the session changes.
    """
    sizes = files_of(spark, path, partition_col)
    first, count, total = {}, {}, 0
    for value in map(str, values):
        first[value], count[value] = total, files_needed(sizes[value][1], target_mb)
        total += count[value]
    if not total:
        return

    name = F.coalesce(F.col(partition_col).cast("string"), F.lit(NULL_PARTITION))

    def literal(numbers: dict[str, int]) -> Column:
        return F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])[name]

    rows = read(spark, path, schema).where(name.isin(list(first)))
    columns = rows.columns
    share = F.pmod(F.xxhash64(*columns), literal(count).cast("long"))
    dealt = rows.withColumn("_file", (literal(first) + share).cast("int")).repartitionById(total, "_file")
    (dealt.select(columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))


def count_files(spark: SparkSession, path: str) -> int:
    fs, target = _fs(spark, path)
    return fs.getContentSummary(target).getFileCount()


def bulk_load(build: Callable[[int], DataFrame], years: list[int], path: str, year_col: str) -> int:
    """Initial load in yearly slices, each an overwrite of its own partition.

    A partition appears when its slice is committed, so a load that broke off goes on with the first
    year that is missing. Returns the number of years loaded.
    """
    loaded = 0
    for year in years:
        df = build(year)
        spark = df.sparkSession
        if exists(spark, path) and str(year) in partition_values(spark, path, year_col):
            continue
        overwrite_partitions(df, path, [year_col])
        loaded += 1
    return loaded
