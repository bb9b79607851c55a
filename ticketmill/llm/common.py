"""What the operators of this subpackage share: scratch tables, row checks, running totals."""

from __future__ import annotations

import os
import site
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"

_SHIPPED: set[str] = set()

# A word is a run of bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share. One of our own is named only where the session has none,
    which a session on several machines must not leave to us."""
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"{CHECKPOINT_KEY} must name a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="ticketmill-llm-")
    spark.conf.set(CHECKPOINT_KEY, root)
    return root


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """The rows written once to the shared folder and read back: cuts the lineage and keeps
    later stages from computing them again, also when an executor is lost."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_rest(docs: DataFrame, needed: list[str]) -> DataFrame:
    """The needed columns and all others in one, `_rest`, where their names clash with nothing."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in needed]
    return docs.select(*needed, (F.struct(*others) if others else F.lit(0)).alias("_rest"))


def restored(rows: DataFrame, columns: list[str], needed: list[str]) -> DataFrame:
    """Undoes `with_rest`."""
    return rows.select(*[F.col(c) if c in needed else F.col("_rest")[c].alias(c) for c in columns])


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character unchanged."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ascii_doc_id(doc_id: Column) -> Column:
    return doc_id.cast("string").cast("binary")


def crc_bucket(doc_id: Column, parts: int) -> Column:
    """crc32(doc_id as text) mod parts; a null id counts as 0 of an empty text."""
    return F.coalesce(F.crc32(ascii_doc_id(doc_id)), F.lit(0)) % parts


def with_running_total(df: DataFrame, group: str, digits: tuple[str, str], order: list[str],
                       value: str, out: str) -> DataFrame:
    """Adds the sum of `value` over the rows before this one in its group.

    `digits` are two columns that split a group into ordered ranges and those into ordered
    sub-ranges, at most a few hundred each. A window never holds more than one sub-range, or the
    totals of the ranges of one level, so a group with most of the rows is spread over tasks.
    """
    coarse, fine = digits
    before = (Window.unboundedPreceding, -1)
    within = Window.partitionBy(group, coarse, fine).orderBy(*order).rowsBetween(*before)
    small = df.groupBy(group, coarse, fine).agg(F.sum(value).alias("_sum"))
    small = small.withColumn("_fine", F.sum("_sum").over(
        Window.partitionBy(group, coarse).orderBy(fine).rowsBetween(*before)))
    large = small.groupBy(group, coarse).agg(F.sum("_sum").alias("_all"))
    large = large.withColumn("_coarse", F.sum("_all").over(
        Window.partitionBy(group).orderBy(coarse).rowsBetween(*before))).drop("_all")
    base = small.join(large, [group, coarse]).select(
        group, coarse, fine, (F.coalesce("_fine", F.lit(0)) + F.coalesce("_coarse", F.lit(0))).alias("_base"))
    return (df.withColumn("_own", F.coalesce(F.sum(value).over(within), F.lit(0)))
            .join(base, [group, coarse, fine])
            .withColumn(out, F.col("_own") + F.col("_base")).drop("_own", "_base"))


def with_package(df: DataFrame) -> DataFrame:
    """`df`, after making sure that Python workers can import this package: where its folder is
    not on the path that they inherit, Spark distributes the source to them."""
    context = df.sparkSession.sparkContext
    package = Path(__file__).resolve().parents[1]
    inherited = {os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    if str(package.parent) not in inherited | {os.path.realpath(p) for p in site.getsitepackages()}:
        if context.applicationId not in _SHIPPED:
            archive = os.path.join(os.path.realpath(tempfile.mkdtemp()), f"{package.name}.zip")
            with zipfile.ZipFile(archive, "w") as z:
                for file in package.rglob("*.py"):
                    z.write(file, file.relative_to(package.parent))
            context.addPyFile(archive)
            _SHIPPED.add(context.applicationId)
    return df
