from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .. import schema
from ..functions import parse_iso_timestamp

# Fixed value: where a high-water mark starts while the target is empty.
EPOCH_FLOOR = "2020-01-01 00:00:00"


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """The fixed 26-column ticket schema; NTZ files are read as UTC instants."""
    return conform_raw(spark.read.parquet(path))


def conform_raw(df: DataFrame) -> DataFrame:
    return df.select([F.col(n).cast(t).alias(n) for n, t in schema.RAW_COLUMNS])


def parse_feed(messages: DataFrame, body: str = "value") -> tuple[DataFrame, DataFrame]:
    """Feed messages {"rows": [...], "count": n} -> (typed rows, rejected rows)."""
    judged = judge_feed(messages, body)
    return accepted(judged), rejected(judged)


def judge_feed(messages: DataFrame, body: str = "value") -> DataFrame:
    """Typed feed rows; those that are refused have the reason and what was sent, the others neither.

    Numbers and flags may come as text, 5.0 is a whole number. A row is rejected when a cell is
    present but cannot be read as its type, or a mandatory one is absent; a message when its JSON does
    not parse, and as a whole when its count differs from its rows.
    """
    # FAILFAST would kill the job on one bad message; PERMISSIVE leaves rows NULL.
    parsed = messages.select(
        F.col(body).alias("_body"), F.from_json(F.col(body), schema.FEED_MESSAGE).alias("_m"))
    count, rows_in = F.col("_m.count"), F.size("_m.rows")
    fault = F.when(F.col("_m.rows").isNull(), "json").when(count != rows_in, "count")
    rows = parsed.select("_body", fault.alias("_fault"), F.explode_outer(
        F.when(fault.isNull(), F.col("_m.rows"))).alias("_r"))
    typed = rows.select("_body", "_r", "_fault", *[_cell(F.col(f"_r.{n}"), t).alias(n) for n, t in schema.RAW_COLUMNS])
    bad = F.array_compact(F.array(*[
        F.when(F.col("_r" if n in schema.MANDATORY else f"_r.{n}").isNotNull() & F.col(n).isNull(), F.lit(n))
        for n, _ in schema.RAW_COLUMNS]))
    judged = typed.withColumn("_reason", F.coalesce("_fault", F.nullif(F.array_join(bad, ","), F.lit(""))))
    payload = F.when(F.col("_fault").isNotNull(), F.col("_body")).when(F.col("_reason").isNotNull(), F.to_json("_r"))
    # Sent text goes no further than to the refused rows: a batch that is kept holds every cell once.
    return judged.where(F.col("_r").isNotNull() | F.col("_fault").isNotNull()).select(
        *[n for n, _ in schema.RAW_COLUMNS], payload.alias("_payload"), "_reason")


def _cell(text: Column, kind: T.DataType) -> Column:
    """The cell as its type; NULL where it cannot be read."""
    if isinstance(kind, T.TimestampType):
        return parse_iso_timestamp(text)
    if isinstance(kind, T.IntegerType):
        number = text.try_cast("decimal(38,10)")
        return F.when(number == F.floor(number), number.try_cast("int"))
    return text if isinstance(kind, T.StringType) else text.try_cast(kind)


def accepted(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("_reason").isNull()).select([n for n, _ in schema.RAW_COLUMNS])


def rejected(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("_reason").isNotNull()).select(
        F.col("_payload").alias("payload"), F.col("_reason").alias("reason"))


def to_feed(raw: DataFrame) -> DataFrame:
    """Inverse of parse_feed: one message per row, without a shuffle."""
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    cells = [F.date_format(n, iso).alias(n) if isinstance(t, T.TimestampType) else F.col(n)
             for n, t in schema.RAW_COLUMNS]
    message = F.struct(F.array(F.struct(*cells)).alias("rows"), F.lit(1).alias("count"))
    return raw.select(F.to_json(message).alias("value"))
