"""Orders: text change rows -> typed current orders -> customer-hour metrics -> user mart."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from .. import functions as fn
from ..operators import registry as reg
from ..operators.dedup import latest_cdc
from ..operators.registry import ORDER_METRICS
from ..sources import storage

c = F.col


def customer_sk(ident: Column) -> Column:
    return fn.entity_key("customer", ident)


def order_changes(orders: DataFrame) -> DataFrame:
    """Change rows derived from `orders`: a create for each, an update for every tenth,
    a delete for every 50th and unreadable money in every 211th create."""
    k = c("o_orderkey")
    stamped = orders.select(
        k, "o_custkey", F.round(c("o_totalprice") * 100).cast("bigint").alias("cents"),
        F.timestamp_add("SECOND", (k * 7919) % 86400, c("o_orderdate").cast("timestamp")).alias("order_ts"),
        F.explode(F.array_compact(F.array(
            F.lit("c"), F.when(k % 10 == 0, F.lit("u")), F.when(k % 50 == 0, F.lit("d")))))
        .alias("_cdc_op"))
    step = F.when(c("_cdc_op") == "c", 0).when(c("_cdc_op") == "u", 1).otherwise(2)
    cents = c("cents") + F.when(c("_cdc_op") == "u", 1000).otherwise(0)
    text = F.concat(F.floor(cents / 100).cast("string"), F.lit("."),
                    F.lpad((cents % 100).cast("string"), 2, "0"))
    return stamped.select(
        k.cast("string").alias("order_id"), c("o_custkey").cast("string").alias("customer_id"),
        "order_ts",
        F.when((c("_cdc_op") == "c") & (k % 211 == 0), F.lit("n/a")).otherwise(text).alias("amount_raw"),
        "_cdc_op",
        F.timestamp_add("SECOND", step * 3600, c("order_ts")).alias("_cdc_ts"),
        F.timestamp_add("SECOND", step * 3600 + 300, c("order_ts")).alias("_ingested_at"))


def order_bronze(changes: DataFrame, batch_id: str) -> DataFrame:
    # Provenance texts.
    return changes.withColumns({
        "_ingested_date": F.to_date("_ingested_at"), "_source_system": F.lit("oltp_postgres"),
        "_source_table": F.lit("orders"), "_source_file_path": F.lit("manual"),
        "_batch_id": F.lit(batch_id)})


def change_order() -> list[Column]:
    return [c("_cdc_ts").desc(), c("_ingested_at").desc()]


def merge_orders(bronze: DataFrame, path: str) -> list:
    """Stored current orders by month, with tombstones of the deleted ones; returns the months."""
    rows = bronze.withColumn("month_sk", fn.month_sk(c("order_ts").cast("date")))
    return storage.merge_changes(rows, path, ["order_id"], "month_sk", change_order(), ["_cdc_ts", "_ingested_at"])


def order_silver(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Current typed orders, and current orders whose money text does not parse."""
    return typed_orders(latest_cdc(bronze, ["order_id"], change_order()))


def typed_orders(current: DataFrame) -> tuple[DataFrame, DataFrame]:
    typed = current.withColumn("amount", fn.cast_amount(c("amount_raw")))
    good = typed.where(c("amount").isNotNull()).select(
        "order_id", "customer_id", "order_ts", "amount", "_ingested_at", "_batch_id")
    bad = typed.where(c("amount").isNull()).select("order_id", "customer_id", "amount_raw", "_cdc_op")
    return good, bad


def order_hour_long(silver: DataFrame, as_of: datetime) -> DataFrame:
    """Per customer and hour: number of orders and revenue, one row per field."""
    agg = silver.groupBy(F.to_date("order_ts").alias("date_sk"), F.hour("order_ts").alias("hour"),
                         "customer_id").agg(F.count("*").alias("orders_count"),
                                            F.sum("amount").alias("revenue_amount"))
    keyed = agg.withColumns({"month_sk": fn.month_sk(c("date_sk")),
                             "entity_sk": customer_sk(c("customer_id"))})
    return (reg.unpivot(keyed, ORDER_METRICS, ["date_sk", "hour", "month_sk", "entity_sk"])
            .drop("value_double").withColumn("updated_at", fn.utc_instant(as_of)))


def order_hour_wide(long: DataFrame) -> DataFrame:
    return reg.hour_wide(long.withColumn("value_double", F.lit(None).cast("double")),
                         ORDER_METRICS, ["month_sk"])


def order_day_wide(hours: DataFrame) -> DataFrame:
    return reg.day_wide(hours, ORDER_METRICS, ["month_sk"])


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select(customer_sk(c("c_custkey")).alias("entity_sk"),
                            c("c_name").alias("customer_name"), F.lit(1).alias("is_current"))


def user_metric_day(days: DataFrame, calendar: DataFrame, customers: DataFrame,
                    from_date: date = date(1900, 1, 1)) -> DataFrame:
    """Customer-day mart. The customer side has no size bound and is left to the
    statistics; the calendar has one row per day."""
    kept = days.where(c("date_sk") >= F.lit(from_date))
    return (kept.join(calendar.select("date_sk", "year_quarter", "is_weekend"), "date_sk", "left")
            .join(customers.drop("is_current"), "entity_sk", "left")
            .select("date_sk", "month_sk", "entity_sk", "year_quarter", "is_weekend",
                    "customer_name", "orders_count", "revenue_amount", "updated_at"))
