from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import safe_ratio
from ..operators.joins import lookup
from ..operators.windows import day_lookback
from ..schema import DAY_KEYS, MEASURE, TICKET_DIMS
from . import dims as d
from .facts import ADDITIVE, COUNTS, PARTS, RATIOS, with_ratios

# Serving window, refresh window, tier tags.
SERVING_DAYS, REFRESH_DAYS = 730, 3
BATCH_TIER, INTRADAY_TIER = "batch", "intraday_hourly_sum"

LABELS = ["product_name", "catsub_region", "catsub_code", "source_name_zh", "source_name_en",
          "status_name_zh", "status_name_en", "perform_name", "sla_hours"]


def star(fact: DataFrame) -> DataFrame:
    """Fact plus labels of its four fixed dimensions; unmatched facts stay."""
    spark = fact.sparkSession
    labelled = fact
    for dim, key in (
            (d.dim_catsub(spark).withColumnRenamed("region", "catsub_region"), "catsub_id"),
            (d.dim_source(spark), "prblm_source_id"),
            (d.dim_status(spark), "prblm_status_id"),
            (d.dim_perform(spark).drop("sla_desc"), "prblm_perform_id")):
        labelled = lookup(labelled, dim, key, fixed=True)
    return labelled


def serving_window(day: Column, today: date, refresh: bool) -> Column:
    return day_lookback(day, today, REFRESH_DAYS if refresh else SERVING_DAYS)


def ticket_daily(days: DataFrame, today: date, refresh: bool = False) -> DataFrame:
    kept = days.where(serving_window(F.col("prblm_date"), today, refresh))
    return star(kept).select(
        F.col("prblm_date").alias("date_sk"), *TICKET_DIMS, *LABELS, *ADDITIVE, *RATIOS,
        "updated_at")


def ticket_hourly(hours: DataFrame, today: date, refresh: bool = False) -> DataFrame:
    kept = hours.where(serving_window(F.col("prblm_date"), today, refresh))
    c = F.col
    return star(kept).select(
        c("prblm_date").alias("date_sk"), c("prblm_hour").alias("hour_of_day"),
        *TICKET_DIMS, *LABELS, *ADDITIVE,
        safe_ratio(c("sum_resolution_hours"), c("cnt_resolution_hours")).alias("avg_resolution_hours"),
        safe_ratio(c("sum_response_hours"), c("cnt_response_hours")).alias("avg_response_hours"),
        "updated_at")


def intraday_tier(hours: DataFrame, today: date) -> DataFrame:
    """Today's hours summed to day grain: the speed tier of the report."""
    now = hours.where(F.col("prblm_date") == F.lit(today))
    sums = now.groupBy(*DAY_KEYS).agg(
        *[F.sum(c).cast(MEASURE).alias(c) for c in [*COUNTS, PARTS["resolution_hours_cnt"],
                                                    PARTS["response_hours_cnt"]]],
        *[F.sum(c).alias(c) for c in (PARTS["resolution_hours_sum"], PARTS["response_hours_sum"])],
        F.max("updated_at").alias("updated_at"))
    return with_ratios(sums).withColumn("source_tier", F.lit(INTRADAY_TIER))


def batch_tier(days: DataFrame, today: date, refresh: bool = False) -> DataFrame:
    """Settled days before today."""
    window = serving_window(F.col("prblm_date"), today, refresh)
    return (days.where(window & (F.col("prblm_date") < F.lit(today)))
            .withColumn("source_tier", F.lit(BATCH_TIER)))


def tiered_union(batch: DataFrame, intraday: DataFrame, columns: list[str]) -> DataFrame:
    return batch.select(columns).unionByName(intraday.select(columns))


def daily_report(days: DataFrame, hours: DataFrame, today: date, refresh: bool = False) -> DataFrame:
    """Settled days and today in one table; labels are joined once, after the union."""
    cols = [*DAY_KEYS, *COUNTS, *RATIOS, "source_tier", "updated_at"]
    both = tiered_union(batch_tier(days, today, refresh), intraday_tier(hours, today), cols)
    return star(both).select(
        F.col("prblm_date").alias("date_sk"), *TICKET_DIMS, *LABELS, *COUNTS, *RATIOS,
        "source_tier", F.col("prblm_date").alias("freshness_as_of"), "updated_at")
