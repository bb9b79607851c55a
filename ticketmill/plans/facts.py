from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from .. import functions as fn
from ..operators import registry as reg
from ..operators.registry import TICKETS
from ..schema import DAY_KEYS, HOUR_KEYS, MEASURE, MONTH_KEYS

COUNTS = ["total_tickets", "resolved_tickets", "one_shot_resolved", "complain_tickets",
          "forwarded_tickets", "within_sla_tickets"]
# Long-fact field -> column of the wide facts.
PARTS = {"resolution_hours_sum": "sum_resolution_hours",
         "resolution_hours_cnt": "cnt_resolution_hours",
         "response_hours_sum": "sum_response_hours",
         "response_hours_cnt": "cnt_response_hours"}
ADDITIVE = [*COUNTS, *PARTS.values()]


def hour_agg(silver: DataFrame) -> DataFrame:
    """Ten additive measures per local hour and dimension combination."""
    def valid(hours: str):
        return F.when(F.col(hours) >= 0, F.col(hours))

    rows = silver.select(
        "prblm_date", fn.local_hour(F.col("prblm_sysdate")).alias("prblm_hour"),
        "catsub_id", "prblm_source_id", "prblm_class_id",
        fn.null_member(F.col("prblm_perform_id")).alias("prblm_perform_id"), "prblm_status_id",
        "is_resolved", "prblm_doneatatime", "is_complain", "is_forwarded", "within_sla",
        "resolution_hours", "response_hours")
    return rows.groupBy(*HOUR_KEYS).agg(
        F.count("*").alias("total_tickets"),
        F.sum("is_resolved").alias("resolved_tickets"),
        F.sum(F.when(F.col("prblm_doneatatime"), 1).otherwise(0)).alias("one_shot_resolved"),
        F.sum("is_complain").alias("complain_tickets"),
        F.sum("is_forwarded").alias("forwarded_tickets"),
        F.sum("within_sla").alias("within_sla_tickets"),
        F.sum(valid("resolution_hours")).cast("double").alias("resolution_hours_sum"),
        F.count(valid("resolution_hours")).alias("resolution_hours_cnt"),
        F.sum(valid("response_hours")).cast("double").alias("response_hours_sum"),
        F.count(valid("response_hours")).alias("response_hours_cnt"))


def hour_long(silver: DataFrame, as_of: datetime) -> DataFrame:
    """Canonical narrow fact: one row per hour grain and field."""
    agg = hour_agg(silver).withColumn("month_sk", fn.month_sk(F.col("prblm_date")))
    long = reg.unpivot(agg, TICKETS, ["prblm_date", "month_sk", *HOUR_KEYS[1:]])
    return long.withColumn("updated_at", fn.utc_instant(as_of))


def hour_totals(silver: DataFrame, as_of: datetime) -> DataFrame:
    """The hourly wide fact straight from silver.

    Equal to pivoting the long fact, since pivoting an unpivoted aggregate gives
    the aggregate back, at a tenth of the rows. Full builds use this one.
    """
    agg = hour_agg(silver)
    def cell(f: str):
        zero = F.coalesce(F.col(f), F.lit(0.0)) if f.endswith("_sum") else F.col(f).cast(MEASURE)
        return zero.alias(PARTS.get(f, f))
    return agg.select("prblm_date", fn.month_sk(F.col("prblm_date")).alias("month_sk"), *HOUR_KEYS[1:],
                      *[cell(f) for f in [*COUNTS, *PARTS]], fn.utc_instant(as_of).alias("updated_at"))


def registry_hours(silver: DataFrame, as_of: datetime) -> DataFrame:
    """The registry's hourly facts straight from silver; equal to its pivot of the long fact."""
    agg = hour_agg(silver).withColumns({"month_sk": fn.month_sk(F.col("prblm_date")),
                                        "updated_at": fn.utc_instant(as_of)})
    return reg.hour_wide_from_totals(agg, TICKETS, ["month_sk"])


def long_from_wide(wide: DataFrame) -> DataFrame:
    """Narrow form of stored hours: a map over the rows, without an aggregate."""
    fields = {**{c: F.col(c) for c in COUNTS},
              **{f: F.col(c) for f, c in PARTS.items()}}
    for kind in ("resolution", "response"):
        counted = F.col(f"cnt_{kind}_hours") > 0
        fields[f"{kind}_hours_sum"] = F.when(counted, F.col(f"sum_{kind}_hours"))
    keys = ["prblm_date", "month_sk", *HOUR_KEYS[1:]]
    narrow = wide.select(*keys, *[c.alias(f) for f, c in fields.items()], "updated_at")
    long = reg.unpivot(narrow, TICKETS, [*keys, "updated_at"])
    return long.select(*keys, "field_sk", "value_decimal", "value_double", "updated_at")


def hour_wide(long: DataFrame) -> DataFrame:
    keys = ["prblm_date", "month_sk", *HOUR_KEYS[1:]]
    wide = long.groupBy(*keys).agg(*reg.pivot_columns(TICKETS),
                                   F.max("updated_at").alias("updated_at"))
    return wide.select(*keys, *COUNTS,
                       *[F.col(f).alias(c) for f, c in PARTS.items()], "updated_at")


def with_ratios(wide: DataFrame) -> DataFrame:
    c = F.col
    return wide.withColumns({
        "avg_resolution_hours": fn.safe_ratio(c("sum_resolution_hours"), c("cnt_resolution_hours")),
        "avg_response_hours": fn.safe_ratio(c("sum_response_hours"), c("cnt_response_hours")),
        "pct_resolved": fn.safe_pct(c("resolved_tickets"), c("total_tickets")),
        "pct_within_sla": fn.safe_pct(c("within_sla_tickets"), c("total_tickets")),
        "pct_one_shot": fn.safe_pct(c("one_shot_resolved"), c("total_tickets")),
    })


RATIOS = ["avg_resolution_hours", "avg_response_hours", "pct_resolved", "pct_within_sla",
          "pct_one_shot"]


def _roll_up(fine: DataFrame, keys: list[str]) -> DataFrame:
    # Counts are whole: as such they are summed several times faster than as decimals.
    whole = {*COUNTS, PARTS["resolution_hours_cnt"], PARTS["response_hours_cnt"]}
    sums = [F.sum(F.col(c).cast("bigint") if c in whole else c).cast(fine.schema[c].dataType).alias(c) for c in ADDITIVE]
    coarse = fine.groupBy(*keys).agg(*sums, F.max("updated_at").alias("updated_at"))
    return with_ratios(coarse).select(*keys, *ADDITIVE, *RATIOS, "updated_at")


def day_wide(hours: DataFrame) -> DataFrame:
    return _roll_up(hours, DAY_KEYS)


def month_wide(days: DataFrame) -> DataFrame:
    return _roll_up(days.withColumn("month_sk", fn.month_sk(F.col("prblm_date"))), MONTH_KEYS)
