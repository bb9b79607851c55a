"""Hot-tier metrics straight from raw tickets: the UTC-day dialect.

Definitions differ from the gold facts on purpose: resolved means status 5,
forwarded means a forward type, within SLA means done at first contact and closed.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import rounded_pct, safe_ratio
from ..schema import TICKET_DIMS

CLOSED = 5


def _measures() -> list[Column]:
    closed = F.col("prblm_status_id") == CLOSED
    once = F.col("prblm_doneatatime")

    def mean_hours(end: str) -> Column:
        minutes = F.timestamp_diff("MINUTE", F.col("prblm_sysdate"), F.col(end))
        # Minutes are whole, so their sum is exact whatever the task order.
        return F.sum(minutes).cast("double") / (F.nullif(F.count(minutes), F.lit(0)) * 60.0)

    return [
        F.count("*").alias("total_tickets"),
        F.count_if(closed).alias("resolved_tickets"),
        F.count_if(once).alias("one_shot_resolved"),
        F.count_if(F.col("prblm_complain_id") >= 2).alias("complain_tickets"),
        F.count_if(F.col("prblm_forwardtype").isNotNull()).alias("forwarded_tickets"),
        F.count_if(once & closed).alias("within_sla_tickets"),
        mean_hours("prblm_donedate").alias("avg_resolution_hours"),
        mean_hours("prblm_preassignenddate").alias("avg_response_hours"),
    ]


def raw_daily(raw: DataFrame) -> DataFrame:
    days = raw.groupBy(F.to_date("prblm_sysdate").alias("date_sk"), *TICKET_DIMS).agg(*_measures())
    total = F.col("total_tickets")
    return days.withColumns({
        "pct_resolved": rounded_pct(F.col("resolved_tickets"), total, 2),
        "pct_within_sla": rounded_pct(F.col("within_sla_tickets"), total, 2),
        "pct_one_shot": rounded_pct(F.col("one_shot_resolved"), total, 2)})


def raw_hourly(raw: DataFrame) -> DataFrame:
    return raw.groupBy(F.to_date("prblm_sysdate").alias("date_sk"),
                       F.hour("prblm_sysdate").alias("hour_of_day"), *TICKET_DIMS).agg(*_measures())


def hour_today(hours: DataFrame, today: date) -> DataFrame:
    """Today's hot rows from the gold hours, in integer counts."""
    from .facts import COUNTS
    c = F.col
    return hours.where(c("prblm_date") == F.lit(today)).select(
        c("prblm_date").alias("date_sk"), c("prblm_hour").alias("hour_of_day"), *TICKET_DIMS,
        *[c(n).cast("bigint").alias(n) for n in COUNTS],
        safe_ratio(c("sum_resolution_hours"), c("cnt_resolution_hours")).alias("avg_resolution_hours"),
        safe_ratio(c("sum_response_hours"), c("cnt_response_hours")).alias("avg_response_hours"))
