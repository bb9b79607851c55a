"""Event activity per hour: a non-additive field and a weighted ratio."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from ..functions import month_sk, utc_instant
from ..operators import registry as reg
from ..operators.registry import ACTIVITY

CONVERSION = "purchase"


def activity_hour_long(events: DataFrame, as_of: datetime) -> DataFrame:
    """Events, distinct users, sessions (users with any event) and conversions per hour.

    Rows are first reduced to one per user, so that the distinct count of a very
    busy event type is spread over its users instead of gathering in one group.
    """
    ts = F.col("ts").cast("timestamp")
    keys = [F.to_date(ts).alias("date_sk"), F.hour(ts).alias("hour"), F.col("event_type")]
    per_user = events.groupBy(*keys, "user_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("value") > 10).alias("wins"))
    agg = per_user.groupBy("date_sk", "hour", "event_type").agg(
        F.sum("n").alias("events_count"), F.count("user_id").alias("active_users"),
        F.count_if(F.col("wins") > 0).alias("conversions"), F.count("*").alias("sessions"))
    agg = agg.withColumn("month_sk", month_sk(F.col("date_sk")))
    return (reg.unpivot(agg, ACTIVITY, ["date_sk", "hour", "month_sk", "event_type"])
            .withColumn("updated_at", utc_instant(as_of)))
