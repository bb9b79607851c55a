"""Incremental predicates: which source rows does this run still have to read."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import utc_instant
from ..sources.readers import EPOCH_FLOOR


def static_lookback(ts: Column, as_of: datetime, hours: int = 6) -> Column:
    """Literal lower bound, which prunes Parquet row groups."""
    return ts >= utc_instant(as_of - timedelta(hours=hours))


def high_water_mark(target: DataFrame, column: str, overlap_minutes: int) -> datetime:
    """max(column) minus the overlap, read once; the floor while the target is empty."""
    top = target.agg(F.unix_micros(F.max(column))).first()[0]
    if top is None:
        return datetime.fromisoformat(EPOCH_FLOOR)
    return datetime(1970, 1, 1) + timedelta(microseconds=top) - timedelta(minutes=overlap_minutes)


def newer_than_target(source: DataFrame, target: DataFrame, column: str,
                      overlap_minutes: int, floor: str = EPOCH_FLOOR) -> DataFrame:
    """The same bound as an uncorrelated scalar subquery, resolved by Spark at run time."""
    mark = target.select(F.coalesce(
        F.max(column) - F.expr(f"INTERVAL {overlap_minutes} MINUTE"),
        F.lit(floor).cast("timestamp"))).scalar()
    return source.where(F.col(column) > mark)


def touched_keys(source: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of the keys that occur in the delta, so that totals stay whole."""
    return source.join(delta.select(*keys).distinct(), keys, "left_semi")


def day_lookback(day: Column, today: date, days: int) -> Column:
    return day >= F.lit(today - timedelta(days=days))


def month_floor(today: date, months: int) -> date:
    """First day of the month `months` before today's: a roll-up never sees half a month."""
    index = today.year * 12 + today.month - 1 - months
    return date(index // 12, index % 12 + 1, 1)


def month_lookback(day: Column, today: date, months: int) -> Column:
    return day >= F.lit(month_floor(today, months))


def month_sk_lookback(month: Column, today: date, months: int) -> Column:
    first = month_floor(today, months)
    return month >= first.year * 100 + first.month


def half_open_month(ts: Column, year: int, month: int) -> Column:
    start = datetime(year, month, 1)
    end = datetime(year + month // 12, month % 12 + 1, 1)
    return (ts >= utc_instant(start)) & (ts < utc_instant(end))


def rebuild_from(day: Column, start: date) -> Column:
    return day >= F.lit(start)


def lateness(ingested_day: Column, event_day: Column, heal_days: int = 7) -> Column:
    """How a late row reaches the daily facts: by itself, or through a backfill."""
    gap = F.date_diff(ingested_day, event_day)
    return F.when(gap <= 0, "on_time").when(gap <= heal_days, "self_heals").otherwise("backfill")
