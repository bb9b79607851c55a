from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, functions as F

LOCAL_ZONE = "Asia/Taipei"

# Weekday names, Monday first.
WEEKDAY_NAMES = ["週一", "週二", "週三", "週四", "週五", "週六", "週日"]


def local_ts(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.from_utc_timestamp(ts, zone)


def local_date(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.to_date(local_ts(ts, zone))


def local_hour(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.hour(local_ts(ts, zone))


def utc_instant(moment: datetime) -> Column:
    """Literal for a naive-UTC moment. Text, so that the driver's own zone plays no part."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(moment.isoformat(" ")).cast("timestamp")


def local_today(as_of: datetime, zone: str = LOCAL_ZONE) -> date:
    """Calendar date in `zone` at the naive-UTC instant `as_of`."""
    return as_of.replace(tzinfo=timezone.utc).astimezone(ZoneInfo(zone)).date()


def local_day_range(ts: Column, first: date, last: date, zone: str = LOCAL_ZONE) -> Column:
    """Rows whose local date lies in [first, last].

    Written on the raw instant with literal bounds, so that the predicate
    reaches the Parquet row-group statistics.
    """
    tz = ZoneInfo(zone)
    lo = datetime.combine(first, time(), tz)
    hi = datetime.combine(last + timedelta(days=1), time(), tz)
    return (ts >= utc_instant(lo)) & (ts < utc_instant(hi))


def month_sk(day: Column) -> Column:
    return (F.year(day) * 100 + F.month(day)).cast("bigint")


def year_quarter(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string"))


def date_parts(day: Column) -> dict[str, Column]:
    iso_dow = F.weekday(day) + 1
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES])
    return {
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "day_of_week_num": iso_dow,
        "day_of_week_name": F.element_at(names, iso_dow),
        "is_weekend": F.when(iso_dow >= 6, 1).otherwise(0),
        "year_month": F.date_format(day, "yyyyMM"),
        "year_quarter": year_quarter(day),
    }


def business_hour(hour: Column) -> Column:
    return F.when(hour.between(9, 18), 1).otherwise(0)


def hour_label(hour: Column, minutes: bool = True) -> Column:
    padded = F.lpad(hour.cast("string"), 2, "0")
    return F.concat(padded, F.lit(":00")) if minutes else padded


def day_hour_label(day: Column, hour: Column) -> Column:
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" "), hour_label(hour))


def clock_label(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")
