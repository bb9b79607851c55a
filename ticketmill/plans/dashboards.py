"""Dashboard cards over the marts and directly over gold.

Output columns carry the display labels the cards show.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from .. import functions as fn
from ..operators.joins import lookup
from .dims import dim_catsub, dim_perform

# Card labels.
TOTAL, RESOLVED, SLA_COUNT, COMPLAINED = "總問題單數", "已結案數", "時效內問題單數", "客訴問題單數"
PCT_RESOLVED, PCT_COMPLAIN, PCT_SLA, AVG_SLA = "結案率_pct", "客訴比例_pct", "SLA達標率_pct", "平均達標率_pct"
SITE, TIER, TIER_HOURS, AVG_RESOLVED = "子站名稱", "SLA類型", "SLA時效_hr", "平均結案率"
DAY, SLOT, HOUR = "日期", "時段", "小時"
RESPONSE_HR, RESOLUTION_HR, ONE_SHOT = "平均回覆時效_hr", "平均結案時效_hr", "一次結案率_pct"
TODAY_TOTAL, COUNT, CLOSED, IN_TIME, WRITTEN = "今日問題單數", "問題單數", "結案數", "時效內", "最後寫入時間"
SITE_NAMES = {1: "購物(台灣)", 2: "購物(香港)", 3: "拍賣(台灣)", 4: "超市(台灣)", 5: "旅遊(台灣)",
              6: "票券(台灣)", 7: "金融(台灣)", 8: "企業(台灣)", 9: "廣告(台灣)"}
SITE_OTHER = "其他"
TIER_NAMES = {1: "急件 (8hr)", 2: "特急 (4hr)", 99: "一般 (24hr)"}
TIER_OTHER = "未分類"
VOLUME_DAYS, COMPLAINT_DAYS, DURATION_DAYS = 90, 60, 30

c = F.col


def _sum(column: str) -> Column:
    return F.sum(column).cast("bigint")


def _pct(num: str, den: str, digits: int) -> Column:
    return fn.rounded_pct(F.sum(num), F.sum(den), digits)


def _site(code: Column) -> Column:
    return fn.code_decode(code, SITE_NAMES, SITE_OTHER)


def recent(df: DataFrame, day: str, n: int) -> DataFrame:
    """The n latest days: a top-k, not a full sort."""
    return df.orderBy(c(day).desc()).limit(n)


# -- trends by day -----------------------------------------------------------------

def _volume(df: DataFrame, day: str, out: str) -> DataFrame:
    days = df.groupBy(c(day).alias(out)).agg(
        _sum("total_tickets").alias(TOTAL), _sum("resolved_tickets").alias(RESOLVED),
        fn.exact_mean(c("pct_resolved"), 1).alias(PCT_RESOLVED))
    return recent(days, out, VOLUME_DAYS)


def _complaints(df: DataFrame, day: str, out: str) -> DataFrame:
    days = df.groupBy(c(day).alias(out)).agg(
        _sum("total_tickets").alias(TOTAL), _sum("complain_tickets").alias(COMPLAINED),
        _pct("complain_tickets", "total_tickets", 2).alias(PCT_COMPLAIN))
    return recent(days, out, COMPLAINT_DAYS)


def _durations(df: DataFrame, day: str, out: str) -> DataFrame:
    answered = df.where(c("avg_response_hours").isNotNull())
    days = answered.groupBy(c(day).alias(out)).agg(
        fn.exact_mean(c("avg_response_hours"), 1).alias(RESPONSE_HR),
        fn.exact_mean(c("avg_resolution_hours"), 1).alias(RESOLUTION_HR),
        fn.exact_mean(c("pct_one_shot"), 1).alias(ONE_SHOT))
    return recent(days, out, DURATION_DAYS)


def daily_volume_trend(daily: DataFrame) -> DataFrame:
    return _volume(daily, "date_sk", "date_sk")


def complaint_ratio_trend(daily: DataFrame) -> DataFrame:
    return _complaints(daily, "date_sk", "date_sk")


def response_resolution_trend(daily: DataFrame) -> DataFrame:
    return _durations(daily, "date_sk", "date_sk")


def gold_daily_volume(days: DataFrame) -> DataFrame:
    return _volume(days, "prblm_date", DAY)


def gold_complaint_ratio(days: DataFrame) -> DataFrame:
    return _complaints(days, "prblm_date", DAY)


def gold_response_resolution(days: DataFrame) -> DataFrame:
    return _durations(days, "prblm_date", DAY)


# -- whole-period breakdowns ---------------------------------------------------------

def subsite_distribution(daily: DataFrame) -> DataFrame:
    return (daily.groupBy("catsub_id").agg(
        _sum("total_tickets").alias(TOTAL), fn.exact_mean(c("pct_resolved"), 1).alias(AVG_RESOLVED))
        .select(_site(c("catsub_id")).alias(SITE), TOTAL, AVG_RESOLVED).orderBy(c(TOTAL).desc()))


def sla_attainment(daily: DataFrame) -> DataFrame:
    return (daily.groupBy("prblm_perform_id").agg(
        _sum("total_tickets").alias(TOTAL), _sum("within_sla_tickets").alias(SLA_COUNT),
        fn.exact_mean(c("pct_within_sla"), 1).alias(AVG_SLA))
        .orderBy("prblm_perform_id")
        .select(fn.code_decode(c("prblm_perform_id"), TIER_NAMES, TIER_OTHER).alias(TIER),
                TOTAL, SLA_COUNT, AVG_SLA))


def gold_subsite(days: DataFrame) -> DataFrame:
    """Grouped by key first, so that the label joins a handful of rows."""
    sites = days.groupBy("catsub_id").agg(
        _sum("total_tickets").alias(TOTAL), fn.exact_mean(c("pct_resolved"), 1).alias(AVG_RESOLVED))
    named = lookup(sites, dim_catsub(days.sparkSession), "catsub_id", fixed=True)
    return (named.select(fn.fallback_label(c("product_name"), c("catsub_id")).alias(SITE),
                         TOTAL, AVG_RESOLVED).orderBy(c(TOTAL).desc()))


def gold_sla(days: DataFrame) -> DataFrame:
    tiers = days.groupBy("prblm_perform_id").agg(
        _sum("total_tickets").alias(TOTAL), _sum("within_sla_tickets").alias(SLA_COUNT),
        fn.exact_mean(c("pct_within_sla"), 1).alias(AVG_SLA))
    named = lookup(tiers, dim_perform(days.sparkSession), "prblm_perform_id", fixed=True)
    return (named.orderBy("prblm_perform_id")
            .select(fn.fallback_label(c("perform_name"), c("prblm_perform_id")).alias(TIER),
                    c("sla_hours").alias(TIER_HOURS), TOTAL, SLA_COUNT, AVG_SLA))


# -- today ---------------------------------------------------------------------------

def _by_hour(hours: DataFrame, day: str, hour: str, label: Column, today: date) -> DataFrame:
    return (hours.where(c(day) == F.lit(today)).groupBy(day, hour).agg(
        _sum("total_tickets").alias(TOTAL), _sum("resolved_tickets").alias(RESOLVED),
        _pct("resolved_tickets", "total_tickets", 1).alias(PCT_RESOLVED))
        .orderBy(hour).select(label.alias(SLOT), TOTAL, RESOLVED, PCT_RESOLVED))


def _by_site(hours: DataFrame, day: str, today: date) -> DataFrame:
    return (hours.where(c(day) == F.lit(today)).groupBy("catsub_id").agg(
        _sum("total_tickets").alias(TODAY_TOTAL), _sum("within_sla_tickets").alias(SLA_COUNT),
        _pct("within_sla_tickets", "total_tickets", 1).alias(PCT_SLA))
        .select(_site(c("catsub_id")).alias(SITE), TODAY_TOTAL, SLA_COUNT, PCT_SLA)
        .orderBy(c(TODAY_TOTAL).desc()))


def _detail(hours: DataFrame, day: str, hour: str, today: date, written: Column) -> DataFrame:
    return (hours.where(c(day) == F.lit(today)).groupBy(hour).agg(
        _sum("total_tickets").alias(COUNT), _sum("resolved_tickets").alias(CLOSED),
        _sum("within_sla_tickets").alias(IN_TIME),
        _pct("resolved_tickets", "total_tickets", 1).alias(PCT_RESOLVED),
        written.alias(WRITTEN))
        .orderBy(hour).select(fn.hour_label(c(hour), minutes=False).alias(HOUR),
                              COUNT, CLOSED, IN_TIME, PCT_RESOLVED, WRITTEN))


def today_by_hour(hourly: DataFrame, today: date) -> DataFrame:
    label = fn.day_hour_label(c("date_sk"), c("hour_of_day"))
    return _by_hour(hourly, "date_sk", "hour_of_day", label, today)


def today_by_subsite(hourly: DataFrame, today: date) -> DataFrame:
    return _by_site(hourly, "date_sk", today)


def today_hour_detail(hourly: DataFrame, today: date) -> DataFrame:
    return _detail(hourly, "date_sk", "hour_of_day", today, fn.clock_label(F.max("updated_at")))


def gold_today_by_hour(hours: DataFrame, today: date) -> DataFrame:
    return _by_hour(hours, "prblm_date", "prblm_hour", fn.hour_label(c("prblm_hour")), today)


def gold_today_by_subsite(hours: DataFrame, today: date) -> DataFrame:
    return _by_site(hours, "prblm_date", today)


def gold_today_hour_detail(hours: DataFrame, today: date) -> DataFrame:
    return _detail(hours, "prblm_date", "prblm_hour", today, F.max("updated_at"))


# -- weighted twins ------------------------------------------------------------------
# The cards above average group percentages; these weigh each group by its tickets.

def daily_volume_trend_weighted(daily: DataFrame) -> DataFrame:
    days = daily.groupBy("date_sk").agg(
        _sum("total_tickets").alias(TOTAL), _sum("resolved_tickets").alias(RESOLVED),
        _pct("resolved_tickets", "total_tickets", 1).alias(PCT_RESOLVED))
    return recent(days, "date_sk", VOLUME_DAYS)


def sla_attainment_weighted(daily: DataFrame) -> DataFrame:
    return (daily.groupBy("prblm_perform_id").agg(
        _sum("total_tickets").alias(TOTAL), _sum("within_sla_tickets").alias(SLA_COUNT),
        _pct("within_sla_tickets", "total_tickets", 1).alias(AVG_SLA))
        .orderBy("prblm_perform_id")
        .select(fn.code_decode(c("prblm_perform_id"), TIER_NAMES, TIER_OTHER).alias(TIER),
                TOTAL, SLA_COUNT, AVG_SLA))
