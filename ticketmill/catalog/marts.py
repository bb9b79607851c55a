"""Serving marts, tier unions, top-k and dashboard cards."""

from datetime import date

from pyspark.sql import functions as F

from .. import functions as fn, schema
from ..operators import registry as reg
from ..operators.registry import ACTIVITY
from ..plans import cases, dashboards as db, marts
from . import oracle as o
from .core import TODAY, Tables, query
from .facts import ACT_HOUR, activity_hours

c = F.col
SUMMED = ", ".join([*o.COUNTS, *o.SUMS])
OUT_LABELS = ", ".join(marts.LABELS)


@query("j7_cache_ticket_daily", f"SELECT date_sk, {o.KEYS5}, {OUT_LABELS}, {SUMMED}, {o.RATIO_NAMES}, updated_at FROM m_daily")
def cache_ticket_daily(t: Tables):
    return t.daily


@query("j8_cache_ticket_hourly", f"""
SELECT date_sk, hour_of_day, {o.KEYS5}, {OUT_LABELS}, {SUMMED}, avg_resolution_hours, avg_response_hours, updated_at FROM m_hourly""")
def cache_ticket_hourly(t: Tables):
    return t.hourly


@query("j9_cache_daily_report", f"""
SELECT date_sk, {o.KEYS5}, {OUT_LABELS}, {', '.join(o.COUNTS)}, {o.RATIO_NAMES}, source_tier, freshness_as_of, updated_at FROM m_report""")
def cache_daily_report(t: Tables):
    return marts.daily_report(t.served.days, t.served.hours, TODAY)


@query("h1_lambda_union", f"""
SELECT date_sk, source_tier, sum(total_tickets) AS total_tickets, sum(within_sla_tickets) AS within_sla_tickets, count(*) AS n_rows
FROM m_report GROUP BY ALL""")
def lambda_union(t: Tables):
    return marts.daily_report(t.served.days, t.served.hours, TODAY).groupBy("date_sk", "source_tier").agg(
        F.sum("total_tickets").alias("total_tickets"), F.sum("within_sla_tickets").alias("within_sla_tickets"),
        F.count("*").alias("n_rows"))


ACT_TODAY = "DATE '2024-01-20'"


@query("h2_lambda_union_generic", f"""
SELECT date_sk, event_type, sum(events_count)::DOUBLE AS events_count, max(active_users)::DOUBLE AS active_users,
       sum(conversions)::DOUBLE / nullif(sum(sessions), 0) AS conversion_rate,
       CASE WHEN date_sk < {ACT_TODAY} THEN 'batch' ELSE 'intraday_hourly_sum' END AS source_tier
FROM ({ACT_HOUR}) WHERE date_sk <= {ACT_TODAY} GROUP BY ALL""")
def lambda_generic(t: Tables):
    """Settled days and one day's hours of the activity fact; the rate is re-weighted."""
    today = F.lit("2024-01-20").cast("date")
    hours = activity_hours(t)
    days = reg.day_wide(hours.where(c("date_sk") < today), ACTIVITY)
    now = reg.day_wide(hours.where(c("date_sk") == today), ACTIVITY)
    cols = ["date_sk", "event_type", "events_count", "active_users", "conversion_rate", "source_tier"]
    return marts.tiered_union(days.withColumn("source_tier", F.lit(marts.BATCH_TIER)),
                              now.withColumn("source_tier", F.lit(marts.INTRADAY_TIER)), cols)


CASE_RATIOS = """sla_4hr_met_count::DOUBLE / nullif(has_response_count::DOUBLE, 0) * 100 AS sla_4hr_pct,
       coalesce(response_hours_sum::DOUBLE / 1e12, 0) / nullif(has_response_count::DOUBLE, 0) AS avg_response_hours"""
CASE_LABELLED = f"""SELECT event_date, product_name, sales_area,
    CASE WHEN quek_id::INTEGER IN ({', '.join(map(str, cases.SHOPPING_MAIL))}) THEN '購物信件類' END AS group_type,
    ticket_count, sla_4hr_met_count, has_response_count, response_hours_sum FROM c_day JOIN c_labels USING (store)"""


@query("h2_cs_report_live", f"""
SELECT event_date, product_name, sales_area, group_type, ticket_count::DOUBLE AS ticket_count,
       sla_4hr_met_count::DOUBLE AS sla_4hr_met_count, has_response_count::DOUBLE AS has_response_count, {CASE_RATIOS}, source_tier
FROM (SELECT *, 'batch' AS source_tier FROM ({CASE_LABELLED}) WHERE event_date < {o.TODAY}
      UNION ALL
      SELECT event_date, product_name, sales_area, group_type, sum(ticket_count), sum(sla_4hr_met_count), sum(has_response_count),
             sum(response_hours_sum)::HUGEINT, 'intraday' FROM ({CASE_LABELLED}) WHERE event_date = {o.TODAY} GROUP BY ALL)""")
def case_report_live(t: Tables):
    return cases.case_report_live(t.case_days, t.case_hours, t.entities, TODAY)


# -- order and top-k -----------------------------------------------------------------

@query("g1_recent_n_days", """
SELECT prblm_date, count(*) AS n_tickets FROM t_silver GROUP BY ALL ORDER BY prblm_date DESC LIMIT 30""")
def recent_n_days(t: Tables):
    return db.recent(t.silver.groupBy("prblm_date").agg(F.count("*").alias("n_tickets")), "prblm_date", 30)


@query("g2_ranked_groups", """
SELECT catsub_id, prblm_class_id, count(*) AS n_tickets FROM t_silver GROUP BY ALL ORDER BY n_tickets DESC""")
def ranked_groups(t: Tables):
    return (t.silver.groupBy("catsub_id", "prblm_class_id").agg(F.count("*").alias("n_tickets"))
            .orderBy(c("n_tickets").desc()))


@query("g3_ordered_slice", """
SELECT prblm_date, catsub_id, count(*) AS n_tickets FROM t_silver WHERE prblm_date >= DATE '1998-01-01' AND prblm_date < DATE '1999-01-01'
GROUP BY ALL ORDER BY prblm_date, catsub_id""")
def ordered_slice(t: Tables):
    year = t.between(date(1998, 1, 1), date(1998, 12, 31)).silver
    return (year.groupBy("prblm_date", "catsub_id")
            .agg(F.count("*").alias("n_tickets")).orderBy("prblm_date", "catsub_id"))


# -- cards ----------------------------------------------------------------------------

def q(label: str) -> str:
    return f'"{label}"'


def _volume(relation: str, day: str, out: str, weighted: bool = False) -> str:
    share = o.pct("resolved_tickets", "total_tickets", 1) if weighted else o.mean("pct_resolved", 1)
    return f"""SELECT {day} AS {q(out)}, sum(total_tickets)::BIGINT AS {q(db.TOTAL)}, sum(resolved_tickets)::BIGINT AS {q(db.RESOLVED)},
 {share} AS {q(db.PCT_RESOLVED)} FROM {relation} GROUP BY {day} ORDER BY {day} DESC LIMIT 90"""


def _complaints(relation: str, day: str, out: str) -> str:
    return f"""SELECT {day} AS {q(out)}, sum(total_tickets)::BIGINT AS {q(db.TOTAL)}, sum(complain_tickets)::BIGINT AS {q(db.COMPLAINED)},
 {o.pct('complain_tickets', 'total_tickets', 2)} AS {q(db.PCT_COMPLAIN)} FROM {relation} GROUP BY {day} ORDER BY {day} DESC LIMIT 60"""


def _durations(relation: str, day: str, out: str) -> str:
    return f"""SELECT {day} AS {q(out)}, {o.mean('avg_response_hours', 1)} AS {q(db.RESPONSE_HR)},
 {o.mean('avg_resolution_hours', 1)} AS {q(db.RESOLUTION_HR)}, {o.mean('pct_one_shot', 1)} AS {q(db.ONE_SHOT)}
 FROM {relation} WHERE avg_response_hours IS NOT NULL GROUP BY {day} ORDER BY {day} DESC LIMIT 30"""


def _tiers(relation: str, weighted: bool = False) -> str:
    share = o.pct("within_sla_tickets", "total_tickets", 1) if weighted else o.mean("pct_within_sla", 1)
    return f"""SELECT {o.code_case('prblm_perform_id', db.TIER_NAMES, db.TIER_OTHER)} AS {q(db.TIER)},
 sum(total_tickets)::BIGINT AS {q(db.TOTAL)}, sum(within_sla_tickets)::BIGINT AS {q(db.SLA_COUNT)}, {share} AS {q(db.AVG_SLA)}
 FROM {relation} GROUP BY prblm_perform_id"""


def _by_hour(relation: str, day: str, hour: str, label: str) -> str:
    return f"""SELECT {label} AS {q(db.SLOT)}, sum(total_tickets)::BIGINT AS {q(db.TOTAL)}, sum(resolved_tickets)::BIGINT AS {q(db.RESOLVED)},
 {o.pct('resolved_tickets', 'total_tickets', 1)} AS {q(db.PCT_RESOLVED)} FROM {relation} WHERE {day} = {o.TODAY} GROUP BY {day}, {hour}"""


def _by_site(relation: str, day: str) -> str:
    return f"""SELECT {o.code_case('catsub_id', db.SITE_NAMES, db.SITE_OTHER)} AS {q(db.SITE)}, sum(total_tickets)::BIGINT AS {q(db.TODAY_TOTAL)},
 sum(within_sla_tickets)::BIGINT AS {q(db.SLA_COUNT)}, {o.pct('within_sla_tickets', 'total_tickets', 1)} AS {q(db.PCT_SLA)}
 FROM {relation} WHERE {day} = {o.TODAY} GROUP BY catsub_id"""


def _detail(relation: str, day: str, hour: str, written: str) -> str:
    return f"""SELECT lpad({hour}::VARCHAR, 2, '0') AS {q(db.HOUR)}, sum(total_tickets)::BIGINT AS {q(db.COUNT)},
 sum(resolved_tickets)::BIGINT AS {q(db.CLOSED)}, sum(within_sla_tickets)::BIGINT AS {q(db.IN_TIME)},
 {o.pct('resolved_tickets', 'total_tickets', 1)} AS {q(db.PCT_RESOLVED)}, {written} AS {q(db.WRITTEN)}
 FROM {relation} WHERE {day} = {o.TODAY} GROUP BY {hour}"""


@query("k1_daily_volume_trend", _volume("m_daily", "date_sk", "date_sk"))
def k1(t: Tables):
    return db.daily_volume_trend(t.daily)


@query("k1_daily_volume_trend_weighted", _volume("m_daily", "date_sk", "date_sk", weighted=True))
def k1w(t: Tables):
    return db.daily_volume_trend_weighted(t.daily)


@query("k2_subsite_distribution", f"""
SELECT {o.code_case('catsub_id', db.SITE_NAMES, db.SITE_OTHER)} AS {q(db.SITE)}, sum(total_tickets)::BIGINT AS {q(db.TOTAL)},
       {o.mean('pct_resolved', 1)} AS {q(db.AVG_RESOLVED)} FROM m_daily GROUP BY catsub_id""")
def k2(t: Tables):
    return db.subsite_distribution(t.daily)


@query("k3_sla_attainment", _tiers("m_daily"))
def k3(t: Tables):
    return db.sla_attainment(t.daily)


@query("k3_sla_attainment_weighted", _tiers("m_daily", weighted=True))
def k3w(t: Tables):
    return db.sla_attainment_weighted(t.daily)


@query("k4_complaint_ratio_trend", _complaints("m_daily", "date_sk", "date_sk"))
def k4(t: Tables):
    return db.complaint_ratio_trend(t.daily)


@query("k5_response_resolution_trend", _durations("m_daily", "date_sk", "date_sk"))
def k5(t: Tables):
    return db.response_resolution_trend(t.daily)


SLOT = "strftime(date_sk, '%Y-%m-%d') || ' ' || lpad(hour_of_day::VARCHAR, 2, '0') || ':00'"


@query("k6_today_by_hour", _by_hour("m_hourly", "date_sk", "hour_of_day", SLOT))
def k6(t: Tables):
    return db.today_by_hour(t.between(TODAY, TODAY).hourly_all, TODAY)


@query("k7_today_by_subsite", _by_site("m_hourly", "date_sk"))
def k7(t: Tables):
    return db.today_by_subsite(t.between(TODAY, TODAY).hourly_all, TODAY)


@query("k8_today_hour_detail", _detail("m_hourly", "date_sk", "hour_of_day", "strftime(max(updated_at), '%H:%M:%S')"))
def k8(t: Tables):
    return db.today_hour_detail(t.between(TODAY, TODAY).hourly_all, TODAY)


@query("k9_gold_daily_volume", _volume("t_day", "prblm_date", db.DAY))
def k9(t: Tables):
    return db.gold_daily_volume(t.days)


@query("k10_gold_subsite", f"""
SELECT coalesce(product_name, catsub_id::VARCHAR) AS {q(db.SITE)}, sum(total_tickets)::BIGINT AS {q(db.TOTAL)},
       {o.mean('pct_resolved', 1)} AS {q(db.AVG_RESOLVED)} FROM t_day LEFT JOIN d_catsub USING (catsub_id) GROUP BY catsub_id, product_name""")
def k10(t: Tables):
    return db.gold_subsite(t.days)


@query("k11_gold_sla", f"""
SELECT coalesce(perform_name, prblm_perform_id::VARCHAR) AS {q(db.TIER)}, sla_hours AS {q(db.TIER_HOURS)},
       sum(total_tickets)::BIGINT AS {q(db.TOTAL)}, sum(within_sla_tickets)::BIGINT AS {q(db.SLA_COUNT)},
       {o.mean('pct_within_sla', 1)} AS {q(db.AVG_SLA)}
FROM t_day LEFT JOIN d_perform USING (prblm_perform_id) GROUP BY prblm_perform_id, perform_name, sla_hours""")
def k11(t: Tables):
    return db.gold_sla(t.days)


@query("k12_gold_complaint_ratio", _complaints("t_day", "prblm_date", db.DAY))
def k12(t: Tables):
    return db.gold_complaint_ratio(t.days)


@query("k13_gold_response_resolution", _durations("t_day", "prblm_date", db.DAY))
def k13(t: Tables):
    return db.gold_response_resolution(t.days)


@query("k14_gold_today_by_hour", _by_hour("t_hourw", "prblm_date", "prblm_hour", "lpad(prblm_hour::VARCHAR, 2, '0') || ':00'"))
def k14(t: Tables):
    return db.gold_today_by_hour(t.between(TODAY, TODAY).hours, TODAY)


@query("k15_gold_today_by_subsite", _by_site("t_hourw", "prblm_date"))
def k15(t: Tables):
    return db.gold_today_by_subsite(t.between(TODAY, TODAY).hours, TODAY)


@query("k16_gold_today_hour_detail", _detail("t_hourw", "prblm_date", "prblm_hour", "max(updated_at)"))
def k16(t: Tables):
    return db.gold_today_hour_detail(t.between(TODAY, TODAY).hours, TODAY)
