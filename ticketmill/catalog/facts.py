"""Aggregations, roll-ups, windows and layer builds."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from .. import functions as fn, schema
from ..operators import quality as dq, registry as reg
from ..operators.dedup import latest_cdc, latest_per_key, ticket_version_order
from ..operators.registry import ACTIVITY, TICKETS
from ..plans import activity, cases, facts, raw_metrics, sales
from ..plans.bucketed import Bucketed
from . import oracle as o
from .core import AS_OF, TODAY, Tables, query

c = F.col
SUMMED = ", ".join([*o.COUNTS, *o.SUMS])


@query("e1_hour_grain_agg", f"""
SELECT prblm_date, prblm_hour, {o.KEYS5}, {', '.join(o.COUNTS)}, {', '.join(o.WIDE_ALIAS)} FROM t_hour""")
def hour_grain_agg(t: Tables):
    return facts.hour_agg(t.silver)


@query("e2_eav_unpivot", f"""
SELECT prblm_date, month_sk, prblm_hour, {o.KEYS5}, field_sk, value_decimal, value_double, updated_at FROM t_long""")
def eav_unpivot(t: Tables):
    return t.long


@query("e3_eav_pivot", f"""
SELECT prblm_date, month_sk, prblm_hour, {o.KEYS5}, {SUMMED}, updated_at FROM t_hourw""")
def eav_pivot(t: Tables):
    return facts.hour_wide(t.long)


@query("e4_day_rollup", f"SELECT prblm_date, {o.KEYS5}, {SUMMED}, {o.RATIO_NAMES}, updated_at FROM t_day")
def day_rollup(t: Tables):
    return facts.day_wide(t.hours)


@query("e5_month_rollup", f"SELECT month_sk, {o.KEYS5}, {SUMMED}, {o.RATIO_NAMES}, updated_at FROM t_month")
def month_rollup(t: Tables):
    return facts.month_wide(t.days)


RAW_MEASURES = """count(*) AS total_tickets,
       count(*) FILTER (WHERE prblm_status_id = 5) AS resolved_tickets,
       count(*) FILTER (WHERE prblm_doneatatime) AS one_shot_resolved,
       count(*) FILTER (WHERE prblm_complain_id >= 2) AS complain_tickets,
       count(*) FILTER (WHERE prblm_forwardtype IS NOT NULL) AS forwarded_tickets,
       count(*) FILTER (WHERE prblm_doneatatime AND prblm_status_id = 5) AS within_sla_tickets,
       sum(date_sub('minute', prblm_sysdate, prblm_donedate))::DOUBLE
         / (nullif(count(prblm_donedate), 0) * 60.0::DOUBLE) AS avg_resolution_hours,
       sum(date_sub('minute', prblm_sysdate, prblm_preassignenddate))::DOUBLE
         / (nullif(count(prblm_preassignenddate), 0) * 60.0::DOUBLE) AS avg_response_hours"""


@query("e6_raw_daily_metrics", f"""
SELECT *, {o.half_up('100 * resolved_tickets', 'total_tickets', 2)} AS pct_resolved,
       {o.half_up('100 * within_sla_tickets', 'total_tickets', 2)} AS pct_within_sla,
       {o.half_up('100 * one_shot_resolved', 'total_tickets', 2)} AS pct_one_shot
FROM (SELECT prblm_sysdate::DATE AS date_sk, {o.KEYS5}, {RAW_MEASURES} FROM t_raw GROUP BY date_sk, {o.KEYS5})""")
def raw_daily(t: Tables):
    return raw_metrics.raw_daily(t.raw)


@query("e7_raw_hourly_metrics", f"""
SELECT prblm_sysdate::DATE AS date_sk, hour(prblm_sysdate)::INTEGER AS hour_of_day, {o.KEYS5}, {RAW_MEASURES}
FROM t_raw GROUP BY date_sk, hour_of_day, {o.KEYS5}""")
def raw_hourly(t: Tables):
    return raw_metrics.raw_hourly(t.raw)


@query("e8_filtered_aggregate", """
SELECT prblm_source_id, count(*) FILTER (WHERE prblm_status_id = 5) AS closed,
       count(*) FILTER (WHERE prblm_doneatatime) AS once, count(DISTINCT prblm_code) FILTER (WHERE usr_id IS NULL) AS anonymous
FROM t_raw GROUP BY ALL""")
def filtered_aggregate(t: Tables):
    anonymous = t.raw.where(c("usr_id").isNull()).groupBy("prblm_source_id", "prblm_code").agg(F.lit(1).alias("one"))
    per_source = anonymous.groupBy("prblm_source_id").agg(F.count("*").alias("anonymous"))
    main = t.raw.groupBy("prblm_source_id").agg(F.count_if(c("prblm_status_id") == 5).alias("closed"),
                                                F.count_if(c("prblm_doneatatime")).alias("once"))
    return main.join(per_source, "prblm_source_id", "left").fillna(0, ["anonymous"])


@query("e9_hour_today_from_gold", f"""
SELECT prblm_date AS date_sk, prblm_hour AS hour_of_day, {o.KEYS5}, {', '.join(f'{n}::BIGINT AS {n}' for n in o.COUNTS)},
       {o.ratio('sum_resolution_hours', 'cnt_resolution_hours')} AS avg_resolution_hours,
       {o.ratio('sum_response_hours', 'cnt_response_hours')} AS avg_response_hours FROM t_hourw WHERE prblm_date = {o.TODAY}""")
def hour_today(t: Tables):
    return raw_metrics.hour_today(t.between(TODAY, TODAY).hours, TODAY)


# -- registry-driven ----------------------------------------------------------------

def _registry_sql(relation: str, keys: str) -> str:
    weighted = []
    for n in ("resolution", "response"):
        num, den = f"sum(sum_{n}_hours)", f"sum(cnt_{n}_hours)"
        weighted.append(f"{num} AS avg_{n}_hours_num, {den} AS avg_{n}_hours_den, {num} / nullif({den}, 0) AS avg_{n}_hours")
    return (f"SELECT {keys}, {', '.join(f'sum({n}) AS {n}' for n in o.COUNTS)}, {', '.join(weighted)}, "
            f"max(updated_at) AS updated_at FROM {relation} GROUP BY ALL")


@query("e10_registry_hour_wide", _registry_sql("t_hourw", f"prblm_date, prblm_hour, {o.KEYS5}"))
def registry_hour_wide(t: Tables):
    return reg.hour_wide(t.long, TICKETS)


@query("e11_registry_day_wide", _registry_sql("t_hourw", f"prblm_date, month_sk, {o.KEYS5}"))
def registry_day_wide(t: Tables):
    return reg.day_wide(facts.registry_hours(t.silver, AS_OF), TICKETS, ["month_sk"])


@query("e12_registry_month_wide", _registry_sql("t_hourw", f"month_sk, {o.KEYS5}"))
def registry_month_wide(t: Tables):
    days = reg.day_wide(facts.registry_hours(t.silver, AS_OF), TICKETS, ["month_sk"])
    return reg.month_wide(days, TICKETS)


ACT_HOUR = """SELECT ts::DATE AS date_sk, hour(ts) AS hour, event_type, count(*) AS events_count, count(DISTINCT user_id) AS active_users,
  count(DISTINCT user_id) FILTER (WHERE value > 10) AS conversions, count(DISTINCT user_id) AS sessions FROM events GROUP BY ALL"""


def activity_hours(t: Tables):
    return reg.hour_wide(activity.activity_hour_long(t.table("events"), AS_OF), ACTIVITY, ["month_sk"])


@query("e13_non_additive_max", f"""
SELECT strftime(date_sk, '%Y%m')::BIGINT AS month_sk, event_type, sum(events_count)::DOUBLE AS events_count,
       max(active_users)::DOUBLE AS active_users, sum(conversions)::DOUBLE AS conversion_rate_num,
       sum(sessions)::DOUBLE AS conversion_rate_den, sum(conversions)::DOUBLE / sum(sessions) AS conversion_rate, {o.AS_OF} AS updated_at
FROM ({ACT_HOUR}) GROUP BY month_sk, event_type""")
def non_additive_max(t: Tables):
    days = reg.day_wide(activity_hours(t), ACTIVITY, ["month_sk"])
    return reg.month_wide(days, ACTIVITY)


@query("e14_grouped_having_distinct", """
SELECT usr_id_masked, count(DISTINCT usr_id) AS natural_key_count FROM t_bronze GROUP BY ALL HAVING count(DISTINCT usr_id) > 1""")
def grouped_having_distinct(t: Tables):
    """A masked id used as if it were a key: which ones stand for several users?"""
    keyed = t.raw.select(fn.mask_id(c("usr_id")).alias("usr_id_masked"), "usr_id")
    return dq.hash_collisions(keyed, "usr_id_masked", "usr_id")


@query("e15_distinct_rows", f"SELECT DISTINCT {o.KEYS5}, prblm_intclass_id FROM t_raw")
def distinct_rows(t: Tables):
    return t.raw.select(*schema.TICKET_DIMS, "prblm_intclass_id").distinct()


CASE_SK = {f: o.literal_key(f"cs|{f}") for f in o.CASE_FIELDS}


@query("e16_cs_hour_long", f"""
SELECT event_date, event_hour, month_sk, entity_sk, e.field_sk, e.value_decimal FROM (
  SELECT event_date, event_hour, month_sk, entity_sk, unnest([{', '.join(
      f"{{'field_sk': {CASE_SK[f]}::BIGINT, 'value_decimal': {o.case_value(f)}}}" for f in o.CASE_FIELDS)}]) AS e FROM c_hour)""")
def cs_hour_long(t: Tables):
    return t.case_long


def _zero_null(names=o.CASE_FIELDS):
    return ", ".join(f"coalesce({o.case_value(n)}, 0) AS {n}" for n in names)


@query("e17_cs_hour_wide", f"SELECT event_date, event_hour, month_sk, entity_sk, {_zero_null()} FROM c_hour")
def cs_hour_wide(t: Tables):
    return cases.case_hour_wide(t.case_long)


@query("e17_cs_day_wide", f"SELECT event_date, month_sk, entity_sk, {_zero_null()} FROM c_day")
def cs_day_wide(t: Tables):
    return t.case_days


@query("e17_cs_month_wide", f"""
SELECT month_sk, entity_sk, {_zero_null()} FROM (SELECT month_sk, entity_sk,
  {', '.join(f'sum({f})::HUGEINT AS {f}' for f in o.CASE_FIELDS)} FROM c_day GROUP BY ALL)""")
def cs_month_wide(t: Tables):
    return cases.case_month_wide(t.case_days)


@query("e18_freshness_max", """
SELECT catsub_id, prblm_status_id, max(prblm_updateddate) AS last_update, max(ingested_at) AS last_arrival FROM t_raw GROUP BY ALL""")
def freshness_max(t: Tables):
    return t.raw.groupBy("catsub_id", "prblm_status_id").agg(
        F.max("prblm_updateddate").alias("last_update"), F.max("ingested_at").alias("last_arrival"))


# -- windows ------------------------------------------------------------------------

@query("f1_latest_per_key", """
SELECT prblm_code, prblm_updateddate, ingested_at, prblm_status_id FROM t_silver""")
def latest(t: Tables):
    return latest_per_key(t.raw, ["prblm_code"], ticket_version_order()).select(
        "prblm_code", "prblm_updateddate", "ingested_at", "prblm_status_id")


@query("f2_latest_cdc_per_key", "SELECT order_id, customer_id, order_ts, amount_raw, _cdc_op, _cdc_ts FROM o_current")
def latest_change(t: Tables):
    return latest_cdc(t.changes, ["order_id"], sales.change_order()).select(
        "order_id", "customer_id", "order_ts", "amount_raw", "_cdc_op", "_cdc_ts")


# -- layers --------------------------------------------------------------------------

BRONZE_COLS = ", ".join([*schema.BUSINESS, "customer_name_masked", "usr_id_masked", *schema.BRONZE_METRICS])


@query("j1_bronze_tickets", f"""
SELECT {BRONZE_COLS}, {o.pii_key('usr_id')} AS usr_pk, ingested_at, bronze_created_at,
       (ingested_at + INTERVAL 8 HOUR)::DATE AS _ingested_date, 'data_source_pod' AS _source_system, 'raw_tickets' AS _source_table,
       '/api/tickets' AS _source_file_path, 'r' AS _cdc_op, ingested_at AS _cdc_ts, 'full' AS _batch_id,
       {o.xxh64_key("prblm_code || '|' || strftime(prblm_updateddate, '%Y-%m-%d %H:%M:%S.%f') || ' UTC'")} AS _record_hash
FROM t_bronze""")
def bronze_tickets(t: Tables):
    return t.bronze


@query("j2_silver_tickets", f"""
SELECT {BRONZE_COLS}, {o.pii_key('usr_id')} AS usr_pk, resolution_bucket, response_bucket, is_complain, is_forwarded,
       prblm_date, ingested_at, updated_at FROM t_silver""")
def silver_tickets(t: Tables):
    return t.silver


@query("j3_fact_hour_long", f"""
SELECT prblm_date, month_sk, prblm_hour, {o.KEYS5}, field_sk, value_decimal, value_double, updated_at FROM t_long""")
def fact_hour_long(t: Tables):
    return facts.hour_long(t.silver, AS_OF)


@query("j4_fact_hour_wide", f"SELECT prblm_date, month_sk, prblm_hour, {o.KEYS5}, {SUMMED}, updated_at FROM t_hourw")
def fact_hour_wide(t: Tables):
    """From silver in one aggregate; e3 gives the same rows from the long fact."""
    return t.hours


@query("j5_fact_day_wide", f"""
SELECT prblm_date, {o.KEYS5}, {SUMMED}, {o.RATIO_NAMES}, updated_at FROM t_day WHERE prblm_date >= {o.TODAY} - 7""")
def fact_day_wide(t: Tables):
    """The rolling form: the last seven days, filtered below the aggregate."""
    from ..operators.windows import day_lookback
    return facts.day_wide(t.between(TODAY - timedelta(days=7)).hours.where(day_lookback(c("prblm_date"), TODAY, 7)))


@query("j6_fact_month_wide", f"""
SELECT month_sk, {o.KEYS5}, {SUMMED}, {o.RATIO_NAMES}, updated_at FROM t_month WHERE month_sk >= 199805""")
def fact_month_wide(t: Tables):
    from ..operators.windows import month_lookback
    return facts.month_wide(t.between(date(1998, 5, 1)).days.where(month_lookback(c("prblm_date"), TODAY, 2)))


@query("j10_cs_daily_report", f"""
SELECT event_date, year(event_date)::INTEGER AS year, month(event_date)::INTEGER AS month, weekofyear(event_date)::INTEGER AS week,
       month_sk, store AS catsub_id, quek_id, queid, product_name, sales_area,
       CASE WHEN quek_id::INTEGER IN ({', '.join(map(str, cases.SHOPPING_MAIL))}) THEN '購物信件類' END AS group_type,
       {o.case_columns(cases.COUNTED)},
       coalesce(response_hours_sum::DOUBLE / 1e12, 0) / nullif(has_response_count::DOUBLE, 0) AS avg_response_hours,
       coalesce(closure_hours_sum::DOUBLE / 1e12, 0) / nullif(has_closure_count::DOUBLE, 0) AS avg_closure_hours,
       sla_4hr_met_count::DOUBLE / nullif(has_response_count::DOUBLE, 0) * 100 AS sla_4hr_pct,
       sla_8hr_met_count::DOUBLE / nullif(has_response_count::DOUBLE, 0) * 100 AS sla_8hr_pct,
       first_resolution_count::DOUBLE / nullif(ticket_count::DOUBLE, 0) * 100 AS first_resolution_pct
FROM c_day JOIN c_labels USING (store)""")
def cs_daily_report(t: Tables):
    return cases.case_daily_report(t.case_days, t.entities)


USER_METRICS = f"""
SELECT date_sk, month_sk, entity_sk, strftime(date_sk, '%Y') || '-Q' || quarter(date_sk) AS year_quarter,
       CASE WHEN isodow(date_sk) >= 6 THEN 1 ELSE 0 END AS is_weekend, c_name AS customer_name,
       sum(orders_count)::DOUBLE AS orders_count, sum(cents)::DOUBLE / 100 AS revenue_amount, {o.AS_OF} AS updated_at
FROM o_hour JOIN o_customer USING (customer_id) LEFT JOIN customer ON c_custkey::VARCHAR = customer_id GROUP BY ALL"""


@query("j11_user_metric_day", USER_METRICS)
def user_metric_day(t: Tables):
    return sales.user_metric_day(t.order_days, t.calendar, sales.dim_customer(t.table("customer")))


@query("j11_user_metric_bucketed", USER_METRICS)
def user_metric_bucketed(t: Tables):
    """From a stored fact and dimension with the same buckets, which need no shuffle to be joined."""
    days, customers = bucketed_tables(t)
    return sales.user_metric_day(days.read(t.spark), t.calendar, customers.read(t.spark))


def bucketed_tables(t: Tables, buckets: int = 8) -> tuple[Bucketed, Bucketed]:
    """Order days and customers, stored; half of the months in a second write."""
    def at(name: str, *parts: str) -> Bucketed:
        path = t.scratch(name)
        return Bucketed(path.rsplit("/", 1)[-1].replace("-", "_"), path, "entity_sk", buckets, parts)
    days, customers = at("order_days", "month_sk"), at("customers")
    days.store(t.order_days.where(c("month_sk") % 2 == 0))
    days.refresh(t.order_days.where(c("month_sk") % 2 == 1))
    customers.store(sales.dim_customer(t.table("customer")))
    return days, customers


@query("j12_cs_silver_events", """
SELECT prblm_code, prblm_updateddate, ingested_at, prblm_status_id, prblm_donedate, store AS catsub_id, quek_id, queid, supplier_id,
       event_date, event_hour, month_sk, response_min / 60.0::DOUBLE AS response_hours, closure_min / 60.0::DOUBLE AS closure_hours,
       has_response, has_closure, CASE WHEN waited <= 4 THEN 1 ELSE 0 END AS sla_4hr_met,
       CASE WHEN waited <= 8 THEN 1 ELSE 0 END AS sla_8hr_met, CASE WHEN waited <= 24 THEN 1 ELSE 0 END AS sla_24hr_met,
       CASE WHEN prblm_doneatatime THEN 1 ELSE 0 END AS is_first_resolution FROM c_events""")
def cs_silver_events(t: Tables):
    return t.cases


@query("j13_orders_silver", """
SELECT order_id, customer_id, order_ts, cents::DOUBLE / 100 AS amount, _ingested_at, 'full' AS _batch_id
FROM o_current WHERE cents IS NOT NULL""")
def orders_silver(t: Tables):
    return t.orders


@query("j13_orders_quarantine", """
SELECT order_id, customer_id, amount_raw, _cdc_op FROM o_current WHERE cents IS NULL""")
def orders_quarantine(t: Tables):
    return sales.order_silver(t.changes)[1]


@query("j14_orders_hour_metrics", f"""
SELECT date_sk, hour, month_sk, entity_sk, orders_count::DOUBLE AS orders_count, cents::DOUBLE / 100 AS revenue_amount, {o.AS_OF} AS updated_at
FROM o_hour JOIN o_customer USING (customer_id)""")
def orders_hour_metrics(t: Tables):
    return t.order_hours


@query("j14_orders_hour_long", f"""
SELECT date_sk, hour, month_sk, entity_sk, e.field_sk, e.value_decimal, {o.AS_OF} AS updated_at FROM (
  SELECT date_sk, hour, month_sk, entity_sk, unnest([
     {{'field_sk': {o.literal_key('order|orders_count')}::BIGINT, 'value_decimal': orders_count::DOUBLE}},
     {{'field_sk': {o.literal_key('order|revenue_amount')}::BIGINT, 'value_decimal': cents::DOUBLE / 100}}]) AS e
  FROM o_hour JOIN o_customer USING (customer_id))""")
def orders_hour_long(t: Tables):
    return t.order_long
