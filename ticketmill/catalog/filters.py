"""Predicates and incremental windows."""

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from .. import functions as fn, schema
from ..operators import windows as w
from ..operators.registry import TICKETS
from ..plans import facts, layers, marts, sales
from . import oracle as o
from .core import AS_OF, TODAY, Tables, query

c = F.col
CUT = datetime(1997, 1, 1)
CUT_SQL = "TIMESTAMP '1997-01-01'"
EARLIER = AS_OF - timedelta(days=1)


def _stored(t: Tables):
    """Rows that had arrived at the cut: the state of a target table."""
    return t.raw.where(c("ingested_at") < fn.utc_instant(CUT))


@query("c1_static_lookback", f"""
SELECT prblm_code, ingested_at FROM t_bronze WHERE ingested_at >= {o.AS_OF} - INTERVAL 48 HOUR""")
def static_lookback(t: Tables):
    return t.bronze.where(w.static_lookback(c("ingested_at"), AS_OF, 48)).select("prblm_code", "ingested_at")


@query("c2_hwm_with_overlap", f"""
SELECT prblm_code, ingested_at FROM t_raw WHERE ingested_at >
  (SELECT max(ingested_at) - INTERVAL 10 MINUTE FROM t_raw WHERE ingested_at < {CUT_SQL})""")
def hwm_with_overlap(t: Tables):
    mark = w.high_water_mark(_stored(t), "ingested_at", 10)
    return t.raw.where(c("ingested_at") > fn.utc_instant(mark)).select("prblm_code", "ingested_at")


@query("c3_hwm_ingestion_time", f"""
SELECT prblm_code, ingested_at, prblm_sysdate <= mark AS created_before_mark FROM t_raw,
  (SELECT max(ingested_at) - INTERVAL 1 MINUTE AS mark FROM t_raw WHERE ingested_at < {CUT_SQL}) WHERE ingested_at > mark""")
def hwm_ingestion_time(t: Tables):
    """Late rows - created before the mark, arrived after it - are kept."""
    mark = fn.utc_instant(w.high_water_mark(_stored(t), "ingested_at", 1))
    return t.raw.where(c("ingested_at") > mark).select(
        "prblm_code", "ingested_at", (c("prblm_sysdate") <= mark).alias("created_before_mark"))


def _long_in_two_runs(t: Tables):
    first = c("ingested_at") < fn.utc_instant(CUT)
    old = facts.hour_long(t.silver.where(first), EARLIER)
    return old, facts.hour_long(t.silver.where(~first), AS_OF)


@query("c4_delta_hwm_whole_keys", f"""
SELECT prblm_date, month_sk, prblm_hour, {o.KEYS5}, total_tickets::DOUBLE AS total_tickets FROM t_hour
WHERE (prblm_date, prblm_hour) IN (SELECT ((prblm_sysdate + INTERVAL 8 HOUR)::DATE, hour(prblm_sysdate + INTERVAL 8 HOUR))
                                   FROM t_silver WHERE ingested_at >= {CUT_SQL})""")
def delta_hwm(t: Tables):
    """Long rows written after the mark select their hours; each hour is pivoted whole."""
    old, new = _long_in_two_runs(t)
    stored = old.unionByName(new)
    delta = stored.where(c("updated_at") > fn.utc_instant(EARLIER))
    wide = facts.hour_wide(w.touched_keys(stored, delta, ["prblm_date", "prblm_hour"]))
    return wide.select("prblm_date", "month_sk", *schema.HOUR_KEYS[1:], "total_tickets")


@query("c5_business_lookback", f"""
SELECT 'day' AS grain, prblm_date::VARCHAR AS slice, sum(total_tickets) AS total_tickets FROM t_day WHERE prblm_date >= {o.TODAY} - 7 GROUP BY ALL
UNION ALL SELECT 'month', month_sk::VARCHAR, sum(total_tickets) FROM t_month WHERE month_sk >= 199805 GROUP BY ALL
UNION ALL SELECT 'month_by_day', strftime(prblm_date, '%Y%m'), sum(total_tickets) FROM t_day WHERE prblm_date >= DATE '1998-05-01' GROUP BY ALL""")
def business_lookback(t: Tables):
    def slices(grain, df, label):
        return df.groupBy(F.lit(grain).alias("grain"), label.cast("string").alias("slice")).agg(
            F.sum("total_tickets").alias("total_tickets"))
    day = c("prblm_date")
    t = t.between(date(1998, 5, 1))
    return (slices("day", t.days.where(w.day_lookback(day, TODAY, 7)), day)
            .unionByName(slices("month", t.months.where(w.month_sk_lookback(c("month_sk"), TODAY, 2)), c("month_sk")))
            .unionByName(slices("month_by_day", t.days.where(w.month_lookback(day, TODAY, 2)), fn.month_sk(day))))


@query("c6_serving_window", f"""
SELECT CASE WHEN prblm_date >= {o.TODAY} - 3 THEN 'refresh' ELSE 'full' END AS run, count(*) AS n_rows,
       sum(total_tickets) AS total_tickets FROM t_day WHERE prblm_date >= {o.TODAY} - 730 GROUP BY ALL""")
def serving_window(t: Tables):
    day = c("prblm_date")
    kept = t.served.days.where(marts.serving_window(day, TODAY, refresh=False))
    run = F.when(marts.serving_window(day, TODAY, refresh=True), "refresh").otherwise("full")
    return kept.groupBy(run.alias("run")).agg(F.count("*").alias("n_rows"),
                                              F.sum("total_tickets").alias("total_tickets"))


@query("c7_initial_window", f"""
SELECT prblm_date, count(*) AS n_tickets FROM t_silver WHERE prblm_date >= {o.TODAY} - 30 GROUP BY ALL""")
def initial_window(t: Tables):
    return (t.between(TODAY - timedelta(days=30)).silver.where(w.day_lookback(c("prblm_date"), TODAY, 30))
            .groupBy("prblm_date").agg(F.count("*").alias("n_tickets")))


@query("c8_half_open_month", """
SELECT prblm_code, prblm_sysdate, ingested_at FROM t_raw WHERE prblm_sysdate >= TIMESTAMP '1997-12-01' AND prblm_sysdate < TIMESTAMP '1998-01-01'""")
def half_open_month(t: Tables):
    return t.raw.where(w.half_open_month(c("prblm_sysdate"), 1997, 12)).select(
        "prblm_code", "prblm_sysdate", "ingested_at")


@query("c9_rebuild_from_date", f"""
SELECT prblm_date, {o.KEYS5}, total_tickets FROM t_day WHERE prblm_date >= DATE '2000-06-01'""")
def rebuild_from_date(t: Tables):
    return (t.between(date(2000, 6, 1)).days.where(w.rebuild_from(c("prblm_date"), date(2000, 6, 1)))
            .select(*schema.DAY_KEYS, "total_tickets"))


@query("c10_cdc_delete_filter", "SELECT order_id, _cdc_op, amount_raw FROM o_current")
def cdc_delete_filter(t: Tables):
    from ..operators.dedup import latest_cdc
    return latest_cdc(t.changes, ["order_id"], sales.change_order()).select("order_id", "_cdc_op", "amount_raw")


@query("c11_late_arrival_policy", """
SELECT CASE WHEN gap <= 0 THEN 'on_time' WHEN gap <= 7 THEN 'self_heals' ELSE 'backfill' END AS policy, count(*) AS n_rows
FROM (SELECT date_diff('day', (prblm_sysdate + INTERVAL 8 HOUR)::DATE, (ingested_at + INTERVAL 8 HOUR)::DATE) AS gap FROM t_raw)
GROUP BY ALL""")
def late_arrival_policy(t: Tables):
    policy = w.lateness(fn.local_date(c("ingested_at")), fn.local_date(c("prblm_sysdate")))
    return t.raw.groupBy(policy.alias("policy")).agg(F.count("*").alias("n_rows"))


@query("o_registry_run_variables", f"""
SELECT 'strict' AS setting, sum(CASE WHEN prblm_perform_id IS NULL THEN 0 ELSE within_sla END)::BIGINT AS within_sla FROM t_bronze
UNION ALL SELECT 'normalised', sum(within_sla)::BIGINT FROM t_bronze""")
def run_variables(t: Tables):
    """A run variable is a function argument: the SLA reading of a feed that sends 99."""
    fed = t.raw.withColumn("prblm_perform_id", fn.null_member(c("prblm_perform_id")))
    rows = [layers.bronze(fed, AS_OF, strict_perform=s).agg(
        F.lit(n).alias("setting"), F.sum("within_sla").alias("within_sla"))
        for n, s in (("strict", True), ("normalised", False))]
    return rows[0].unionByName(rows[1])
