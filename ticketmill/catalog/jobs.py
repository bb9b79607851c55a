"""Jobs above single tables: nightly build, range backfill, audit."""

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators import quality as dq
from ..plans import warehouse as w
from ..plans.warehouse import AuditedRun, Warehouse
from . import oracle as o
from .core import AS_OF, Tables, query
from .storage import SLICE, slices, two_slices

c = F.col
CALENDAR = (date(1995, 1, 1), date(2001, 12, 31))


@query("n1_daily_build", """
SELECT 'silver' AS table_name, count(*) AS n_rows, count(*)::DOUBLE AS total FROM t_silver
UNION ALL SELECT 'hour_long', count(*), sum(value_decimal) FROM t_long
UNION ALL SELECT 'hour_wide', count(*), sum(total_tickets) FROM t_hourw
UNION ALL SELECT 'day_wide', count(*), sum(total_tickets) FROM t_day
UNION ALL SELECT 'month_wide', count(*), sum(total_tickets) FROM t_month
UNION ALL SELECT 'mart_daily', count(*), sum(total_tickets) FROM m_daily
UNION ALL SELECT 'mart_hourly', count(*), sum(total_tickets) FROM m_hourly
UNION ALL SELECT 'mart_report', count(*), sum(total_tickets) FROM m_report""")
def daily_build(t: Tables):
    """The whole nightly run; its checks must pass, then every table is summed up."""
    wh = Warehouse(t.scratch("warehouse"), "month_sk")
    dq.enforce(w.daily_build(t.spark, wh, t.raw, AS_OF, CALENDAR))
    totals = {"silver": F.count("*"), "hour_long": F.sum("value_decimal")}
    return reduce(DataFrame.unionByName, [
        wh.read(t.spark, name).agg(
            F.lit(name).alias("table_name"), F.count("*").alias("n_rows"),
            totals.get(name, F.sum("total_tickets")).cast("double").alias("total"))
        for name in ("silver", "hour_long", "hour_wide", "day_wide", "month_wide", "mart_daily",
                     "mart_hourly", "mart_report")])


@query("n1_two_nights", """
SELECT arrived, count(*) AS n_rows, count(DISTINCT prblm_code) AS tickets
FROM (SELECT prblm_code, year(ingested_at)::INTEGER AS arrived FROM t_raw) GROUP BY ALL""")
def two_nights(t: Tables):
    """Bronze after two nightly runs that were given no id: it has the rows of both."""
    wh = Warehouse(t.scratch("warehouse"), "month_sk")
    for rows in two_slices(t.raw):
        w.daily_build(t.spark, wh, rows, AS_OF, CALENDAR)
    bronze = w.read_bronze(t.spark, wh, date(1900, 1, 1), date(2999, 1, 1))
    return bronze.groupBy(F.year("ingested_at").alias("arrived")).agg(
        F.count("*").alias("n_rows"), F.count_distinct("prblm_code").alias("tickets"))


@query("n1_incremental_nights", f"""
SELECT 'bronze night-' || CASE WHEN {SLICE} < 2 THEN 1 ELSE 2 END AS part, count(*) AS n_rows FROM t_raw GROUP BY ALL
UNION ALL SELECT 'silver', count(*) FROM t_silver
UNION ALL SELECT 'days', sum(total_tickets)::BIGINT FROM t_day""")
def incremental_nights(t: Tables):
    """Each night is given the whole raw table as it is by then; the third night finds nothing new."""
    wh = Warehouse(t.scratch("warehouse"), "month_sk")
    for night, raw in enumerate([two_slices(t.raw)[0], t.raw, t.raw], 1):
        w.daily_build(t.spark, wh, raw, AS_OF, CALENDAR, f"night-{night}", incremental=True)
    bronze = w.read_bronze(t.spark, wh, date(1900, 1, 1), date(2999, 1, 1))
    return reduce(DataFrame.unionByName, [
        bronze.groupBy(F.concat(F.lit("bronze "), "_batch_id").alias("part")).agg(F.count("*").alias("n_rows")),
        wh.read(t.spark, "silver").agg(F.lit("silver").alias("part"), F.count("*").alias("n_rows")),
        wh.read(t.spark, "day_wide").agg(F.lit("days").alias("part"), F.sum("total_tickets").cast("bigint").alias("n_rows"))])


@query("n1_refused_rows", """
SELECT 'refused' AS part, CASE WHEN prblm_intclass_id = 7 THEN 'prblm_sysdate' ELSE 'prblm_code' END AS reason, count(*) AS n_rows
FROM t_raw WHERE prblm_intclass_id IN (7, 8) GROUP BY ALL
UNION ALL SELECT 'silver', NULL, count(*) FROM t_silver WHERE prblm_intclass_id NOT IN (7, 8)""")
def refused_rows(t: Tables):
    """Tickets without a creation time or a code in every batch: they are put aside, and nothing else is lost."""
    wh = Warehouse(t.scratch("warehouse"), "month_sk")
    inner = c("prblm_intclass_id")
    raw = t.raw.withColumns({"prblm_sysdate": F.when(inner != 7, c("prblm_sysdate")), "prblm_code": F.when(inner != 8, c("prblm_code"))})
    for number, part in enumerate(slices(raw)):
        w.run_batch(t.spark, wh, part, AS_OF, f"b-{number}")
    refused = wh.read(t.spark, "bronze_rejects").groupBy("reason").agg(F.count("*").alias("n_rows"))
    silver = wh.read(t.spark, "silver").agg(F.lit("silver").alias("part"), F.lit(None).cast("string").alias("reason"), F.count("*").alias("n_rows"))
    return refused.select(F.lit("refused").alias("part"), "reason", "n_rows").unionByName(silver)


BACKFILLED = f"""
SELECT prblm_date, prblm_status_id, count(*)::DOUBLE AS total_tickets, sum(is_resolved)::DOUBLE AS resolved_tickets FROM (
  SELECT *, row_number() OVER (PARTITION BY prblm_code ORDER BY prblm_updateddate DESC, ingested_at DESC) AS rn
  FROM (SELECT *, (prblm_sysdate + INTERVAL 8 HOUR)::DATE AS prblm_date FROM t_bronze)
  WHERE {SLICE} < 2 OR prblm_date BETWEEN DATE '1998-02-01' AND DATE '1998-05-31') WHERE rn = 1 GROUP BY ALL"""


@query("n2_range_backfill", BACKFILLED)
def range_backfill(t: Tables):
    """Gold is built from the first two arrivals. The third reaches bronze only; the
    backfill brings it into four months and leaves the others as they were."""
    return _backfilled(t)


@query("n2_backfill_in_slices", BACKFILLED)
def backfill_in_slices(t: Tables):
    """The same in three slices of up to two months; the second call finds all of them in the journal."""
    return _backfilled(t, ("fill-1", 2), ("fill-1", 2))


@query("n2_heal_late_partitions", """
WITH late AS (
  SELECT DISTINCT strftime((prblm_sysdate + INTERVAL 8 HOUR)::DATE, '%Y%m') AS value FROM t_raw
  WHERE ingested_at >= TIMESTAMP '1998-07-01' AND last_day((prblm_sysdate + INTERVAL 8 HOUR)::DATE) < DATE '1998-07-01' - 7)
SELECT strftime(prblm_date, '%Y%m') AS value, sum(total_tickets)::DOUBLE AS total_tickets, sum(resolved_tickets)::DOUBLE AS resolved_tickets,
       strftime(prblm_date, '%Y%m') IN (SELECT value FROM late) AS was_late FROM t_day GROUP BY ALL""")
def heal_late_partitions(t: Tables):
    """Late versions enter the list instead of lengthening the batch; working it off brings every day up to date."""
    wh = Warehouse(t.scratch("warehouse"), "month_sk")
    first, third = two_slices(t.raw)
    w.run_batch(t.spark, wh, first, AS_OF, "b-1")
    w.run_batch(t.spark, wh, third, AS_OF, "b-2", heal_days=7)
    listed = w.heal(t.spark, wh, AS_OF)
    value = F.date_format("prblm_date", "yyyyMM")
    return wh.read(t.spark, "day_wide").groupBy(value.alias("value")).agg(
        F.sum("total_tickets").cast("double").alias("total_tickets"), F.sum("resolved_tickets").cast("double").alias("resolved_tickets"),
        ).withColumn("was_late", c("value").isin(listed))


def _backfilled(t: Tables, *calls: tuple[str | None, int | None]) -> DataFrame:
    wh = Warehouse(t.scratch("warehouse"), "month_sk")
    first, third = two_slices(t.raw)
    w.run_batch(t.spark, wh, first, AS_OF, "b-1")
    w.append_bronze(wh, third, AS_OF, "b-2")
    for run_id, step in calls or [(None, None)]:
        w.backfill(t.spark, wh, date(1998, 2, 10), date(1998, 5, 20), AS_OF, run_id, step)
    return wh.read(t.spark, "day_wide").groupBy("prblm_date", "prblm_status_id").agg(
        F.sum("total_tickets").alias("total_tickets"), F.sum("resolved_tickets").alias("resolved_tickets"))


@query("n3_audit_log", """
SELECT 'run-1' AS run_id, step, status, detail FROM (
  SELECT 'bronze' AS step, 'success' AS status, count(*)::VARCHAR AS detail FROM t_raw
  UNION ALL SELECT 'silver', 'success', count(*)::VARCHAR FROM t_silver
  UNION ALL SELECT 'marts', 'failed', 'ValueError: bronze has ' || count(*) || ' rows' FROM t_raw)""")
def audit_log(t: Tables):
    """Two steps that succeed and one that fails leave three rows."""
    wh = Warehouse(t.scratch("warehouse"))
    run = AuditedRun(t.spark, wh, "run-1")
    rows = run.step("bronze", t.bronze.count)
    run.step("silver", t.silver.count)

    def broken():
        raise ValueError(f"bronze has {rows} rows")

    try:
        run.step("marts", broken)
    except ValueError:
        pass
    return wh.read(t.spark, "audit").select("run_id", "step", "status", "detail")
