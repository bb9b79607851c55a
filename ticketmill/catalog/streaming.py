"""Streams over landing folders, drained slice by slice as they arrive."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from .. import functions as fn, schema
from ..operators import quality as dq
from ..plans.marts import serving_window
from ..plans.warehouse import Warehouse
from ..sources import readers, storage as st
from ..streaming import jobs, progress
from . import oracle as o
from .core import AS_OF, TODAY, Tables, query
from .facts import SUMMED
from .marts import OUT_LABELS
from .storage import LACKING, RAW_NAMES, slices, two_slices, without_cells

c = F.col
LATER = "ingested_at >= TIMESTAMP '1998-07-01'"


def _two(raw: DataFrame) -> list[DataFrame]:
    """Two arrivals: until mid 1998, with versions of older tickets in the second."""
    return two_slices(raw)


def _drained(t: Tables) -> tuple[str, str]:
    """Feed files land three times; each drain reads only what is new."""
    landing, target, rejects, state = (t.scratch(n) for n in ("feed", "raw", "rejects", "state"))
    for part in slices(t.raw):
        without_cells(readers.to_feed(part)).write.mode("append").text(landing)
        jobs.drain_ingest(t.spark, landing, target, rejects, state)
    return target, rejects


@query("l1_drain_ingest", f"SELECT {RAW_NAMES} FROM t_raw WHERE prblm_intclass_id NOT IN (29, 30)")
def drain_ingest(t: Tables):
    return readers.read_raw(t.spark, _drained(t)[0])


@query("l1_drain_rejects", f"""
SELECT CASE WHEN prblm_intclass_id = 29 THEN prblm_code END AS prblm_code, concat_ws(',', {LACKING}) AS reason
FROM t_raw WHERE prblm_intclass_id IN (29, 30)""")
def drain_rejects(t: Tables):
    """Rows without a code or a creation time do not stop the stream."""
    rejects = st.read(t.spark, _drained(t)[1])
    return rejects.select(F.get_json_object("payload", "$.prblm_code").alias("prblm_code"), "reason")


def _chain(t: Tables, first_as_of: datetime = AS_OF) -> Warehouse:
    landing, state = t.scratch("landing"), t.scratch("state")
    wh = Warehouse(t.scratch("warehouse"), "month_sk")
    for part, as_of in zip(_two(t.raw), (first_as_of, AS_OF)):
        st.append(part, landing)
        jobs.drain_chain(t.spark, landing, wh, state, as_of)
    return wh


@query("l2_micro_batch_chain", f"SELECT prblm_date, {o.KEYS5}, {SUMMED}, {o.RATIO_NAMES}, updated_at FROM t_day")
def micro_batch_chain(t: Tables):
    """Versions that arrive in the second drain correct days stored by the first."""
    days = _chain(t).read(t.spark, "day_wide")
    return days.drop("month_sk")


@query("l3_overlap_and_dedup", "SELECT prblm_code, prblm_updateddate, ingested_at FROM t_raw")
def overlap_and_dedup(t: Tables):
    """The second arrival repeats the last ten minutes of the first."""
    landing, out, state = t.scratch("landing"), t.scratch("rows"), t.scratch("state")
    first, second = _two(t.raw)
    top = first.agg((F.max("ingested_at") - F.expr("INTERVAL 10 MINUTE")).alias("mark"))
    repeated = first.where(c("ingested_at") > top.scalar())
    for part in (first, second.unionByName(repeated)):
        st.append(part, landing)
        jobs.append_to(jobs.deduplicated(jobs.raw_stream(t.spark, landing), "1 hour")
                       .select("prblm_code", "prblm_updateddate", "ingested_at"), out, state)
    return st.read(t.spark, out)


def _hourly(t: Tables, delay: str, log: progress.ProgressLog | None = None) -> DataFrame:
    landing, out, state = t.scratch("landing"), t.scratch("hours"), t.scratch("state")
    for part in _two(t.raw):
        st.append(part, landing)
        counts = jobs.hourly_counts(jobs.raw_stream(t.spark, landing), delay)
        ended = jobs.keep_latest(counts.withColumn("month_sk", fn.month_sk(c("hour_start"))), out,
                                 ["hour_start", "catsub_id"], "month_sk", state)
        if log:
            log.wait_for(ended)
    return st.read(t.spark, out).select("hour_start", "catsub_id", "total_tickets", "complain_tickets")


HOURLY = """SELECT date_trunc('hour', prblm_sysdate) AS hour_start, catsub_id, count(*) AS total_tickets,
       count(*) FILTER (WHERE prblm_complain_id >= 2) AS complain_tickets"""


@query("l4_hourly_tumbling", f"{HOURLY} FROM t_raw GROUP BY ALL")
def hourly_tumbling(t: Tables):
    return _hourly(t, "120 days")


@query("l5_watermark_late_data", f"""
{HOURLY} FROM t_raw, (SELECT max(prblm_sysdate) - INTERVAL 30 DAY AS mark FROM t_raw WHERE NOT ({LATER}))
WHERE NOT ({LATER}) OR date_trunc('hour', prblm_sysdate) + INTERVAL 1 HOUR > mark GROUP BY ALL""")
def watermark_late_data(t: Tables):
    """With 30 days of patience, older hours no longer take part after the first drain."""
    return _hourly(t, "30 days")


@query("l5_dropped_late_rows", f"""
SELECT count(DISTINCT (date_trunc('hour', prblm_sysdate), catsub_id)) AS dropped_rows
FROM t_raw, (SELECT max(prblm_sysdate) - INTERVAL 30 DAY AS mark FROM t_raw WHERE NOT ({LATER}))
WHERE {LATER} AND date_trunc('hour', prblm_sysdate) + INTERVAL 1 HOUR <= mark""")
def dropped_late_rows(t: Tables):
    """What the watermark refused, as the stored progress of the stream tells: aggregates, one per hour and site."""
    return progress.by_query(_progress_of_hours(t, "30 days")).select(c("dropped_rows").alias("dropped_rows"))


@query("l7_stream_progress", "SELECT count(*)::BIGINT AS input_rows, 0::BIGINT AS dropped_rows FROM t_raw")
def stream_progress(t: Tables):
    """Both drains belong to one query; with enough patience nothing is dropped."""
    return progress.by_query(_progress_of_hours(t, "4000 days")).select("input_rows", "dropped_rows")


def _progress_of_hours(t: Tables, delay: str) -> DataFrame:
    path = t.scratch("progress")
    with progress.ProgressLog(t.spark, path) as log:
        _hourly(t, delay, log)
    return progress.stored(t.spark, path)


@query("l6_intraday_tier", f"""
SELECT date_sk, {o.KEYS5}, {OUT_LABELS}, {', '.join(o.COUNTS)}, {o.RATIO_NAMES}, source_tier, freshness_as_of FROM m_report""")
def intraday_tier(t: Tables):
    """The report after two micro-batches on two days: what was today on the first has settled."""
    report = _chain(t, AS_OF - timedelta(days=1)).read(t.spark, "mart_report").drop("month_sk", "updated_at")
    return report.where(serving_window(c("date_sk"), TODAY, False))


@query("l7_lag_monitor", f"""
SELECT table_name, date_sub('minute', top, {o.AS_OF}) AS lag_minutes, lim::BIGINT AS limit_minutes,
       CASE WHEN date_sub('minute', top, {o.AS_OF}) > lim THEN 1 ELSE 0 END AS stale
FROM (SELECT 'bronze' AS table_name, max(ingested_at) AS top, 240 AS lim FROM t_raw WHERE ingested_at <= {o.AS_OF}
      UNION ALL SELECT 'silver', max(ingested_at), 240 FROM t_raw WHERE ingested_at <= {o.AS_OF} - INTERVAL 7 HOUR
      UNION ALL SELECT 'hour_long', max(updated_at), 120 FROM t_long)""")
def lag_monitor(t: Tables):
    """Silver stopped seven hours ago; bronze and gold did not."""
    until = fn.utc_instant(AS_OF)
    old = t.raw.where(c("ingested_at") <= fn.utc_instant(AS_OF - timedelta(hours=7)))
    return dq.freshness({"bronze": (t.raw.where(c("ingested_at") <= until), "ingested_at", 240),
                         "silver": (old, "ingested_at", 240),
                         "hour_long": (t.long, "updated_at", 120)}, AS_OF)
