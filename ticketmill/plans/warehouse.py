"""The stored layers and the jobs that keep them current.

Silver is the only table that is merged. Every fact and mart partition is a
function of the silver rows of that partition, so a run recomputes the touched
partitions and swaps them in; running a batch twice changes nothing.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from .. import functions as fn, schema
from ..functions.calendar import local_day_range, local_today
from ..operators import quality as dq
from ..operators.dedup import latest_per_key, ticket_version_order
from ..operators.windows import high_water_mark
from ..sources import storage
from . import dims, facts, layers, marts
from .state import HealList, Journal, RunChecks, WatermarkLog, next_bounds, within

AUDIT_SCHEMA = ("run_id string, step string, status string, started_at timestamp, "
                "seconds double, detail string")


# Tables above silver that have the partitions of silver.
REBUILT = ("hour_wide", "hour_long", "day_wide", "mart_daily", "mart_hourly", "mart_report")


@dataclass(frozen=True)
class Warehouse:
    """Table locations under one root.

    `partition_col` is prblm_date, or month_sk where a day is much smaller than
    one file. Either way a partition value is known from a ticket's creation
    time, which never changes.
    """
    root: str
    partition_col: str = "prblm_date"

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def partition_of(self, day: Column) -> Column:
        return day if self.partition_col == "prblm_date" else fn.month_sk(day)

    def tagged(self, df: DataFrame, day: str = "prblm_date") -> DataFrame:
        if self.partition_col in df.columns:
            return df
        return df.withColumn(self.partition_col, self.partition_of(F.col(day)))

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return storage.read(spark, self.path(table))

    def slices(self, first: date, last: date, step: int) -> list[tuple[date, date]]:
        """[first, last], which covers whole partitions, in ranges of `step` partitions."""
        out = []
        while first <= last:
            end = self.cover(first, first)[1]
            for _ in range(step - 1):
                end = self.cover(first, end + timedelta(days=1))[1]
            out.append((first, min(end, last)))
            first = end + timedelta(days=1)
        return out

    def cover(self, first: date, last: date) -> tuple[date, date]:
        """The smallest range of whole partitions around [first, last]."""
        if self.partition_col == "prblm_date":
            return first, last
        end = date(last.year + last.month // 12, last.month % 12 + 1, 1) - timedelta(days=1)
        return first.replace(day=1), end


# -- bronze ------------------------------------------------------------------------

MONTH = "_created_month"


def row_rules(table: str) -> list[dq.RowRule]:
    """What every row of a table must keep; counted while it is written."""
    missing = lambda *names: [dq.not_null(n) for n in names]
    return {
        "bronze": [*missing(*schema.MANDATORY), dq.no_negative_resolution(), dq.sla_needs_response()],
        "silver": [*missing(*schema.MANDATORY, "prblm_date"), dq.accepted_values("is_resolved", [0, 1]),
                   dq.accepted_values("is_complain", [0, 1])],
        "hour_wide": [*missing("prblm_hour"), dq.accepted_values("prblm_hour", list(range(24)))],
        "day_wide": missing("prblm_date", "catsub_id", "prblm_source_id", "prblm_perform_id", "prblm_status_id",
                            "total_tickets", "updated_at"),
    }.get(table, [])


def new_batch_id(prefix: str) -> str:
    return f"{prefix}-{uuid.uuid4().hex[:16]}"


def append_bronze(wh: Warehouse, raw: DataFrame, as_of: datetime, batch_id: str,
                  checks: RunChecks | None = None) -> DataFrame:
    """Store one batch in a directory of its own and return the stored rows.

    The id must name this batch alone: a batch that is retried under its id replaces itself, and
    nothing else. Inside, rows lie by creation month. Only this directory is listed. Rows without a
    code or creation time go to `bronze_rejects`, under the same id and with the reason.
    """
    refused = Observation()
    seen = raw.observe(refused, F.count_if(layers.incomplete()).alias("n"))
    rows = layers.bronze(seen.where(~layers.incomplete()), as_of, batch_id).withColumn(
        MONTH, fn.month_sk(F.col("prblm_sysdate")))
    path = f"{wh.path('bronze')}/_batch_id={batch_id}"
    storage.replace(rows.drop("_batch_id"), path, [MONTH], cluster_by=["prblm_sysdate"],
                    watch=(checks or RunChecks()).on("bronze", row_rules("bronze")))
    rejects = f"{wh.path('bronze_rejects')}/_batch_id={batch_id}"
    n = storage.observed(refused).get("n")  # not known where no row was left to store
    if n or storage.exists(raw.sparkSession, rejects) or n is None and not raw.where(layers.incomplete()).isEmpty():
        storage.replace(layers.refused(raw), rejects)
    stored = storage.read(raw.sparkSession, path, rows.drop("_batch_id").schema)
    return stored.withColumn("_batch_id", F.lit(batch_id)).select(rows.columns)


def read_bronze(spark: SparkSession, wh: Warehouse, first: date, last: date) -> DataFrame:
    """Bronze rows created on local days of the range; months outside of it are not opened. The
    schema is given, so that an id like 007 stays text."""
    empty = spark.createDataFrame([], schema.RAW)
    stored = layers.bronze(empty, datetime(2000, 1, 1)).withColumn(MONTH, fn.month_sk(F.col("prblm_sysdate"))).schema
    months = [(d.year * 100 + d.month) for d in (first - timedelta(days=1), last + timedelta(days=1))]
    rows = storage.read(spark, wh.path("bronze"), stored)
    return rows.where(F.col(MONTH).between(*months)).where(local_day_range(F.col("prblm_sysdate"), first, last))


def incremental_append(source: DataFrame, path: str, column: str, overlap_minutes: int,
                       partition_by: list[str] = (), lookback: timedelta | None = None,
                       as_of: datetime | None = None, log: WatermarkLog | None = None) -> None:
    """Append the rows newer than the stored high-water mark minus the overlap.

    With `lookback` and `as_of` both the mark and the new rows are sought only in that much time
    before `as_of`, so that the scan of the target is bounded too. With a `log` the target is not read at
    all: the mark comes from there, and every batch has a folder of its own, which a batch that is taken
    up again replaces.
    """
    spark = source.sparkSession
    if log is not None:
        bounds = next_bounds(log, path, source, column, new_batch_id("append"), overlap_minutes,
                             as_of - lookback if lookback else None)
        if bounds is not None:
            batch_id, *span = bounds
            log.note(path, batch_id, "begun", *span)
            rows = source.where(within(column, *span)).withColumn("_batch_id", F.lit(batch_id))
            storage.overwrite_partitions(rows, path, ["_batch_id", *partition_by])
            log.note(path, batch_id, "finished", *span)
        return
    recent = F.lit(True)
    if lookback is not None:
        recent = F.col(column) >= fn.utc_instant(as_of - lookback)
        source = source.where(recent)
    if storage.exists(spark, path):
        mark = high_water_mark(storage.read(spark, path).where(recent), column, overlap_minutes)
        source = source.where(F.col(column) > fn.utc_instant(mark))
    storage.append(source, path, partition_by)


# -- silver and facts --------------------------------------------------------------

def unseen(wh: Warehouse, raw: DataFrame, log: WatermarkLog, low: datetime, batch_id: str) -> DataFrame:
    """Raw rows that no finished batch stored. Only the batches of the overlap are read, and of those
    the rows above `low`."""
    spark = raw.sparkSession
    paths = [f"{wh.path('bronze')}/_batch_id={b}" for b in log.batches_above("bronze", low) if b != batch_id]
    if not paths:
        return raw
    key = ["prblm_code", "prblm_updateddate", "ingested_at"]
    stored = spark.read.schema(layers.bronze(raw.limit(0), low).select(key).schema).parquet(*paths)
    stored = stored.where(F.col("ingested_at") > fn.utc_instant(low)).select(*[F.col(n).alias(f"_{n}") for n in key]).distinct()
    same = [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in key]
    return raw.join(stored, same[0] & same[1] & same[2], "left_anti")


def merge_silver(wh: Warehouse, bronze_rows: DataFrame, as_of: datetime, checks: RunChecks | None = None) -> list:
    """Guarded merge of a bronze batch; returns the partitions it touched.

    The batch is not deduplicated beforehand: the merge ranks stored and new
    versions together, so one ranking settles both.
    """
    batch = wh.tagged(layers.silver_columns(bronze_rows, as_of))
    return storage.upsert(batch, wh.path("silver"), ["prblm_code"], wh.partition_col,
                          ticket_version_order(), watch=checks and checks.on("silver", row_rules("silver")))


def refresh_facts(spark: SparkSession, wh: Warehouse, touched: list, as_of: datetime,
                  checks: RunChecks | None = None) -> None:
    """Recompute the touched partitions of every fact from the layer below; row rules are counted on
    the way."""
    part = F.col(wh.partition_col)

    def swap(table: str, df: DataFrame, placed: bool = False) -> DataFrame:
        rules = row_rules(table)
        storage.overwrite_partitions(wh.tagged(df), wh.path(table), [wh.partition_col], placed=placed,
                                     watch=checks.on(table, rules) if checks and rules else None)
        return wh.read(spark, table).where(part.isin(touched))

    silver = wh.read(spark, "silver").where(part.isin(touched))
    hours = swap("hour_wide", facts.hour_totals(silver, as_of))
    swap("hour_long", facts.long_from_wide(hours), placed=True)
    swap("day_wide", facts.day_wide(hours))
    refresh_months(spark, wh, touched)


def refresh_months(spark: SparkSession, wh: Warehouse, touched: list) -> None:
    """Whole months around the touched partitions, read from the stored days."""
    months = sorted({v.year * 100 + v.month if isinstance(v, date) else int(v) for v in touched})
    days = wh.read(spark, "day_wide").where(fn.month_sk(F.col("prblm_date")).isin(months)
                                            if wh.partition_col == "prblm_date"
                                            else F.col("month_sk").isin(months))
    storage.overwrite_partitions(facts.month_wide(days), wh.path("month_wide"), ["month_sk"])


def refresh_marts(spark: SparkSession, wh: Warehouse, today: date, touched: list | None = None) -> None:
    """Serving tables. The report keeps one tier per date, since each partition is
    written whole. All rows but today's sums lie in files of their partitions."""
    days, hours = wh.read(spark, "day_wide"), wh.read(spark, "hour_wide")
    if touched is not None:
        part = F.col(wh.partition_col)
        days, hours = days.where(part.isin(touched)), hours.where(part.isin(touched))
    for table, df in (("mart_daily", marts.ticket_daily(days, today)),
                      ("mart_hourly", marts.ticket_hourly(hours, today)),
                      ("mart_report", marts.daily_report(days, hours, today))):
        keyed = df.withColumn(wh.partition_col, wh.partition_of(F.col("date_sk")))
        storage.overwrite_partitions(keyed, wh.path(table), [wh.partition_col], placed=True)


# -- jobs --------------------------------------------------------------------------

class AuditedRun:
    """Times steps and appends one audit row per step, also for the failing one."""

    def __init__(self, spark: SparkSession, wh: Warehouse, run_id: str):
        self.spark, self.wh, self.run_id = spark, wh, run_id

    def step(self, name: str, action: Callable[[], object]) -> object:
        started, clock = datetime.now(timezone.utc), time.monotonic()
        status, detail, result = "failed", "", None
        try:
            result = action()
            status = "success"
            return result
        except Exception as error:
            detail = f"{type(error).__name__}: {error}"
            raise
        finally:
            detail = str(result) if status == "success" and isinstance(result, int) else detail
            row = (self.run_id, name, status, started, time.monotonic() - clock, detail)
            storage.append(self.spark.createDataFrame([row], AUDIT_SCHEMA).coalesce(1),
                           self.wh.path("audit"))


def write_dims(spark: SparkSession, wh: Warehouse, first: date, last: date) -> None:
    tables = {"dim_catsub": dims.dim_catsub(spark), "dim_prblm_source": dims.dim_source(spark),
              "dim_prblm_status": dims.dim_status(spark), "dim_perform": dims.dim_perform(spark),
              "dim_date": dims.dim_date_range(spark, first, last)}
    for name, df in tables.items():
        storage.replace(df.coalesce(1), wh.path(name))


def gold_checks(spark: SparkSession, wh: Warehouse, checks: RunChecks) -> DataFrame:
    """The row rules as they were counted while writing, and those that need whole tables."""
    days = wh.read(spark, "day_wide")
    dim_of = {"catsub_id": "dim_catsub", "prblm_source_id": "dim_prblm_source",
              "prblm_perform_id": "dim_perform", "prblm_status_id": "dim_prblm_status"}
    parents = {"prblm_date": (wh.read(spark, "dim_date"), "date_sk"),
               **{k: (wh.read(spark, d), k) for k, d in dim_of.items()}}
    whole = dq.run_checks([
        ("day_wide", dq.unique(days, facts.DAY_KEYS)),
        ("day_wide", dq.relationships(days, parents)),
        ("mart_daily", dq.row_count_min(wh.read(spark, "mart_daily"), "mart_daily")),
    ])
    counted = checks.frame(spark).withColumn("status", F.when(F.col("failures") > 0, "fail").otherwise("pass"))
    return whole.unionByName(counted)


def daily_build(spark: SparkSession, wh: Warehouse, raw: DataFrame, as_of: datetime,
                calendar: tuple[date, date], run_id: str | None = None,
                fresh_hours: int | None = None, refresh: bool = False, incremental: bool = False,
                lookback_hours: int | None = None, overlap_minutes: int = 10) -> DataFrame:
    """Nightly run over all layers in dependency order; returns the check results.

    A run that is retried passes the id of the first attempt; otherwise it gets one of its own.
    With `fresh_hours` nothing is written unless some row arrived that recently. With `refresh` the
    marts are rewritten for the refresh window and for what the night changed, not for all served days.

    With `incremental`, `raw` is the whole raw table, of which the run takes what arrived after the
    stored mark less an overlap, without what is stored already, and (with `lookback_hours`) no further back than
    that. The mark moves when all layers are done: a run that broke off is taken up with its bounds by the next one.
    """
    log, bounds = WatermarkLog(spark, wh.path("watermarks")), None
    if incremental:
        since = as_of - timedelta(hours=lookback_hours) if lookback_hours is not None else None
        bounds = next_bounds(log, "bronze", raw, "ingested_at", run_id or new_batch_id("daily"), overlap_minutes, since)
        if bounds is None:
            return gold_checks(spark, wh, RunChecks())
        run_id, low, high = bounds
        raw = unseen(wh, raw.where(within("ingested_at", low, high)), log, low, run_id)
        if raw.isEmpty() and storage.exists(spark, wh.path("mart_daily")):
            return gold_checks(spark, wh, RunChecks())
        log.note("bronze", run_id, "begun", low, high)
    run_id = run_id or new_batch_id("daily")
    run, today, checks = AuditedRun(spark, wh, run_id), local_today(as_of), RunChecks()
    if fresh_hours is not None:
        run.step("freshness", lambda: dq.enforce(dq.run_checks(
            [("raw", dq.source_freshness(raw, "ingested_at", as_of, fresh_hours))])))
    run.step("dims", lambda: write_dims(spark, wh, *calendar))
    rows = run.step("bronze", lambda: append_bronze(wh, raw, as_of, run_id, checks))
    touched = run.step("silver", lambda: merge_silver(wh, rows, as_of, checks))
    run.step("facts", lambda: refresh_facts(spark, wh, touched, as_of, checks))
    run.step("marts", lambda: refresh_marts(
        spark, wh, today, changed_partitions(spark, wh, touched, today) if refresh else None))
    run.step("retention", lambda: [
        storage.expire(spark, wh.path(t), wh.partition_col, today)
        for t in ("mart_daily", "mart_hourly", "mart_report")])
    checks.save(spark, wh.path("checks"), run_id)
    if bounds:
        log.note("bronze", run_id, "finished", *bounds[1:])
    return gold_checks(spark, wh, checks)


def run_batch(spark: SparkSession, wh: Warehouse, raw: DataFrame, as_of: datetime,
              batch_id: str, heal_days: int | None = None) -> list:
    """One micro-batch through every layer, touching only the partitions it reaches.

    A cycle without rows, or without one that is a ticket, changes no layer above bronze. With `heal_days` partitions that end
    earlier than that many days before today are merged into silver and left to `heal` above it, so that late rows do not
    lengthen the cycle.
    """
    if raw.isEmpty():
        return []
    run, today, checks = AuditedRun(spark, wh, batch_id), local_today(as_of), RunChecks()
    rows = run.step("bronze", lambda: append_bronze(wh, raw, as_of, batch_id, checks))
    if rows.isEmpty():
        return []
    touched = run.step("silver", lambda: merge_silver(wh, rows, as_of, checks))
    if heal_days is not None:
        late = [v for v in touched if storage._last_day(str(v)) < today - timedelta(days=heal_days)]
        if late:
            HealList(spark, wh.path("heal_list")).note(late, batch_id)
        touched = [v for v in touched if v not in late]
    if touched:
        run.step("facts", lambda: refresh_facts(spark, wh, touched, as_of, checks))
    checks.save(spark, wh.path("checks"), batch_id)
    if not storage.exists(spark, wh.path("day_wide")):
        return touched
    ended = run.step("ended days", lambda: ended_intraday(spark, wh, today))
    run.step("marts", lambda: refresh_marts(spark, wh, today, sorted({*touched, *ended})))
    return touched


def changed_partitions(spark: SparkSession, wh: Warehouse, touched: list, today: date) -> list:
    """Partitions of the marts that a night can have changed."""
    recent = [today - timedelta(days=i) for i in range(marts.REFRESH_DAYS + 1)]
    values = {d if wh.partition_col == "prblm_date" else d.year * 100 + d.month for d in recent}
    return sorted({*values, *touched, *ended_intraday(spark, wh, today)})


def ended_intraday(spark: SparkSession, wh: Warehouse, today: date) -> list:
    """Partitions of the report with days before today that were written while they went on."""
    if not storage.exists(spark, wh.path("mart_report")):
        return []
    report = wh.read(spark, "mart_report")
    stale = report.where((F.col("date_sk") < F.lit(today)) & (F.col("source_tier") == marts.INTRADAY_TIER))
    return storage.touched_values(stale, wh.partition_col)


def backfill(spark: SparkSession, wh: Warehouse, first: date, last: date, as_of: datetime,
             run_id: str | None = None, step: int | None = None) -> list:
    """Rebuild silver and everything above it for a date range from bronze; returns the partitions.

    The range becomes a literal bound on the creation instant, so bronze is
    pruned by row-group statistics, and it grows to whole partitions. With `step` it is worked
    off in slices of that many partitions, each journaled when it is done; a call under the id of one that
    broke off leaves those out.
    """
    run_id = run_id or new_batch_id("backfill")
    run, journal, out = AuditedRun(spark, wh, run_id), Journal(spark, wh.path("backfill_journal")), []
    first, last = wh.cover(first, last)
    finished = journal.finished(run_id)
    for low, high in wh.slices(first, last, step) if step else [(first, last)]:
        if (low, high) not in finished:
            out += run.step(f"backfill {low} {high}", lambda: _backfill(spark, wh, low, high, as_of))  # noqa: B023
            journal.note(run_id, low, high)
    return out


def heal(spark: SparkSession, wh: Warehouse, as_of: datetime) -> list[str]:
    """Works off the heal list, a partition at a time, so that a break loses only the one at work."""
    waiting, done = HealList(spark, wh.path("heal_list")), []
    for value in waiting.open():
        began = datetime.now(timezone.utc).replace(tzinfo=None)
        last = storage._last_day(value)
        run_id = new_batch_id("heal")
        backfill(spark, wh, last, last, as_of, run_id)
        waiting.done(value, began, run_id)
        done.append(value)
    return done


def _backfill(spark: SparkSession, wh: Warehouse, first: date, last: date, as_of: datetime) -> list:
    rows = read_bronze(spark, wh, first, last)
    current = latest_per_key(rows, ["prblm_code"], ticket_version_order())
    rebuilt = wh.tagged(layers.silver_columns(current, as_of))
    # Partitions of the range that got no rows are emptied in every table.
    days = [first + timedelta(days=i) for i in range((last - first).days + 1)]
    values = sorted({d if wh.partition_col == "prblm_date" else d.year * 100 + d.month for d in days})
    noted = storage.Noted(wh.partition_col, rebuilt.schema[wh.partition_col].dataType)
    storage.replace_slice(rebuilt, wh.path("silver"), wh.partition_col, values, watch=noted)
    touched = noted.values()
    gone = [v for v in values if v not in set(touched)]
    for table in REBUILT:
        for value in gone:
            storage.drop_partition(spark, wh.path(table), wh.partition_col, value)
    if touched:
        refresh_facts(spark, wh, touched, as_of)
        refresh_marts(spark, wh, local_today(as_of), touched)
    for table in ("silver", *REBUILT):
        if touched and wh.read(spark, table).where(F.col(wh.partition_col).isin(touched)).isEmpty():
            raise ValueError(f"{table} has no rows of the range after the backfill")
    return touched
