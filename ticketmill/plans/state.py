"""What jobs remember between runs: how far a source was read, what the rules counted, which
partitions still have to be rebuilt, and which schemas were stored.

Every state is a small append-only table of events, one row per batch, rule or partition; what
holds now is an aggregate over them. No state needs a scan of the data it speaks of.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions import utc_instant
from ..operators.quality import RowRule, schema_diff, schema_rows
from ..sources import storage

# Where a source is read from while there is no mark.
EARLIEST = datetime(1900, 1, 1)


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _naive(micros: int | None) -> datetime | None:
    return None if micros is None else datetime(1970, 1, 1) + timedelta(microseconds=micros)


class EventTable:
    """Rows of one schema, appended a file at a time, in partitions of `part`."""

    def __init__(self, spark: SparkSession, path: str, schema: str, part: str):
        self.spark, self.path, self.part = spark, path, part
        self.schema = spark.createDataFrame([], schema).schema

    def add(self, *rows: tuple) -> None:
        if rows:
            storage.append(self.spark.createDataFrame(list(rows), self.schema).coalesce(1), self.path, [self.part])

    def rows(self) -> DataFrame:
        if not storage.exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        return storage.read(self.spark, self.path, self.schema)


# -- watermarks ----------------------------------------------------------------------

class WatermarkLog:
    """How far each target has read its source, one event when a batch begins and one when all of its
    work is done.

    The mark is the largest upper bound of a finished batch. A batch that began and did not finish is
    taken up again under its id and with its bounds, whatever arrived since.
    """

    SCHEMA = "target string, batch_id string, state string, low_us long, high_us long, noted_at timestamp"

    def __init__(self, spark: SparkSession, path: str):
        self.events = EventTable(spark, path, self.SCHEMA, "target")

    def _of(self, target: str) -> DataFrame:
        return self.events.rows().where(F.col("target") == target)

    def mark(self, target: str) -> datetime | None:
        return _naive(self._of(target).where("state = 'finished'").agg(F.max("high_us")).first()[0])

    def pending(self, target: str) -> tuple[str, datetime, datetime] | None:
        """Id and bounds of the batch that began last, if it did not finish."""
        batches = self._of(target).groupBy("batch_id").agg(
            F.max("noted_at").alias("_at"), F.max("low_us").alias("_low"), F.max("high_us").alias("_high"),
            F.bool_or(F.col("state") == "finished").alias("_done"))
        found = batches.where("not _done").orderBy(F.desc("_at"), "batch_id").limit(1).collect()
        return (found[0]["batch_id"], _naive(found[0]["_low"]), _naive(found[0]["_high"])) if found else None

    def batches_above(self, target: str, low: datetime) -> list[str]:
        """Finished batches that hold rows above `low`: those of the overlap."""
        above = self._of(target).where("state = 'finished'").where(F.col("high_us") > _micros(low))
        return sorted(r[0] for r in above.select("batch_id").distinct().collect())

    def note(self, target: str, batch_id: str, state: str, low: datetime, high: datetime) -> None:
        self.events.add((target, batch_id, state, _micros(low), _micros(high), _now()))


def _micros(moment: datetime) -> int:
    return (moment - datetime(1970, 1, 1)) // timedelta(microseconds=1)


def repaired_mark(spark: SparkSession, path: str, column: str, partition_col: str) -> datetime | None:
    """The largest value of a column, from the last partition alone, for a target whose log is lost.
    The partition must grow with the column, like the day of arrival with its time."""
    values = [v for v in storage.partition_values(spark, path, partition_col) if v != storage.NULL_PARTITION]
    if not values:
        return None
    last = storage.read(spark, path).where(F.col(partition_col).cast("string") == values[-1])
    return _naive(last.agg(F.unix_micros(F.max(column))).first()[0])


def next_bounds(log: WatermarkLog, target: str, source: DataFrame, column: str, batch_id: str, overlap_minutes: int,
                since: datetime | None = None, fallback: datetime | None = None) -> tuple[str, datetime, datetime] | None:
    """(batch id, low, high] of the next batch, or None without rows above the mark less the overlap.

    `since` bounds how far back the source is read at all; `fallback` is the mark where the log has none.
    """
    if waiting := log.pending(target):
        return waiting
    mark = log.mark(target) or fallback
    low = mark - timedelta(minutes=overlap_minutes) if mark else EARLIEST
    low = max(low, since) if since else low
    top = _naive(source.where(F.col(column) > utc_instant(low)).agg(F.unix_micros(F.max(column))).first()[0])
    return None if top is None else (batch_id, low, max(top, mark or top))


def within(column: str, low: datetime, high: datetime) -> Column:
    return (F.col(column) > utc_instant(low)) & (F.col(column) <= utc_instant(high))


# -- rules counted while a layer is written ----------------------------------------------

CHECKS = ("run_id string, table_name string, rule string, column_name string, failures long, "
          "checked long, status string, noted_at timestamp")


class RunChecks:
    """Row rules that are counted on the way into the files, without a scan of their own.

    They are observed behind the last shuffle of a write, where a task's counts enter once.
    """

    def __init__(self):
        self.watched: list[tuple[str, list[RowRule], Observation]] = []

    def on(self, table: str, rules: list[RowRule]) -> storage.Watch:
        def watch(df: DataFrame) -> DataFrame:
            seen = Observation()
            self.watched.append((table, rules, seen))
            return df.observe(seen, F.count(F.lit(1)).alias("checked"),
                              *[F.count_if(F.coalesce(r.failing, F.lit(False))).alias(f"r{i}") for i, r in enumerate(rules)])
        return watch

    def results(self) -> list[tuple]:
        """(table, rule, column, failures, checked) of everything written so far."""
        out = []
        for table, rules, seen in self.watched:
            found = storage.observed(seen)
            out += [(table, r.rule, r.column, int(found.get(f"r{i}") or 0), int(found.get("checked") or 0))
                    for i, r in enumerate(rules)]
        return out

    def frame(self, spark: SparkSession) -> DataFrame:
        """In the form of rule results, several writes of a table added up."""
        rows = spark.createDataFrame(self.results(), "table_name string, rule string, column_name string, failures long, checked long")
        return rows.groupBy("table_name", "rule", "column_name").agg(
            F.sum("failures").alias("failures"), F.sum("checked").alias("checked"))

    def save(self, spark: SparkSession, path: str, run_id: str) -> None:
        rows = [(run_id, *r, "fail" if r[3] else "pass", _now()) for r in self.results()]
        if rows:
            storage.append(spark.createDataFrame(rows, CHECKS).coalesce(1), path)


# -- partitions that wait for a rebuild ---------------------------------------------------

class HealList:
    """Partitions that late rows reached beyond the window of the runs, until they are rebuilt."""

    SCHEMA = "state string, value string, source string, noted_at timestamp"

    def __init__(self, spark: SparkSession, path: str):
        self.events = EventTable(spark, path, self.SCHEMA, "state")

    def note(self, values: list, source: str) -> None:
        self.events.add(*[("noted", str(v), source, _now()) for v in values])

    def done(self, value, since: datetime, source: str) -> None:
        """`since` is when the rebuild began: what was noted later stays on the list."""
        self.events.add(("done", str(value), source, since))

    def open(self) -> list[str]:
        at = lambda state: F.max(F.when(F.col("state") == state, F.col("noted_at")))
        events = self.events.rows().groupBy("value").agg(at("noted").alias("_noted"), at("done").alias("_done"))
        waiting = events.where("_noted is not null and (_done is null or _done < _noted)")
        return sorted(r[0] for r in waiting.select("value").collect())


class Journal:
    """Finished slices of long jobs, so that a job that broke off goes on behind them."""

    SCHEMA = "run_id string, first_day date, last_day date, noted_at timestamp"

    def __init__(self, spark: SparkSession, path: str):
        self.events = EventTable(spark, path, self.SCHEMA, "run_id")

    def finished(self, run_id: str) -> set[tuple[date, date]]:
        own = self.events.rows().where(F.col("run_id") == run_id)
        return {(r[0], r[1]) for r in own.select("first_day", "last_day").collect()}

    def note(self, run_id: str, first: date, last: date) -> None:
        self.events.add((run_id, first, last, _now()))


# -- schemas of stored tables --------------------------------------------------------------

class SchemaLog:
    """The schema of every table at every run, and what changed against the run before."""

    VERSIONS = "table_name string, run_id string, position int, column_name string, type string, noted_at timestamp"
    DRIFT = "table_name string, run_id string, column_name string, change string, old_type string, new_type string, noted_at timestamp"

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.versions = EventTable(spark, f"{root}/schema_versions", self.VERSIONS, "table_name")
        self.drift = EventTable(spark, f"{root}/schema_drift", self.DRIFT, "table_name")

    def last(self, table: str) -> list[tuple[str, str]]:
        """(column, type) in order, as of the last run that stored the table."""
        own = self.versions.rows().where(F.col("table_name") == table)
        newest = own.agg(F.max_by("run_id", "noted_at")).first()[0]
        return [(r[0], r[1]) for r in own.where(F.col("run_id") == newest).orderBy("position").select("column_name", "type").collect()]

    def store(self, table: str, df: DataFrame, run_id: str) -> list[tuple]:
        """Logs the schema and returns (column, change, old type, new type) against the last one. A
        run that is repeated, and a table that did not change, add nothing."""
        before, now = self.last(table), schema_rows(df.schema)
        if before == now:
            return []
        at = _now()
        changes = schema_diff(dict(before), dict(now)) if before else []
        self.drift.add(*[(table, run_id, *change, at) for change in changes])
        self.versions.add(*[(table, run_id, i, name, kind, at) for i, (name, kind) in enumerate(now)])
        return changes
