"""Type-2 history: one row per version with its validity interval.

Stored, the open versions are one partition (closed_month 0) and the closed ones lie by the month and the
snapshot that closed them. A snapshot reads and rewrites the open versions only.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from ..functions import month_sk, stable_hash64, utc_instant
from ..sources import storage


def _digest(columns: list[str]):
    parts = [F.coalesce(F.col(n).cast("string"), F.lit("\x00")) for n in columns]
    return stable_hash64(F.concat_ws("\x1f", *parts))


def first_snapshot(snapshot: DataFrame, at: datetime) -> DataFrame:
    return snapshot.withColumns({
        "valid_from": utc_instant(at), "valid_to": F.lit(None).cast("timestamp"),
        "is_current": F.lit(1)})


def apply_snapshot(history: DataFrame, snapshot: DataFrame, key: str, tracked: list[str],
                   at: datetime, close_missing: bool = False) -> DataFrame:
    """Close versions whose tracked columns changed and open their successors.

    One full join of the current rows with the snapshot gives both the closed and
    the opened rows; closed history never takes part in the shuffle.
    """
    past = history.where(F.col("is_current") == 0)
    versions = _next_versions(history.where(F.col("is_current") == 1), snapshot, key, tracked, at, close_missing)
    return past.select(history.columns).unionByName(versions)


def _next_versions(live: DataFrame, snapshot: DataFrame, key: str, tracked: list[str], at: datetime,
                   close_missing: bool) -> DataFrame:
    """The current versions after a snapshot, and those that it closes. A version that is newer than
    the snapshot stays as it is."""
    now, history = utc_instant(at), live
    old = live.select(F.col(key), F.struct(*history.columns).alias("old"), _digest(tracked).alias("od"))
    new = snapshot.select(F.col(key), F.struct(*snapshot.columns).alias("new"), _digest(tracked).alias("nd"))
    both = old.join(new, key, "full")

    earlier = F.col("old").isNotNull() & (F.col("old.valid_from") < now)
    changed = earlier & F.col("new").isNotNull() & (F.col("od") != F.col("nd"))
    gone = earlier & F.col("new").isNull() if close_missing else F.lit(False)
    ended = changed | gone
    kept = [F.col(f"old.{n}").alias(n) for n in history.columns if n not in ("valid_to", "is_current")]
    before = F.struct(*kept,
                      F.when(ended, now).otherwise(F.col("old.valid_to")).alias("valid_to"),
                      F.when(ended, 0).otherwise(1).alias("is_current"))
    after = F.struct(*[F.col(f"new.{n}").alias(n) for n in history.columns
                       if n not in ("valid_from", "valid_to", "is_current")],
                     now.alias("valid_from"),
                     F.lit(None).cast("timestamp").alias("valid_to"), F.lit(1).alias("is_current"))
    rows = F.array_compact(F.array(
        F.when(F.col("old").isNotNull(), before),
        F.when(F.col("new").isNotNull() & (changed | F.col("old").isNull()), after)))
    return both.select(F.inline(rows)).select(history.columns)


# -- stored ------------------------------------------------------------------------------

MONTH, CLOSED_BY = "closed_month", "closed_by"
OPEN = 0
_STAMP = "%Y%m%dT%H%M%S%f"


def store_snapshot(snapshot: DataFrame, path: str, key: str, tracked: list[str], at: datetime,
                   close_missing: bool = False) -> None:
    """Apply a snapshot to a stored history.

    Closed versions are written first, into a folder that bears the snapshot's time; then the open
    ones are swapped. A run that breaks in between and is repeated, before the next snapshot, finds the same
    open versions again and writes the same folder; a snapshot that was applied already finds nothing to close.
    One that is older than the last change comes too late and changes nothing.
    """
    spark = snapshot.sparkSession
    if not storage.exists(spark, path):
        storage.replace(_placed(first_snapshot(snapshot, at), at), path, [MONTH, CLOSED_BY])
        return
    live = open_versions(read_history(snapshot, path))
    if at < _last_change(live, path):
        return
    after = _placed(_next_versions(live, snapshot, key, tracked, at, close_missing), at)
    storage.overwrite_partitions(after.where(F.col(MONTH) != OPEN), path, [MONTH, CLOSED_BY])
    storage.overwrite_partitions(after.where(F.col(MONTH) == OPEN), path, [MONTH, CLOSED_BY])


def _last_change(live: DataFrame, path: str) -> datetime:
    """When a version was last opened or closed: from the open versions and the names of folders."""
    opened = live.agg(F.unix_micros(F.max("valid_from"))).first()[0]
    times = [datetime.min if opened is None else datetime(1970, 1, 1) + timedelta(microseconds=opened)]
    months = [v for v in storage.partition_values(live.sparkSession, path, MONTH) if v != str(OPEN)]
    if months:
        closed = storage.partition_values(live.sparkSession, f"{path}/{MONTH}={max(months)}", CLOSED_BY)
        times += [datetime.strptime(max(closed), _STAMP)] if closed else []
    return max(times)


def _placed(versions: DataFrame, at: datetime) -> DataFrame:
    closed = F.col("is_current") == 0
    return versions.withColumns({
        MONTH: F.when(closed, month_sk(F.to_date("valid_to"))).otherwise(F.lit(OPEN)).cast("int"),
        CLOSED_BY: F.when(closed, F.lit(at.strftime(_STAMP))).otherwise(F.lit("-"))})


def read_history(like: DataFrame, path: str) -> DataFrame:
    """The stored history of snapshots with the columns of `like`."""
    spark = like.sparkSession
    schema = _placed(first_snapshot(like.limit(0), datetime(2000, 1, 1)), datetime(2000, 1, 1)).schema
    return storage.read(spark, path, schema)


def open_versions(history: DataFrame) -> DataFrame:
    """Current versions: one partition, whatever the length of the history."""
    return history.where(F.col(MONTH) == OPEN).drop(MONTH, CLOSED_BY)


def versions_at(history: DataFrame, moment: datetime) -> DataFrame:
    """Versions that held at a moment: open ones and those closed since, by partition."""
    then, month = utc_instant(moment), moment.year * 100 + moment.month
    return history.where((F.col(MONTH) == OPEN) | (F.col(MONTH) >= month)).where(
        (F.col("valid_from") <= then) & (F.col("valid_to").isNull() | (F.col("valid_to") > then))).drop(MONTH, CLOSED_BY)
