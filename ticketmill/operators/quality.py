"""Data-quality rules as result rows (rule, column_name, failures, checked).

Row-level rules of one table share a single pass; only uniqueness and foreign
keys with parents of unknown size need their own shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import utc_instant

RESULT = "rule string, column_name string, failures bigint, checked bigint"


@dataclass(frozen=True)
class RowRule:
    rule: str
    column: str
    failing: Column


def not_null(column: str) -> RowRule:
    return RowRule("not_null", column, F.col(column).isNull())


def accepted_values(column: str, values: list) -> RowRule:
    """NULL passes; not_null is its own rule."""
    return RowRule("accepted_values", column, F.col(column).isNotNull() & ~F.col(column).isin(values))


def no_negative_resolution() -> RowRule:
    return RowRule("no_negative_resolution", "resolution_hours",
                   (F.col("is_resolved") == 1) & (F.col("resolution_hours") < 0))


def sla_needs_response() -> RowRule:
    return RowRule("sla_logic", "response_hours",
                   (F.col("within_sla") == 1) & F.col("response_hours").isNull())


def check_rows(df: DataFrame, rules: list[RowRule]) -> DataFrame:
    """All row-level rules in one scan and one aggregate row, then one row per rule."""
    counted = df.agg(F.count("*").alias("_n"),
                     *[F.count_if(r.failing).alias(f"_r{i}") for i, r in enumerate(rules)])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(r.rule).alias("rule"), F.lit(r.column).alias("column_name"),
                 F.col(f"_r{i}").alias("failures"), F.col("_n").alias("checked"))
        for i, r in enumerate(rules)])))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


def unique(df: DataFrame, keys: list[str]) -> DataFrame:
    rule = "unique" if len(keys) == 1 else "unique_combination"
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(F.lit(rule).alias("rule"), F.lit(",".join(keys)).alias("column_name"),
                       F.count_if(F.col("n") > 1).alias("failures"),
                       F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("checked"))


def relationships(df: DataFrame, parents: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Orphan counts of several foreign keys in one scan of the child.

    The child is reduced to its distinct (column, key) pairs with their counts
    before it meets the parents, so a frequent key costs one row.
    """
    pairs = F.inline(F.array(*[
        F.struct(F.lit(n).alias("column_name"), F.col(n).cast("string").alias("key")) for n in parents]))
    used = (df.select(pairs).where(F.col("key").isNotNull())
            .groupBy("column_name", "key").agg(F.count("*").alias("n")))
    known = reduce(DataFrame.unionByName, [
        parent.select(F.lit(n).alias("column_name"), F.col(k).cast("string").alias("key")).distinct()
        for n, (parent, k) in parents.items()]).withColumn("_hit", F.lit(1))
    found = used.join(known, ["column_name", "key"], "left").groupBy("column_name").agg(
        F.sum(F.when(F.col("_hit").isNull(), F.col("n")).otherwise(0)).alias("failures"),
        F.sum("n").alias("checked"))
    names = df.sparkSession.createDataFrame([(n,) for n in parents], "column_name string")
    return F.broadcast(names).join(found, "column_name", "left").select(
        F.lit("relationships").alias("rule"), "column_name",
        F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures"),
        F.coalesce("checked", F.lit(0)).cast("bigint").alias("checked"))


def hash_collisions(df: DataFrame, key: str, natural: str) -> DataFrame:
    return (df.select(key, natural).distinct().groupBy(key)
            .agg(F.count(natural).alias("natural_key_count"))
            .where(F.col("natural_key_count") > 1))


def row_count_min(df: DataFrame, table: str, minimum: int = 1) -> DataFrame:
    n = F.count("*")
    return df.agg(
        F.lit("row_count_min").alias("rule"), F.lit(table).alias("column_name"),
        F.when(n < minimum, 1).otherwise(0).cast("bigint").alias("failures"), n.alias("checked"))


def source_freshness(df: DataFrame, column: str, as_of: datetime, hours: int = 24) -> DataFrame:
    """Fails when nothing arrived in the last hours before as_of."""
    lo, hi = (utc_instant(t) for t in (as_of - timedelta(hours=hours), as_of))
    recent = df.where((F.col(column) >= lo) & (F.col(column) <= hi))
    n = F.count("*")
    return recent.agg(F.lit("source_freshness").alias("rule"), F.lit(column).alias("column_name"),
                      F.when(n == 0, 1).otherwise(0).cast("bigint").alias("failures"),
                      n.alias("checked"))


def freshness(tables: dict[str, tuple[DataFrame, str, int]], as_of: datetime) -> DataFrame:
    """Lag of max(column) behind as_of in minutes, against a limit per table."""
    rows = []
    for name, (df, column, limit) in tables.items():
        lag = F.timestamp_diff("MINUTE", F.max(column), utc_instant(as_of))
        rows.append(df.agg(F.lit(name).alias("table_name"), lag.alias("lag_minutes"),
                           F.lit(limit).cast("bigint").alias("limit_minutes"),
                           F.when(lag.isNull() | (lag > limit), 1).otherwise(0).alias("stale")))
    return reduce(DataFrame.unionByName, rows)


def fingerprints(df: DataFrame, by: list[str], columns: list[str] | None = None) -> DataFrame:
    """Rows, xor and sum of row hashes per partition, which do not depend on the order of the rows. The
    sum tells repeated rows apart, which cancel out in the xor."""
    row = F.xxhash64(*[F.col(f"`{n}`") for n in columns or sorted(df.columns)],
                     *[F.col(f"`{n}`").isNull() for n in columns or sorted(df.columns)])
    return df.select(*by, row.alias("_h")).groupBy(*by).agg(
        F.count("*").alias("n_rows"), F.bit_xor("_h").alias("hash_xor"), F.sum(F.col("_h").cast("decimal(38,0)")).alias("hash_sum"))


def differing(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Partitions whose fingerprints differ or that one side lacks, with the rows of both sides. Only
    fingerprints meet, not the tables."""
    sides = [df.select(*by, F.struct("n_rows", "hash_xor", "hash_sum").alias(n)) for df, n in ((left, "_l"), (right, "_r"))]
    both = sides[0].unionByName(sides[1], allowMissingColumns=True).groupBy(*by).agg(
        *[F.any_value(n, ignoreNulls=True).alias(n) for n in ("_l", "_r")])
    return both.where(~F.col("_l").eqNullSafe(F.col("_r"))).select(
        *by, *[F.coalesce(f"{n}.n_rows", F.lit(0)).alias(out) for n, out in (("_l", "left_rows"), ("_r", "right_rows"))])


def reconcile(left: DataFrame, right: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Keys on which two tables disagree about a metric total, or which one side lacks."""
    def totals(df: DataFrame, side: str) -> DataFrame:
        return df.groupBy(*keys).agg(*[F.sum(m).cast("double").alias(f"{m}_{side}") for m in metrics])

    both = totals(left, "left").join(totals(right, "right"), keys, "full")
    differs = [~F.col(f"{m}_left").eqNullSafe(F.col(f"{m}_right")) for m in metrics]
    return both.where(reduce(lambda a, b: a | b, differs))


def rates(df: DataFrame, keys: list[str], source: str, cast: Column) -> DataFrame:
    """Share of surplus rows per key and share of present values that cast."""
    per_key = df.groupBy(*keys).agg(
        F.count("*").alias("n"), F.count(source).alias("present"), F.count(cast).alias("cast_ok"))
    return per_key.agg(
        F.sum("n").cast("bigint").alias("n_rows"),
        ((F.sum("n") - F.count("*")).cast("double") / F.sum("n")).alias("duplicate_rate"),
        (F.sum("cast_ok").cast("double") / F.sum("present")).alias("cast_success_rate"))


# -- schemas ------------------------------------------------------------------------

NUMERIC_KEYS = (T.NumericType, T.DateType)


def beside(one_row: DataFrame, names: list[str], rows: list[tuple]) -> DataFrame:
    """A few literal text rows, each next to the columns of a one-row frame."""
    structs = [F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(names, r)]) for r in rows]
    return one_row.select(F.inline(F.array(*structs)), *one_row.columns)


def schema_rows(schema: T.StructType) -> list[tuple]:
    return [(f.name, f.dataType.simpleString()) for f in schema]


def schema_diff(before: T.StructType | dict, after: T.StructType | dict) -> list[tuple]:
    """(column, change, old type, new type) per difference of schemas or of {column: type}."""
    old, new = (s if isinstance(s, dict) else dict(schema_rows(s)) for s in (before, after))
    rows = [(n, "removed", old[n], None) for n in old if n not in new]
    rows += [(n, "added", None, new[n]) for n in new if n not in old]
    rows += [(n, "type_changed", old[n], new[n]) for n in old if n in new and old[n] != new[n]]
    return rows


def contract_violations(df: DataFrame, contract: T.StructType, numeric_only: bool,
                        audit: tuple[str, ...] = ("updated_at",)) -> list[tuple[str, str]]:
    """(column, problem) pairs; serving facts may hold numbers and dates only."""
    have = {f.name: f.dataType for f in df.schema}
    out = [(f.name, "missing") for f in contract if f.name not in have]
    out += [(f.name, "type") for f in contract if f.name in have and have[f.name] != f.dataType]
    if numeric_only:
        out += [(n, "not_numeric") for n, t in have.items()
                if n not in audit and not isinstance(t, NUMERIC_KEYS)]
    return out


# -- runner -------------------------------------------------------------------------

def run_checks(results: list[tuple[str, DataFrame]]) -> DataFrame:
    """All rule results of all tables with a status; nothing is raised here."""
    tagged = [df.select(F.lit(table).alias("table_name"), "rule", "column_name", "failures", "checked")
              for table, df in results]
    return reduce(DataFrame.unionByName, tagged).withColumn(
        "status", F.when(F.col("failures") > 0, "fail").otherwise("pass"))


def enforce(results: DataFrame) -> None:
    """Raise on all failing rules; results has one row per rule."""
    failed = results.where(F.col("status") == "fail").collect()
    if failed:
        raise ValueError("; ".join(f"{r.table_name}.{r.column_name}: {r.rule} "
                                   f"({r.failures})" for r in failed))
