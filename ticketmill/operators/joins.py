from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def lookup(fact: DataFrame, dim: DataFrame, key: str, fixed: bool = False) -> DataFrame:
    """LEFT JOIN on one key, unmatched facts kept.

    `fixed` marks a literal table of a handful of rows, which is safe to
    broadcast at any scale. Everything else is left to the size statistics.
    """
    return fact.join(F.broadcast(dim) if fixed else dim, key, "left")


def decode(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    return fact.join(dim, key, "inner")


def current_rows(fact: DataFrame, dim: DataFrame, key: str, flag: str = "is_current") -> DataFrame:
    return fact.join(dim.where(F.col(flag) == 1).drop(flag), key, "left")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    keys = parent.select(F.col(parent_key).alias(child_key))
    return child.where(F.col(child_key).isNotNull()).join(keys, child_key, "left_anti")


def observed_combinations(facts: DataFrame, left: DataFrame, right: DataFrame,
                          left_keys: list[str], right_keys: list[str]) -> DataFrame:
    """Pairs of two dimensions that really occur.

    Starting from the distinct pairs gives the same rows as filtering the
    product of the dimensions, without ever forming it.
    """
    seen = facts.select(*left_keys, *right_keys).distinct()
    return seen.join(left, left_keys, "inner").join(right, right_keys, "inner")


def attribute_map(members: DataFrame, attribution: DataFrame, key: str, probe: str,
                  flag: str) -> DataFrame:
    """Distinct members with their mapped attributes and whether a mapping exists."""
    return (members.distinct().join(attribution, key, "left")
            .withColumn(flag, F.col(probe).isNotNull()))
