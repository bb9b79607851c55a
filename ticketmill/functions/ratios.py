"""Ratios. Averages of doubles go through DECIMAL, so that the result does not
depend on the order in which tasks finish or are retried."""

from pyspark.sql import Column, functions as F


def safe_ratio(num: Column, den: Column) -> Column:
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def safe_pct(num: Column, den: Column) -> Column:
    return safe_ratio(num, den) * 100


def rounded_pct(num: Column, den: Column, digits: int) -> Column:
    """100*num/den rounded half up in decimal arithmetic; NULL on a zero denominator."""
    n = (num.cast("decimal(18,0)") * 100).cast("decimal(20,0)")
    d = F.nullif(den.cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)"))
    return F.round(n / d, digits).cast("double")


def exact_mean(value: Column, digits: int) -> Column:
    """Mean of values below 1e14 in magnitude, to 12 decimals, of at most 1e10 rows a group; the sum
    is kept in DECIMAL(36, 12)."""
    return F.round(F.avg(value.cast("decimal(26,12)")), digits).cast("double")
