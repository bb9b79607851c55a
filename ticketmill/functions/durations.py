from pyspark.sql import Column, functions as F


def duration_hours(start: Column, end: Column) -> Column:
    """Whole hours elapsed, truncated toward zero; NULL while the end is open."""
    return F.timestamp_diff("HOUR", start, end)


def duration_hours_frac(start: Column, end: Column) -> Column:
    """Whole minutes elapsed, in hours."""
    return F.timestamp_diff("MINUTE", start, end) / F.lit(60.0)
