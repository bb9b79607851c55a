from pyspark.sql import Column, functions as F

# Fixed value: date, T, time, at most six fraction digits, then nothing or a UTC suffix.
ISO_UTC = r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?(\+00:00)?Z*$"


def parse_iso_timestamp(text: Column) -> Column:
    """UTC instant from ISO-8601 text; NULL when the shape or a field does not fit.

    The session zone is UTC, so text without a suffix is UTC as well.
    """
    return F.when(text.rlike(ISO_UTC), F.rtrim(text, F.lit("Z")).try_cast("timestamp"))


def cast_amount(text: Column) -> Column:
    """Money text to DECIMAL(18,2); NULL marks a row for quarantine."""
    return text.try_cast("decimal(18,2)")
