from __future__ import annotations

from pyspark.sql import Column, functions as F

from .durations import duration_hours

# First-response limit in hours by service tier; standard = NULL.
SLA_URGENT, SLA_EXPRESS = 1, 2
SLA_HOURS = {SLA_EXPRESS: 4, SLA_URGENT: 8, None: 24}
STANDARD_MEMBER = 99
STANDARD_ALIASES = [99, -1]


def _bit(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0)


def is_resolved(resolution_hours: Column) -> Column:
    return _bit(resolution_hours >= 0)


def normalise_perform(perform: Column) -> Column:
    """Feeds send the standard tier as 99 or -1; the SLA rule knows it as NULL."""
    return F.when(~perform.isin(STANDARD_ALIASES), perform)


def within_sla(response_hours: Column, perform: Column, strict: bool = False) -> Column:
    """First response within the limit of its tier. Feeds send the standard tier as 99
    or -1 too; a strict reading accepts NULL only."""
    standard = perform.isNull() if strict else perform.isNull() | perform.isin(STANDARD_ALIASES)
    limit = (F.when(perform == SLA_EXPRESS, SLA_HOURS[SLA_EXPRESS])
             .when(perform == SLA_URGENT, SLA_HOURS[SLA_URGENT])
             .when(standard, SLA_HOURS[None]))
    return _bit(response_hours <= limit)


def sla_tier_flags(created: Column, responded: Column, closed: Column,
                   first_contact: Column) -> dict[str, Column]:
    waited = duration_hours(created, responded)
    flags = {f"sla_{h}hr_met": _bit(waited <= h) for h in (4, 8, 24)}
    return {"has_response": _bit(responded.isNotNull()), "has_closure": _bit(closed.isNotNull()),
            **flags, "is_first_resolution": _bit(first_contact)}


def is_complain(complain_id: Column) -> Column:
    return _bit(complain_id >= 2)


def is_forwarded(forwarded_at: Column) -> Column:
    return _bit(forwarded_at.isNotNull())


def null_member(perform: Column) -> Column:
    return F.coalesce(perform, F.lit(STANDARD_MEMBER))


def fallback_label(name: Column, code: Column) -> Column:
    return F.coalesce(name, code.cast("string"))
