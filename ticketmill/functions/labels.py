from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values: (inclusive upper bound in hours, label).
RESOLUTION_BANDS = [
    (24, "24hr內"), (48, "24~48hr"), (72, "48~72hr"), (120, "3~5天"),
    (168, "5~7天"), (240, "7~10天"), (360, "10~15天"),
]
RESOLUTION_OPEN, RESOLUTION_BEYOND = "未結案", "15天以上"
RESPONSE_BANDS = [
    (4, "4hr內"), (8, "4~8hr"), (12, "8~12hr"), (24, "12~24hr"),
    (48, "24~48hr"), (72, "48~72hr"),
]
RESPONSE_OPEN, RESPONSE_BEYOND = "未回覆", "72hr以上"


def band_label(hours: Column, bands: list[tuple[int, str]], missing: str, beyond: str) -> Column:
    chain = F.when(hours.isNull() | (hours < 0), F.lit(missing))
    for upper, label in bands:
        chain = chain.when(hours <= upper, F.lit(label))
    return chain.otherwise(F.lit(beyond))


def resolution_bucket(hours: Column) -> Column:
    return band_label(hours, RESOLUTION_BANDS, RESOLUTION_OPEN, RESOLUTION_BEYOND)


def response_bucket(hours: Column) -> Column:
    return band_label(hours, RESPONSE_BANDS, RESPONSE_OPEN, RESPONSE_BEYOND)


def code_decode(code: Column, labels: dict[int, str], default: str) -> Column:
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), F.lit(default))


def membership_label(code: Column, members: list[int], label: str) -> Column:
    return F.when(code.isin(members), F.lit(label))
