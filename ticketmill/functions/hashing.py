"""Stable 63-bit keys.

Spark's xxhash64 starts from seed 42 and feeds each argument's hash to the next
one as its seed. SEED_RESET is the bigint that hashes to 0 under seed 42, so an
argument after it is hashed under seed 0 - the plain XXH64 of its UTF-8 bytes.
"""

from pyspark.sql import Column, functions as F

# Fixed values.
SEED_RESET = -365884300664092260
MASK_63 = 9223372036854775807
NULL_TEXT = "__NULL__"
PII_NULL_TEXT = "__null__"


def stable_hash64(value: Column) -> Column:
    text = F.coalesce(value.cast("string"), F.lit(NULL_TEXT))
    return F.xxhash64(F.lit(SEED_RESET), text).bitwiseAND(F.lit(MASK_63))


def stable_hash64_md5(value: Column) -> Column:
    """Leading 8 bytes of MD5, sign bit cleared. Never mix with stable_hash64 in a table."""
    text = F.coalesce(value.cast("string"), F.lit(NULL_TEXT))
    unsigned = F.conv(F.substring(F.md5(text), 1, 16), 16, 10).cast("decimal(20,0)")
    return (unsigned % F.lit(str(MASK_63 + 1)).cast("decimal(20,0)")).cast("bigint")


def pii_hash(value: Column) -> Column:
    text = F.coalesce(value.cast("string"), F.lit(PII_NULL_TEXT))
    return stable_hash64(F.concat(F.lit("pii:"), text))


def entity_key(namespace: str, *parts: Column) -> Column:
    """Namespaced surrogate key; use the same call when writing and when looking up. A NULL part makes
    it the key of the NULL member, so that parts in different places cannot collide."""
    text = F.lit(namespace)
    for part in parts:
        text = F.concat(text, F.lit("|"), part.cast("string"))
    return stable_hash64(text)


def field_key(namespace: str, code: str) -> Column:
    return stable_hash64(F.lit(f"{namespace}|{code}"))


def record_hash(code: Column, updated: Column) -> Column:
    stamp = F.coalesce(updated, F.lit("1900-01-01 00:00:00").cast("timestamp"))
    text = F.date_format(stamp, "yyyy-MM-dd HH:mm:ss.SSSSSS 'UTC'")
    return stable_hash64(F.concat(code, F.lit("|"), text))
