"""Document fingerprints: bottom-k sketches of word-shingle hashes.

The sketch of a text is the sorted array of the k smallest distinct 64-bit hashes of its runs of
five words; a shorter text is one shingle, one without words has an empty sketch. Sketches of
parts merge to the sketch of the whole, and estimate resemblance, containment and the number of
distinct shingles; below k shingles all three are exact.

Everything is a Column expression or a DataFrame transformation. A null text counts as empty;
very long texts are ordinary; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window, functions as F

K = 128
SHINGLE = 5
_SPACE = r"[\x20\x09-\x0D]+"
_RANGE = float(1 << 64)


def word_hashes(text: Column) -> Column:
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), _SPACE), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def sketch_of(hashes: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    """Sketch from word hashes. `hashes` should be a column of a projection below, not an
    expression, since it is read once for every word."""
    n = F.size(hashes)
    long_text = F.transform(
        F.slice(hashes, 1, F.greatest(n - (shingle - 1), F.lit(1))),
        lambda h, i: F.xxhash64(h, *[F.get(hashes, i + j) for j in range(1, shingle)]))
    all_hashes = F.when(n >= shingle, long_text).when(n > 0, F.array(F.xxhash64(hashes))).otherwise(
        F.array().cast("array<bigint>"))
    return bottom(all_hashes, k)


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    return bottom(F.concat(a, b), k)


def merge_groups(df: DataFrame, keys: list[str], sketch: str, k: int = K) -> DataFrame:
    """Sketch of each group of rows from the rows' sketches. The rank filter keeps k hashes of a
    group per task before the shuffle, however many rows the group has."""
    hashes = df.select(*keys, F.explode(sketch).alias("_h")).distinct()
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_h"))
    kept = hashes.withColumn("_rank", rank).where(F.col("_rank") <= k)
    return kept.groupBy(*keys).agg(F.sort_array(F.collect_list("_h")).alias(sketch))


def shared_of_union(a: Column, b: Column, k: int = K) -> tuple[Column, Column]:
    """How many of the k smallest hashes of the union are in both, and how many there are."""
    union = merge(a, b, k)
    return F.size(F.array_intersect(union, F.array_intersect(a, b))), F.size(union)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Jaccard similarity of the shingle sets; two empty texts are alike."""
    both, total = shared_of_union(a, b, k)
    return F.when(total == 0, F.lit(1.0)).otherwise(both / total)


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Number of distinct shingles: exact below k, else from the k-th smallest hash."""
    share = (F.element_at(sketch, -1).cast("double") + _RANGE / 2) / _RANGE
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Share of a's shingles that b has: resemblance times the size of the union over a's size."""
    part = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k) / distinct_shingles(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), part))


def as_text(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def sketches(docs: DataFrame, text: str = "text", k: int = K) -> DataFrame:
    """`docs` with a column `sketch`."""
    return docs.withColumn("_words", word_hashes(F.col(text))).withColumn(
        "sketch", sketch_of(F.col("_words"), k)).drop("_words")


_FAN = 1024
MOST_RANGES = 1 << 15
_PLACE = "struct<absent: int, id: bigint, tie: bigint, row: bigint>"


def _places(docs: DataFrame) -> DataFrame:
    """doc_id, text and `_place`, which ascends in descending doc_id order: null ids last, equal ids
    by a hash of the text, equal rows by where they were read."""
    text = F.coalesce("text", F.lit(""))
    place = F.struct(F.col("doc_id").isNull().cast("int").alias("absent"),
                     F.coalesce(F.bitwise_not(F.col("doc_id").cast("bigint")), F.lit(0)).alias("id"),
                     F.xxhash64(text).alias("tie"), F.monotonically_increasing_id().alias("row"))
    return docs.select("doc_id", text.alias("text"), place.alias("_place"))


def range_starts(rows: DataFrame) -> list:
    """First places of ranges of about _FAN rows, or of MOST_RANGES ranges where those are fewer.

    The cut is by order, not by the distance of ids: far, null, equal ids and equal rows are split
    like others. What comes to the driver is one place a range, MOST_RANGES at most.
    """
    ranges = max(1, min(MOST_RANGES, -(-rows.count() // _FAN)))
    cut = rows.select("_place").repartitionByRange(ranges, "_place")
    return sorted(r[0] for r in cut.groupBy(F.spark_partition_id()).agg(F.min("_place").alias("first")).select("first").collect())


def with_following(docs: DataFrame, columns: list[str], build) -> DataFrame:
    """Rows of `docs` in descending doc_id order, each with the next one's columns.

    `build` adds `columns` to rows (doc_id, text); the result has them and `next_<column>`; the
    last row is followed by the first. Rows are cut into ranges of their order; the first row of a
    range is also sent to the range before it, so that one shuffle of the texts is enough.
    `docs` is read twice and must give its rows in the same partitions, as stored tables do. An
    empty table gives an empty result.
    """
    rows = _places(docs)
    starts = range_starts(rows)
    n = max(1, len(starts))
    # A literal, looked up by halving steps.
    first = F.from_json(F.lit(json.dumps([s.asDict() for s in starts])), f"array<{_PLACE}>")
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(n.bit_length()))])
    at = F.aggregate(steps, F.lit(0), lambda k, step: F.when(
        F.get(first, k + step - 1) <= F.col("_place"), k + step).otherwise(k))
    rows = rows.withColumn("_part", at - 1)
    own = F.struct(F.col("_part").alias("_part"), F.lit(False).alias("_guest"))
    before = F.struct(F.pmod(F.col("_part") - 1, F.lit(n)).alias("_part"), F.lit(True).alias("_guest"))
    sent = F.when(F.get(first, F.col("_part")) == F.col("_place"), F.array(own, before)).otherwise(F.array(own))
    dealt = rows.select("doc_id", "text", "_place", F.inline(sent)).repartition("_part")
    out = build(dealt)
    order = Window.partitionBy("_part").orderBy("_guest", "_place")
    for c in columns:
        out = out.withColumn(f"next_{c}", F.lead(c).over(order))
    return out.where(~F.col("_guest")).drop("_guest", "_part", "_place")


def edited_fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of all texts and of their edited texts: the last third of the characters
    replaced by the first as many of the next document in descending doc_id order."""
    rows = with_following(docs, ["text", "sketch"], lambda d: sketches(d, "text", k))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    rows = rows.withColumn("n_chars", F.length("text").cast("long")).withColumn("edited", F.concat(
        F.substring("text", F.lit(1), (F.col("n_chars") - cut).cast("int")),
        F.substring("next_text", F.lit(1), cut)))
    rows = rows.withColumn("_words", word_hashes(F.col("edited"))).withColumn(
        "edited_sketch", sketch_of(F.col("_words"), k))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
        distinct_shingles(F.col("sketch"), k).alias("shingles"))
