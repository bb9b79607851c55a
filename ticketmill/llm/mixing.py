"""Mixing sources to target weights by a low-discrepancy schedule.

Every source has a target number of words. Its documents, shuffled by a hash, form a stream that
is cut into blocks of equal length; a source whose target exceeds its size runs through the
stream again, three times at most. The mixture is a sequence of slots of one block each. Slot i
takes the i-th van der Corput point, which falls into the share of one source on [0, 1); the
slots of a source are ranked in slot order and the r-th takes the r-th block of its stream. At
every point of the sequence each source so has its share up to O(log slots) blocks.

Only DataFrame functions are used. The order follows a hash of id and text; rows that agree in both are
summed up before the running totals and dealt out behind them, so that neither equal ids nor equal rows
gather in one window, and reruns agree in whatever order rows come. What has a row per source is
sorted in one place; more than MOST_SOURCES sources are refused.

Nulls: a null text has size 0, a null source is the last
source, a null doc_id is an ordinary value. Rows of size 0 take 0. Repeated rows are documents of
their own. An empty table gives an empty result. Other columns are ignored by `schedule` and kept
by `mixed_documents`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from .common import WORD, restored, stored, with_rest, with_running_total

WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
BLOCK_WORDS = 1024
MOST_SOURCES = 1 << 16
_COPIES = 1 << 12
_BITS = 52
_CELLS = 1024


def _sizes(docs: DataFrame, seed: int) -> DataFrame:
    """Distinct (doc_id, source, text) with how many rows they are and where the shuffle puts them."""
    found = docs.select(
        "doc_id", "source", F.xxhash64("text").alias("_text"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("_order"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    h = F.col("_order")
    return found.groupBy("doc_id", "source", "_text", "_order", "size").agg(F.count("*").alias("copies")).withColumns({
        "words": F.col("size") * F.col("copies"), "_coarse_digit": F.shiftrightunsigned(h, 56).cast("int"),
        "_fine_digit": F.shiftrightunsigned(h, 48).bitwiseAND(F.lit(255)).cast("int")})


def _copies(rows: DataFrame) -> DataFrame:
    """Every row as often as it stands; the k-th copy begins behind the ones before it."""
    last = F.col("copies") - 1
    spread = rows.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(_COPIES).cast("long"))))
    spread = spread.withColumn("_k", F.explode(F.sequence("_k", F.least(F.col("_k") + _COPIES - 1, last))))
    return spread.withColumn("start", F.col("start") + F.col("_k") * F.col("size")).drop("_k", "copies", "words")


def targets(sizes: DataFrame, weights=WEIGHTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """One row per source: position, source_size and target.

    Filling by weight until no source is above its cap ends at one level L with
    target = min(cap, L * weight). Sources are capped in order of cap / weight, so L follows from
    running sums over the source totals (one small row per source).
    """
    by_source = sizes.groupBy("source").agg(F.sum("words").alias("source_size"))
    place = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = by_source.withColumn("pos", F.row_number().over(place) - 1).withColumn(
        "_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                           (F.col("pos") % len(weights) + 1).cast("int")))
    weighed = weighed.withColumn("_cap", (F.col("source_size") * max_passes).cast("double"))
    filling = Window.orderBy(F.col("_cap") / F.col("_w"), "pos")
    upto = filling.rowsBetween(Window.unboundedPreceding, -1)
    rest = filling.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(upto), F.lit(0.0))
             ) / F.sum("_w").over(rest)
    # The first source in filling order that stays under its cap sets the level; later ones give less.
    leveled = weighed.withColumn("_level", level).withColumn(
        "_free", F.max(F.when(F.col("_cap") > F.col("_level") * F.col("_w"), F.col("_level"))).over(everything))
    return leveled.select("pos", "source", "source_size", F.least(
        "_cap", F.coalesce(F.col("_free") * F.col("_w"), F.col("_cap"))).alias("target"))


def schedule(spark, sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(pos, rank, slot): which source and which of its blocks fills each slot."""
    quotas = sources.select("pos", F.ceil(F.round("target").cast("long") / block_words).alias("quota"))
    quotas = quotas.where("quota > 0").withColumn(
        "_hi", F.sum("quota").over(Window.orderBy("pos"))).withColumn("_lo", F.col("_hi") - F.col("quota"))
    slots = quotas.agg(F.coalesce(F.max("_hi"), F.lit(0))).first()[0]
    shares = quotas.select("pos", "quota", (F.col("_lo") / slots).alias("_from"), (F.col("_hi") / slots).alias("_to"))
    cells = shares.withColumn("_cell", F.explode(F.sequence(
        F.floor(F.col("_from") * _CELLS), F.least(F.floor(F.col("_to") * _CELLS), F.lit(_CELLS - 1).cast("long")))))
    # Bits of the slot number mirrored at the binary point.
    point = F.conv(F.reverse(F.lpad(F.bin("slot"), _BITS, "0")), 2, 10).cast("double") / float(1 << _BITS)
    placed = spark.range(slots).withColumnRenamed("id", "slot").withColumn("_u", point)
    placed = placed.withColumn("_cell", F.floor(F.col("_u") * _CELLS)).join(cells, "_cell").where(
        "_u >= _from and _u < _to")
    span = max(1, slots)
    placed = placed.select(
        "pos", "quota", "slot", F.lit(1).alias("_one"),
        F.floor(F.col("slot") * 256 / span).cast("int").alias("_c"),
        (F.floor(F.col("slot") * 65536 / span) % 256).cast("int").alias("_f"))
    ranked = with_running_total(placed, "pos", ("_c", "_f"), ["slot"], "_one", "rank")
    # A share of the points differs from the quota by O(log slots): surplus slots fall away and
    # missing ones follow at the end.
    counts = placed.groupBy("pos").agg(F.count("*").alias("_n"))
    missing = quotas.join(counts, "pos", "left").withColumn("_n", F.coalesce("_n", F.lit(0))).where("_n < quota")
    missing = missing.select("pos", F.explode(F.sequence(F.col("_n"), F.col("quota") - 1)).alias("rank"))
    return ranked.where("rank < quota").select("pos", "rank", "slot").unionByName(
        missing.select("pos", "rank", (F.lit(slots) + F.col("rank")).alias("slot")))


def mix(docs: DataFrame, weights=WEIGHTS, max_passes: int = MAX_PASSES,
        block_words: int = BLOCK_WORDS, seed: int = 20) -> tuple[DataFrame, DataFrame]:
    """Places of the documents in the mixture.

    Returns (documents, pieces). documents: doc_id, source, size, source_size, target, start (words
    of its source's stream before it), _order. pieces: one row per part of a document in a block:
    pos, start, pass (0 first), rank, slot, words; (pos, start) names a document of size > 0.
    """
    spark = docs.sparkSession
    sizes = stored(_sizes(docs, seed), "mix-sizes")
    if sizes.select("source").distinct().limit(MOST_SOURCES + 1).count() > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    sources = stored(targets(sizes, weights, max_passes), "mix-sources")
    plan = schedule(spark, sources, block_words)
    known = sizes.join(sources, sizes["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    placed = with_running_total(known, "pos", ("_coarse_digit", "_fine_digit"),
                                ["_order", "doc_id", "_text"], "words", "start")
    documents = _copies(placed.drop("_coarse_digit", "_fine_digit"))
    passes = documents.where("size > 0").withColumn("_goal", F.round("target").cast("long")).withColumn(
        "pass", F.explode(F.array(*[F.lit(p) for p in range(max_passes)])))
    first = F.col("start") + F.col("pass") * F.col("source_size")
    parts = passes.withColumn("_a", first).withColumn(
        "_b", F.least(F.col("_a") + F.col("size"), F.col("_goal"))).where("_b > _a")
    parts = parts.withColumn("rank", F.explode(F.sequence(
        F.floor(F.col("_a") / block_words), F.floor((F.col("_b") - 1) / block_words))))
    words = F.least("_b", (F.col("rank") + 1) * block_words) - F.greatest("_a", F.col("rank") * block_words)
    pieces = parts.join(plan, ["pos", "rank"]).select(
        "pos", "start", "pass", "rank", "slot", words.alias("words"))
    return documents, pieces


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken; one row per document."""
    documents, pieces = mix(docs, **options)
    sums = pieces.groupBy("pos", "start").agg(F.sum("words").alias("taken"))
    full = documents.where("size > 0").join(sums, ["pos", "start"], "left")
    empty = documents.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    columns = ["doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")]
    return full.select(*columns).unionByName(empty.select(*columns))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixture as documents: a row for each pass in which a document is taken, whole texts.

    Empty documents take no words and stay once. A document that is cut by the end of its source's
    share stays whole, so a source exceeds its target by less than one document. Repeated rows
    (same doc_id, source and text) all stand as often as the one that is taken most.
    """
    documents, pieces = mix(docs, **options)
    passes = pieces.groupBy("pos", "start").agg((F.max("pass") + 1).alias("_times"))
    key = ["doc_id", "source", "_text"]
    full = documents.where("size > 0").join(passes, ["pos", "start"]).groupBy(*key).agg(F.max("_times").alias("_times"))
    empty = documents.where("size = 0").select(*key).distinct().withColumn("_times", F.lit(1))
    times = full.unionByName(empty).withColumnsRenamed({c: f"_k{i}" for i, c in enumerate(key)})
    needed = ["doc_id", "source", "text"]
    hashed = with_rest(docs, needed).withColumn("_text", F.xxhash64("text"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(key)])
    rows = hashed.join(times, same).withColumn("_pass", F.explode(F.sequence(F.lit(1), "_times")))
    return restored(rows, docs.columns, needed)
