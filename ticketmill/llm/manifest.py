"""Merkle manifest of a table: a digest for every row, a tree of digests for every group, one root.

A row is a leaf: the digest of its fields, each with its length in front. Leaves of a group are
ordered; runs of FAN consecutive nodes become their digest, level by level, until one is left, the
group's subroot. Subroots in the order of the groups give the root in the same way. A leaf's proof
lists, level by level, the digests left and right of it in its run, so that its own digest and the
proof give the root.

Rows get their places from a range partitioning and prefix sums of the sizes of the ranges. A place
is read as digits: its last two are grouped away one after the other inside blocks of FAN * FAN
rows, where child structs nest in their parents; one shuffle by block serves both. The digests of
the blocks are the rows of the next stage, so that no group of rows is larger than a block whatever
the size of a source. On the way back each stage's nested blocks meet the path of their parent in a
grouped union, and transform and explode hand it down to the children; no join is needed.

Defined cases. Nulls: a null field counts as `-`, a null group is a group of its own and the first,
a null order value comes first. Empty and long texts are ordinary. Ties in the order: by leaf, so
that equal rows are neighbours whose places may be exchanged; each keeps a row of the result. A group
of one row has that leaf as its subroot; a table of one group has its subroot as root. An empty table
gives an empty result. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import ascii_doc_id, lower_ascii, stored

FAN = 16
BLOCK = FAN * FAN
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """A value with its length in bytes in front; a hyphen for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _joined(digests: Column) -> Column:
    return F.sha2(F.array_join(digests, ""), 256)


def folded(start: Column, proof: Column) -> Column:
    """The root that a leaf digest and a proof give."""
    return F.aggregate(proof, start, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """The digest of all siblings in order."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """`at` (place in its group `g`, from 0) and `n` (rows of the group) for rows of (g, ...)."""
    dealt = rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
    kept = stored(dealt.withColumn("_id", F.monotonically_increasing_id()), "manifest-rows").withColumn(
        "_part", F.shiftright("_id", 33))
    # A partition holds a stretch of each of its groups: one row for each, however large the group.
    runs = kept.groupBy("g", "_part").agg(F.min("_id").alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy("g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = stored(runs.select("g", "_part", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"),
                              F.sum("_rows").over(Window.partitionBy("g")).alias("n")), "manifest-runs")
    return kept.join(runs, ["g", "_part"]).withColumn(
        "at", F.col("_base") + F.col("_id") - F.col("_first")).drop("_id", "_part", "_first", "_base")


def _stage(nodes: DataFrame) -> DataFrame:
    """Blocks (g, block, n, hash, runs) of nodes (g, at, n, hash, own): the last digit is grouped
    away, then the one before it. A level is there only where its group has several nodes."""
    digits = nodes.select(
        "g", "n", (F.col("at") % FAN).cast("int").alias("last"), F.floor(F.col("at") / FAN).alias("_run"), "hash", "own")
    digits = digits.select("*", (F.col("_run") % FAN).cast("int").alias("next"),
                           F.floor(F.col("_run") / FAN).cast("long").alias("block")).drop("_run")
    ordered = lambda *cols: F.array_sort(
        F.collect_list(F.struct(*cols)), lambda a, b: a[cols[0]] - b[cols[0]])
    runs = digits.repartition("g", "block").groupBy("g", "block", "next").agg(
        F.max("n").alias("n"), ordered("last", "hash", "own").alias("kids"))
    runs = runs.withColumn("hash", F.when(F.col("n") > 1, _joined(F.col("kids.hash"))).otherwise(F.col("kids")[0]["hash"]))
    blocks = runs.groupBy("g", "block").agg(F.max("n").alias("n"), ordered("next", "hash", "kids").alias("runs"))
    return stored(blocks.withColumn("hash", F.when(
        F.col("n") > FAN, _joined(F.col("runs.hash"))).otherwise(F.col("runs")[0]["hash"])), "manifest-blocks")


def _rolled(nodes: DataFrame, most: int) -> list[DataFrame]:
    """The stages from the rows up to one block for each group; `most`: rows of the largest group."""
    stages = [_stage(nodes)]
    while most > BLOCK:
        most = -(-most // BLOCK)
        below = stages[-1]
        stages.append(_stage(below.select(
            "g", F.col("block").alias("at"), F.ceil(F.col("n") / BLOCK).alias("n"), "hash", F.lit(0).alias("own"))))
    return stages


def _sides(digests: Column, i: Column) -> Column:
    return F.struct(F.array_join(F.slice(digests, F.lit(1), i), "").alias("left"),
                    F.array_join(F.slice(digests, i + 2, F.lit(FAN)), "").alias("right"))


def _handed_down(stage: DataFrame, paths: DataFrame) -> DataFrame:
    """(g, at, hash, own, proof, subroot, root) of every node of a stage, from the paths
    (g, block, proof, subroot, root) of its blocks."""
    path = F.struct("proof", "subroot", "root")
    both = stage.select("g", "block", "n", "runs", F.lit(None).cast(paths.select(path.alias("p")).schema["p"].dataType).alias("path"))
    both = both.unionByName(paths.select("g", "block", path.alias("path")), allowMissingColumns=True)
    met = both.groupBy("g", "block").agg(*[F.any_value(c, ignoreNulls=True).alias(c) for c in ("n", "runs", "path")])

    def with_level(there: Column, digests: Column, i: Column, rest: Column) -> Column:
        return F.when(there, F.concat(F.array(_sides(digests, i)), rest)).otherwise(rest)
    runs = F.transform("runs", lambda r, i: F.struct(
        i.alias("place"), r["kids"].alias("kids"),
        with_level(F.col("n") > FAN, F.col("runs.hash"), i, F.col("path.proof")).alias("proof")))
    each = met.select("g", "block", "n", "path", F.explode(runs).alias("run"))
    kids = F.transform("run.kids", lambda k, i: F.struct(
        ((F.col("block") * FAN + F.col("run.place")) * FAN + i).alias("at"), k["hash"].alias("hash"), k["own"].alias("own"),
        with_level(F.col("n") > 1, F.col("run.kids.hash"), i, F.col("run.proof")).alias("proof")))
    return each.select("g", "path.subroot", "path.root", F.explode(kids).alias("kid")).select("g", "kid.*", "subroot", "root")


def manifest(rows: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "source", order: str = "doc_id",
             carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per row: `order`, leaf, subroot, root, proof (array of left and right siblings from
    the leaf up), and the columns `carry`."""
    carry = carry or {}
    g = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    own = F.struct(F.col(order).alias("_order"), *[c.alias(name) for name, c in carry.items()])
    leaves = stored(rows.select(g.alias("g"), F.col(order).alias("_order"), leaf_digest(
        [F.col(f) for f in fields]).alias("hash"), own.alias("own"), F.monotonically_increasing_id().alias("_row")), "manifest-leaves")
    placed = stored(_placed(leaves, ["_order", "hash", "_row"]).select("g", "at", "n", "hash", "own"), "manifest-places")
    stages = _rolled(placed, placed.agg(F.max("n")).first()[0] or 0)

    tops = stages[-1].select(F.lit("").alias("g"), "hash", F.struct("g").alias("own"), F.col("g").alias("_name"))
    tops = stored(_placed(tops, ["_name"]).select("g", "at", "n", "hash", "own"), "manifest-subroots")
    upper = _rolled(tops, tops.agg(F.max("n")).first()[0] or 0)
    step = "array<struct<left:string,right:string>>"
    paths = upper[-1].select("g", "block", F.array().cast(step).alias("proof"), F.lit("").alias("subroot"), F.col("hash").alias("root"))
    for k, stage in enumerate(reversed(upper)):
        nodes = _handed_down(stage, paths)
        paths = nodes.select("g", F.col("at").alias("block"), "proof", "subroot", "root")
    paths = stored(nodes.select("own.g", F.lit(0).cast("long").alias("block"), "proof", F.col("hash").alias("subroot"), "root"),
                   "manifest-paths")
    for stage in reversed(stages):
        nodes = _handed_down(stage, paths)
        paths = nodes.select("g", F.col("at").alias("block"), "proof", "subroot", "root")
    return nodes.select(F.col("own._order").alias(order), F.col("hash").alias("leaf"), "subroot", "root", "proof",
                        *[f"own.{name}" for name in carry])


def tampering_found(docs: DataFrame, every: int = 5) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256 of `documents`, and the root that each proof gives
    (folded_root, verified) if the texts of those whose crc32(doc_id) is divisible by `every` were
    lower-cased. A null doc_id has no such number."""
    changed = [lower_ascii(F.col(f)) if f == "text" else F.col(f) for f in FIELDS]
    hit = F.crc32(ascii_doc_id(F.col("doc_id"))) % every == 0
    proven = manifest(docs, carry={"_changed": F.when(hit, leaf_digest(changed))})
    found = proven.withColumn("folded_root", folded(F.coalesce("_changed", "leaf"), F.col("proof")))
    return found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
                        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
