"""Hard negatives by a geometric near-neighbour access tree over vectors.

Every inner node has up to FAN split points, chosen far apart from a sample; a vector goes to the
subtree of its nearest split point (a multiway cut by hyperplanes). For every pair of a split point and
a sibling subtree the node stores the smallest and largest distance between them, and for every subtree
the range of the squared lengths of its vectors; these are taken over all rows. A score is an inner
product, so that a window of scores is, for a subtree with known lengths, an annulus of distances around
the anchor: d^2 = |a|^2 + |x|^2 - 2 score. A subtree is eliminated if for some split point the annulus,
seen from there by the triangle inequality, does not meet the stored range. Leaves are searched exactly,
so that results are those of a full search.

Anchors first visit the leaf they fall into. The scores found there narrow their windows; with those,
all other leaves are tried against the tree. This is done for the positives (the best rows of the same label)
and then for the negatives (the best rows of other labels in a window below each positive).

The tree has up to DEPTH levels, as many as bring a leaf down to about LEAF rows; it is fitted on about
SAMPLE rows drawn by a hash, which bounds what the driver and each task hold. Every row is indexed. A leaf
with more than BLOCK rows, a group of copies for instance, is cut into blocks of a task each; anchors
pass a block in batches and only their best rows leave it.

Defined cases. Rows without an id, label or vector, or with a null or non-finite component, take no part.
Vectors are compared with those of the same length only. Rows that agree in id, label and vector are one; others
that share an id are rows of their own. Ties in the score go to the smaller id. An anchor without positives, and a positive without negatives, give no
row; a negative positive score leaves its window empty. An empty vector has the score 0 with others. Components must be
whole numbers, and exact scores be under 2^53, for results that do not depend on rounding. An empty table gives an empty result.
Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored, with_package

FAN = 16
DEPTH = 3
LEAF = 4096
SAMPLE = 1 << 15
BLOCK = 4096
BATCH = 256
SLACK = 1e-7  # of a distance, for rounding
_LEAF_BITS, _BLOCK_BITS = 13, 27  # a tree of DEPTH 3 has fewer than 2^13 nodes


def _distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    square = (x ** 2).sum(1)[:, None] + (points ** 2).sum(1) - 2 * x @ points.T
    return np.sqrt(np.maximum(square, 0))


@dataclass
class Node:
    """Split points; by split point and subtree the least and greatest distance; by subtree the
    least and greatest squared length. A subtree without rows has an empty range."""
    points: np.ndarray
    low: np.ndarray = field(init=False)
    high: np.ndarray = field(init=False)
    short: np.ndarray = field(init=False)
    long: np.ndarray = field(init=False)

    def __post_init__(self):
        m = len(self.points)
        self.low, self.high = np.full((m, m), np.inf), np.full((m, m), -np.inf)
        self.short, self.long = np.full(m, np.inf), np.full(m, -np.inf)


class Tree:
    """Nodes by number; the subtree j of node k is k * FAN + j + 1, the root 0. A number that is no
    node is a leaf."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.nodes: dict[int, Node] = {}
        self._fit(0, sample, depth, np.random.default_rng(13))

    def _fit(self, number: int, x: np.ndarray, depth: int, rng: np.random.Generator) -> None:
        if not depth or len(x) < 2:
            return
        some = x[rng.permutation(len(x))[:4 * FAN]]
        picks, apart = [0], _distances(some, some[:1])[:, 0]
        while len(picks) < FAN and apart.max() > 0:
            picks.append(int(apart.argmax()))
            apart = np.minimum(apart, _distances(some, some[picks[-1]:picks[-1] + 1])[:, 0])
        if len(picks) < 2:
            return
        self.nodes[number] = Node(some[picks])
        nearest = _distances(x, some[picks]).argmin(1)
        for j in range(len(picks)):
            self._fit(number * FAN + j + 1, x[nearest == j], depth - 1, rng)

    def leaves(self, x: np.ndarray, learn: bool = False) -> np.ndarray:
        """The leaf of every row of x; with `learn`, ranges are widened to hold them."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            number, rows = todo.pop()
            if number not in self.nodes or not len(rows):
                out[rows] = number
                continue
            node = self.nodes[number]
            d = _distances(x[rows], node.points)
            nearest = d.argmin(1)
            for j in np.unique(nearest):
                of = nearest == j
                if learn:
                    node.low[:, j] = np.minimum(node.low[:, j], d[of].min(0))
                    node.high[:, j] = np.maximum(node.high[:, j], d[of].max(0))
                    square = (x[rows[of]] ** 2).sum(1)
                    node.short[j], node.long[j] = min(node.short[j], square.min()), max(node.long[j], square.max())
                todo.append((number * FAN + int(j) + 1, rows[of]))
        return out

    def learn(self, number: int, i: int, j: int, low: float, high: float, short: float, long: float) -> None:
        node = self.nodes[number]
        node.low[i, j], node.high[i, j], node.short[j], node.long[j] = low, high, short, long

    def ranges(self) -> Iterator[tuple]:
        for number, node in self.nodes.items():
            for i, j in zip(*np.nonzero(node.low <= node.high)):
                yield number, int(i), int(j), node.low[i, j], node.high[i, j], node.short[j], node.long[j]

    def reached(self, a: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of a that must search it), for windows low to high of scores, a row of
        windows for each row of a; an empty window reaches nothing."""
        todo = [(0, np.flatnonzero((low <= high).any(1)))]
        square = (a ** 2).sum(1)
        while todo:
            number, rows = todo.pop()
            if not len(rows):
                continue
            if number not in self.nodes:
                yield number, rows
                continue
            node = self.nodes[number]
            d = _distances(a[rows], node.points)
            for j in np.flatnonzero(node.short <= node.long):
                with np.errstate(invalid="ignore"):
                    near = square[rows, None] + node.short[j] - 2 * high[rows]
                    far = square[rows, None] + node.long[j] - 2 * low[rows]
                open_ = (low[rows] <= high[rows]) & (far >= -SLACK * (1 + square[rows, None]))
                near, far = np.sqrt(np.maximum(near, 0)), np.sqrt(np.maximum(far, 0))
                for i in range(len(node.points)):
                    di = d[:, i:i + 1]
                    slack = SLACK * (1 + di + node.high[i, j])
                    open_ &= (np.maximum(di - far, near - di) <= node.high[i, j] + slack) & (di + far >= node.low[i, j] - slack)
                todo.append((number * FAN + int(j) + 1, rows[open_.any(1)]))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


def usable(rows: DataFrame) -> DataFrame:
    """(rid, vec_id, label, dim, asks, vector) of the rows that take part; `asks` marks anchors."""
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & fine)
    kept = kept.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("vector").cast("array<double>"), "asks")
    kept = kept.distinct().select(F.monotonically_increasing_id().alias("rid"), "vec_id", "label", F.size("vector").alias("dim"), "asks", "vector")
    return stored(kept, "gnat-rows")


def fitted(rows: DataFrame) -> dict[int, Tree]:
    """A tree for every length of vectors in a sample of about SAMPLE rows."""
    n, depth = rows.count(), 0
    while depth < DEPTH and FAN ** depth * LEAF < n:
        depth += 1
    share = min(1.0, SAMPLE / max(1, n))
    drawn = rows.where(F.pmod(F.xxhash64("rid"), F.lit(1 << 30)) < int(share * (1 << 30))).select("rid", "dim", "vector")
    sample = sorted(drawn.limit(2 * SAMPLE).collect()) if depth else []
    return {dim: Tree(np.array([r.vector for r in sample if r.dim == dim], np.float64), depth)
            for dim in sorted({r.dim for r in sample})}


PLACED = "rid long, vec_id long, label long, dim int, asks boolean, vector binary, leaf long, node array<double>"


def indexed(rows: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """Every row with its leaf, and the ranges that the tasks saw, in `node`."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = {dim: Tree(np.zeros((0, dim)), 0) for dim in trees}
        for dim, tree in trees.items():
            own[dim].nodes = {k: Node(node.points) for k, node in tree.nodes.items()}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                same = batch.take(pa.array(np.flatnonzero(dims == dim)))
                x = np.asarray(same.column("vector").flatten(), np.float64).reshape(same.num_rows, int(dim))
                leaf = own[dim].leaves(x, True) if dim in own else np.zeros(len(x), np.int64)
                yield pa.RecordBatch.from_pydict({
                    **{c: same.column(c) for c in ("rid", "vec_id", "label", "dim", "asks")}, "vector": [r.tobytes() for r in x],
                    "leaf": leaf, "node": pa.nulls(len(x), pa.list_(pa.float64()))})
        seen = [[dim, *r] for dim, tree in own.items() for r in tree.ranges()]
        if seen:
            none = lambda kind: pa.nulls(len(seen), kind)
            yield pa.RecordBatch.from_pydict({
                **{c: none(pa.int64()) for c in ("rid", "vec_id", "label")}, "dim": none(pa.int32()), "asks": none(pa.bool_()),
                "vector": none(pa.binary()), "leaf": none(pa.int64()), "node": pa.array(seen, pa.list_(pa.float64()))})
    return stored(with_package(rows).mapInArrow(work, PLACED), "gnat-index")


def _learned(index: DataFrame, trees: dict[int, Tree]) -> None:
    """Gives the trees the ranges over all rows; as many as nodes times FAN * FAN."""
    at = [F.col("node")[k].alias(f"n{k}") for k in range(8)]
    whole = index.where("node is not null").select(*at).groupBy("n0", "n1", "n2", "n3").agg(
        F.min("n4"), F.max("n5"), F.min("n6"), F.max("n7"))
    for dim, number, i, j, *spans in whole.collect():
        trees[int(dim)].learn(int(number), int(i), int(j), *spans)
    for tree in trees.values():
        for node in tree.nodes.values():  # lengths belong to the subtree, whichever the split point
            node.short, node.long = np.where(np.isfinite(node.low).any(0), node.short, np.inf), np.where(
                np.isfinite(node.low).any(0), node.long, -np.inf)


def _routes(trees: dict[int, Tree], home: bool):
    """Anchors to the leaves they must search: their own, or all others that their windows reach."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                same = batch.take(pa.array(np.flatnonzero(dims == dim)))
                own, to = same.column("leaf").to_numpy(), []
                if home:
                    to = [(leaf, np.flatnonzero(own == leaf)) for leaf in np.unique(own)]
                elif int(dim) in trees:
                    low, high = (np.asarray(same.column(c).flatten(), np.float64).reshape(same.num_rows, -1) for c in ("low", "high"))
                    to = trees[int(dim)].reached(_matrix(same.column("vector")), low, high)
                for leaf, rows in to:
                    rows = rows if home else rows[own[rows] != leaf]
                    if len(rows):
                        part = same.take(pa.array(rows))
                        columns = {c: part.column(c) for c in ("rid", "label", "dim", "vector", "low", "high")}
                        yield pa.RecordBatch.from_pydict({**columns, "leaf": np.full(len(rows), leaf, np.int64)})
    return work


def best(score: np.ndarray, allowed: np.ndarray, count: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of every row of `score` the columns of its `count` largest allowed values, first columns
    first among equals: (rows, columns) of each rank."""
    left, out = np.where(allowed, score, -np.inf), []
    every = np.arange(len(left))
    for _ in range(min(count, left.shape[1])):
        top = left.argmax(1)
        there = left[every, top] > -np.inf
        out.append((every[there], top[there]))
        left[every, top] = -np.inf
    return out


def _searching(same_label: bool, count: int):
    """The best rows of a block for every window of the anchors that visit it. A block's rows come
    before its anchors."""
    def answers(data: pa.Table, asking: pa.RecordBatch) -> pa.RecordBatch:
        x, ids, label, rid = (_matrix(data.column("vector").combine_chunks()), *(
            data.column(c).to_numpy() for c in ("vec_id", "label", "rid")))
        a, of, me = _matrix(asking.column("vector")), asking.column("label").to_numpy(), asking.column("rid").to_numpy()
        low, high = (np.asarray(asking.column(c).flatten(), np.float64).reshape(len(a), -1) for c in ("low", "high"))
        score = a @ x.T
        rows = ((of[:, None] == label) & (me[:, None] != rid)) if same_label else of[:, None] != label
        out = [[], [], [], []]
        for k in range(low.shape[1]):
            inside = rows & (score >= low[:, k:k + 1]) & (score <= high[:, k:k + 1])
            some = np.flatnonzero(inside.any(1))
            for who, which in best(score[some], inside[some], count):
                whole = np.clip(score[some[who], which], -2.0 ** 62, 2.0 ** 62).astype(np.int64)
                for column, values in zip(out, (me[some[who]], np.full(len(who), k), whole, ids[which])):
                    column.append(values)
        columns = [np.concatenate(c or [np.zeros(0, np.int64)]).astype(np.int64) for c in out]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["rid", "k", "score", "found"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, data = None, [], None
        for batch in batches:
            groups = batch.column("group").to_numpy()
            cuts = [0, *(np.flatnonzero(groups[1:] != groups[:-1]) + 1).tolist(), len(groups)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                if groups[a] != current:
                    current, held, data = groups[a], [], None
                part = batch.slice(a, b - a)
                rows = int(pc.sum(pc.equal(part.column("asking"), 0)).as_py() or 0)
                if rows:
                    held.append(part.slice(0, rows))
                if rows < len(part) and held:
                    if data is None:
                        data = pa.Table.from_batches(held).sort_by("vec_id")
                    for at in range(rows, len(part), BATCH):
                        yield answers(data, part.slice(at, min(BATCH, len(part) - at)))
    return work


GROUP = f"shiftleft(cast(dim as long), {_LEAF_BITS + _BLOCK_BITS}) + shiftleft(cast(leaf as long), {_BLOCK_BITS})"


def _pass(index: DataFrame, blocks: DataFrame, trees: dict[int, Tree], anchors: DataFrame, home: bool, same_label: bool,
          count: int) -> DataFrame:
    """(rid, k, score, found): candidates for window k of anchors (rid, label, dim, leaf, vector,
    low, high) in their own leaf or in all others."""
    routed = with_package(anchors.select("rid", "label", "dim", "leaf", "vector", "low", "high")).mapInArrow(
        _routes(trees, home), "rid long, label long, dim int, vector binary, low array<double>, high array<double>, leaf long")
    asking = routed.join(blocks, ["dim", "leaf"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    asking = asking.select((F.expr(GROUP) + F.col("block")).alias("group"), F.lit(1).alias("asking"), "rid",
                           F.lit(None).cast("long").alias("vec_id"), "label", "vector", "low", "high")
    none = F.lit(None).cast("array<double>")
    held = index.where("node is null").join(blocks, ["dim", "leaf"]).select(
        (F.expr(GROUP) + F.pmod(F.xxhash64("rid"), "blocks")).alias("group"), F.lit(0).alias("asking"), "rid", "vec_id",
        "label", "vector", none.alias("low"), none.alias("high"))
    rows = held.unionByName(asking).repartition("group").sortWithinPartitions("group", "asking")
    return with_package(rows).mapInArrow(_searching(same_label, count), "rid long, k long, score long, found long")


def _leading(rows: DataFrame, count: int) -> DataFrame:
    """The first `count` candidates of every window, with their rank."""
    order = Window.partitionBy("rid", "k").orderBy(F.desc("score"), "found")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def _found(index: DataFrame, blocks: DataFrame, trees: dict[int, Tree], anchors: DataFrame, same_label: bool, count: int) -> DataFrame:
    """(rid, k, score, found, rank): the first `count` rows in each window of the anchors."""
    near = stored(_leading(_pass(index, blocks, trees, anchors, True, same_label, count), count), "gnat-near")
    # Where the own leaf holds enough, no score under the last one can come in.
    full = near.where(F.col("rank") == count).groupBy("rid").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("k").cast("int").alias("k"), F.col("score").cast("double").alias("s")))).alias("_last"))
    raised = F.transform("low", lambda x, k: F.greatest(x, F.coalesce(F.try_element_at("_last", k), x)))
    narrowed = anchors.join(full, "rid", "left").withColumn("low", F.when(F.col("_last").isNull(), F.col("low")).otherwise(raised)).drop("_last")
    more = _pass(index, blocks, trees, stored(narrowed, "gnat-anchors"), False, same_label, count)
    return stored(_leading(near.drop("rank").unionByName(more), count), "gnat-found")


def mine(rows: DataFrame, positives: int = 5, negatives: int = 5, percent: int = 80) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows (vec_id,
    label, vector, asks): for each row that asks and each of its `positives` best others of the same label,
    the `negatives` best rows of other labels whose score is at least `percent` of the positive's and not above it."""
    held = usable(rows)
    trees = fitted(held)
    index = indexed(held, trees)
    _learned(index, trees)
    sizes = index.where("node is null").groupBy("dim", "leaf").agg(F.count("*").alias("_rows"))
    blocks = stored(sizes.select("dim", "leaf", F.ceil(F.col("_rows") / BLOCK).cast("long").alias("blocks")), "gnat-blocks")

    anchors = stored(index.where("asks"), "gnat-anchors").drop("asks", "node")
    everything = [F.array(F.lit(v)).alias(c) for c, v in (("low", float("-inf")), ("high", float("inf")))]
    near = _found(index, blocks, trees, anchors.select("*", *everything), True, positives)
    ordered = near.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("rank", "score", "found"))).alias("kin"))
    windows = ordered.select("rid", "kin", F.col("kin.score").cast("array<double>").alias("high"), F.transform(
        "kin", lambda s: F.ceil(s["score"].cast("decimal(20,0)") * percent / 100).cast("double")).alias("low"))
    # Windows of one array length in a task: those an anchor lacks are empty.
    filled = [F.concat(F.col(c), F.array_repeat(F.lit(v), F.lit(positives) - F.size("kin"))).alias(c)
              for c, v in (("low", 1.0), ("high", 0.0))]
    asking = stored(anchors.join(windows, "rid").select("rid", "vec_id", "label", "dim", "leaf", "vector", "kin", *filled), "gnat-windows")
    far = _found(index, blocks, trees, asking.drop("kin", "vec_id"), False, negatives)
    kin = F.col("kin")[F.col("k").cast("int")]
    return far.join(asking.select("rid", "vec_id", "kin"), "rid").select(
        F.col("vec_id").alias("anchor_id"), kin["found"].alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("found").alias("negative_id"), kin["score"].alias("positive_score"), F.col("score").alias("negative_score"))


def relabelled(vectors: DataFrame, every: int = 100) -> DataFrame:
    """Rows for `mine` from embeddings: components in 256ths, rounded down; every seventh id has
    the next label; ids divisible by `every` ask."""
    def divisible(by: int) -> Column:
        return F.col("vec_id") % by == 0
    label = F.when(divisible(7), (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vector = F.transform("embedding", lambda x: F.when(F.isnan(x) | (F.abs(x) == float("inf")), x.cast("double")).otherwise(
        F.floor(256 * x.cast("double")).cast("double")))
    return vectors.select("vec_id", label.alias("label"), vector.alias("vector"), divisible(every).alias("asks"))
