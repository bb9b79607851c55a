"""MinHash near-duplicates: banding, verification, connected components.

A document is the set of its runs of five words. BANDS * ROWS universal hashes (odd factor and
shift modulo 2^32) give its minima, ROWS of them make a band. Documents with the same set are one
node. Nodes that share a band are candidates, in two steps that never list all pairs of a bucket:

1. Every node of a bucket is verified against the smallest one there; the links that hold are
   joined to components by large-star and small-star.
2. Buckets that then still span several components are cut into blocks, and pairs of blocks
   compared: pairs of different components whose minima agree often enough (LOWEST, five standard
   deviations below the threshold) are verified, most alike first, until they are connected.

Every link is confirmed on the full shingle sets. A pair at the threshold shares a band with
probability 0.9997. Sets are compared as 64-bit run hashes; equal sets and equal texts are told by
128-bit hashes of them, and a node is named by the number of one of its rows.

Defined cases. A null text is empty. Documents without words link with nothing; a null doc_id never
names a component, but its text links others. Every row is judged by its own text: rows that repeat an id
with different texts may be in different components. Copies are one node, however many. A very long
text is one row of a batch like any other. An empty table gives an empty result; columns besides doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .blocks import Forest, pairs, whole_groups
from .common import stored, with_package
from .components import components
from .shingles import mix, parts, set_key, shingle_sets

SHINGLE = 5
ROWS = 6
BANDS = 42
BLOCK = 512
LOWEST = 0.61

_rng = np.random.default_rng(10)
_FACTOR = (_rng.integers(0, 1 << 31, ROWS * BANDS, dtype=np.uint32) * np.uint32(2) + np.uint32(1))
_SHIFT = _rng.integers(0, 1 << 32, ROWS * BANDS, dtype=np.uint32)
_PLACE = _rng.integers(1, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minima(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(sets, ROWS * BANDS): the minimum of every hash over each set; no set may be empty."""
    x = (values >> np.uint64(32)).astype(np.uint32)
    out = np.empty((ROWS * BANDS, len(bounds) - 1), np.uint32)
    for i, (a, b) in enumerate(zip(_FACTOR, _SHIFT)):
        out[i] = np.minimum.reduceat(x * a + b, bounds[:-1])
    return out.T


def band_keys(low: np.ndarray) -> np.ndarray:
    grouped = low.reshape(len(low), BANDS, ROWS).astype(np.uint64) * _PLACE
    return mix(grouped.sum(2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def _profile_parts(batch: pa.RecordBatch):
    """Row numbers and sets of the texts with words, a part of the batch at a time."""
    for at, column in parts(batch.column("text")):
        sets, values, bounds = shingle_sets(column, SHINGLE)
        full = np.flatnonzero(np.diff(bounds))
        yield at, sets, values, np.append(bounds[full], bounds[-1]), full


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and both halves of the text's hash."""
    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"))


def profiles(rows: DataFrame) -> DataFrame:
    """doc_id, t1, t2, n_shingles, n1 and n2 (hash of the set, null without words), bands of every
    row of `keyed`."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, sets, values, bounds, full in _profile_parts(batch):
                keys = [None] * len(sets)
                nodes = [(None, None)] * len(sets)
                if len(full):
                    for i, k in zip(full.tolist(), band_keys(minima(values, bounds))):
                        keys[i] = k
                        nodes[i] = set_key(sets[i])
                yield pa.RecordBatch.from_pydict({
                    **{c: batch.column(c).slice(at, len(sets)) for c in ("doc_id", "t1", "t2")},
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "n1": pa.array([n[0] for n in nodes], pa.int64()), "n2": pa.array([n[1] for n in nodes], pa.int64()),
                    "bands": pa.array(keys, pa.list_(pa.int64()))})
    return with_package(rows).mapInArrow(
        work, "doc_id long, t1 long, t2 long, n_shingles long, n1 long, n2 long, bands array<long>")


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _set_of(text: str) -> np.ndarray:
    return shingle_sets(pa.array([text]), SHINGLE)[0][0]


def _verified(pairs_with_texts: DataFrame, percent: int) -> DataFrame:
    """(u, v) of the rows (u, v, u_text, v_text) whose sets are similar enough."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, hub = None, None
        for batch in batches:
            us, vs = batch.column("u").to_pylist(), batch.column("v").to_pylist()
            found = []
            for i, (u, v) in enumerate(zip(us, vs)):
                if v != known:
                    known, hub = v, _set_of(batch.column("v_text")[i].as_py())
                if _similar(_set_of(batch.column("u_text")[i].as_py()), hub, percent):
                    found.append((u, v))
            yield pa.RecordBatch.from_pydict({
                "u": pa.array([f[0] for f in found], pa.int64()), "v": pa.array([f[1] for f in found], pa.int64())})
    return with_package(pairs_with_texts.select("u", "v", "u_text", "v_text")).mapInArrow(work, "u long, v long")


def _block_links(rows: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Links between components in the groups of `rows`."""
    node, component = rows.column("node").to_pylist(), rows.column("component").to_numpy()
    texts = rows.column("text")
    own: dict[int, np.ndarray] = {}

    def set_at(i: int) -> np.ndarray:
        if node[i] not in own:
            own[node[i]] = _set_of(texts[i].as_py())
        return own[node[i]]
    low = np.stack([minima(s, np.array([0, len(s)]))[0] for s in map(set_at, range(len(node)))])
    forest, links = Forest(), []
    get = lambda c: rows.column(c).to_numpy(zero_copy_only=False)
    for a, b in pairs(get("group"), get("side"), get("across"), 1 << 14):
        apart = component[a] != component[b]
        a, b = a[apart], b[apart]
        alike = (low[a] == low[b]).mean(1)
        order = np.argsort(-alike, kind="stable")
        for k in order[:int((alike >= LOWEST).sum())]:
            i, j = int(a[k]), int(b[k])
            x, y = int(component[i]), int(component[j])
            if forest.find(x) != forest.find(y) and _similar(set_at(i), set_at(j), percent):
                forest.join(x, y)
                links.append((node[i], node[j]))
    return links


def _blocked(batches_percent: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches):
            links = _block_links(rows, batches_percent)
            yield pa.RecordBatch.from_pydict({
                "u": pa.array([x[0] for x in links], pa.int64()), "v": pa.array([x[1] for x in links], pa.int64())})
    return work


def classes(docs: DataFrame, percent: int = 75) -> DataFrame:
    """One row per row: doc_id, t1, t2 (hash of the text), n_shingles, component (null without words),
    the same number for all rows that links connect."""
    source = keyed(docs)
    known = stored(profiles(source).withColumn("row", F.monotonically_increasing_id()), "minhash-profiles")
    # One row per distinct set, with the row whose text stands for it: one with an id, if there is any.
    pick = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "t1", "t2")
    nodes = stored(known.where("n1 is not null").groupBy("n1", "n2").agg(
        F.min("row").alias("node"), F.min(pick).alias("pick"), F.any_value("bands").alias("bands")), "minhash-nodes")
    places = nodes.select("node", F.explode("bands").alias("key"))
    # Grouped tables are stored before they are joined, so that Spark can split a key with many rows.
    shared = stored(places.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("_high")).where(
        "hub != _high").select("key", "hub"), "minhash-shared")
    members = stored(places.join(shared, "key").select("key", "hub", "node"), "minhash-members")
    # Texts are read again only for nodes with candidates, by id and the text's hash.
    chosen = nodes.select("node", "pick").join(members.select("node").distinct(), "node", "left_semi").select(
        "node", F.coalesce("pick.doc_id", F.lit(0)).alias("_id"), "pick.nameless", "pick.t1", "pick.t2")
    texts = source.withColumn("_id", F.coalesce("doc_id", F.lit(0))).withColumn("nameless", F.col("doc_id").isNull())
    texts = texts.drop("doc_id").join(chosen, ["_id", "nameless", "t1", "t2"]).select("node", "text")
    # Rows that repeat an id and its text have all come along: one text of a node is enough.
    texts = stored(texts.groupBy("node").agg(F.any_value("text").alias("text")), "minhash-texts")

    stars = members.where("node != hub").select(F.col("node").alias("u"), F.col("hub").alias("v")).distinct()
    with_texts = stars.join(texts.select(F.col("node").alias("u"), F.col("text").alias("u_text")), "u").join(
        texts.select(F.col("node").alias("v"), F.col("text").alias("v_text")), "v")
    links = stored(_verified(with_texts, percent), "minhash-star-links")
    groups = components(links, "minhash-components")

    named = members.join(groups, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    open_keys = stored(named.groupBy("key").agg(
        F.min("component").alias("_a"), F.max("component").alias("_b"), F.count("*").alias("_n")).where("_a != _b").select(
        "key", F.ceil(F.col("_n") / BLOCK).cast("int").alias("_blocks")), "minhash-open")
    left = named.join(open_keys, "key")
    left = left.withColumn("side", F.pmod(F.xxhash64("node"), "_blocks").cast("int"))
    left = left.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    left = left.select("node", "component", "side", (F.col("side") != F.col("_other")).alias("across"), F.xxhash64(
        "key", F.least("side", "_other"), F.greatest("side", "_other")).alias("group"))
    rows = left.join(texts, "node").repartition("group").sortWithinPartitions("group")
    more = stored(with_package(rows).mapInArrow(_blocked(percent), "u long, v long"), "minhash-block-links")
    groups = components(links.unionByName(more), "minhash-components")

    named = stored(nodes.select("n1", "n2", "node").join(groups, "node", "left").select(
        "n1", "n2", F.coalesce("component", "node").alias("component")), "minhash-classes")
    return known.select("doc_id", "t1", "t2", "n_shingles", "n1", "n2").join(named, ["n1", "n2"], "left").drop("n1", "n2")


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """One row per row: doc_id, n_shingles, component_id (smallest doc_id reachable by links),
    kept (doc_id is component_id)."""
    named = classes(docs, percent)
    least = stored(named.where("component is not null").groupBy("component").agg(
        F.min("doc_id").alias("component_id")), "minhash-least")
    out = named.join(least, "component", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
