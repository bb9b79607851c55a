"""Embedding near-duplicates by randomised-rotation binary codes.

A vector is scaled to length 1 and turned by seeded random rotations, once; its code is the signs of
the turned coordinates. With each rotation the inner product f of the turned vector with its own sign
vector (scaled to length 1) is stored, and the coordinates themselves as LEVEL_BITS bit planes of
steps, rounded with a seeded dither. For vectors x and y the inner product of y's steps with x's sign
vector, divided by f, estimates cos(x, y) without bias; it is counted in common bits of planes and
code. |error| is at most EPSILON standard deviations with high confidence: sqrt(1 - f^2) /
(f * sqrt(dim - 1)) for the signs and step / (2 f) for the rounding; the average over the rotations
is that much sharper. A pair is computed exactly, in double precision, only if the upper bound
reaches the threshold, so that no link is below it. An estimate reads a quarter of the bytes of an
exact product of 64 dimensions. Vectors travel with their codes, since pairs never leave a task.

Pairs come from the codes too: stretches of a code are bands, and vectors that agree in a band are
compared. A band has log2(n) + EXTRA_BITS bits, so that buckets stay small, and there are as many
bands (BANDS at least) as find a pair at the threshold with probability RECALL whatever n is; closer
pairs are found almost surely. At cosine 0.95 these are 33 bands at 50,000 vectors and 153 at 10^9.
A bucket of more than BLOCK vectors is cut into blocks, each pair of blocks a group of its own. A
pair that agrees in several bands counts in the first. Estimates read the rotations of the first
SIGNS signs (whole rotations), whatever the number of bands. Tasks return sums of link counts and a spanning forest,
never all pairs.

Equal vectors are one class, indexed once. Vectors that are null, empty, zero, or hold a null or a
value that is not finite link with nothing, as do vectors of another length and rows without an
id. Repeated rows are vectors of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .blocks import pairs, spanning, whole_groups
from .common import stored, with_package
from .components import components

BANDS = 24
RECALL = 0.99
EXTRA_BITS = 3
SIGNS = 256
LEVEL_BITS = 4
BLOCK = 512
EPSILON = 4.0
SEED = 8


def shape(n: int, threshold: float) -> tuple[int, int]:
    """Bits of a band and number of bands for n vectors."""
    bits = min(40, max(8, math.ceil(math.log2(max(2, n))) + EXTRA_BITS))
    shared = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** bits
    return bits, BANDS if shared >= RECALL else max(BANDS, math.ceil(math.log1p(-RECALL) / math.log1p(-shared)))


@lru_cache(8)
def rotations(dim: int, count: int) -> np.ndarray:
    """(count * dim, dim): the rows of `count` random rotations."""
    make = np.random.default_rng((SEED, dim))
    return np.concatenate([np.linalg.qr(make.standard_normal((dim, dim)))[0].T for _ in range(count)])


@lru_cache(8)
def dither(dim: int, count: int) -> np.ndarray:
    return np.random.default_rng((SEED, dim, 1)).random((count, dim))


def _words(bits: np.ndarray) -> np.ndarray:
    """Bits along the last axis as 64-bit words, filled up with zeros."""
    wide = np.zeros((*bits.shape[:-1], -(-bits.shape[-1] // 64) * 64), bool)
    wide[..., :bits.shape[-1]] = bits
    return np.packbits(wide, axis=-1).view(np.uint64)


def sharp(dim: int, bits: int, bands: int) -> int:
    """Number of rotations that estimates read."""
    return min(math.ceil(bits * bands / dim), math.ceil(SIGNS / dim))


def encode(x: np.ndarray, bits: int, bands: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes (n, bytes), factors (n, rotations, 3), planes (n, rotations, LEVEL_BITS, words) and band
    keys (n, bands) of rows of length 1. Factors: f, least level and step of the coordinates."""
    n, dim = x.shape
    count, used = math.ceil(bits * bands / dim), sharp(dim, bits, bands)
    turned = x @ rotations(dim, count).T
    signs = turned >= 0
    turned = turned.reshape(n, count, dim)[:, :used]
    most = (1 << LEVEL_BITS) - 1
    low = turned.min(2, keepdims=True)
    step = np.maximum((turned.max(2, keepdims=True) - low) / most, 1e-12)
    levels = np.minimum(most, np.floor((turned - low) / step + dither(dim, used))).astype(np.uint8)
    planes = _words(levels[:, :, None, :] >> np.arange(LEVEL_BITS, dtype=np.uint8)[:, None] & 1)
    f = np.abs(turned).sum(2) / math.sqrt(dim)
    factors = np.stack([f, low[..., 0], step[..., 0]], axis=2).astype(np.float32)
    return np.packbits(signs, axis=1), factors, planes, band_keys(signs, bits, bands)


def band_keys(signs: np.ndarray, bits: int, bands: int) -> np.ndarray:
    weights = 1 << np.arange(bits, dtype=np.int64)
    return signs[:, :bits * bands].reshape(len(signs), bands, bits) @ weights


class Estimates:
    """Estimated cosines of pairs of rows, and their bounds."""

    def __init__(self, dim: int, codes: np.ndarray, factors: np.ndarray, planes: np.ndarray):
        n, count = factors.shape[:2]
        signs = np.unpackbits(codes, axis=1, count=count * dim).reshape(n, count, dim)
        self.words, self.planes = _words(signs), planes
        f, low, step = (factors[..., k].astype(np.float64) for k in range(3))
        levels = (np.bitwise_count(planes).sum(3, dtype=np.int64) << np.arange(LEVEL_BITS)).sum(2)
        # Of the vector whose coordinates are read: sum of level * sign = scale * common + shift * ones + rest.
        self.scale, self.shift = 2 * step / math.sqrt(dim), 2 * low / math.sqrt(dim)
        self.rest = -(low * dim + step * levels) / math.sqrt(dim)
        # Of the vector whose signs are read.
        self.ones, self.weight = signs.sum(2, dtype=np.float64), 1 / f / count
        self.turn = np.maximum(0, 1 - f ** 2) / max(1, dim - 1)
        self.round = step ** 2 / 4

    def __call__(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For the coordinates of rows a and the codes of rows b."""
        total, variance = np.zeros(len(a)), np.zeros(len(a))
        for r in range(self.words.shape[1]):
            common = np.zeros(len(a), np.uint32)
            for w in range(self.words.shape[2]):
                code = self.words[b, r, w]
                for level in range(LEVEL_BITS):
                    common += np.bitwise_count(self.planes[a, r, level, w] & code).astype(np.uint32) << np.uint32(level)
            weight = self.weight[b, r]
            total += (self.scale[a, r] * common + self.shift[a, r] * self.ones[b, r] + self.rest[a, r]) * weight
            variance += (self.turn[b, r] + self.round[a, r]) * weight ** 2
        return total, EPSILON * np.sqrt(variance)


def _valid() -> F.Column:
    e = F.col("embedding")
    fine = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.col("vec_id").isNotNull() & e.isNotNull() & fine & F.exists(e, lambda v: v != 0)


def classes(vectors: DataFrame) -> DataFrame:
    """rep (smallest vec_id), copies, embedding for every distinct usable vector, and its hash."""
    usable = vectors.where(_valid()).select("vec_id", F.col("embedding").cast("array<double>"))
    keyed = usable.select("*", *content_key())
    return keyed.groupBy("k1", "k2").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.any_value("embedding").alias("embedding"))


def content_key() -> list:
    e = F.col("embedding").cast("array<double>")
    return [F.xxhash64(e).alias("k1"), F.xxhash64(F.lit(1), e).alias("k2")]


def _unit(column: pa.Array) -> np.ndarray:
    rows = np.asarray(column.flatten(), np.float64).reshape(len(column), -1)
    rows = rows / np.abs(rows).max(1)[:, None]
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def index(vectors: DataFrame, bits: int, bands: int) -> DataFrame:
    """rep, copies, dim, unit vector, code, factors and band keys of every class."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.asarray(pc.list_value_length(batch.column("embedding")))
            for dim in np.unique(lengths):
                same = batch.take(pa.array(np.flatnonzero(lengths == dim)))
                step = max(1, (1 << 22) // max(bits * bands, int(dim)))
                for at in range(0, same.num_rows, step):
                    part = same.slice(at, step)
                    x = _unit(part.column("embedding"))
                    codes, factors, planes, keys = encode(x, bits, bands)
                    yield pa.RecordBatch.from_pydict({
                        "rep": part.column("rep"), "copies": part.column("copies"),
                        "dim": np.full(len(x), dim, np.int32), "unit": [r.tobytes() for r in x],
                        "code": [r.tobytes() for r in codes], "factors": [r.tobytes() for r in factors],
                        "planes": [r.tobytes() for r in planes],
                        "bands": pa.array(list(keys), pa.list_(pa.int64()))})
    return with_package(classes(vectors).select("rep", "copies", "embedding")).mapInArrow(
        work, "rep long, copies long, dim int, unit binary, code binary, factors binary, planes binary, "
        "bands array<long>")


def _compare(rows: pa.Table, threshold: float, bits: int, bands: int) -> pa.RecordBatch | None:
    """Link counts and forest of the groups in `rows`, sorted by group; all of one length."""
    get = lambda c: rows.column(c).to_numpy()
    bytes_of = lambda c, kind: np.frombuffer(b"".join(rows.column(c).to_pylist()), kind).reshape(len(rows), -1)
    rep, copies, band = get("rep"), get("copies"), get("band")
    x, codes = bytes_of("unit", "<f8"), bytes_of("code", np.uint8)
    dim = x.shape[1]
    used = sharp(dim, bits, bands)
    guess = Estimates(dim, codes, bytes_of("factors", np.float32).reshape(-1, used, 3),
                      bytes_of("planes", np.uint64).reshape(len(x), used, LEVEL_BITS, -1))
    keys = band_keys(np.unpackbits(codes, axis=1, count=bits * bands), bits, bands)
    counts: dict[int, int] = {}
    edges: list[tuple[int, int]] = []
    for a, b in pairs(get("group"), get("side"), get("across"), 1 << 15):
        value, error = guess(a, b)
        near = value + error >= threshold
        a, b = a[near], b[near]
        first = (keys[a] == keys[b]).argmax(1) == band[a]
        a, b = a[first], b[first]
        linked = (x[a] * x[b]).sum(1) >= threshold
        a, b = a[linked], b[linked]
        for i, j in ((a, b), (b, a)):
            who, where = np.unique(rep[i], return_inverse=True)
            for r, n in zip(who.tolist(), np.bincount(where, weights=copies[j]).astype(np.int64).tolist()):
                counts[r] = counts.get(r, 0) + n
        edges += spanning(rep[a].tolist(), rep[b].tolist())
    if not counts:
        return None
    edges = spanning(*zip(*edges))
    return pa.RecordBatch.from_pydict({
        "u": pa.array([*counts, *[e[0] for e in edges]], pa.int64()),
        "v": pa.array([None] * len(counts) + [e[1] for e in edges], pa.int64()),
        "n": pa.array([*counts.values(), *[None] * len(edges)], pa.int64())})


def _comparing(threshold: float, bits: int, bands: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches):
            for dim in rows.column("dim").unique().to_pylist():
                found = _compare(rows.filter(pc.equal(rows.column("dim"), dim)), threshold, bits, bands)
                if found is not None:
                    yield found
    return work


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, bands: int | None = None) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    bits, enough = shape(vectors.count(), threshold)
    bands = bands or enough
    codes = stored(index(vectors, bits, bands), "vector-codes")
    places = codes.select("rep", "dim", F.posexplode("bands").alias("band", "key"))
    # Joins are with stored tables, so that Spark can split a key with many rows.
    sizes = stored(places.groupBy("dim", "band", "key").agg(F.count("*").alias("members")).where("members > 1"),
                   "vector-buckets")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    shared = places.join(sizes, ["dim", "band", "key"]).withColumn("_blocks", blocks)
    shared = shared.withColumn("side", F.pmod(F.xxhash64("rep"), "_blocks").cast("int"))
    shared = shared.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    shared = shared.select("rep", "band", "side", (F.col("side") != F.col("_other")).alias("across"), F.xxhash64(
        "dim", "band", "key", F.least("side", "_other"), F.greatest("side", "_other")).alias("group"))
    rows = shared.join(codes.drop("bands"), "rep").repartition("group").sortWithinPartitions("group")
    found = stored(with_package(rows).mapInArrow(_comparing(threshold, bits, bands), "u long, v long, n long"), "vector-links")
    links = found.where("v is null").groupBy(F.col("u").alias("rep")).agg(F.sum("n").alias("near"))
    groups = components(found.where("v is not null").select("u", "v"), "vector-components")
    named = stored(classes(vectors).drop("embedding").join(links, "rep", "left").join(
        groups.withColumnRenamed("node", "rep"), "rep", "left"), "vector-classes")
    rows = vectors.select("vec_id", _valid().alias("_valid"), *content_key())
    joined = rows.join(named.withColumn("_valid", F.lit(True)), ["k1", "k2", "_valid"], "left")
    component = F.coalesce("component", "rep", "vec_id")
    return joined.select(
        "vec_id", F.coalesce(F.col("copies") - 1 + F.coalesce("near", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
