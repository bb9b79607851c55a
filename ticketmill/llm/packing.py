"""Best-fit packing of token sequences with swap-based local search.

Texts are encoded and cut: a document longer than a sequence gives full pieces, which are
sequences of their own, after one shorter piece at its start. The short pieces are dealt into
groups of about GROUP. Each group is packed best fit in decreasing length; then bins are searched
from the emptiest on: a document moves to another underfull bin, or one or two of them change
places with a shorter one there, as long as this makes the sum of squared fills larger, so that
the emptier bin drains until it is gone. Bins that stay emptiest go on to the next round, where
FAN groups become one; the last round is a single group.

Nulls: a null text is empty and has the end id alone; null doc_ids are ordinary. Repeated rows are
documents of their own. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import stored, with_package
from .tokens import encode_all

CAPACITY = 1024
GROUP = 4096
FAN = 32
CARRIED = GROUP // FAN


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces; only the first may be short."""
    head = length % capacity
    starts = ([0] if head else []) + list(range(head, length, capacity))
    return [(s, head if head and s == 0 else capacity) for s in starts]


def pieces(docs: DataFrame, tokenizer: str, keeps_space: bool, end: int, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 for every piece of every document."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = []
                texts = part.column("text").to_pylist()
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encode_all(texts, tokenizer, keeps_space, end)):
                    for n, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                        rows.append((doc_id, n, start, length, zlib.crc32(ids[4 * start:4 * (start + length)])))
                columns = list(zip(*rows)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int32(), *[pa.int64()] * 3])],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return with_package(docs.select(F.col("doc_id").cast("long"), "text")).mapInArrow(work, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each item: longest first, into the bin it leaves fullest."""
    bins = np.zeros(len(lengths), np.int64)
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    some, count = 0, 0
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        fitting = some >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                some ^= 1 << free
        else:
            free, b, count = capacity, count, count + 1
        bins[i] = b
        by_free[free - size].append(b)
        some |= 1 << (free - size)
    return bins


def local_search(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """Moves and exchanges that raise the sum of squared fills, until no bin can be emptied or the
    number of bins is the least possible."""
    bins = bins.copy()
    fill = np.bincount(bins, weights=lengths).astype(np.int64)
    least = -(-int(lengths.sum()) // capacity)
    used = int((fill > 0).sum())
    # Numbers of the last change of every bin and of the last one that its own search has seen.
    now, changed, seen = 0, np.zeros(len(fill), np.int64), np.full(len(fill), -1)
    while used > least:
        # The emptiest bin that has not been searched since the others last changed.
        waiting = (fill > 0) & (fill < capacity) & (seen < now)
        if not waiting.any():
            break
        a = int(np.where(waiting, fill, capacity).argmin())
        # A bin that is as its own search left it can only improve with those that are not.
        fresh = changed > (seen[a] if changed[a] <= seen[a] else -1)
        moved = _drain(a, lengths, bins, fill, capacity, fresh)
        if moved:
            now += 1
            changed[moved] = now
        seen[a] = now
        used -= int(fill[a] == 0)
    return bins


def _drain(a: int, lengths: np.ndarray, bins: np.ndarray, fill: np.ndarray, capacity: int, fresh: np.ndarray) -> list[int]:
    """Improves on bin `a` until nothing does or it is empty, at first with the bins in `fresh`;
    the bins that changed."""
    changed: set[int] = set()
    while True:
        own = np.flatnonzero(bins == a)
        if not len(own):
            return sorted(changed)
        other = (bins != a) & (fill[bins] < capacity) & (fresh[bins] | bool(changed))
        there = np.flatnonzero(other)
        if not len(there):
            return sorted(changed)
        targets = np.unique(bins[there])
        best, step = 0, None
        given = [(i,) for i in own] + [(i, j) for k, i in enumerate(own) for j in own[k + 1:]]
        for items in given:
            size = int(lengths[list(items)].sum())
            if len(items) == 1 and len(targets):
                fits = capacity - fill[targets] >= size
                gain = np.where(fits, size * (fill[targets] - fill[a] + size), 0)
                k = int(gain.argmax())
                if gain[k] > best:
                    best, step = int(gain[k]), (items, None, int(targets[k]))
            if len(there):
                more = size - lengths[there]
                fits = (more > 0) & (more <= capacity - fill[bins[there]])
                gain = np.where(fits, more * (fill[bins[there]] - fill[a] + more), 0)
                k = int(gain.argmax())
                if gain[k] > best:
                    best, step = int(gain[k]), (items, int(there[k]), int(bins[there[k]]))
        if step is None:
            return sorted(changed)
        items, back, b = step
        changed.update((a, b))
        for i in items:
            bins[i] = b
        moved = int(lengths[list(items)].sum())
        if back is not None:
            bins[back] = a
            moved -= int(lengths[back])
        fill[b] += moved
        fill[a] -= moved


def _pack_group(capacity: int, last: bool, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["length", "uid"], ascending=[False, True], ignore_index=True)
    lengths = rows["length"].to_numpy(np.int64)
    bins = local_search(lengths, best_fit(lengths, capacity), capacity)
    fill = np.bincount(bins, weights=lengths)
    rows["bin"] = bins
    # The emptiest bins with CARRIED pieces in all go on; a group that is one bin goes on whole.
    order = np.argsort(fill, kind="stable")
    order = order[(fill[order] > 0) & (fill[order] < capacity)]
    held = np.cumsum(np.bincount(bins, minlength=len(fill))[order])
    going = order[:0] if last else order[held <= max(CARRIED, held[0] if len(held) else 0)]
    rows["open"] = np.isin(bins, going)
    rows = rows.sort_values(["bin", "length", "uid"], ascending=[True, False, True], ignore_index=True)
    rows["offset"] = rows.groupby("bin")["length"].cumsum() - rows["length"]
    return rows


def _group_packer(capacity: int, last: bool):
    def work(rows: pd.DataFrame) -> pd.DataFrame:
        return _pack_group(capacity, last, rows)
    return work


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY, group_size: int = GROUP) -> DataFrame:
    """The pieces (any columns, `length` among them) with sequence_id and offset.

    Full pieces get negative numbers, others the round, group and bin in which they were packed.
    """
    columns = cut_pieces.columns
    numbered = stored(cut_pieces.withColumn("uid", F.monotonically_increasing_id()), "pack-pieces")
    done = [numbered.where(F.col("length") >= capacity).select(
        *columns, (-F.col("uid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    left = numbered.where(F.col("length") < capacity)
    groups = max(1, math.ceil(left.count() / group_size))
    left = left.withColumn("group", F.pmod(F.xxhash64("uid"), F.lit(groups)))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in left.schema.fields)
    schema = f"{fields}, bin long, open boolean, offset long"
    step = 0
    while True:
        last = groups == 1
        packed = with_package(left).groupBy("group").applyInPandas(
            _group_packer(capacity, last), schema)
        packed = stored(packed, f"pack-round{step}")
        number = F.lit(step) * F.lit(1 << 57) + F.col("group") * F.lit(1 << 20) + F.col("bin")
        done.append(packed.where(~F.col("open")).select(*columns, number.alias("sequence_id"), "offset"))
        if last:
            break
        groups = math.ceil(groups / FAN)
        left = packed.where("open").drop("bin", "open", "offset").withColumn("group", F.pmod("group", F.lit(groups)))
        step += 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out
