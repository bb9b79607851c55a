"""Language-model scores by deleted interpolation.

A token's probability after the token v is
    l2(b) * c(v w) / c(v) + l1(b) * c(w) / N + l0(b) / (V + 1)
with maximum-likelihood counts of the training texts and b the bucket of c(v), a power of two.
The weights of every bucket are learned by expectation-maximisation on texts deleted from the
counts: one part of the training texts, counted apart, is predicted from the others. Scores then
use the counts of all training texts. Words are lower-cased (A-Z); every text ends with an end
token and starts after a start token.

Counts are exchanged in two steps. Texts are stored in compressed blocks of about BLOCK bytes. A
block sends its distinct tokens and pairs, as sorted 64-bit hashes, to the ranges of hashes they
fall into, and gets back their totals in the same order; a token in every text costs one entry per
block. Blocks and ranges are what a task holds. Pairs are sent as 48 bits next to their range.
The statistics for the weights are counts on a grid of bounded size (context bucket, and both
likelihoods in steps of 2^(1/GRID)).

Nulls: a null text is an empty one, a null doc_id is text with no characters. Repeated rows are texts
of their own; without any training text all counts are 0. Other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import crc_bucket, stored, with_package
from .shingles import Words, mix, parts

BLOCK = 16 << 20
LEAST_RANGES = 64
GRID = 4
STEPS = 200
_U = np.uint64
_END, _START = _U(0x5851F42D4C957F2D), _U(0x14057B7EF767814F)
_BEFORE, _AFTER = _U(0xD1342543DE82EF95), _U(0x2545F4914F6CDD1D)


def _packed(a: np.ndarray) -> bytes:
    return zstandard.compress(a.tobytes(), 1)


def _unpacked(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(b), kind)


def blocks(docs: DataFrame) -> DataFrame:
    """block, deleted, payload: the texts in compressed blocks; `part` (0 other, 1 training,
    2 deleted training texts) is a column of `docs`. Deleted texts have blocks of their own."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << 32, 0
        held: dict[bool, list[pa.RecordBatch]] = {False: [], True: []}

        def flush(deleted: bool) -> pa.RecordBatch:
            nonlocal number
            number += 1
            sink = pa.BufferOutputStream()
            rows = pa.Table.from_batches(held[deleted]).combine_chunks()
            with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(rows)
            held[deleted] = []
            return pa.RecordBatch.from_pydict({
                "block": [base + number], "deleted": [deleted], "payload": [sink.getvalue().to_pybytes()]})
        for batch in batches:
            mine = batch.column("part").to_numpy() == 2
            for deleted in (False, True):
                rows = batch.filter(pa.array(mine == deleted))
                for at, column in parts(rows.column("text"), BLOCK // 8):
                    held[deleted].append(rows.slice(at, len(column)))
                    if sum(b.column("text").nbytes for b in held[deleted]) >= BLOCK:
                        yield flush(deleted)
        for deleted in (False, True):
            if held[deleted]:
                yield flush(deleted)
    return with_package(docs.select("doc_id", "text", "part")).mapInArrow(
        work, "block long, deleted boolean, payload binary")


class Tokens:
    """Tokens of a block: hash of each token, of each pair with the token before it, and the range
    of each text."""

    def __init__(self, payload: bytes):
        rows = pa.ipc.open_stream(payload).read_all().combine_chunks()
        self.doc_id = rows.column("doc_id")
        self.part = rows.column("part").to_numpy()
        text = rows.column("text")
        hashes, counts = [], []
        for chunk in text.chunks:
            for _, column in parts(chunk):
                words = Words(column, True)
                own = np.diff(words.first)
                out = np.full(own.sum() + len(own), _END, _U)
                end = np.cumsum(own + 1) - 1
                inside = np.ones(len(out), bool)
                inside[end] = False
                out[inside] = words.hashes()
                hashes.append(out)
                counts.append(own + 1)
        self.token = np.concatenate(hashes) if hashes else np.zeros(0, _U)
        n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        self.first = np.concatenate([[0], np.cumsum(n)])
        before = np.empty_like(self.token)
        before[1:] = self.token[:-1]
        before[self.first[:-1]] = _START
        self.before = before
        self.pair = mix(before * _BEFORE + self.token * _AFTER)
        self.of_text = np.repeat(np.arange(len(n)), n)

    def keys(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """(distinct hashes in order, place of each token's own) of tokens and pairs. The start
        token counts once a text, as what stands before the first token."""
        with_start = np.append(self.token, np.full(len(self.first) - 1, _START, _U))
        return [np.unique(with_start, return_inverse=True), np.unique(self.pair, return_inverse=True)]


def _ranges(keys: np.ndarray, count: int) -> np.ndarray:
    """Bounds of the hash ranges in sorted keys."""
    edges = (np.arange(1, count, dtype=object) * (1 << 64) // count).astype(_U)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _requests(count: int):
    """Rows (range, block, keys, training, deleted) of every block: what it asks for and adds."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload")):
                tokens = Tokens(payload.as_py())
                train = tokens.part[tokens.of_text] > 0
                gone = tokens.part[tokens.of_text] == 2
                starts = tokens.part > 0, tokens.part == 2
                for order, (keys, place) in enumerate(tokens.keys()):
                    masks = [np.append(m, s) if order == 0 else m for m, s in zip((train, gone), starts)]
                    sums = [np.bincount(place[m], minlength=len(keys)).astype("<u4") for m in masks]
                    bounds = _ranges(keys, count)
                    rows = defaultdict(list)
                    for r, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
                        if a == b:
                            continue
                        own = keys[a:b] if order == 0 else keys[a:b].view(np.uint8).reshape(-1, 8)[:, :6]
                        for name, value in (("range", order * count + r), ("block", block), ("keys", own.tobytes()),
                                            ("training", _packed(sums[0][a:b])), ("deleted", _packed(sums[1][a:b]))):
                            rows[name].append(value)
                    if rows:
                        yield pa.RecordBatch.from_pydict({**rows, "range": pa.array(rows["range"], pa.int32())})
    return work, "range int, block long, keys binary, training binary, deleted binary"


def _totals(count: int):
    """Answers (block, range, training, kept) of a range to its blocks, and a row without a block
    with the number of training tokens, of those not deleted, and of distinct ones."""
    def work(rows: pa.Table) -> pa.Table:
        order, r = divmod(rows.column("range")[0].as_py(), count)
        keys = rows.column("keys").to_pylist()
        width = 6 if order else 8
        wide = np.zeros((sum(map(len, keys)) // width, 8), np.uint8)
        wide[:, :width] = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, width)
        _, place = np.unique(wide.view(_U).ravel(), return_inverse=True)
        del wide
        both = [np.concatenate([_unpacked(b, "<u4") for b in rows.column(c).to_pylist()]) for c in ("training", "deleted")]
        training, deleted = (np.bincount(place, weights=x).astype("<i8") for x in both)
        kept = training - deleted
        ends = np.cumsum([len(k) // width for k in keys])
        answers = [(t, _packed(training[place[a:b]]), _packed(kept[place[a:b]]))
                   for t, a, b in zip(rows.column("block").to_pylist(), [0, *ends[:-1]], ends)]
        out = {"block": [a[0] for a in answers], "range": [order * count + r] * len(answers),
               "training": [a[1] for a in answers], "kept": [a[2] for a in answers],
               "n": [None] * len(answers), "m": [None] * len(answers), "v": [None] * len(answers)}
        if order == 0:
            for name, value in (("block", None), ("range", r), ("training", None), ("kept", None),
                                ("n", int(training.sum())), ("m", int(kept.sum())), ("v", int((training > 0).sum()))):
                out[name].append(value)
        return pa.table({c: pa.array(x, t) for (c, x), t in zip(
            out.items(), [pa.int64(), pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 3])})
    return work, "block long, range int, training binary, kept binary, n long, m long, v long"


def _counts(tokens: Tokens, answers: pa.Table, which: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """c(w), c(v), c(v w) of every token of a block."""
    answers = answers.sort_by("range")
    values = np.concatenate([_unpacked(b, "<i8") for b in answers.column(which).to_pylist()])
    (single, at), (_, pair_at) = tokens.keys()
    one, two = values[:len(single)], values[len(single):]
    at = at[:len(tokens.token)]
    context = np.empty(len(at), np.int64)
    context[1:] = one[at[:-1]]
    context[tokens.first[:-1]] = one[np.searchsorted(single, _START)]
    return one[at], context, two[pair_at]


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else 1 + the power of two below its count."""
    return np.where(context > 0, np.log2(np.maximum(context, 1)).astype(np.int64) + 1, 0)


def _step(p: np.ndarray) -> np.ndarray:
    """Grid place of a likelihood, -1 for 0."""
    return np.where(p > 0, np.rint(-np.log2(np.where(p > 0, p, 1)) * GRID), -1).astype(np.int64)


def _statistics(n: int):
    def work(block: pa.Table, answers: pa.Table) -> pa.Table:
        columns = {c: [] for c in ("bucket", "pair", "single", "tokens")}
        for payload in block.column("payload").to_pylist():
            tokens = Tokens(payload)
            c1, context, c2 = _counts(tokens, answers, "kept")
            cell = np.stack([bucket_of(context), _step(c2 / np.maximum(context, 1)), _step(c1 / max(1, n))])
            cells, times = np.unique(cell, axis=1, return_counts=True)
            for name, values in zip(columns, [*cells, times]):
                columns[name] += values.tolist()
        return pa.table({c: pa.array(v, pa.int64()) for c, v in columns.items()})
    return work, "bucket long, pair long, single long, tokens long"


def learn_weights(cells: list[tuple[int, int, int, int]], v: int, steps: int = STEPS) -> dict[int, np.ndarray]:
    """Weights (pair, single, uniform) of each bucket by expectation-maximisation on the counts."""
    by_bucket = defaultdict(list)
    for bucket, pair, single, n in cells:
        by_bucket[bucket].append((2.0 ** (-pair / GRID) if pair >= 0 else 0.0,
                                  2.0 ** (-single / GRID) if single >= 0 else 0.0, 1 / (v + 1), n))
    out = {}
    for bucket, rows in by_bucket.items():
        data = np.array(rows)
        p, n = data[:, :3], data[:, 3]
        weights = np.array([0.4, 0.4, 0.2]) if bucket else np.array([0.0, 0.7, 0.3])
        for _ in range(steps):
            share = p * weights
            share /= share.sum(1, keepdims=True)
            after = n @ share / n.sum()
            done = np.abs(after - weights).max() < 1e-9
            weights = after
            if done:
                break
        # A token that no deleted text had must keep some probability.
        floor = np.array([0.0, 0.0, 1e-6])
        out[bucket] = (weights + floor) / (1 + 1e-6)
    return out


def weight_table(weights: dict[int, np.ndarray], buckets: int = 66) -> np.ndarray:
    """Weights for every bucket; those that were not learned are those of the nearest below, or
    above, or fixed ones. A context that was never seen has no pairs."""
    out, last = np.zeros((buckets, 3)), None
    for b in range(buckets):
        last = weights.get(b, last)
        known = last if last is not None else next((weights[k] for k in sorted(weights)), np.array([0.3, 0.6, 0.1]))
        out[b] = known
    rest = out[0][1:].sum()
    out[0] = [0.0, *(out[0][1:] / rest)] if rest > 0 else [0.0, 0.7, 0.3]
    return out


def _scores(n: int, v: int, table: np.ndarray):
    def work(block: pa.Table, answers: pa.Table) -> pa.Table:
        out = {c: [] for c in ("doc_id", "part", "n_tokens", "n_known", "base_score", "score")}
        for payload in block.column("payload").to_pylist():
            tokens = Tokens(payload)
            c1, context, c2 = _counts(tokens, answers, "training")
            w = table[bucket_of(context)]
            p = w[:, 0] * c2 / np.maximum(context, 1) + w[:, 1] * c1 / max(1, n) + w[:, 2] / (v + 1)
            base = np.log10((c1 + 1) / (n + v + 1))
            texts, of = len(tokens.first) - 1, tokens.of_text
            out["doc_id"] += tokens.doc_id.to_pylist()
            out["part"] += tokens.part.tolist()
            out["n_tokens"] += np.diff(tokens.first).tolist()
            out["n_known"] += np.bincount(of[c1 > 0], minlength=texts).tolist()
            out["base_score"] += np.bincount(of, weights=base, minlength=texts).tolist()
            out["score"] += np.bincount(of, weights=np.log10(p), minlength=texts).tolist()
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.table({c: pa.array(x, t) for (c, x), t in zip(out.items(), types)})
    return work, "doc_id long, part int, n_tokens long, n_known long, base_score double, score double"


def score(docs: DataFrame) -> DataFrame:
    """doc_id, part, n_tokens, n_known, train_tokens, base_score, score of every text of `docs`
    (doc_id, text, part: 0 not learned from, 1 learned from, 2 learned from and deleted for the
    weights)."""
    pieces = stored(blocks(docs.select(F.col("doc_id").cast("long"), "text", F.col("part").cast("int"))), "lm-blocks", "uncompressed")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(LEAST_RANGES, -(-size // BLOCK))
    asked = pieces.select("block", "payload").mapInArrow(*_requests(count))
    totals = stored(asked.groupBy("range").applyInArrow(*_totals(count)), "lm-totals", "uncompressed")
    # The start counts once a text like a token, but is none of the model.
    seen = totals.where("block is null").agg(F.sum("n"), F.sum("m"), F.sum("v")).first()
    texts = docs.agg(F.count_if(F.col("part") > 0), F.count_if(F.col("part") == 1)).first()
    n, kept, v = (seen[0] or 0) - texts[0], (seen[1] or 0) - texts[1], (seen[2] or 0) - (texts[0] > 0)
    answers = totals.where("block is not null").select("block", "range", "training", "kept")

    apart = pieces.where("deleted")
    told = answers.join(apart.select("block"), "block", "left_semi").select("block", "range", "kept")
    cells = apart.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(*_statistics(kept))
    cells = cells.groupBy("bucket", "pair", "single").agg(F.sum("tokens").alias("tokens"))
    table = weight_table(learn_weights([tuple(r) for r in cells.collect()], v))

    scored = pieces.groupBy("block").cogroup(answers.select("block", "range", "training").groupBy("block")).applyInArrow(
        *_scores(n, v, table))
    return scored.withColumn("train_tokens", F.lit(n).cast("long"))


def held_out_scores(docs: DataFrame, parts_in_all: int = 7, held_out: int = 2, deleted: int = 3) -> DataFrame:
    """Scores with documents split by crc32(doc_id as text)."""
    bucket = crc_bucket(F.col("doc_id"), parts_in_all)
    part = F.when(bucket == held_out, 0).when(bucket == deleted, 2).otherwise(1)
    return score(docs.select("doc_id", "text", part.alias("part")))
