"""Substring dedup by recompression.

The words of a text are rewritten in rounds. A round names runs of equal symbols (the first one
only) and then pairs: a bit of its name puts each symbol on the left or on the right side, and a
left symbol followed by a right one becomes a new symbol. Names are 64-bit hashes of what they
stand for, so that all tasks give the same name without an exchange. Whether symbols form a pair
depends on them alone; for every symbol the words that its existence depends on, its context, are
known. If a window of words stands at two places, each symbol whose context lies inside the window
stands at both.

1. Spark counts the names of the last round over the whole table.
2. A window that holds the context of a name that occurs once occurs once, too. The other windows
   are candidates: copies, and a few others.
3. Spark counts a hash of the words of every candidate, of 96 bits: among 10^13 windows two different
   ones share it with a probability under 0.001. Windows found twice are repeated, and all their
   words are removed.

No window is lost: symbols only rule windows out. Texts are dealt into blocks of about BLOCK bytes
that are stored once; a block sends each name once, so that a passage in a third of all texts sends
one row per block. Nulls: a null text has no words. Windows in repeated rows count like any others.
An empty table gives an empty result. All other columns are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from .common import stored, with_package
from .shingles import Words, mix, parts

WINDOW = 35
ROUNDS = 6
LONGEST = 14
BLOCK = 4 << 20
_U = np.uint64
_LEFT, _RIGHT, _RUN = (_U(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))
_BASE = 0xC2B2AE3D27D4EB4F
_SECOND = _U(0x8EBC6AF09C88C6E3)


class Symbols:
    """Names, places [start, end) and contexts [low, high) of the symbols of some texts, by word."""

    def __init__(self, hashes: np.ndarray, first: np.ndarray):
        self.name = hashes
        self.start = np.arange(len(hashes))
        self.end = self.start + 1
        self.low, self.high = self.start.copy(), self.end.copy()
        self.text = np.repeat(np.arange(len(first) - 1), np.diff(first))

    def _keep(self, mask: np.ndarray) -> None:
        for k in ("name", "start", "end", "low", "high", "text"):
            setattr(self, k, getattr(self, k)[mask])

    def _lean_on(self, at: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
        """Contexts of the symbols `at` with those of their neighbours; a place outside of the
        text stands for a neighbour that is missing."""
        other = np.clip(at + step, 0, len(self.name) - 1)
        there = (other != at) & (self.text[other] == self.text[at])
        low = np.where(there, self.low[other], self.start[at] - (step < 0))
        high = np.where(there, self.high[other], self.end[at] + (step > 0))
        return np.minimum(self.low[at], low), np.maximum(self.high[at], high)

    def name_runs(self) -> None:
        n = len(self.name)
        if not n:
            return
        new = np.r_[True, (self.name[1:] != self.name[:-1]) | (self.text[1:] != self.text[:-1])]
        head = np.flatnonzero(new)
        last = np.r_[head[1:], n] - 1
        words = self.end[last] - self.start[head]
        # All depend on the symbols next to the run; members of a run that is too long on all of it.
        low, _ = self._lean_on(head, -1)
        _, high = self._lean_on(last, 1)
        count = last - head + 1
        run = np.repeat(np.arange(len(head)), count)
        self.low, self.high = low[run], high[run]
        short = (count > 1) & (words <= LONGEST)
        at = head[short]
        self.name = self.name.copy()
        self.name[at] = mix(self.name[at] * _RUN + count[short].astype(_U))
        self.end[at] = self.end[last[short]]
        self._keep(new | ~short[run])

    def name_pairs(self, number: int) -> None:
        n = len(self.name)
        if not n:
            return
        left = mix(self.name + np.array([number + 1], _U) * _LEFT) & _U(1) == 0
        pair = np.zeros(n, bool)
        pair[:-1] = (left[:-1] & ~left[1:] & (self.text[:-1] == self.text[1:])
                     & (self.end[1:] - self.start[:-1] <= LONGEST))
        tail = np.r_[False, pair[:-1]]
        a = np.flatnonzero(pair)
        low, high = self.low.copy(), self.high.copy()
        low[a], high[a] = np.minimum(low[a], low[a + 1]), np.maximum(high[a], high[a + 1])
        alone = ~pair & ~tail
        for which, step in ((left, 1), (~left, -1)):
            i = np.flatnonzero(alone & which)
            low[i], high[i] = self._lean_on(i, step)
        self.name = self.name.copy()
        self.name[a] = mix(self.name[a] * _LEFT + self.name[a + 1] * _RIGHT)
        self.end[a] = self.end[a + 1]
        self.low, self.high = low, high
        self._keep(~tail)


def symbols(hashes: np.ndarray, first: np.ndarray, window: int, rounds: int = ROUNDS) -> Symbols:
    """Symbols of the last round whose context fits into a window, of texts with a window."""
    out = Symbols(hashes, first)
    out._keep((np.diff(first) >= window)[out.text])
    out.name_runs()
    for number in range(rounds):
        out.name_pairs(number)
    out._keep(out.high - out.low <= window)
    return out


def _spread(low: np.ndarray, high: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in one of the ranges [low, high)."""
    ok = low < high
    steps = np.bincount(low[ok], minlength=n + 1) - np.bincount(high[ok], minlength=n + 1)
    return np.cumsum(steps)[:n] > 0


def candidates(hashes: np.ndarray, first: np.ndarray, window: int, shared: np.ndarray) -> np.ndarray:
    """Which words start a window that no name outside of `shared` (sorted) rules out."""
    found = symbols(hashes, first, window)
    unique = ~_within(found.name, shared)
    low, high, text = found.low[unique], found.high[unique], found.text[unique]
    begin, last = first[:-1][text], first[1:][text] - window
    ruled_out = _spread(np.maximum(high - window, begin), np.minimum(low, last) + 1, len(hashes))
    starts = _spread(first[:-1], np.maximum(first[1:] - window + 1, first[:-1]), len(hashes))
    return starts & ~ruled_out


def _within(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    at = np.searchsorted(ordered, values)
    return (at < len(ordered)) & (np.take(ordered, at, mode="clip") == values) if len(ordered) else np.zeros(len(values), bool)


def _rolling(hashes: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    n = len(hashes)
    power = np.full(n + 1, _BASE | 1, _U)
    back = np.full(n + 1, pow(_BASE | 1, -1, 1 << 64), _U)
    power[0] = back[0] = 1
    np.multiply.accumulate(power, out=power)
    np.multiply.accumulate(back, out=back)
    sums = np.zeros(n + 1, _U)
    np.cumsum(hashes * power[:n], out=sums[1:])
    return mix((sums[at + window] - sums[at]) * back[at])


def window_hashes(hashes: np.ndarray, at: np.ndarray, window: int) -> list[np.ndarray]:
    """64 and 32 bits for every window, from two names of each word that do not depend on each other."""
    return [_rolling(hashes, at, window), (_rolling(mix(hashes ^ _SECOND), at, window) >> _U(32)).astype(np.uint32)]


def _in_order(keys: list[np.ndarray]) -> list[np.ndarray]:
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0])
    return [k[order] for k in keys]


def _key_rows(block: int, keys: list[np.ndarray]) -> pa.RecordBatch:
    """The distinct keys of a block and whether they stand in it twice."""
    keys = _in_order(keys)
    new = np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)] if len(keys[0]) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    keys = [k[first] for k in keys]
    twice = np.diff(np.r_[first, len(new)]) > 1
    columns = [pa.array(k.view(f"i{k.itemsize}")) for k in keys]
    return pa.RecordBatch.from_arrays(
        [*columns, pa.array(np.full(len(first), block, np.int64)), pa.array(twice)], [*KEY[:len(keys)], "block", "twice"])


# Columns of a key: names of symbols have the first, windows both.
KEY = ("key", "more")


def _key_schema(width: int) -> str:
    return ", ".join([*["key long", "more int"][:width], "block long", "twice boolean"])


def repeated_keys(keys: DataFrame) -> DataFrame:
    """(block, key) of the keys that occur at two places at least. A key has one row per block and
    all its rows meet in order, so that tasks only look at neighbours. A block tells its own windows
    by the first 64 bits."""
    names = [c for c in KEY if c in keys.columns]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: pa.RecordBatch | None = None  # the last row, not yet judged
        shared_before = False

        def some(rows: pa.Table, chosen: np.ndarray) -> pa.RecordBatch:
            return rows.select(["block", "key"]).filter(pa.array(chosen)).combine_chunks().to_batches()
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch] if before is None else [before, batch])
            own = [rows.column(c).to_numpy() for c in names]
            same = np.all([k[1:] == k[:-1] for k in own], axis=0)
            shared = rows.column("twice").to_numpy().copy()
            shared[1:] |= same
            shared[:-1] |= same
            shared[0] |= shared_before
            yield from some(rows.slice(0, len(shared) - 1), shared[:-1])
            before, shared_before = batch.slice(batch.num_rows - 1), bool(shared[-1])
        if before is not None and shared_before:
            yield from some(pa.Table.from_batches([before]), np.array([True]))
    ordered = keys.repartition("key").sortWithinPartitions(*names)
    return ordered.mapInArrow(work, "block long, key long")


def blocks(docs: DataFrame) -> DataFrame:
    """`docs` with _block, which numbers stretches of about BLOCK bytes of text."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, seen = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for at, column in parts(batch.column("text"), BLOCK // 4):
                seen += column.nbytes
                own = pa.array(np.full(len(column), base + seen // BLOCK, np.int64))
                rows = batch.slice(at, len(column))
                yield pa.RecordBatch.from_arrays([*rows.columns, own], [*rows.schema.names, "_block"])
    schema = T.StructType([*docs.schema.fields, T.StructField("_block", T.LongType())])
    return with_package(docs).mapInArrow(work, schema)


def _names(window: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, []
        for batch in batches:
            numbers = batch.column("_block").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                if block is not None and numbers[a] != block:
                    yield _key_rows(block, [np.concatenate(held)])
                    held = []
                block = int(numbers[a])
                for _, column in parts(batch.column("text").slice(a, b - a)):
                    words = Words(column, False)
                    held.append(symbols(words.hashes(), words.first, window).name)
        if held:
            yield _key_rows(block, [np.concatenate(held)])
    return work


def _judge(window: int, with_text: bool):
    """Whole blocks with their shared names: finished texts, and those with candidates."""
    def work(docs: pa.Table, names: pa.Table) -> pa.Table:
        docs = docs.combine_chunks()
        shared = np.sort(names.column("key").to_numpy().view(_U))
        n_words, digest, starts, text = [], [], [], []
        column = docs.column("text").combine_chunks() if docs.num_rows else pa.array([], pa.string())
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) and column.num_chunks else column
        for _, part in parts(column):
            words = Words(part, False)
            open_at = candidates(words.hashes(), words.first, window, shared)
            for i, t in enumerate(part.to_pylist()):
                a, b = words.first[i], words.first[i + 1]
                # Places at which candidates begin and end to follow each other.
                own = np.flatnonzero(np.diff(np.r_[False, open_at[a:b], False].astype(np.int8)))
                n_words.append(int(b - a))
                starts.append(own.astype("<i4").tobytes() if len(own) else None)
                digest.append(None if len(own) else _digest(_split(t)))
                text.append(t if with_text or len(own) else None)
        place = docs.schema.get_field_index("text")
        docs = docs.set_column(place, "text", pa.array(text, pa.string()))
        for name, values in (("_words", pa.array(n_words, pa.int64())), ("_removed", pa.array([0] * len(text), pa.int64())),
                             ("_digest", pa.array(digest, pa.string())), ("_starts", pa.array(starts, pa.binary()))):
            docs = docs.append_column(name, values)
        return docs
    return work


def _split(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _own_windows(text: str, starts: bytes, window: int) -> tuple[np.ndarray, list[np.ndarray]]:
    hashes = Words(pa.array([text]), False).hashes()
    low, high = np.frombuffer(starts, "<i4").astype(np.int64).reshape(-1, 2).T
    at = np.flatnonzero(_spread(low, high, len(hashes)))
    return at, window_hashes(hashes, at, window)


def _windows(window: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, []
        for batch in batches:
            rows = zip(batch.column("_block").to_pylist(), batch.column("text").to_pylist(), batch.column("_starts").to_pylist())
            for number, text, starts in rows:
                if block is not None and number != block:
                    yield _key_rows(block, [np.concatenate(k) for k in zip(*held)])
                    held = []
                block = number
                held.append(_own_windows(text, starts, window)[1])
        if held:
            yield _key_rows(block, [np.concatenate(k) for k in zip(*held)])
    return work


def _remove(window: int, with_text: bool):
    def work(docs: pa.Table, repeated: pa.Table) -> pa.Table:
        again = np.sort(repeated.column("key").to_numpy().view(_U))
        removed, digest, kept_text = [], [], []
        for text, starts in zip(docs.column("text").to_pylist(), docs.column("_starts").to_pylist()):
            at, keys = _own_windows(text, starts, window)
            at = at[_within(keys[0], again)]
            words = _split(text)
            gone = _spread(at, at + window, len(words))
            kept = [w for w, g in zip(words, gone.tolist()) if not g] if len(at) else words
            removed.append(len(words) - len(kept))
            digest.append(_digest(kept))
            kept_text.append((b" ".join(kept).decode() if len(at) else text) if with_text else None)
        for name, values in (("text", pa.array(kept_text, pa.string())), ("_removed", pa.array(removed, pa.int64())),
                             ("_digest", pa.array(digest, pa.string()))):
            docs = docs.set_column(docs.schema.get_field_index(name), name, values)
        return docs
    return work


def without_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """`docs` with the repeated words removed, and _words, _removed and _digest (SHA-256 of the
    kept words joined by one space). Texts in which nothing repeats stay as they are, those of the
    others are the kept words joined by one space; without `with_text` no text is returned."""
    pieces = stored(blocks(docs), "substring-blocks")
    names = with_package(pieces.select("text", "_block")).mapInArrow(_names(window), _key_schema(1))
    shared = repeated_keys(names)
    out = T.StructType([*pieces.schema.fields, T.StructField("_words", T.LongType()), T.StructField("_removed", T.LongType()),
                        T.StructField("_digest", T.StringType()), T.StructField("_starts", T.BinaryType())])
    judged = stored(pieces.groupBy("_block").cogroup(shared.groupBy("block")).applyInArrow(
        _judge(window, with_text), out), "substring-judged")
    pending = judged.where("_starts is not null")
    windows = pending.select("text", "_block", "_starts").mapInArrow(_windows(window), _key_schema(2))
    again = repeated_keys(windows)
    cleaned = pending.groupBy("_block").cogroup(again.groupBy("block")).applyInArrow(_remove(window, with_text), out)
    return judged.where("_starts is null").unionByName(cleaned).drop("_block", "_starts")
