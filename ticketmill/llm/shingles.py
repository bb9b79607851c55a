"""Hashes of words and word runs for whole Arrow batches of texts, as numpy arrays.

A word is a run of bytes other than ASCII white space; A-Z count as a-z where asked. Hashes are 64
bits wide and the same on every machine. Work goes in parts of about PART bytes, so that the memory
of a task does not follow the size of its batches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PART = 1 << 21
_U = np.uint64
_rng = np.random.default_rng(5)
_LETTERS = _rng.integers(1, 1 << 63, 256, dtype=_U) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_PLACES = _rng.integers(1, 1 << 63, 64, dtype=_U) * _U(2) + _U(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_AS_IS = np.arange(256, dtype=np.uint8)
_LOWER = _AS_IS.copy()
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of the input over the output."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def parts(column: pa.Array, limit: int = PART) -> Iterator[tuple[int, pa.Array]]:
    """(first row, slice) of a string column in slices of about `limit` bytes, at least a row."""
    ends = np.cumsum(np.asarray(pc.binary_length(column.fill_null("")), np.int64))
    at = 0
    while at < len(column):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield at, column.slice(at, to - at)
        at = to


class Words:
    """The words of a string column: bytes (lower-cased where asked), starts and ends in them, and
    for each text the range of its words, first[i] to first[i + 1]. `outside` marks the bytes that are
    in no word, white space if not given."""

    def __init__(self, column: pa.Array, lower: bool, outside: np.ndarray = _SPACE):
        column = column.fill_null("")
        _, offsets, data = column.buffers()
        offsets = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
        raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        self.data = (_LOWER if lower else _AS_IS)[raw]
        inside = ~outside[raw]
        border = np.zeros(len(raw) + 1, bool)
        border[offsets] = True
        before = np.empty(len(raw), bool)
        after = np.empty(len(raw), bool)
        if len(raw):
            before[0] = after[-1] = False
            before[1:] = inside[:-1]
            after[:-1] = inside[1:]
        self.start = np.flatnonzero(inside & (~before | border[:-1]))
        self.end = np.flatnonzero(inside & (~after | border[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)

    def hashes(self) -> np.ndarray:
        n = len(self.data)
        power = np.full(n + 1, _BASE, _U)
        back = np.full(n + 1, pow(_BASE, -1, 1 << 64), _U)
        power[0] = back[0] = 1
        np.multiply.accumulate(power, out=power)
        np.multiply.accumulate(back, out=back)
        sums = np.zeros(n + 1, _U)
        np.cumsum(_LETTERS[self.data] * power[:n], out=sums[1:])
        return mix((sums[self.end] - sums[self.start]) * back[self.start] + (self.end - self.start).astype(_U))

    def text(self, a: int, b: int, drop: np.ndarray | None = None) -> bytes:
        """Words a to b, joined by one space; without those marked in `drop`."""
        keep = range(a, b) if drop is None else np.flatnonzero(~drop[a:b]) + a
        data, s, e = self.data.tobytes(), self.start.tolist(), self.end.tolist()
        return b" ".join([data[s[i]:e[i]] for i in keep])


def runs(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` words and the range of each text's runs. A text with fewer
    words is one run; one without words has none."""
    n = np.diff(first)
    whole = np.zeros(max(0, len(hashes) - width + 1), _U)
    for k in range(width):
        whole += hashes[k:k + len(whole)] * _PLACES[k]
    counts = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    out_first = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(out_first[-1], _U)
    long = n >= width
    # Places of the long texts' runs, in order.
    reps = counts[long]
    at = np.repeat(first[:-1][long] - (np.cumsum(reps) - reps), reps) + np.arange(reps.sum())
    to = np.repeat(out_first[:-1][long] - (np.cumsum(reps) - reps), reps) + np.arange(reps.sum())
    out[to] = whole[at]
    for i in np.flatnonzero((n > 0) & ~long):
        h = hashes[first[i]:first[i + 1]]
        terms = np.append(h * _PLACES[:len(h)], _PLACES[-1 - len(h)])
        out[out_first[i]] = terms.sum(dtype=_U)
    return mix(out), out_first


def shingle_sets(column: pa.Array, width: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Sorted distinct run hashes of every text, in lower case, and all of them in one array with
    each text's range."""
    words = Words(column, True)
    all_runs, first = runs(words.hashes(), words.first, width)
    sets = [np.unique(all_runs[a:b]) for a, b in zip(first[:-1], first[1:])]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return sets, np.concatenate(sets) if sets else all_runs, bounds


def set_key(s: np.ndarray) -> tuple[int, int]:
    """Both halves of a 128-bit hash."""
    digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
    return tuple(int.from_bytes(digest[i:i + 8], "little", signed=True) for i in (0, 8))
