"""Benchmark passages in documents, by an FM-index for every shard of the documents.

`build` writes the index, a table of its own that serves any number of searches. A shard is about
SHARD words of one task's texts. Its words are numbered in the order of their hashes; its suffixes are
sorted by prefix doubling, in which only those still tied are sorted again; every text ends in a
separator of its own, so that no comparison runs past it. Kept are the words before the sorted suffixes
(Burrows-Wheeler transform) as a wavelet matrix of bit rows with rank counts, and the positions of every
SAMPLE-th word of a text. `search` takes phrases of up to `width` words in blocks of at most BLOCK
(phrase, item) rows: all phrases of a block go backwards, word by word, through the ranks of a shard
until their range of suffixes is empty; the ranges that are left are walked back to sampled positions.
The words that occurrences cover are merged to spans, in a shard and then for each document.

Texts longer than a shard are cut into pieces that overlap by width - 1 words, so that every occurrence
is whole in one of them. Blocks of phrases, shards and texts under work bound the memory of a task; the
driver sees one block of phrases at a time. Words are compared as 64-bit hashes, phrases as sequences
of them.

Defined cases. A null or empty text, and one without words, has no words and is hit by nothing; an
item without words is no phrase. Null and repeated doc_ids are ordinary: every row has a result of its
own. Rows that repeat an item_id are one item; items without an id are one more, named by an empty
string. Several items may share a window, and one item may stand in a text many times; it counts once.
Very long texts are cut as above. Empty tables: no documents give no rows, no items no hits. Other columns, whatever
their names, are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import stored, with_package
from .shingles import PART, Words, parts

WIDTH = 10
SHARD = 1 << 20
SAMPLE = 32
BLOCK = 1 << 16
STEP = 1 << 17
_KEY = 21  # bits of a place in a shard: words and separators are fewer than 2 * SHARD
_U = np.uint64

# Words are runs of ASCII letters and digits and of all bytes beyond ASCII.
OUTSIDE = np.ones(256, bool)
OUTSIDE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def word_hashes(column: pa.Array) -> Iterator[np.ndarray]:
    """Of every text the hashes of its words in lower case; a long text in parts between words."""
    for _, part in parts(column):
        if len(part) == 1 and (pc.binary_length(part)[0].as_py() or 0) > 2 * PART:
            yield np.concatenate([Words(x, True, OUTSIDE).hashes() for x in _stretches(part[0].as_buffer())])
        else:
            words = Words(part, True, OUTSIDE)
            hashes = words.hashes()
            yield from (hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:]))


def _stretches(text: pa.Buffer) -> Iterator[pa.Array]:
    data, at = np.frombuffer(text, np.uint8), 0
    while at < len(data):
        to = at + PART
        while to < len(data) and not (gap := OUTSIDE[data[to:to + PART]]).any():
            to += PART
        to = min(len(data), to + int(gap.argmax()) if to < len(data) else to)
        yield pa.StringArray.from_buffers(1, pa.py_buffer(np.array([0, to - at], np.int32)), text.slice(at, to - at))
        at = to


class Bits:
    """A row of bits with the number of ones before every place."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int32)])[:-1]

    @staticmethod
    def pack(bits: np.ndarray) -> np.ndarray:
        packed = np.packbits(bits, bitorder="little")
        out = np.zeros(len(bits) // 64 + 1, _U)
        out.view(np.uint8)[:len(packed)] = packed
        return out

    def ones(self, i: np.ndarray) -> np.ndarray:
        w = i >> 6
        mask = (_U(1) << (i & 63).astype(_U)) - _U(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(_U)) & _U(1) != 0


def suffix_ranks(text: np.ndarray) -> np.ndarray:
    """The rank of every suffix of `text`, where 0 is a separator and each one is a symbol of its
    own, smaller than all words, in the order of the text."""
    ends = text == 0
    count = int(ends.sum())
    x = np.zeros(len(text) + 2, np.int64)
    x[:-2] = text + count
    x[:-2][ends] = np.arange(count)
    key = (x[:-2] << 2 * _KEY) | (x[1:-1] << _KEY) | x[2:]
    place = np.argsort(key)
    key = key[place]
    rank, depth = np.empty(len(text), np.int64), 3
    new = np.r_[True, key[1:] != key[:-1]]
    rank[place] = np.maximum.accumulate(np.where(new, np.arange(len(text)), 0))
    while True:
        tied = ~(new & np.r_[new[1:], True])
        place = place[tied]
        if not len(place):
            return rank
        key = (rank[place] << _KEY) | rank[place + depth]
        order = np.argsort(key)
        place, key = place[order], key[order]
        old, at = key >> _KEY, np.arange(len(place))
        new = np.r_[True, key[1:] != key[:-1]]
        group = np.r_[True, old[1:] != old[:-1]]
        first = np.maximum.accumulate(np.where(group, at, 0))
        rank[place] = old + np.maximum.accumulate(np.where(new, at, 0)) - first
        depth *= 2


class Index:
    """FM-index of the texts of a shard, as arrays of words' hashes: `at`, where each text begins in
    the texts joined by separators."""

    @staticmethod
    def build(texts: list[np.ndarray]) -> tuple[bytes, np.ndarray]:
        lengths = np.array([len(t) for t in texts], np.int64)
        at = np.cumsum(lengths + 1) - lengths - 1
        alphabet, symbols = np.unique(np.concatenate(texts), return_inverse=True)
        n = int((lengths + 1).sum())
        inside = np.ones(n, bool)
        inside[at + lengths] = False
        text = np.zeros(n, np.int32)
        text[inside] = symbols + 1
        suffix = np.empty(n, np.int32)
        suffix[suffix_ranks(text)] = np.arange(n, dtype=np.int32)
        sampled = (np.arange(n) - np.repeat(at, lengths + 1)) % SAMPLE == 0
        marked = sampled[suffix]
        rows, left = [], text[suffix - 1]
        for level in reversed(range(len(alphabet).bit_length())):
            bit = (left >> level) & 1 != 0
            rows.append(Bits.pack(bit))
            left = np.concatenate([left[~bit], left[bit]])
        out = io.BytesIO()
        np.savez(out, alphabet=alphabet, counts=np.bincount(text, minlength=len(alphabet) + 1).astype(np.int32),
                 rows=np.stack(rows), marked=Bits.pack(marked), samples=suffix[marked])
        return out.getvalue(), at

    def __init__(self, data: bytes):
        with np.load(io.BytesIO(data)) as z:
            self.alphabet, self.samples, counts = z["alphabet"], z["samples"], z["counts"]
            self.levels, self.marked = [Bits(r) for r in z["rows"]], Bits(z["marked"])
        self.first = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        n = np.array([self.first[-1]])
        self.zeros = [int(n[0] - level.ones(n)[0]) for level in self.levels]

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where place i goes through the levels of the matrix among the bits of the symbol."""
        for k, (level, zeros) in enumerate(zip(self.levels, self.zeros)):
            bit = (symbol >> (len(self.levels) - 1 - k)) & 1 != 0
            ones = level.ones(i)
            i = np.where(bit, zeros + ones, i - ones)
        return i

    def _back(self, rows: np.ndarray) -> np.ndarray:
        """The row of the suffix that is one word longer."""
        i, symbol = rows, np.zeros(len(rows), np.int64)
        for level, zeros in zip(self.levels, self.zeros):
            bit = level[i]
            ones = level.ones(i)
            i = np.where(bit, zeros + ones, i - ones)
            symbol = symbol * 2 + bit
        return self.first[symbol] + i - self._down(symbol, np.zeros(len(symbol), np.int64))

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words; 0 for those that are not in the shard."""
        i = np.searchsorted(self.alphabet, hashes)
        return np.where(self.alphabet[np.minimum(i, len(self.alphabet) - 1)] == hashes, i + 1, 0)

    def ranges(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases (numbers) that occur, and the first and last + 1 of their rows. `phrases` holds
        hashes of words, each row filled up at its end."""
        known = self.symbols(phrases)
        alive = np.flatnonzero(((known > 0) | (np.arange(phrases.shape[1]) >= lengths[:, None])).all(1))
        symbol = known[alive, lengths[alive] - 1]
        low, high = self.first[symbol], self.first[symbol + 1]
        for k in range(2, phrases.shape[1] + 1):
            longer = lengths[alive] >= k
            symbol = known[alive, np.maximum(lengths[alive] - k, 0)]
            base = self.first[symbol] - self._down(symbol, np.zeros(len(symbol), np.int64))
            low = np.where(longer, base + self._down(symbol, low), low)
            high = np.where(longer, base + self._down(symbol, high), high)
            there = high > low
            alive, low, high = alive[there], low[there], high[there]
        return alive, low, high

    def positions(self, rows: np.ndarray) -> np.ndarray:
        out, active, steps = np.empty(len(rows), np.int64), np.arange(len(rows)), 0
        while len(active):
            there = self.marked[rows]
            out[active[there]] = self.samples[self.marked.ones(rows[there])] + steps
            active, rows, steps = active[~there], rows[~there], steps + 1
            if len(active):
                rows = self._back(rows)
        return out


INDEX = "key array<long>, doc_id array<long>, n_words array<long>, first array<long>, at array<int>, data binary"


def build(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The index of all texts, stored: one row per shard with its pieces (key of the row of `docs`,
    doc_id, words of the whole text, number of the piece's first word, place in the shard or -1)."""
    shard = max(SHARD, 2 * width)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words, count = [], 0, 0

        def done() -> pa.RecordBatch:
            at = np.full(len(held), -1, np.int32)
            full = [i for i, h in enumerate(held) if len(h[4])]
            data = None
            if full:
                data, at[full] = Index.build([held[i][4] for i in full])
            columns = [[[h[k] for h in held]] for k in range(4)]
            return pa.RecordBatch.from_arrays([
                *[pa.array(c, pa.list_(pa.int64())) for c in columns], pa.array([at.tolist()], pa.list_(pa.int32())),
                pa.array([data], pa.binary())], ["key", "doc_id", "n_words", "first", "at", "data"])
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for doc_id, hashes in zip(ids, word_hashes(batch.column("text"))):
                key = (TaskContext.get().partitionId() << 40) + count
                count += 1
                step = shard - width + 1
                for first in range(0, max(1, len(hashes) - width + 1 if len(hashes) > shard else 1), step):
                    piece = hashes[first:first + shard]
                    if held and (words + len(piece) > shard or len(held) >= shard):
                        yield done()
                        held, words = [], 0
                    held.append((key, doc_id, len(hashes), first, piece))
                    words += len(piece)
        if held:
            yield done()
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return stored(with_package(rows).mapInArrow(work, INDEX), "fm-index")


def phrases(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """(item, words) of every window of `width` words of an item, or of all its words if there are
    fewer; words: hashes of 8 bytes each."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, hashes in zip(batch.column("item").to_pylist(), word_hashes(batch.column("text"))):
                starts = range(max(min(1, len(hashes)), len(hashes) - width + 1))
                for at in range(0, len(starts), BLOCK):
                    windows = [hashes[i:i + width].tobytes() for i in starts[at:at + BLOCK]]
                    yield pa.RecordBatch.from_pydict({"item": [item] * len(windows), "words": pa.array(windows, pa.binary())})
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    return with_package(rows).mapInArrow(work, "item string, words binary").distinct()


def _found(index: Index, at: np.ndarray, first: np.ndarray, words: np.ndarray, lengths: np.ndarray,
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All occurrences: place, phrase, piece; by place."""
    which, low, high = index.ranges(words, lengths)
    places, owner = [], []
    ends = np.cumsum(high - low)
    total = int(ends[-1]) if len(ends) else 0
    for a in range(0, total, STEP):
        k = np.arange(a, min(total, a + STEP))
        of = np.searchsorted(ends, k, "right")
        places.append(index.positions(k - ends[of] + high[of]))
        owner.append(which[of])
    place = np.concatenate([np.zeros(0, np.int64), *places])
    order = np.argsort(place, kind="stable")
    place, phrase = place[order], np.concatenate([np.zeros(0, np.int64), *owner])[order]
    return place, phrase, np.searchsorted(at, place, "right") - 1


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans [start, end), sorted by start, without overlaps and gaps of no word."""
    reach = np.maximum.accumulate(end)
    new = np.r_[True, start[1:] > reach[:-1]]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(start) - 1]
    return start[new], reach[last]


def _searching(block: list[tuple[bytes, str]], width: int):
    """Search of the phrases of a block, (words, item) sorted by words, in shards."""
    distinct = list(dict.fromkeys(w for w, _ in block))
    number = {w: i for i, w in enumerate(distinct)}
    lengths = np.array([len(w) // 8 for w in distinct], np.int64)
    words = np.zeros((len(distinct), width), _U)
    for row, w in zip(words, distinct):
        row[:len(w) // 8] = np.frombuffer(w, _U)
    phrase = np.array([number[w] for w, _ in block])
    names, item = np.unique([i for _, i in block], return_inverse=True)
    of = np.searchsorted(phrase, np.arange(len(distinct) + 1))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                data = batch.column("data")[k].as_py()
                if data is None:
                    continue
                get = lambda c: np.asarray(batch.column(c)[k].values)  # noqa: B023, E731
                at, first, key = get("at"), get("first"), get("key")
                full = at >= 0
                at, first, key = at[full].astype(np.int64), first[full], key[full]
                place, found, piece = _found(Index(data), at, first, words, lengths)
                if not len(place):
                    continue
                start, end = merged(place, place + lengths[found])
                owner = np.searchsorted(at, start, "right") - 1
                shift = first[owner] - at[owner]
                pairs = np.unique(piece * len(distinct) + found)
                piece, found = pairs // len(distinct), pairs % len(distinct)
                many = of[found + 1] - of[found]
                entry = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many - of[found], many)
                pairs = np.unique(np.repeat(piece, many) * len(names) + item[entry])
                piece, of_item = pairs // len(names), pairs % len(names)
                hit = np.unique(owner)
                cut = lambda values, by, kind: pa.ListArray.from_arrays(
                    pa.array(np.r_[np.searchsorted(by, hit), len(by)].astype(np.int32)), pa.array(values, kind))  # noqa: B023
                yield pa.RecordBatch.from_pydict({
                    "key": key[hit], "starts": cut(start + shift, owner, pa.int64()), "ends": cut(end + shift, owner, pa.int64()),
                    "items": cut(names[of_item].tolist(), piece, pa.string())})
    return work


def search(index: DataFrame, wanted: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_words, starts, ends, items) of every row of the indexed documents: spans of
    words that occurrences of phrases (item, words) cover, and the items they belong to, sorted."""
    wanted = stored(wanted, "fm-phrases")
    blocks = max(1, -(-wanted.count() // BLOCK))
    number = F.pmod(F.xxhash64("words", "item"), F.lit(blocks))
    found = []
    for k in range(blocks):
        block = sorted((bytes(r.words), r.item) for r in wanted.where(number == k).select("words", "item").collect())
        if block:
            found.append(with_package(index.select("key", "first", "at", "data")).mapInArrow(
                _searching(block, width), "key long, starts array<long>, ends array<long>, items array<string>"))
    texts = index.select(F.explode(F.arrays_zip("key", "doc_id", "n_words", "first")).alias("t")).where("t.first = 0").select(
        "t.key", "t.doc_id", "t.n_words")
    longs, strings = (F.array().cast(f"array<{kind}>") for kind in ("long", "string"))
    if not found:
        return texts.select("doc_id", "n_words", longs.alias("starts"), longs.alias("ends"), strings.alias("items"))
    hits = stored(reduce(DataFrame.unionByName, found), "fm-hits")
    whole = hits.groupBy("key").agg(F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends"),
                                    F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    whole = stored(with_package(whole).mapInArrow(
        _merging, "key long, starts array<long>, ends array<long>, items array<string>"), "fm-spans")
    return texts.join(whole, "key", "left").select(
        "doc_id", "n_words", F.coalesce("starts", longs).alias("starts"), F.coalesce("ends", longs).alias("ends"),
        F.coalesce("items", strings).alias("items"))


def _merging(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of pieces and blocks of phrases, merged for each document."""
    for batch in batches:
        spans = []
        for a, b in zip(batch.column("starts"), batch.column("ends")):
            start, end = np.asarray(a.values), np.asarray(b.values)
            order = np.argsort(start, kind="stable")
            spans.append(merged(start[order], end[order]))
        lists = pa.list_(pa.int64())
        yield pa.RecordBatch.from_pydict({
            "key": batch.column("key"), "starts": pa.array([s for s, _ in spans], lists),
            "ends": pa.array([e for _, e in spans], lists), "items": batch.column("items")})


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """The spans of `search` for the windows of `items` in `docs`."""
    return search(build(docs, width), phrases(items, width), width)
