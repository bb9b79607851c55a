"""Toxicity scores from a lexicon that also catches misspelled terms.

The lexicon is learned from labelled texts: words, and stems of words, that toxic texts have much
more often than others. It is a trie; a Levenshtein automaton of one error (two in long terms) for
all its terms at once is intersected with it. States of the product, sets of (node, errors), are
built on first use and kept, so that reading a word is one lookup per letter and most words end at
the second or third. A word is what is left of a run of non-blank characters without outer
punctuation, as it is and with digits and signs read as the letters they stand for.

Every hit is judged in a window of CONTEXT words on both sides: inside quotation marks, next to
words of reporting, with other hits, or addressed to somebody. Counts of hits of each kind are the
features of a logistic regression.

Labels are learned from a sample of at most SAMPLE labelled ids, chosen by a hash of doc_id; all
statistics, the regression too, are over distinct texts of the sample, where near copies of one label, as `minhash`
confirms them on full sets of five-word runs, count once. The sample's size is the bound of what is broadcast and of the
features that the driver fits. Score work is one pass over the texts, without a shuffle.

Nulls: a null text is empty; a null label or null doc_id is not learned from; of several labels of
a document the highest counts. Without labels of both kinds every score is the share of toxic ones,
or 0. An id stored several times is scored row by row; of its texts one, the first by hash, is learned from.
An empty table gives an empty result. Very long texts are read whole, in memory that follows the text. Other
columns are ignored.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import minhash
from .common import crc_bucket, stored, with_package

SAMPLE = 20_000
LEAST_COUNT = 3  # toxic texts that must have a term, however many there are
LEAST_RATIO = 12.0
STEM = (4, 9)
CONTEXT = 6
# What a task keeps for later words; beyond these it starts anew.
KNOWN_WORDS, KNOWN_LETTERS = 200_000, 4_000_000
KNOWN_STATES, KNOWN_NODES = 100_000, 1_000_000
PAIRS = 50_000

# Signs that stand for letters; quotation marks; words of reporting and of address.
LOOKALIKE = str.maketrans("0134578@$!", "oieastbasi")
QUOTES = "\"“”„«»‘’"
REPORTING = frozenset("said says wrote writes quoted called cited dit écrit sagte schrieb dijo escribió".split())
ADDRESS = frozenset("you your yours du dein ihr tu ton vous votre tú usted".split())

_OUTER = re.compile(r"^[\W_]+|[\W_]+$")


def core(word: str) -> str:
    return _OUTER.sub("", word)


def _inside(word: str, before: int, in_all: int) -> bool:
    """Whether a quotation that is open at the word's first letter ends after it."""
    opened = before + sum(word[:word.find(core(word))].count(q) for q in QUOTES)
    return opened % 2 == 1 and in_all > opened


@dataclass
class Lexicon:
    """Terms (with `*` at the end: stems) and their weights in a trie, and the automaton over it."""

    terms: list[tuple[str, float]]
    children: list[dict[str, int]] = field(default_factory=lambda: [{}])
    ends: list[dict[bool, int]] = field(default_factory=lambda: [{}])
    # A state is its nodes and their errors, packed; numbers of states, and what follows on a letter.
    states: list[bytes] = field(default_factory=list)
    numbers: dict[bytes, int] = field(default_factory=dict)
    steps: list[dict[str, int] | None] = field(default_factory=list)
    found: list[tuple[int, int] | None] = field(default_factory=list)
    n_nodes: int = 0

    def __post_init__(self):
        self.allowed = [0]
        for number, (term, _) in enumerate(self.terms):
            at, stem = 0, term.endswith("*")
            text = term.rstrip("*")
            errors = self.errors_of(term)
            self.allowed[0] = max(self.allowed[0], errors)
            for c in text:
                if c not in self.children[at]:
                    self.children[at][c] = len(self.children)
                    self.children.append({})
                    self.ends.append({})
                    self.allowed.append(0)
                at = self.children[at][c]
                self.allowed[at] = max(self.allowed[at], errors)
            self.ends[at][stem] = number
        self.start = self._state({0: 0})

    @staticmethod
    def errors_of(term: str) -> int:
        n = len(term.rstrip("*"))
        if term.endswith("*"):
            return 0 if n < 6 else 1
        return 0 if n < 4 else 1 if n < 9 else 2

    def _state(self, nodes: dict[int, int]) -> int:
        """Number of the state; letters of a term that the word lacks cost an error each."""
        todo = list(nodes)
        while todo:
            at = todo.pop()
            for child in self.children[at].values() if at >= 0 else ():
                e = nodes[at] + 1
                if e <= self.allowed[child] and e < nodes.get(child, 99):
                    nodes[child] = e
                    todo.append(child)
        best = None
        for at, e in list(nodes.items()):
            if at < 0:  # a stem that has been read to its end: -(term + 1)
                best = min(best or (99, 0), (e, -at - 1))
                continue
            for stem, term in self.ends[at].items():
                if e <= self.errors_of(self.terms[term][0]):
                    best = min(best or (99, 0), (e, term))
                    if stem:
                        nodes[-term - 1] = min(e, nodes.get(-term - 1, 99))
        key = array("i", [x for node in sorted(nodes.items()) for x in node]).tobytes()
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(key)
            self.steps.append(None)
            self.found.append(best)
            self.n_nodes += len(nodes)
        return self.numbers[key]

    def _step(self, state: int, c: str) -> int:
        after: dict[int, int] = {}

        def reach(at: int, e: int) -> None:
            if at < 0 or e <= self.allowed[at]:
                after[at] = min(e, after.get(at, 99))
        packed = array("i", self.states[state])
        for at, e in zip(packed[::2], packed[1::2]):
            if at < 0:
                reach(at, e)
                continue
            for letter, child in self.children[at].items():
                reach(child, e + (letter != c))
            reach(at, e + 1)
        return self._state(after) if after else -1

    def match(self, word: str) -> tuple[int, int] | None:
        """(errors, term) of the closest term, or None. States are built anew when there are KNOWN_STATES or
        they have KNOWN_NODES."""
        if len(self.states) > KNOWN_STATES or self.n_nodes > KNOWN_NODES:
            self.states, self.numbers, self.steps, self.found, self.n_nodes = [], {}, [], [], 0
            self.start = self._state({0: 0})
        state = self.start
        for c in word:
            step = self.steps[state]
            if step is None:
                step = self.steps[state] = {}
            state = step[c] if c in step else step.setdefault(c, self._step(state, c))
            if state < 0:
                return None
        return self.found[state]


class Reader:
    """Features of texts; what each distinct word matches is kept for KNOWN_WORDS words, of KNOWN_LETTERS in all."""

    FEATURES = 10

    def __init__(self, terms: list[tuple[str, float]]):
        self.lexicon = Lexicon(terms)
        self.known: dict[str, tuple[int, float] | None] = {}
        self.letters = 0

    def _look(self, raw: str) -> tuple[int, float] | None:
        word = core(raw)
        best = self.lexicon.match(word) if word else None
        if best is None and not word.isalpha():
            plain = core(raw.translate(LOOKALIKE))
            best = self.lexicon.match(plain) if plain and plain.isalpha() else None
        return None if best is None else (best[0], self.lexicon.terms[best[1]][1])

    def features(self, text: str | None) -> np.ndarray:
        words = (text or "").lower().split()
        if len(self.known) > KNOWN_WORDS or self.letters > KNOWN_LETTERS:
            self.known, self.letters = {}, 0
        known = self.known
        for w in set(words).difference(known):
            known[w] = self._look(w)
            self.letters += len(w)
        places = [i for i, w in enumerate(words) if known[w] is not None]
        out = np.zeros(self.FEATURES)
        if not places:
            return out
        exact = fuzzy = quoted = told = near = addressed = strongest = 0.0
        quotes = np.cumsum([sum(w.count(q) for q in QUOTES) for w in words]) if any(q in text for q in QUOTES) else None
        for k, i in enumerate(places):
            errors, weight = known[words[i]]
            window = words[max(0, i - CONTEXT):i] + words[i + 1:i + 1 + CONTEXT]
            inside = quotes is not None and _inside(words[i], quotes[i - 1] if i else 0, quotes[-1])
            reported = any(core(w) in REPORTING for w in window)
            if inside or reported:
                quoted += inside
                told += reported
                weight /= 2
            strongest = max(strongest, weight)
            exact += weight * (errors == 0)
            fuzzy += weight * (errors > 0)
            near += k > 0 and i - places[k - 1] <= CONTEXT
            addressed += any(core(w) in ADDRESS for w in window)
        n = len(words)
        out[:] = (1.0, math.log1p(exact), math.log1p(fuzzy), math.log1p(quoted), math.log1p(told), math.log1p(near),
                  math.log1p(addressed), strongest, math.log1p(len(places)), 100 * len(places) / (n + 20))
        return out


def _terms_of(words: set[str]) -> set[str]:
    out = set()
    for w in words:
        w = core(w)
        if len(w) >= 3 and w.isalpha():
            out.add(w)
            out.update(w[:k] + "*" for k in range(STEM[0], min(STEM[1], len(w) - 1) + 1))
    return out


def _terms(known: set[str] | None):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = set()
            for text, group in zip(batch.column("text"), batch.column("of")):
                terms, group = _terms_of(set((text.as_py() or "").lower().split())), group.as_py()
                rows.update((t, group) for t in (terms if known is None else terms & known))
                # A text has many terms: they go on as they come, not when the whole batch is read.
                if len(rows) >= PAIRS:
                    yield _pairs(rows)
                    rows = set()
            yield _pairs(rows)
    return work


def _pairs(rows: set[tuple[str, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "term": pa.array([r[0] for r in rows], pa.string()), "of": pa.array([r[1] for r in rows], pa.int64())})


def _counts(texts: DataFrame, known: set[str] | None) -> DataFrame:
    return with_package(texts.select("text", "of")).mapInArrow(_terms(known), "term string, of long").groupBy("term").agg(
        F.count_distinct("of").alias("n"))


def with_groups(texts: DataFrame) -> DataFrame:
    """`texts`, stored, with `of`: the same number for near copies and for no other texts; texts
    without words are copies of each other."""
    numbered = stored(texts.withColumn("_row", F.monotonically_increasing_id()), "toxicity-rows")
    found = minhash.near_duplicates(numbered.select(F.col("_row").alias("doc_id"), "text"))
    found = found.select(F.col("doc_id").alias("_row"), F.when(
        F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.lit(-1)).alias("of"))
    return stored(numbered.join(found, "_row").drop("_row"), "toxicity-sample")


def learn_lexicon(sample: DataFrame) -> list[tuple[str, float]]:
    """Terms of toxic texts and their weights, the logarithm of how much more often they have them.
    `sample` has text, toxic and `of`, the group of near copies."""
    toxic, clean = sample.where("toxic = 1"), sample.where("toxic = 0")
    n_toxic, n_clean = (t.select("of").distinct().count() for t in (toxic, clean))
    # At most as many terms as texts of the bounded sample can have that often.
    often = {r["term"]: r["n"] for r in _counts(toxic, None).where(F.col("n") >= LEAST_COUNT).collect()}
    among = {r["term"]: r["n"] for r in _counts(clean, set(often)).collect()}
    weights = {}
    for term, n in often.items():
        ratio = ((n + 0.5) / (n_toxic + 1)) / ((among.get(term, 0) + 0.5) / (n_clean + 1))
        if ratio >= LEAST_RATIO:
            weights[term] = math.log(ratio)
    # A stem says nothing new where a longer stem, or one word, stands for nearly all of it.
    longer: Counter[str] = Counter()
    for term in weights:
        text = term.rstrip("*")
        for k in range(STEM[0], len(text) + (not term.endswith("*"))):
            if text[:k] + "*" != term:
                longer[text[:k] + "*"] = max(longer[text[:k] + "*"], often[term])
    kept = [(t, w) for t, w in weights.items() if not (t.endswith("*") and longer[t] >= 0.8 * often[t])]
    # Nor does a word whose stem is kept.
    stems = {t for t, _ in kept if t.endswith("*")}
    heads = {t: {t.rstrip("*")[:k] + "*" for k in range(STEM[0], STEM[1] + 1)} - {t} for t, _ in kept}
    kept = [(t, w) for t, w in kept if stems.isdisjoint(heads[t])]
    return sorted(kept, key=lambda x: (-often[x[0]], x[0]))


_readers: dict[tuple, Reader] = {}


def reader(terms: tuple) -> Reader:
    if terms not in _readers:
        _readers.clear()
        _readers[terms] = Reader(list(terms))
    return _readers[terms]


def fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, steps: int = 50) -> np.ndarray:
    """Logistic regression by Newton's method; the first weight is the constant."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    w[0] = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    keep = np.full(len(w), ridge)
    keep[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep), x.T @ (y - p) - keep * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    terms: tuple
    weights: np.ndarray

    def score(self, docs: DataFrame) -> DataFrame:
        """doc_id and score of every row."""
        terms, weights = self.terms, self.weights

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = reader(terms)
            for batch in batches:
                z = [weights[0] + own.features(t.as_py()) @ weights[1:] for t in batch.column("text")]
                score = 1 / (1 + np.exp(-np.clip(np.array(z, float), -30, 30)))
                columns = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "_score"]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(score, pa.float64())], [
                    *[n for n in batch.schema.names if n != "_score"], "_score"])
        from pyspark.sql import types as T
        schema = T.StructType([*docs.schema.fields, T.StructField("_score", T.DoubleType())])
        return with_package(docs).mapInArrow(work, schema)


def train(docs: DataFrame, labels: DataFrame, parts: int = 5, held_out: int = 0, sample: int = SAMPLE) -> Model:
    """Learns from labelled documents whose crc32(doc_id as text) mod `parts` is not `held_out`."""
    usable = labels.where("doc_id is not null and toxic is not null").where(crc_bucket(F.col("doc_id"), parts) != held_out)
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    labelled = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # One text of each id, however often it is stored.
    one = labelled.groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("_one"))
    texts = with_groups(one.select("doc_id", "_one.text", "toxic"))
    copies = stored(texts.groupBy("of", "toxic").agg(F.min("text").alias("text")), "toxicity-texts")
    share = copies.agg(F.coalesce(F.avg(F.col("toxic").cast("double")), F.lit(0.0))).first()[0]
    if share in (0.0, 1.0):
        return Model((), np.array([30.0 if share else -30.0, *[0.0] * Reader.FEATURES]))
    terms = tuple(learn_lexicon(texts))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = reader(terms)
        for batch in batches:
            rows = [own.features(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_pydict({
                "x": pa.array([r.tolist() for r in rows], pa.list_(pa.float64())), "toxic": batch.column("toxic")})
    # A row of ten numbers for each text, SAMPLE of them at most.
    kind = copies.schema["toxic"].dataType.simpleString()
    table = with_package(copies.select("text", "toxic")).mapInArrow(work, f"x array<double>, toxic {kind}").toPandas()
    return Model(terms, fit_weights(np.stack(table["x"].to_numpy()), table["toxic"].to_numpy(float)))


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    found = train(docs, labels).score(docs.select("doc_id", "text"))
    return found.select("doc_id", (crc_bucket(F.col("doc_id"), 5) == 0).alias("held_out"), F.col("_score").alias("score"),
                        (F.col("_score") >= 0.5).cast("int").alias("predicted"))
