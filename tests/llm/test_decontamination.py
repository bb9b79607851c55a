import random
import re

import numpy as np
import pytest

from ticketmill.llm import decontamination as dc
from ticketmill.llm import queries

DOCS = "doc_id long, text string, `key` string, `at` int, `first` int, n_words string, items string"
ITEMS = "item_id long, text string, item string, words string"


def words(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())


def brute(docs, items, width=10):
    """Sorted (doc_id, n_words, covered word numbers, items)."""
    phrases = {}
    for i, t in items:
        w = words(t)
        for k in range(max(min(1, len(w)), len(w) - width + 1)):
            phrases.setdefault(tuple(w[k:k + width]), set()).add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w, covered, found = words(t), set(), set()
        for size in {len(p) for p in phrases}:
            for k in range(len(w) - size + 1):
                if tuple(w[k:k + size]) in phrases:
                    covered |= {*range(k, k + size)}
                    found |= phrases[tuple(w[k:k + size])]
        out.append((d, len(w), sorted(covered), sorted(found)))
    return sorted(out, key=str)


def check(spark, docs, items, parts=3):
    found = dc.contamination(spark.createDataFrame([(*d, "", 0, 0, "", "") for d in docs], DOCS).repartition(parts),
                             spark.createDataFrame([(*i, "", "") for i in items], ITEMS))
    got = []
    for r in found.collect():
        assert all(b < a for b, a in zip(r.ends, r.starts[1:]))  # merged: not even touching
        got.append((r.doc_id, r.n_words, [k for a, b in zip(r.starts, r.ends) for k in range(a, b)], r.items))
    want = brute(docs, items)
    assert sorted(got, key=str) == want
    return want


def text(rnd, n, vocabulary=40):
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


def corpus(rnd):
    """Documents with quoted items, parts of items, copies and words that repeat."""
    items = [(k, text(rnd, rnd.choice([1, 3, 9, 10, 11, 40]), 400)) for k in range(30)]
    items += [(100, items[5][1]), (101, text(rnd, 5, 400) + " " + items[7][1]), (7, text(rnd, 12, 400)), (None, text(rnd, 14, 400)),
              (102, "same same same same same same same same same same same same"), (103, None), (104, " ... "), (105, "é1 É2 日本")]
    docs = []
    for k in range(120):
        w = text(rnd, rnd.randrange(60), 400).split()
        for _ in range(rnd.randrange(3)):
            quote = (rnd.choice(items)[1] or "").split()
            a = rnd.randrange(len(quote) + 1) if rnd.random() < 0.3 else 0
            at = rnd.randrange(len(w) + 1)
            w[at:at] = [x.upper() if rnd.random() < 0.2 else x for x in quote[a:]]
        docs.append((k, rnd.choice([" ", ", ", "\n"]).join(w)))
    docs += [(200 + k, docs[3][1]) for k in range(40)] + [(3, docs[4][1]), (None, docs[5][1]), (None, None), (300, None), (301, ""), (302, "-- !")]
    docs += [(303, "same " * 30), (304, "x" + items[0][1]), (305, "é1 É2 日本 É1 é2")]
    return docs, items


def test_against_brute_force(spark):
    want = check(spark, *corpus(random.Random(1)))
    assert sum(bool(w[2]) for w in want) > 30


def test_small_shards_and_blocks(spark, monkeypatch):
    """Texts cut into overlapping pieces, many shards, many blocks of phrases, sparse samples."""
    monkeypatch.setattr(dc, "SHARD", 25)
    monkeypatch.setattr(dc, "BLOCK", 60)
    monkeypatch.setattr(dc, "SAMPLE", 5)
    monkeypatch.setattr(dc, "STEP", 7)
    check(spark, *corpus(random.Random(2)))


def test_long_texts_go_in_parts(spark, monkeypatch):
    rnd = random.Random(3)
    item = text(rnd, 25, 10**6)
    long_text = text(rnd, 3000) + " " + item + " " + text(rnd, 3000) + "z" * 5000 + " " + item
    monkeypatch.setattr(dc, "PART", 700)
    import pyarrow as pa
    parts = np.concatenate(list(dc.word_hashes(pa.array([long_text, None, "a b"]))))
    monkeypatch.undo()
    assert (parts == np.concatenate(list(dc.word_hashes(pa.array([long_text, None, "a b"]))))).all()
    check(spark, [(1, long_text), (2, "short")], [(1, item)])


@pytest.mark.parametrize("seed", range(5))
def test_suffixes_are_sorted(seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, [2, 3, 5, 50, 2][seed], 400).astype(np.int32)
    if seed == 4:
        x = np.tile(np.r_[np.arange(1, 30), 0], 20).astype(np.int32)
    x[-1] = 0
    own, k = [], 0
    for v in x:
        own.append((0, k) if v == 0 else (1, int(v)))
        k += v == 0
    suffixes = sorted(range(len(x)), key=lambda i: own[i:])
    assert (np.argsort(dc.suffix_ranks(x)) == suffixes).all()


def test_index_alone():
    """Counts and places of phrases in one shard."""
    rng = np.random.default_rng(9)
    texts = [rng.integers(1, 6, n).astype(np.uint64) for n in (1, 40, 300, 7)]
    data, at = dc.Index.build(texts)
    index = dc.Index(data)
    wanted = np.zeros((200, 4), np.uint64)
    sizes = rng.integers(1, 5, 200)
    for row, n in zip(wanted, sizes):
        row[:n] = rng.integers(1, 7, n)
    which, low, high = index.ranges(wanted, sizes)
    for k in range(200):
        phrase = wanted[k, :sizes[k]].tolist()
        want = [int(a) + i for a, t in zip(at, texts) for i in range(len(t) - len(phrase) + 1) if t[i:i + len(phrase)].tolist() == phrase]
        here = np.flatnonzero(which == k)
        got = sorted(index.positions(np.arange(low[here[0]], high[here[0]])).tolist()) if len(here) else []
        assert got == want


def test_index_serves_several_searches(spark):
    docs, items = corpus(random.Random(4))
    index = dc.build(spark.createDataFrame([(*d, "", 0, 0, "", "") for d in docs], DOCS))
    for some in (items[:5], items[5:], []):
        wanted = dc.phrases(spark.createDataFrame([(*i, "", "") for i in some], ITEMS))
        got = dc.search(index, wanted).collect()
        want = brute(docs, some)
        assert sorted(((r.doc_id, r.n_words, r.items) for r in got), key=str) == sorted(((w[0], w[1], w[3]) for w in want), key=str)


def test_empty_tables(spark):
    no_docs, no_items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "a b", "", 0, 0, "", "")], DOCS)
    assert dc.contamination(no_docs, no_items).count() == 0
    assert dc.contamination(no_docs, spark.createDataFrame([(1, "a b", "", "")], ITEMS)).count() == 0
    assert [tuple(r) for r in dc.contamination(some, no_items).collect()] == [(1, 2, [], [], [])]


def test_query_over_the_table(spark, docs):
    data = "/root/testdata/sf0.001"
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    want = {w[0]: (w[1], len(w[2]), len(w[3])) for w in brute([(r.doc_id, r.text) for r in docs.collect()], items)}
    got = queries.QUERIES["op11_benchmark_decontamination"](spark, data).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in got} == want and len(got) == len(want)
    assert any(r.contaminated for r in got) and all(r.contaminated == (r.n_hit > 0) for r in got)
