import re
from collections import Counter, defaultdict

import pytest

from ticketmill.llm import mixing


def targets(sizes):
    """Shares by weight, again and again for what is above three times the size."""
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    left, out, free = float(sum(sizes.values())), {}, set(names)
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > 3 * sizes[s]}
        if not above:
            return {**out, **share}
        for s in above:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        free -= above
    return out


def check(df, rows):
    got = mixing.taken_words(df).collect()
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    sums = defaultdict(int)
    for (_, _, s), n in zip(rows, size):
        sums[s] += n
    want = targets(sums)
    key = lambda r: (r[0] is not None, r)
    assert sorted([(r.doc_id, r.size, r.source_size) for r in got], key=key) == sorted(
        [(i, n, sums[s]) for (i, _, s), n in zip(rows, size)], key=key)
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    assert sum(r.taken for r in got) == pytest.approx(sum(size), abs=len(sums))
    if len({i for i, _, _ in rows}) == len(rows):
        source = {i: s for i, _, s in rows}
        taken = Counter()
        for r in got:
            taken[source[r.doc_id]] += r.taken
            assert r.target == pytest.approx(want[source[r.doc_id]])
        for s in sums:
            assert taken[s] == round(want[s]) or abs(taken[s] - want[s]) <= 0.5
    return got


def test_whole_table(docs):
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    first = check(docs, rows)
    again = mixing.taken_words(docs.repartition(3)).collect()
    assert sorted(first) == sorted(again)


def test_sources_of_very_different_sizes(spark):
    rows = [(i, "w " * (1 + i % 3000), s) for i, s in enumerate(["big"] * 400 + ["a"] * 3 + ["z"] * 20 + [None] * 5)]
    check(spark.createDataFrame(rows, "doc_id long, text string, source string"), rows)


def test_every_stretch_of_the_schedule_has_the_shares(spark):
    sources = spark.createDataFrame([(0, "a", 0, 50000.0), (1, "b", 0, 20000.0), (2, "c", 0, 30000.0)],
                                    "pos int, source string, source_size long, target double")
    slots = sorted((r.slot, r.pos, r["rank"]) for r in mixing.schedule(spark, sources, 100).collect())
    count = Counter(p for _, p, _ in slots)
    assert count == {0: 500, 1: 200, 2: 300}
    for pos in count:
        assert sorted(r for _, p, r in slots if p == pos) == list(range(count[pos]))
    for upto in (100, 400, 700):
        part = Counter(p for _, p, _ in slots[:upto])
        for pos, share in ((0, .5), (1, .2), (2, .3)):
            assert abs(part[pos] - share * upto) <= 11


def test_mixed_documents_stand_as_often_as_they_are_taken(docs):
    passes = Counter(r.doc_id for r in mixing.mixed_documents(docs).collect())
    for r in mixing.taken_words(docs).collect():
        assert passes[r.doc_id] == (-(-r.taken // r.size) if r.size else 1)


def test_reruns_agree_where_ids_and_sizes_repeat(spark):
    """Repeated and null ids with other texts of the same size, in other orders and partitions."""
    rows = [(k % 3 or None, f"a{k % 40} b c d", "ab"[k % 2]) for k in range(300)] + [(None, "x y", "c")] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check(df, rows)
    runs = [Counter(tuple(r) for r in mixing.mixed_documents(d).collect())
            for d in (df, df.repartition(7), df.orderBy("source", "text").coalesce(1))]
    assert runs[0] == runs[1] == runs[2]


def test_equal_ids_and_equal_rows_do_not_gather(spark):
    rows = [(None, f"t{k}", "a") for k in range(20_000)] + [(7, "same text", "a")] * 20_000
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = mixing._sizes(df, 20)
    largest = sizes.groupBy("source", "_coarse_digit", "_fine_digit").count().agg({"count": "max"}).first()[0]
    assert largest <= 12
    got = mixing.taken_words(df).collect()
    assert len(got) == 40_000 and sum(r.taken for r in got) == 60_000


def test_too_many_sources_are_refused(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_SOURCES", 3)
    df = spark.createDataFrame([(k, "a", f"s{k}") for k in range(4)], "doc_id long, text string, source string")
    with pytest.raises(ValueError):
        mixing.taken_words(df)


def test_odd_rows_and_empty_table(odd, odd_rows, nothing):
    check(odd, [r[:3] for r in odd_rows])
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns and mixed.count() > 0
    assert mixing.taken_words(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0
