import random
from collections import Counter, defaultdict

from ticketmill.llm import minhash
from ticketmill.llm.components import components


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """{doc_id: (n_shingles, component)} by all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in rows}
    where = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            where[g].append(i)
    common = Counter()
    for ids in where.values():
        for a in range(len(ids)):
            for b in range(a + 1, len(ids)):
                common[ids[a], ids[b]] += 1
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def check(df, rows):
    got = minhash.near_duplicates(df).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(rows)


def test_whole_table_against_brute_force(docs):
    check(docs, [(r.doc_id, r.text) for r in docs.collect()])


def test_chains_and_groups_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rnd = random.Random(7)
    word = lambda: f"w{rnd.randrange(10**6)}"
    base = [word() for _ in range(200)]
    texts = []
    for _ in range(60):  # near copies of one text, not all of them near each other
        w = list(base)
        for k in rnd.sample(range(200), 4):
            w[k] = word()
        texts.append(" ".join(w))
    w = [word() for _ in range(300)]
    for _ in range(12):  # a chain: only neighbours are near
        texts.append(" ".join(w))
        w = w[25:] + [word() for _ in range(25)]
    passage = [word() for _ in range(100)]
    for _ in range(40):  # a common passage, but no link
        texts.append(" ".join(passage + [word() for _ in range(60)]))
    texts += [texts[3]] * 5 + [texts[3].upper().replace(" ", "\n")] + ["one", "one two", "ONE two", "one two three four five"]
    rows = [(i * 3 + 1, t) for i, t in enumerate(rnd.sample(texts, len(texts)))]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def by_row(rows):
    """(doc_id, n_shingles, component) of every row, each judged by its own text."""
    ids = {i: doc_id for i, (doc_id, _) in enumerate(rows)}
    groups = brute([(i, t) for i, (_, t) in enumerate(rows)])
    least = {}
    for i, (n, g) in groups.items():
        if n and ids[i] is not None:
            least[g] = min(least.get(g, ids[i]), ids[i])
    return sorted(((ids[i], n, least.get(g, ids[i]) if n else ids[i]) for i, (n, g) in groups.items()), key=str)


def test_repeated_and_null_ids_with_different_texts(spark):
    rnd = random.Random(11)
    text = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    a, b = text(80), text(90)
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, " ".join([*a, "more"])), (9, " ".join(["front", *b]))]
    chain = text(300)
    for i in (30, None, None, 33, None, 31):  # neighbours only are near; rows without ids hold the chain together
        rows.append((i, " ".join(chain)))
        chain = chain[25:] + text(25)
    rows += [(None, " ".join(a)), (1, " ".join(a)), (5, None), (5, " ".join(b[:70])), (None, None), (None, ""), (6, "alone")]
    rows += [(None, " ".join(text(8)))] * 3
    for parts in (1, 4):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = minhash.near_duplicates(df).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == by_row(rows)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (None, 5), (301, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 300: 300, 301: 300}
    assert got == want


def test_odd_rows_and_empty_table(odd, nothing):
    got = minhash.near_duplicates(odd).collect()
    assert len(got) == 11
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert (by_id[7].component_id, by_id[7].kept) == (1, False)
    assert [by_id[i].n_shingles for i in (2, 3, 4)] == [0, 0, 0] and all(by_id[i].kept for i in (2, 3, 4, 5, 6, 8))
    assert minhash.near_duplicates(nothing).count() == 0
