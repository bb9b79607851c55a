import time

import numpy as np

from ticketmill.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int, rep string, `group` int"


def brute(rows, threshold=0.95):
    """n_links and component of every usable row."""
    use = [(i, np.array(v, np.float64)) for i, v in rows
           if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links = {k: [] for k in range(len(use))}
    for a in range(len(use)):
        for b in range(a + 1, len(use)):
            x, y = use[a][1], use[b][1]
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links[a].append(b)
                links[b].append(a)
    component = {}
    for k in sorted(links, key=lambda k: use[k][0]):
        todo = [k]
        while todo:
            x = todo.pop()
            if x not in component:
                component[x] = use[k][0]
                todo += links[x]
    return sorted((use[k][0], len(links[k]), component[k]) for k in links)


def test_recall_on_hard_pairs(spark):
    rng = np.random.default_rng(4)
    rows = []
    for g in range(150):
        x = rng.standard_normal(48)
        x /= np.linalg.norm(x)
        for _ in range(3):
            y = rng.standard_normal(48)
            y -= (y @ x) * x
            y /= np.linalg.norm(y)
            c = rng.uniform(0.955, 0.999)
            rows.append((c * x + np.sqrt(1 - c * c) * y).tolist())
        rows.append(x.tolist())
    rows = list(enumerate(rows))
    df = spark.createDataFrame([(i, v, 0, "", 0) for i, v in rows], SCHEMA.replace("float", "double"))
    got = {r.vec_id: r.n_links for r in vectors.near_duplicates(df).collect()}
    want = {i: n for i, n, _ in brute(rows)}
    assert all(got[i] <= want[i] for i in want)
    assert sum(got.values()) >= 0.95 * sum(want.values())


def test_table_and_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    rows = [(r.vec_id, r.embedding) for r in table]
    rng = np.random.default_rng(5)
    center = np.array(rows[0][1])
    for k in range(80):  # near copies of one vector, more than a block
        rows.append((10_000 + k, (center * (1 + k % 3) + rng.normal(0, 0.003, len(center))).tolist()))
    rows += [(20_000 + k, rows[1][1]) for k in range(30)]
    df = spark.createDataFrame([(i, v, 0, "", 0) for i, v in rows], SCHEMA)
    exact = [(r.vec_id, r.embedding) for r in df.collect()]
    got = vectors.near_duplicates(df).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute(exact)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def at_cosine(rng, n, dim, cosine):
    """Two arrays of n vectors of length 1, whose rows have that cosine."""
    x, y = rng.standard_normal((2, n, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y -= (x * y).sum(1)[:, None] * x
    y /= np.linalg.norm(y, axis=1)[:, None]
    return x, cosine * x + np.sqrt(1 - cosine ** 2) * y


def test_recall_at_the_threshold_for_every_size():
    rng = np.random.default_rng(7)
    for dim in (48, 64):
        x, y = at_cosine(rng, 2000, dim, 0.95)
        for n in (200, 50_000, 1_000_000, 1_000_000_000):
            bits, bands = vectors.shape(n, 0.95)
            met = (vectors.encode(x, bits, bands)[3] == vectors.encode(y, bits, bands)[3]).any(1)
            assert met.mean() >= 0.98, (dim, n)


def test_links_with_the_bits_of_a_large_table(spark, monkeypatch):
    shape = vectors.shape
    monkeypatch.setattr(vectors, "shape", lambda n, threshold: shape(10**9, threshold))
    x, y = at_cosine(np.random.default_rng(8), 400, 64, 0.951)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate([*x, *y])], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in vectors.near_duplicates(df).collect()}
    assert set(got.values()) <= {0, 1} and sum(got.values()) >= 0.97 * 800


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(6)
    for dim in (48, 64, 130):
        x = rng.standard_normal((4000, dim))
        y = x + rng.standard_normal((4000, dim)) * 0.5
        x, y = (a / np.linalg.norm(a, axis=1)[:, None] for a in (x, y))
        codes, factors, planes, _ = vectors.encode(np.concatenate([x, y]), 16, 24)
        at = np.arange(4000)
        guess, bound = vectors.Estimates(dim, codes, factors, planes)(at, at + 4000)
        error = guess - (x * y).sum(1)
        assert abs(error.mean()) < 0.01 and (np.abs(error) <= bound).mean() > 0.999, dim
        assert bound.max() < 0.35


def test_an_estimate_costs_less_than_the_product():
    rng = np.random.default_rng(9)
    x = rng.standard_normal((1024, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    codes, factors, planes, _ = vectors.encode(x, 19, 33)
    guess = vectors.Estimates(64, codes, factors, planes)
    a, b = rng.integers(0, 1024, (2, 1 << 15))

    def best(run):
        times = []
        for _ in range(15):
            start = time.perf_counter()
            run()
            times.append(time.perf_counter() - start)
        return min(times)
    assert best(lambda: guess(a, b)) < best(lambda: (x[a] * x[b]).sum(1))


def test_odd_rows_and_empty_table(spark):
    v = [0.5, 0.25, -1.0]
    rows = [(1, v), (1, v), (2, None), (3, []), (4, [0.0, 0.0, 0.0]), (5, [1.0, None, 0.0]), (6, [float("nan"), 1.0, 0.0]),
            (7, [float("inf"), 1.0, 0.0]), (None, v), (8, [1.0, 0.5, -2.0]), (9, [0.5, 0.25]), (None, None)]
    df = spark.createDataFrame([(i, x, None, None, None) for i, x in rows], SCHEMA)
    got = vectors.near_duplicates(df).collect()
    assert len(got) == len(rows)
    by_id = {r.vec_id: r for r in got}
    assert (by_id[1].n_links, by_id[1].component_id) == (2, 1) and (by_id[8].n_links, by_id[8].component_id) == (2, 1)
    for i in (2, 3, 4, 5, 6, 7, 9):
        assert (by_id[i].n_links, by_id[i].component_id, by_id[i].kept) == (0, i, True)
    assert all(r.n_links == 0 and r.component_id is None for r in got if r.vec_id is None)
    assert vectors.near_duplicates(df.limit(0)).count() == 0
