import numpy as np
import pytest

from ticketmill.llm import negatives
from ticketmill.llm.negatives import Tree

SCHEMA = "vec_id long, embedding array<double>, label int, rid string, `group` string, leaf int, k string"


def brute(rows, positives=5, count=5):
    """Sorted result rows for (id, vector, label)."""
    points, seen = [], set()
    for i, v, label in rows:
        if i is None or v is None or label is None or None in v or not np.isfinite(v).all():
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        whole = tuple(int(np.floor(256 * x)) for x in v)
        if (i, label, whole) not in seen:
            seen.add((i, label, whole))
            points.append((i, label, whole))
    out = []
    for a in points:
        if a[0] % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1]) for b in points if b != a and len(b[2]) == len(a[2]))
        for p in [s for s in scored if s[2] == a[1]][:positives]:
            fits = [s for s in scored if s[2] != a[1] and 80 * -p[0] <= 100 * -s[0] <= 100 * -p[0]][:count]
            out += [(a[0], p[1], r, s[1], -p[0], -s[0]) for r, s in enumerate(fits, 1)]
    return sorted(out)


def check(spark, rows):
    df = spark.createDataFrame([(*r, "a", "b", 1, "c") for r in rows], SCHEMA)
    got = sorted(tuple(r) for r in negatives.mine(negatives.relabelled(df)).collect())
    assert got == brute(rows)
    return got


def clustered(rng, n, dim=12, spread=0.3):
    centers = rng.standard_normal((10, dim))
    label = rng.integers(0, 10, n)
    x = centers[label] + spread * rng.standard_normal((n, dim))
    return [(int(i), (v / np.linalg.norm(v)).tolist(), int(c)) for i, (v, c) in enumerate(zip(x, label))]


def test_whole_table_against_brute_force(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    got = sorted(tuple(r) for r in negatives.mine(negatives.relabelled(table)).collect())
    assert got == brute([(r.vec_id, r.embedding, r.label) for r in table.collect()]) and got


@pytest.mark.parametrize("depth", [1, 3])
def test_deep_trees_small_blocks_and_copies(spark, monkeypatch, depth):
    """A tree of several levels, leaves cut into blocks, a third of all rows one vector, and chains
    of equal scores."""
    monkeypatch.setattr(negatives, "FAN", 4)
    monkeypatch.setattr(negatives, "LEAF", 40)
    monkeypatch.setattr(negatives, "DEPTH", depth)
    monkeypatch.setattr(negatives, "BLOCK", 30)
    monkeypatch.setattr(negatives, "BATCH", 3)
    rng = np.random.default_rng(3)
    rows = clustered(rng, 900)
    rows += [(2000 + i, rows[0][1], int(rng.integers(0, 10))) for i in range(450)]
    assert check(spark, rows)


def test_other_scales(spark, monkeypatch):
    monkeypatch.setattr(negatives, "LEAF", 30)
    rng = np.random.default_rng(5)
    rows = [(int(i), (v * rng.uniform(0.01, 20)).tolist(), int(rng.integers(0, 3))) for i, v in enumerate(rng.standard_normal((400, 3)))]
    assert check(spark, rows)


def test_ranges_hold_and_eliminate():
    rng = np.random.default_rng(6)
    x = np.floor(256 * np.array([v for _, v, _ in clustered(rng, 4000, 8, 0.1)]))
    tree = Tree(x[::4], 2)
    leaf = tree.leaves(x, True)
    a = x[:40]
    score = a @ x.T
    high = np.sort(score, 1)[:, -50:-49]
    low = high - 500.0
    got = {(int(r), n) for n, rows in tree.reached(a, low, high) for r in rows}
    need = {(int(r), int(leaf[c])) for r, c in zip(*np.nonzero((score >= low) & (score <= high)))}
    assert need <= got and len(got) < 0.6 * 40 * len(np.unique(leaf))


def test_odd_rows_and_empty_table(spark):
    v, nan, inf = [0.5, 0.25, -1.0], float("nan"), float("inf")
    rows = [(0, v, 1), (0, v, 1), (0, [0.5, 0.25, -0.5], 2), (None, v, 1), (1, None, 1), (2, v, None), (3, [0.5, None, 1.0], 2),
            (4, [nan, 0.0, 0.0], 2), (5, [inf, 0.0, 0.0], 2), (6, [], 1), (100, [], 1), (200, [0.5, 0.25], 1), (8, v, 2), (9, v, 2),
            (10, [0.5, 0.25, -0.9], 2), (11, [0.4, 0.25, -0.9], 2), (12, v, 2), (300, [-v for v in v], 2), (13, [0.0, 0.0, 0.0], 1),
            (14, [0.5, 0.25, -0.9], 1), (15, v, 1), (15, [0.5, 0.25, -0.9], 1), (400, [0.0, 0.0, 0.0], 3), (401, v, 3), (402, [], 2)]
    assert check(spark, rows)
    df = spark.createDataFrame([], SCHEMA)
    assert negatives.mine(negatives.relabelled(df)).collect() == []
    alone = spark.createDataFrame([(0, v, 1, "", "", 0, "")], SCHEMA)
    assert negatives.mine(negatives.relabelled(alone)).collect() == []
