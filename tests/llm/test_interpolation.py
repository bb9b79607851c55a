import math
import zlib
from collections import Counter

import numpy as np
import pytest

from ticketmill.llm import interpolation as lm


def tokens(text):
    return (text or "").encode().lower().split() + [None]


def part_of(doc_id):
    b = zlib.crc32(str(doc_id).encode() if doc_id is not None else b"") % 7
    return 0 if b == 2 else 2 if b == 3 else 1


def brute(rows, table):
    single, pair, context = Counter(), Counter(), Counter()
    for i, t in rows:
        if part_of(i):
            w = tokens(t)
            single.update(w)
            pair.update(zip([0, *w], w))
            context.update([0, *w[:-1]])
    n, v = sum(single.values()), len(single)
    out = []
    for i, t in rows:
        w = tokens(t)
        p = []
        for before, x in zip([0, *w], w):
            l2, l1, l0 = table[int(lm.bucket_of(np.array([context[before]]))[0])]
            p.append(l2 * pair[before, x] / max(1, context[before]) + l1 * single[x] / max(1, n) + l0 / (v + 1))
        out.append((str(i), part_of(i) == 0, len(w), sum(x in single for x in w), n,
                    sum(math.log10((single[x] + 1) / (n + v + 1)) for x in w), sum(map(math.log10, p))))
    return sorted(out)


def check(df, rows, monkeypatch):
    tables = []
    plain = lm.weight_table
    monkeypatch.setattr(lm, "weight_table", lambda w: tables.append(plain(w)) or tables[-1])
    got = sorted((str(r.doc_id), r.part == 0, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
                 for r in lm.held_out_scores(df).collect())
    assert np.allclose(tables[0].sum(1), 1)
    want = brute(rows, tables[0])
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)
    return got


def test_whole_table_against_brute_force(docs, monkeypatch):
    got = check(docs, [(r.doc_id, r.text) for r in docs.collect()], monkeypatch)
    held_out = [g for g in got if g[1]]
    assert sum(g[6] for g in held_out) > sum(g[5] for g in held_out)


def test_several_blocks(docs, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK", 1 << 14)
    check(docs, [(r.doc_id, r.text) for r in docs.collect()], monkeypatch)


def test_weights_reach_the_best_likelihood():
    rng = np.random.default_rng(1)
    cells = [(3, int(a), int(b), int(n)) for a, b, n in zip(rng.integers(-1, 60, 50), rng.integers(0, 60, 50), rng.integers(1, 99, 50))]
    w = lm.learn_weights(cells, 1000)[3]
    p = np.array([[2.0 ** (-a / lm.GRID) if a >= 0 else 0, 2.0 ** (-b / lm.GRID), 1 / 1001] for _, a, b, _ in cells])
    n = np.array([c[3] for c in cells])
    value = lambda w: n @ np.log(p @ w)
    for other in rng.dirichlet([1, 1, 1], 300):
        assert value(other) <= value(w) + 1e-3


def test_odd_rows_and_empty_table(odd, odd_rows, nothing, monkeypatch):
    check(odd, [r[:2] for r in odd_rows], monkeypatch)
    assert lm.held_out_scores(nothing).count() == 0
