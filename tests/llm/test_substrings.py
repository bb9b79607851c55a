import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from ticketmill.llm import substrings
from ticketmill.llm.shingles import Words


def brute(texts, window):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = True
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((len(w), int(gone.sum()), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def check(df, rows, window):
    got = substrings.without_repeats(df, window).collect()
    want = sorted((str(i), *x) for (i, _), x in zip(rows, brute([t for _, t in rows], window)))
    assert sorted((str(r.doc_id), r["_words"], r["_removed"], r["_digest"]) for r in got) == want
    text = dict(rows)
    for r in got:
        if r.doc_id is not None and r["_removed"] == 0:
            assert r.text == text[r.doc_id]
        elif r["_removed"]:
            assert hashlib.sha256(r.text.encode()).hexdigest() == r["_digest"]


def test_whole_table_against_brute_force(docs):
    check(docs, [(r.doc_id, r.text) for r in docs.collect()], substrings.WINDOW)


def test_small_windows_over_few_words(spark, monkeypatch):
    monkeypatch.setattr(substrings, "BLOCK", 400)
    rnd = random.Random(2)
    texts = [" ".join(rnd.choices("ab" if k % 2 else "abcde", k=rnd.randrange(60))) for k in range(60)]
    texts += ["a " * 50, "x y " * 20, "a " * 6, " ".join(map(str, range(200)))]
    rows = list(enumerate(texts))
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows, 7)


def test_names_rule_out_no_repeated_window():
    rnd = random.Random(3)
    for trial in range(60):
        letters = [str(i) for i in range(rnd.choice([1, 2, 3, 8, 40]))]
        texts = [" ".join(rnd.choices(letters, k=rnd.randrange(90))) for _ in range(12)]
        shared = " ".join(rnd.choices(letters, k=25))
        texts += [f"{t} {shared} {t}" for t in texts[:3]]
        window = rnd.choice([5, 9, 20])
        words = Words(pa.array(texts), False)
        hashes = words.hashes()
        names = substrings.symbols(hashes, words.first, window).name
        again = np.array(sorted(n for n, c in Counter(names.tolist()).items() if c > 1), np.uint64)
        open_at = substrings.candidates(hashes, words.first, window, again)
        parts = [t.split() for t in texts]
        seen = Counter(tuple(w[i:i + window]) for w in parts for i in range(len(w) - window + 1))
        for k, w in enumerate(parts):
            for i in range(len(w) - window + 1):
                if seen[tuple(w[i:i + window])] > 1:
                    assert open_at[words.first[k] + i]


def test_odd_rows_and_empty_table(odd, odd_rows, nothing):
    from ticketmill.llm.common import restored, with_rest
    needed = ["doc_id", "text"]
    rows = [r[:2] for r in odd_rows]
    check(with_rest(odd, needed), rows, 3)
    back = restored(substrings.without_repeats(with_rest(odd, needed), 3), odd.columns, needed)
    assert back.columns == odd.columns and back.count() == 11
    assert substrings.without_repeats(with_rest(nothing, needed)).count() == 0
