import zlib
from itertools import product

import numpy as np
import pyarrow as pa

from ticketmill.llm import toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def best(terms, word):
    out = None
    for n, (term, _) in enumerate(terms):
        text = term.rstrip("*")
        heads = [word[:k] for k in range(len(word) + 1)] if term.endswith("*") else [word]
        e = min(distance(text, h) for h in heads)
        if e <= toxicity.Lexicon.errors_of(term):
            out = min(out or (99, 0), (e, n))
    return out


def test_automaton_against_edit_distance():
    terms = [(t, 1.0) for t in ("abab", "abba", "baabab", "aabbaabba", "abb*", "babaab*")]
    lexicon = toxicity.Lexicon(terms)
    for n in range(0, 8):
        for word in map("".join, product("abc" if n < 6 else "ab", repeat=n)):
            want, got = best(terms, word), lexicon.match(word)
            assert (want is None) == (got is None) and (want is None or want[0] == got[0]), word
    rng = np.random.default_rng(1)
    for n in range(8, 13):
        for _ in range(300):
            word = "".join(rng.choice(list("ab"), n))
            want, got = best(terms, word), lexicon.match(word)
            assert (want is None) == (got is None) and (want is None or want[0] == got[0]), word


def test_context_and_lookalikes():
    own = toxicity.Reader([("idiot", 5.0), ("worthless", 5.0)])
    plain = own.features("you are an 1d10t and w0rthles, you hear")
    quoted = own.features('they said "idiot" was the word')
    assert plain[0] == quoted[0] == 1 and plain[8] > quoted[8]
    assert plain[2] > 0 or plain[1] > 0
    assert quoted[3] > 0 and quoted[4] > 0 and quoted[7] < plain[7]
    assert not own.features("ideas and words of riots").any()


def test_only_copies_count_once(spark):
    rng = np.random.default_rng(2)
    common = [f"common{chr(97 + k)}" for k in range(26)]
    texts = [" ".join(rng.permutation(common)) + f" own{chr(97 + k)}" for k in range(12)]  # no copies, nearly the same words
    rows = [(i, t, 1) for i, t in enumerate([*texts, texts[0], texts[0].upper(), None, ""])]
    sample = toxicity.with_groups(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    of = {r.doc_id: r.of for r in sample.collect()}
    assert len(of) == len(rows) and len(set(of.values())) == 13
    assert of[12] == of[13] == of[0] and of[14] == of[15]
    counts = {r.term: r.n for r in toxicity._counts(sample, None).collect()}
    assert counts["commona"] == 12 and counts["owna"] == 1


def test_copies_and_repeated_ids_do_not_weigh_more(spark, monkeypatch):
    words = [chr(97 + i // 26) + chr(97 + i % 26) + "tterly" for i in range(120)]
    rows = [(i, f"{w} plain{w} idiot{'s' * (i % 2)} text of {w} and {w}") for i, w in enumerate(words[:40])]
    rows += [(100 + i, f"{w} plain{w} calm text of {w} and {w}") for i, w in enumerate(words[40:])]
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in rows] + [(i, 1) for i in range(500, 540)], "doc_id long, toxic int")
    more = rows + [rows[60]] * 300 + [(500 + k, rows[0][1]) for k in range(40)]
    seen = []
    monkeypatch.setattr(toxicity, "fit_weights", lambda x, y, fit=toxicity.fit_weights: (seen.append(len(x)), fit(x, y))[1])
    models = [toxicity.train(spark.createDataFrame(r, "doc_id long, text string"), labels) for r in (rows, more)]
    # Text 0 may lie in the held-out part; its copies under other ids are one text more then.
    assert seen[0] <= seen[1] <= seen[0] + 1
    if seen[0] == seen[1]:
        assert models[0].terms == models[1].terms and np.allclose(models[0].weights, models[1].weights)


def test_few_states_give_the_same_matches(monkeypatch):
    terms = [(t, 1.0) for t in ("abab", "abba", "baabab", "aabbaabba", "abb*")]
    words = ["".join(w) for n in range(8) for w in product("abc", repeat=n)][::7]
    want = [toxicity.Lexicon(terms).match(w) for w in words]
    monkeypatch.setattr(toxicity, "KNOWN_STATES", 5)
    small = toxicity.Lexicon(terms)
    assert [small.match(w) for w in words] == want and len(small.states) < 40


def test_rare_terms_stay_however_many_labels(spark):
    words = [chr(97 + i // 26) + chr(97 + i % 26) + "tterly" for i in range(600)]
    rows = [(f"{words[i]} {words[i - 1]} {words[i - 2]}", 1, i) for i in range(600)]
    rows += [("plain text", 0, 1000 + i) for i in range(1200)]
    terms = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int, of long"))
    assert {t for t, _ in terms} == set(words)


def held_out_accuracy(spark, folder):
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    got = toxicity.scores(docs, labels).collect()
    assert len(got) == docs.count()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    judged = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    right = sum(p == t for p, t in judged) / len(judged)
    found = sum(p and t for p, t in judged) / max(1, sum(t for _, t in judged))
    return right, found


def test_held_out_accuracy(spark):
    right, found = held_out_accuracy(spark, "/root/testdata/sf0.01")
    assert right > 0.9 and found > 0.6


def test_odd_rows_and_tables_without_labels(spark, odd, nothing):
    none = spark.createDataFrame([], "doc_id long, toxic int, extra string")
    one = spark.createDataFrame([(1, 0, ""), (7, 1, None), (None, 1, ""), (5, None, ""), (1, 1, "")], none.schema)
    for labels in (none, one):
        got = toxicity.scores(odd, labels).collect()
        assert len(got) == 11 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.scores(nothing, one).count() == 0


def test_terms_of_a_batch_go_on_in_pieces(monkeypatch):
    """What a task holds follows the pairs of one piece, not the texts that happen to share a batch."""
    rng = np.random.default_rng(5)
    texts = [" ".join("".join(rng.choice(list("abcdefgh"), 9)) for _ in range(40)) for _ in range(60)]
    batch = pa.RecordBatch.from_pydict({"text": [*texts, None], "of": [*range(60), -1]})
    want = {(t, n) for n, text in enumerate(texts) for t in toxicity._terms_of(set(text.split()))}
    monkeypatch.setattr(toxicity, "PAIRS", 500)
    pieces = list(toxicity._terms(None)(iter([batch])))
    assert max(p.num_rows for p in pieces) < 500 + 40 * 10
    got = [pair for p in pieces for pair in zip(p.column("term").to_pylist(), p.column("of").to_pylist())]
    assert set(got) == want and len(got) == len(want)


def test_states_and_words_are_bounded_by_their_size(monkeypatch):
    words = ["".join(w) for n in range(1, 7) for w in product("abc", repeat=n)]
    whole = toxicity.Lexicon([("abab", 1.0), ("aabbaabba", 1.0), ("babaab*", 1.0)])
    want = [whole.match(w) for w in words]
    monkeypatch.setattr(toxicity, "KNOWN_NODES", 50)
    small = toxicity.Lexicon([("abab", 1.0), ("aabbaabba", 1.0), ("babaab*", 1.0)])
    assert [small.match(w) for w in words] == want
    assert small.n_nodes < whole.n_nodes and len(small.states) < len(whole.states)
    monkeypatch.setattr(toxicity, "KNOWN_LETTERS", 1000)
    own = toxicity.Reader([("idiot", 5.0)])
    for n in range(50):
        own.features(f"{n}" * 400)
    assert sum(map(len, own.known)) < 3000
