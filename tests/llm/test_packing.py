import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ticketmill.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def check(df, rows, tokenizer, **options):
    got = packing.pack(packing.pieces(df, PATH, True, 2), **options).collect()
    ids = [(i, tokenizer.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in rows]
    want = sorted((str(i), start, n, zlib.crc32(np.array(x[start:start + n], "<u4").tobytes()))
                  for i, x in ids for start, n in packing.cut(len(x), 1024))
    assert sorted((str(r.doc_id), r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    return len(sequences), -(-sum(len(x) for _, x in ids) // 1024)


def test_whole_table_round_trip(docs, tokenizer):
    bins, least = check(docs, [(r.doc_id, r.text) for r in docs.collect()], tokenizer)
    assert bins <= 1.02 * least + 1


def test_rounds_over_many_groups(docs, tokenizer):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    bins, least = check(docs, rows, tokenizer, group_size=16)
    assert bins <= 1.06 * least + 2


def test_pieces_only_first_is_short():
    assert packing.cut(2500, 1024) == [(0, 452), (452, 1024), (1476, 1024)]
    assert packing.cut(2048, 1024) == [(0, 1024), (1024, 1024)]
    assert packing.cut(7, 1024) == [(0, 7)]


def test_local_search_empties_bins():
    lengths = np.array([6, 6, 4, 4, 5, 5, 3, 7])
    bad = np.arange(len(lengths))  # a bin each
    better = packing.local_search(lengths, bad, 10)
    fill = np.bincount(better, weights=lengths)
    assert fill.max() <= 10 and (fill > 0).sum() == 4
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 1024, 600)
    start = packing.best_fit(lengths, 1024)
    after = packing.local_search(lengths, start, 1024)
    squares = lambda b: (np.bincount(b, weights=lengths) ** 2).sum()
    assert np.bincount(after, weights=lengths).max() <= 1024
    assert squares(after) >= squares(start) and len(set(after)) <= len(set(start))


def test_local_search_looks_again_at_bins_whose_partners_changed():
    lengths = np.array([10, 7, 12, 2, 6, 3])
    start = packing.best_fit(lengths, 20)
    after = packing.local_search(lengths, start, 20)
    assert len(set(start)) == 3 and len(set(after)) == 2
    assert np.bincount(after, weights=lengths).max() <= 20


def test_odd_rows_and_empty_table(odd, odd_rows, nothing, tokenizer):
    check(odd, [r[:2] for r in odd_rows], tokenizer)
    assert packing.pack(packing.pieces(nothing, PATH, True, 2)).count() == 0
