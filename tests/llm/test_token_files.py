import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from ticketmill.llm import token_files, tokens
from ticketmill.llm.common import shared_path

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def written(df, **options):
    folder = shared_path(df.sparkSession, "token-test")
    manifest = token_files.write(df, folder, PATH, False, 1, **options)
    return folder, manifest


def check(df, rows, tokenizer, **options):
    folder, manifest = written(df, **options)
    got = sorted(token_files.digests(df.sparkSession, folder).collect(), key=lambda r: r.start)
    ids = {}
    for i, t in rows:
        x = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        ids.setdefault(i, []).append((len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
    assert len(got) == len(rows)
    at = 0
    for r in got:
        assert r.start == at
        ids[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        at += r.n_tokens
    order = [r.doc_id for r in got]
    assert order == sorted(order, key=lambda i: (i is not None, i))
    return folder, manifest


def test_whole_table_round_trip(docs, tokenizer):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(docs, rows, tokenizer)
    folder, manifest = check(docs, rows, tokenizer, shard_bytes=60_000, id_bytes=4)
    assert manifest.count() > 3
    shard = manifest.orderBy("n_docs_before").first()
    ids, offsets, doc_ids = token_files.open_shard(f"{folder}/{shard['name']}")
    assert isinstance(ids, np.memmap) and ids.dtype == np.dtype("<u4") and len(offsets) == len(doc_ids) + 1
    text = dict(rows)[doc_ids[0]]
    assert ids[:offsets[1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [1]


def test_odd_rows_and_empty_table(odd, odd_rows, nothing, tokenizer):
    check(odd, [r[:2] for r in odd_rows], tokenizer)
    folder, manifest = written(nothing)
    assert manifest.count() == 0 and token_files.digests(nothing.sparkSession, folder).count() == 0


@pytest.mark.parametrize("name, keeps_space", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_pieces_give_the_ids_of_the_whole_text(name, keeps_space, monkeypatch):
    monkeypatch.setattr(tokens, "PIECES", 40)
    whole = Tokenizer.from_file(public_tokenizers.path(name))
    whole.encode_special_tokens = True
    own = tokens.PieceEncoder(public_tokenizers.path(name), keeps_space)

    @settings(max_examples=300, deadline=None)
    @given(st.text(alphabet=st.sampled_from(list(" \n\t\r aB1é'.,)²ªΣ日ß́ \x1c\x85")), max_size=30))
    def same(text):
        ids = np.frombuffer(own.encode(text, 7), "<u4").tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids + [7]
    same()


def test_ids_that_do_not_fit_are_refused(docs, spark, monkeypatch):
    monkeypatch.setattr(token_files, "largest_id", lambda path: 70_000)
    with pytest.raises(ValueError, match="70000"):
        written(docs)
    monkeypatch.setattr(token_files, "largest_id", lambda path: 65_535)
    written(docs.limit(3))
    with pytest.raises(ValueError, match="65536"):
        token_files.write(docs, shared_path(spark, "token-test"), PATH, False, 1 << 16)
    assert token_files.write(docs.limit(3), shared_path(spark, "token-test"), PATH, False, 1 << 16, 4).count() == 1


def test_paths_mean_what_they_mean_to_spark(spark, tmp_path):
    plain = token_files.qualified(spark, str(tmp_path))
    assert plain == token_files.qualified(spark, f"file:{tmp_path}") and plain.startswith("file:/")
    for path in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}"):
        assert token_files._file_system(path)[1] == str(tmp_path)
