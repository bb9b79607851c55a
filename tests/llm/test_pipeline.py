import hashlib
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from conftest import DATA
from test_minhash import brute as near_groups
from test_mixing import targets
from ticketmill.llm import mixing, toxicity

FOLDER = DATA


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Input and output rows of every stage, written and read between them."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = (docs, after)
        docs = after
    return out


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_columns_stay_until_the_last_stage(spark, steps):
    columns = spark.read.parquet(f"{FOLDER}/documents.parquet").columns
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert steps[name][1].columns == columns


def test_rejected_texts_go(spark, steps):
    before, after = steps["toxicity"]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    scored = {r.doc_id: r.score for r in toxicity.scores(before, labels).collect()}
    assert rows(after) == Counter({k: n for k, n in rows(before).items() if scored[k[0]] < 0.5})


def test_one_of_each_group_stays(steps):
    before, after = steps["minhash_near_dedup"]
    groups = near_groups([(r.doc_id, r.text) for r in before.collect()])
    assert rows(after) == Counter({k: n for k, n in rows(before).items() if groups[k[0]][1] == k[0]})


def test_repeated_and_null_id_copies_leave_one_whole_text(spark):
    a, b, c, d = (" ".join(f"{k}{i}" for i in range(60)) for k in "abcd")
    near = b + " more"
    rows = [(1, a, "x"), (1, a, "x"), (None, a, "x"), (None, b, "x"), (7, near, "x"), (None, c, "x"), (None, c, "y"),
            (4, d, "x"), (4, d, "y"), (5, "", "x"), (5, "", "x"), (None, None, "x")]
    docs = spark.createDataFrame([(i, t, s, len(t or "")) for i, t, s in rows], "doc_id long, text string, source string, n_chars long")
    once = corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER)
    want = [(1, a), (7, near), (None, c), (4, d), (5, ""), (5, ""), (None, None)]
    assert Counter((r.doc_id, r.text) for r in once.collect()) == Counter(want)
    cleaned = corpus_pipeline.drop_repeated_passages(spark, once, FOLDER)
    assert Counter((r.doc_id, r.text or "") for r in cleaned.collect()) == Counter((i, t or "") for i, t in want)


def test_repeated_passages_go(steps):
    before, after = steps["substring_dedup"]
    from test_substrings import brute
    old = before.orderBy("doc_id").collect()
    new = {r.doc_id: r for r in after.collect()}
    for r, (n, removed, digest) in zip(old, brute([r.text for r in old], 35)):
        text = new[r.doc_id].text
        assert text == r.text if not removed else hashlib.sha256(text.encode()).hexdigest() == digest
        assert new[r.doc_id].n_chars == len(text) and new[r.doc_id].source == r.source


def test_sources_reach_their_targets(steps):
    before, after = steps["source_mixing"]
    size = {r.doc_id: len((r.text or "").encode().split()) for r in before.collect()}
    sums, have, longest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in before.collect():
        sums[r.source] += size[r.doc_id]
        longest[r.source] = max(longest[r.source], size[r.doc_id])
    for r in after.collect():
        have[r.source] += size[r.doc_id]
    for s, t in targets(sums).items():
        assert t - 1 <= have[s] <= t + longest[s] + 1
    assert set(rows(after)) <= set(rows(before)) and max(rows(after).values()) <= mixing.MAX_PASSES


def test_pieces_are_packed(steps):
    before, after = steps["best_fit_packing"]
    packed = after.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("e"))
    assert packed.where("n > 1024 or n != e").count() == 0
    assert after.where("start = 0").count() == before.count()


def test_run_gives_the_last_stage(spark, steps):
    final = steps["best_fit_packing"][1]
    assert corpus_pipeline.run(spark, FOLDER).count() == final.count()


def test_stages_on_odd_and_empty_tables(spark, odd, nothing, tmp_path):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, nothing):
            after = stage(spark, docs, FOLDER)
            if name != "best_fit_packing":
                assert after.columns == odd.columns
            assert (after.count() == 0) == (docs is nothing)
