import hashlib

from pyspark.sql import functions as F

from ticketmill.llm import fingerprints as fp


def order(rows):
    """Descending ids, null ids last; rows that repeat an id do not matter in their order here."""
    return sorted([r for r in rows if r[0] is not None], key=lambda r: -r[0]) + [r for r in rows if r[0] is None]


def shingles(text):
    w = text.split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def expected(rows):
    rows = order([(i, t or "") for i, t in rows])
    out = {}
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        cut = len(t) // 3
        out[i] = (len(t), t[:len(t) - cut] + following[:cut], following)
    return out


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_whole_table_against_brute_force(docs):
    rows = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    want = expected(list(rows.items()))
    got = fp.edited_fingerprints(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        n, edited, following = want[r.doc_id]
        assert r.n_chars == n
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        exact = max(len(shingles(rows[r.doc_id])), len(shingles(edited))) < fp.K // 2
        limit = 1e-12 if exact else 0.2
        assert abs(r.near_edited - jaccard(rows[r.doc_id], edited)) <= limit
        assert abs(r.near_next - jaccard(rows[r.doc_id], following)) <= limit
    by_text = {}
    for r in got:
        assert by_text.setdefault(rows[r.doc_id], r.fingerprint) == r.fingerprint


def test_next_document_over_sparse_ids(spark, monkeypatch):
    monkeypatch.setattr(fp, "_FAN", 4)
    ids = [-50, -3, 0, 1, 2, 3, 4, 5, 900, 901, 5000, 100_000, 1 << 40]
    df = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string")
    got = {r.doc_id: r.next_text for r in fp.with_following(df, ["text"], lambda d: d).collect()}
    down = sorted(ids, reverse=True)
    assert got == {i: f"text {down[(k + 1) % len(down)]}" for k, i in enumerate(down)}


def test_ranges_follow_the_order_of_the_rows(spark, monkeypatch):
    """Null, equal and far ids and equal rows are split like others."""
    monkeypatch.setattr(fp, "_FAN", 64)
    rows = [(None, f"no id {i}") for i in range(700)] + [(7, f"seven {i}") for i in range(700)]
    rows += [(9, "the same row")] * 700 + [(i, f"text {i}") for i in range(100, 800)] + [(1 << 60, "far"), (-(1 << 63), "low")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    seen = []

    def build(dealt):
        seen.append(max(r["count"] for r in dealt.groupBy("_part").count().collect()))
        return dealt
    got = fp.with_following(df, ["text"], build).collect()
    assert seen[0] <= 4 * 64
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted((i or 0, t) for i, t in rows)
    # One round through all rows: every text follows as often as it occurs.
    assert sorted(r.next_text for r in got) == sorted(t for _, t in rows)
    by_text = {r.text: r.next_text for r in got}
    assert by_text["far"] == "text 799" and by_text["text 100"] == "the same row" and by_text["low"].startswith("no id")
    assert [r.next_text for r in got if r.doc_id == 9].count("the same row") == 699


def test_sketches_merge_and_estimate(spark):
    texts = [" ".join(f"w{i}" for i in range(a, a + 400)) for a in (0, 100, 5000)]
    whole = [(0, texts[0] + " " + texts[2])] + [(1, t) for t in texts]
    df = fp.sketches(spark.createDataFrame(whole, "part int, text string"))
    merged = {r.part: r.sketch for r in fp.merge_groups(df, ["part"], "sketch").collect()}
    single = [r.sketch for r in df.where("part = 1").collect()]
    assert merged[1] == sorted(set(sum(single, [])))[:fp.K]
    pair = df.where("part = 1").select(F.collect_list("sketch").alias("s")).select(
        fp.resemblance(F.col("s")[0], F.col("s")[1]).alias("r"), fp.containment(F.col("s")[0], F.col("s")[1]).alias("c"),
        fp.distinct_shingles(F.col("s")[0]).alias("n")).first()
    assert abs(pair.r - 296 / 496) < 0.15 and abs(pair.c - 296 / 396) < 0.15 and abs(pair.n - 396) < 80


def test_odd_rows_and_empty_table(odd, nothing):
    got = fp.edited_fingerprints(odd).collect()
    assert len(got) == 11
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert {r.n_chars for r in got if r.doc_id in (2, 3)} == {0}
    six = [r for r in got if r.doc_id == 6]
    assert six[0].fingerprint == six[1].fingerprint
    assert fp.edited_fingerprints(nothing).count() == 0
