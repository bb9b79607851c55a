import hashlib
import random
import zlib
from itertools import groupby

from ticketmill.llm import manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, g string, n int, `at` int, hash string, own string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves):
    """Root and, for every leaf, its proof as (left, right) from the leaf up."""
    proofs, at, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for p, i in zip(proofs, at):
            first = i // 16 * 16
            p.append(("".join(nodes[first:i]), "".join(nodes[i + 1:first + 16])))
        nodes, at = [digest(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)], [i // 16 for i in at]
    return nodes[0], proofs


def folded(start, proof):
    for left, right in proof:
        start = digest(left, start, right)
    return start


def brute(rows):
    leaf = {r: digest(*map(field, (r[0], r[1], r[2], r[3], r[4]))) for r in rows}
    key = lambda r: (r[1] is not None, (r[1] or "").encode())
    whole = sorted(rows, key=lambda r: (key(r), r[0] is not None, r[0] or 0, leaf[r]))
    groups = [list(rows) for _, rows in groupby(whole, key)]
    trees = [tree([leaf[r] for r in g]) for g in groups]
    root, upper = tree([t[0] for t in trees])
    out = []
    for g, (subroot, proofs), above in zip(groups, trees, upper):
        for r, p in zip(g, proofs):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            text = r[4] and "".join(c.lower() if c.isascii() else c for c in r[4])
            start = digest(*map(field, (r[0], r[1], r[2], r[3], text))) if hit else leaf[r]
            end = folded(start, p + above)
            out.append((r[0], leaf[r], subroot, root, digest(*[x for s in p + above for x in s]), end, end == root))
    return sorted(out, key=str)


def check(spark, rows):
    df = spark.createDataFrame([(*r, "a", 1, 2, "b", "c") for r in rows], SCHEMA)
    got = sorted((tuple(r) for r in manifest.tampering_found(df).collect()), key=str)
    assert got == brute(rows)
    return got


def test_whole_table_against_brute_force(docs):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    assert sorted((tuple(r) for r in manifest.tampering_found(docs).collect()), key=str) == brute(rows)


def test_group_sizes_around_every_level(spark):
    sizes = {"a": 1, "b": 2, "c": 16, "d": 17, "e": 255, "f": 256, "g": 257, "h": 600, "é": 16, "Z": 15, None: 3, "": 2}
    rnd = random.Random(12)
    ids = iter(rnd.sample(range(10**6), 2000))
    rows = [(next(ids), s, "en", 5, f"Text {k}") for s, n in sizes.items() for k in range(n)]
    rnd.shuffle(rows)
    got = check(spark, rows)
    assert {r[-1] for r in got} == {True, False}


def test_blocks_of_blocks(spark):
    """A group of several thousand rows and more groups than a block holds."""
    rows = [(i, "hot", "en", 1, f"T{i}") for i in range(5000)] + [(10_000 + i, f"s{i}", None, None, None) for i in range(300)]
    check(spark, rows)


def test_one_row_and_one_group(spark):
    check(spark, [(5, None, None, None, "A")])
    check(spark, [(i, "only", "de", 3, "Äb C") for i in range(20)])


def test_nulls_repeated_rows_and_long_texts(spark):
    rows = [(1, "a", None, 1, None), (1, "a", None, 1, "x"), (None, "a", "en", None, ""), (None, None, None, None, None),
            (2, "b", "en", 9, "Word " * 50_000), (3, "b", "en", 2, "日本 ÀB"), (-7, "b", "en", 2, "b")]
    check(spark, rows)
    # Rows that are equal in all fields each keep a row of the result.
    df = spark.createDataFrame([(4, "a", "en", 1, "Same", "", 0, 0, "", "")] * 40, SCHEMA)
    got = manifest.tampering_found(df).collect()
    assert len(got) == 40 and len({(r.leaf, r.subroot, r.root) for r in got}) == 1
    assert got[0].root == tree([digest("1:4", "1:a", "2:en", "1:1", "4:Same")] * 40)[0]


def test_proofs_are_checked_alone(docs):
    """What a reader does who has one document, its proof and the root."""
    text = {r.doc_id: r for r in docs.collect()}
    for r in manifest.manifest(docs).collect():
        d = text[r.doc_id]
        leaf = digest(*map(field, (d.doc_id, d.source, d.lang, d.n_chars, d.text)))
        assert leaf == r.leaf and folded(leaf, r.proof) == r.root


def test_empty_table(spark):
    assert manifest.tampering_found(spark.createDataFrame([], SCHEMA)).collect() == []
