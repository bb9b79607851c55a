"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

from . import decontamination, licenses, manifest, minhash, substrings

_SPACE = r"[\x20\x09-\x0D]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Every node's smallest reachable one, from a table link(a, b) with both directions.
_REACH = """
reach AS (SELECT a AS node, b AS other FROM link
          UNION SELECT reach.node, link.b FROM reach JOIN link ON link.a = reach.other),
least AS (SELECT node, min(other) AS low FROM reach GROUP BY node)"""


def vector_links(threshold: float) -> str:
    return f"""
WITH RECURSIVE usable AS (
    SELECT vec_id, row_number() OVER () AS n, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y
    ON x.n <> y.n AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= {threshold}),
{_REACH}
SELECT v.vec_id, coalesce(n.links, 0) AS n_links, least(v.vec_id, coalesce(least.low, v.vec_id)) AS component_id,
       v.vec_id = least(v.vec_id, coalesce(least.low, v.vec_id)) AS kept
FROM embeddings v LEFT JOIN (SELECT a, count(*) AS links FROM link GROUP BY a) n ON n.a = v.vec_id
LEFT JOIN least ON least.node = v.vec_id"""


def without_repeats(window: int) -> str:
    return f"""
WITH words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}'), lambda x: x <> '') AS w FROM documents),
starts AS (
    SELECT doc_id, pos, array_to_string(w[pos:pos + {window - 1}], ' ') AS run
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - {window - 2})) AS pos FROM words WHERE len(w) >= {window})),
again AS (SELECT run FROM starts GROUP BY run HAVING count(*) > 1),
gone AS (
    SELECT doc_id, list_sort(list_distinct(flatten(list(range(pos, pos + {window}))))) AS g
    FROM starts SEMI JOIN again USING (run) GROUP BY doc_id),
joined AS (
    SELECT doc_id, w, g, CASE WHEN g IS NULL THEN w ELSE list_transform(list_filter(
        list_zip(w, range(1, len(w) + 1)), lambda p: NOT list_contains(g, p[2])), lambda p: p[1]) END AS kept
    FROM words LEFT JOIN gone USING (doc_id))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - len(kept) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256
FROM joined"""


def near_duplicates(width: int, percent: int) -> str:
    return f"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '{_SPACE}'), lambda x: x <> '') AS w FROM documents),
shingle AS (
    SELECT DISTINCT doc_id, array_to_string(w[pos:pos + {width - 1}], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {width - 2}, 2))) AS pos FROM words WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
pair AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingle x JOIN shingle y
    ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
link AS (
    SELECT pair.a, pair.b FROM pair JOIN size p ON p.doc_id = pair.a JOIN size q ON q.doc_id = pair.b
    WHERE 100 * pair.n >= {percent} * (p.n + q.n - pair.n)),
{_REACH}
SELECT d.doc_id, coalesce(size.n, 0) AS n_shingles, least(d.doc_id, coalesce(least.low, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(least.low, d.doc_id)) AS kept
FROM documents d LEFT JOIN size ON size.doc_id = d.doc_id LEFT JOIN least ON least.node = d.doc_id"""


def license_scan(threshold: float) -> str:
    def listed(words):
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"
    templates = ", ".join(f"({n}, '{label}', {listed(words)}, {scale}, {variant})" for n, label, words, scale, variant in licenses.template_words())
    scales = ", ".join(f"({s})" for s in licenses.SCALES)
    starts = []
    for phrase in licenses.PHRASES:
        parts = phrase.split()
        test = " AND ".join(f"w[i + {k}] = '{p}'" for k, p in enumerate(parts))
        starts.append(f"list_filter(range(1, len(w) + 1), lambda i: coalesce({test}, false))")
    labels = " UNION ALL ".join(
        f"SELECT n, '{label}' AS label FROM placed WHERE len(at{k}) > 0" for k, label in enumerate(licenses.PHRASES.values()))
    every = " || ".join(f"at{k}" for k in range(len(starts)))
    found = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH source AS (SELECT row_number() OVER () AS n, doc_id, {_LOWER} AS t FROM documents),
words AS (SELECT n, doc_id, {found.format('t')} AS w FROM source),
placed AS (SELECT n, doc_id, w, {', '.join(f'{s} AS at{k}' for k, s in enumerate(starts))} FROM words),
template (number, label, need, scale, variant) AS (VALUES {templates}),
block AS (
    SELECT n, scale, b, list_distinct(w[b * scale + 1:(b + 2) * scale]) AS have
    FROM (SELECT n, w, scale, unnest(range(0, (len(w) + scale - 1) // scale)) AS b FROM words, (VALUES {scales}) AS v(scale))),
fits AS (
    SELECT block.n, block.scale, block.b, template.number, template.variant, template.label,
           len(list_intersect(block.have, template.need)) AS common, len(template.need) AS whole
    FROM block JOIN template ON template.scale = block.scale AND list_has_any(block.have, template.need)
    WHERE len(list_intersect(block.have, template.need)) >= {threshold} * len(template.need) - 1e-9),
celled AS (
    SELECT *, rank() OVER (PARTITION BY n, variant, cell ORDER BY common / whole DESC, common DESC) AS place
    FROM (SELECT *, unnest(range(b * scale // {licenses.CELL}, (b + 2) * scale // {licenses.CELL})) AS cell FROM fits)),
best AS (SELECT n, label, max(common / whole) AS share FROM celled GROUP BY n, scale, b, number, label HAVING max(place) = 1),
base AS ({labels}),
named AS (SELECT n, label FROM base UNION SELECT n, label FROM best)
SELECT p.doc_id, CAST(len(p.w) AS BIGINT) AS n_words, CAST(len({every}) AS BIGINT) AS n_base,
       CAST(list_min({every}) - 1 AS BIGINT) AS first_word, CAST(list_max({every}) - 1 AS BIGINT) AS last_word,
       coalesce((SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM base WHERE base.n = p.n), '') AS base_labels,
       coalesce((SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM named WHERE named.n = p.n), '') AS labels,
       CASE WHEN len({every}) > 0 THEN 1.0::DOUBLE
            ELSE coalesce((SELECT max(share) FROM best WHERE best.n = p.n), 0.0)::DOUBLE END AS score
FROM placed p"""


def contamination(width: int) -> str:
    found = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_LOWER)
    return f"""
WITH items AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {found} AS w FROM benchmark),
phrase AS (
    SELECT DISTINCT item, least(len(w), {width}) AS size, array_to_string(w[pos:pos + least(len(w), {width}) - 1], ' ') AS run
    FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {width - 2}, 2))) AS pos FROM items WHERE len(w) > 0)),
words AS (SELECT row_number() OVER () AS row, doc_id, {found} AS w FROM documents),
place AS (
    SELECT row, size, pos, array_to_string(w[pos:pos + size - 1], ' ') AS run
    FROM (SELECT row, w, size, unnest(range(1, len(w) - size + 2)) AS pos
          FROM words JOIN (SELECT DISTINCT size FROM phrase) ON len(w) >= size)),
hit AS (SELECT row, place.size, pos, item FROM place JOIN phrase ON phrase.run = place.run AND phrase.size = place.size),
covered AS (SELECT row, count(DISTINCT word) AS n FROM (SELECT row, unnest(range(pos, pos + size)) AS word FROM hit) GROUP BY row),
named AS (SELECT row, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT row, item FROM hit) GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(covered.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(covered.n, 0) > 0 AS contaminated
FROM words LEFT JOIN covered ON covered.row = words.row LEFT JOIN named ON named.row = words.row"""


def merkle_manifest(fan: int) -> str:
    def digest(text):
        values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
        return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    # crc32 of the decimal digits, bit by bit.
    crc = """xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
        lambda acc, b: list_reduce(range(8), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)), xor(acc, b)),
        CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))"""
    siblings = "coalesce(string_agg({0}.hash, '' ORDER BY {0}.pos) FILTER ({0}.pos {1} {2}.pos), '')"

    def tree(name, start):
        """Nodes (level, grp, pos, hash) of every level, and of each the number of its level's nodes."""
        return f"""
{name} AS (
    SELECT 0 AS level, grp, pos, hash, n FROM {start}
    UNION ALL
    SELECT any_value(level) + 1, grp, pos // {fan}, sha256(string_agg(hash, '' ORDER BY pos)), (any_value(n) + {fan - 1}) // {fan}
    FROM {name} WHERE n > 1 GROUP BY grp, pos // {fan})"""

    def sides(name, out):
        """Of every node below the top its siblings before and after it."""
        return f"""
{out} AS (
    SELECT x.level, x.grp, x.pos, {siblings.format('y', '<', 'x')} AS before, {siblings.format('y', '>', 'x')} AS behind
    FROM {name} x JOIN {name} y ON y.level = x.level AND y.grp = x.grp AND y.pos // {fan} = x.pos // {fan}
    WHERE x.n > 1 GROUP BY x.level, x.grp, x.pos)"""

    def climb(name, start, below, nodes, top):
        """Proof texts and digests carried from level to level up to the top."""
        return f"""
{name} AS (
    SELECT *, 0 AS level, pos AS here FROM {start}
    UNION ALL
    SELECT c.* REPLACE (c.proof || s.before || s.behind AS proof, sha256(s.before || c.folded || s.behind) AS folded,
                        c.level + 1 AS level, c.here // {fan} AS here)
    FROM {name} c JOIN {below} s ON s.level = c.level AND s.grp = c.grp AND s.pos = c.here),
{top} AS (
    SELECT c.*, n.hash AS top FROM {name} c JOIN {nodes} n ON n.level = c.level AND n.grp = c.grp AND n.pos = c.here AND n.n = 1)"""
    return f"""
WITH RECURSIVE leaf AS (
    SELECT row_number() OVER () AS row, doc_id, source AS src, coalesce('=' || source, '') AS grp, {digest('text')} AS hash,
           {digest(f"CASE WHEN crc % 5 = 0 THEN {lower} ELSE text END")} AS other
    FROM (SELECT *, {crc} AS crc FROM documents)),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, hash) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n
    FROM leaf),
{tree('node', 'placed')},
subroot AS (SELECT grp AS name, hash FROM node WHERE n = 1),
ordered AS (
    SELECT '' AS grp, name, hash, row_number() OVER (ORDER BY encode(name)) - 1 AS pos, count(*) OVER () AS n FROM subroot),
{tree('high', 'ordered')},
{sides('node', 'side')},
{sides('high', 'upside')},
begun AS (SELECT doc_id, grp, pos, hash AS leaf, other AS folded, '' AS proof FROM placed),
{climb('way', 'begun', 'side', 'node', 'low')},
risen AS (
    SELECT l.doc_id, l.leaf, l.top AS subroot, l.folded, l.proof, '' AS grp, o.pos FROM low l JOIN ordered o ON o.name = l.grp),
{climb('upway', 'risen', 'upside', 'high', 'done')}
SELECT doc_id, leaf, subroot, top AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = top AS verified FROM done"""


def hard_negatives(positives: int, negatives: int, percent: int) -> str:
    return f"""
WITH point AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
numbered AS (SELECT row_number() OVER () AS n, * FROM point),
scored AS (
    SELECT a.n AS anchor, a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
           CASE WHEN len(a.v) > 0 THEN CAST(list_inner_product(a.v, b.v) AS BIGINT) ELSE 0 END AS score
    FROM numbered a JOIN numbered b ON a.n <> b.n AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
kin AS (
    SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) AS k FROM scored WHERE same
    QUALIFY k <= {positives}),
pair AS (
    SELECT kin.anchor_id, kin.other AS positive_id, s.other AS negative_id, kin.score AS positive_score, s.score AS negative_score,
           row_number() OVER (PARTITION BY kin.anchor, kin.k ORDER BY s.score DESC, s.other) AS rank
    FROM kin JOIN scored s ON s.anchor = kin.anchor AND NOT s.same
    WHERE {percent} * kin.score <= 100 * s.score AND s.score <= kin.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM pair WHERE rank <= {negatives}"""


ORACLES = {
    "op6_license_scan": license_scan(licenses.THRESHOLD),
    "op8_vector_near_duplicates": vector_links(0.95),
    "op9_substring_dedup": without_repeats(substrings.WINDOW),
    "op10_minhash_near_duplicates": near_duplicates(minhash.SHINGLE, 75),
    "op11_benchmark_decontamination": contamination(decontamination.WIDTH),
    "op12_merkle_manifest": merkle_manifest(manifest.FAN),
    "op13_hard_negatives": hard_negatives(5, 5, 80),
}
