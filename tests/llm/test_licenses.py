import re

from ticketmill.llm import licenses

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(text):
    text = lower(text or "")
    w = WORDS.findall(text)
    at = {p: [i for i in range(len(w)) if w[i:i + len(p.split())] == p.split()] for p in licenses.PHRASES}
    every = sorted(sum(at.values(), []))
    base = sorted({licenses.PHRASES[p] for p in at if at[p]})
    labels, score = set(base), 1.0 if every else 0.0
    fits, best = [], {}
    for _, label, words, scale, variant in licenses.template_words():
        for start in range(0, len(w), scale):
            common = len({*w[start:start + 2 * scale]} & {*words})
            if common >= licenses.THRESHOLD * len(words) - 1e-9:
                cells = [(variant, c) for c in range(start // 8, (start + 2 * scale) // 8)]
                fits.append((common / len(words), common, label, cells))
                for c in cells:
                    best[c] = max(best.get(c, (0, 0)), (common / len(words), common))
    for share, common, label, cells in fits:
        if all(best[c] == (share, common) for c in cells):
            labels.add(label)
            score = max(score, share)
    return (len(w), len(every), every[0] if every else None, every[-1] if every else None, base, sorted(labels), score)


def check(df, rows):
    got = licenses.scan(df).collect()
    key = lambda r: tuple(str(x) for x in r)
    have = sorted([(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base, r.labels, r.score) for r in got], key=key)
    assert have == sorted([(i, *brute(t)) for i, t in rows], key=key)


def test_whole_table_against_brute_force(docs):
    check(docs, [(r.doc_id, r.text) for r in docs.collect()])


def test_statements_with_changes(spark):
    texts = ["x y\nThis work is LICENSED under GNU General Public License version 3 or later\nz",
             "cc by cc by", "All rights reserved. all RIGHTS reserved", "Released under the MIT licence.",
             "released under some license", "Licensed under CC BY-NC 4.0.", "All rights\nreserved",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of the software.",
             "the the the of of", "CC-BY;General  public-license",
             # Statements over several lines, in a comment, far into a text, and across the edges of blocks.
             "Redistribution and use in source and binary forms, with or without\nmodification, are permitted.",
             "x " * 29 + "/*\n * Redistribution and use in source and\n * binary forms, with or without\n * modification, are permitted.\n */" + " y" * 40,
             "z " * 1003 + "Released under\nthe MIT\nLicense." + " z" * 900, "Released under " + "x " * 40 + "the MIT License",
             "a b c\n" + licenses.NOTICES["mit"] + "\nd e f", "q " * 300 + licenses.NOTICES["gpl"].replace("\n", "\n# "),
             "\n".join(licenses.NOTICES["apache-2.0"].split()), " ".join(licenses.NOTICES.values())]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(df, rows)
    labels = {r.doc_id: r.labels for r in licenses.scan(df).collect()}
    assert "gpl" in labels[0] and "mit" in labels[7] and labels[8] == []
    assert labels[10] == labels[11] == ["bsd"] and "mit" in labels[12] and "mit" not in labels[13]
    assert labels[14] == ["mit"] and labels[15] == ["gpl"] and labels[16] == ["apache-2.0"]
    assert {*licenses.NOTICES} <= {*labels[17]}


def test_every_template_is_found_wherever_it_begins(spark):
    rows = []
    for label in {*licenses.TEMPLATES, *licenses.NOTICES}:
        for text in [*licenses.TEMPLATES.get(label, []), licenses.NOTICES.get(label, "")]:
            rows += [(label, "w " * k + text.replace(" ", "\n") + " w" * 9) for k in (0, 5, 8, 31, 250, 509) if text]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    labels = {r.doc_id: r.labels for r in licenses.scan(df).collect()}
    assert all(label in labels[i] for i, (label, _) in enumerate(rows))


def test_odd_rows_and_empty_table(odd, odd_rows, nothing):
    check(odd, [r[:2] for r in odd_rows])
    assert licenses.scan(nothing).count() == 0
