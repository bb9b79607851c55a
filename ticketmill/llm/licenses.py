"""License scans: which license statements a text holds.

Fixed phrases are counted by place. Templates are found by an exact set-similarity join between them
and blocks of words, whatever the lines: for each of the SCALES s, blocks of 2 s words begin at every s-th word of
the text, and a template of up to s words (and more than the scale before) is sought in the blocks of its
scale, so that a statement stands whole in one of them wherever it begins and however it is wrapped. A block
matches a template when it has at least THRESHOLD of the template's words. Words are ordered by how many
documents have them, rarest first. A block that matches must share a word of the template's prefix, its
first size - need + 1 words; it must have `need` of the template's words; and after a first common word
at places i and j at most 1 + min(words left of the template, words left of the block) can be common. What
passes these filters is verified on the whole sets. Templates that share half of the larger one's words, and
what such pairs connect, are variants: where blocks of several variants cover the same cell of CELL words,
only the best match there names the text.

Only DataFrame functions are used; texts are never shuffled, and only blocks around a word of some
prefix are formed. The templates are a fixed table, so its index is broadcast.

Defined cases. A null text is empty; null doc_ids are ordinary. Empty texts have no words, places or labels. A very
long text is one row, of which blocks of at most 2 * 256 words go on. Repeated rows, also of one id with different
texts, each have a result of their own; an empty table gives an empty one; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import lower_ascii, stored

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.8
SCALES = (8, 32, 256)
CELL = 8

# Phrases whose places are counted, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Statements as they are commonly written, by label.
TEMPLATES = {
    "agpl": ["This program is licensed under the GNU Affero General Public License, version 3."],
    "apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted.",
            "Use of this source code is governed by a BSD style license."],
    "cc-by": ["Licensed under CC BY 4.0.",
              "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0."],
    "cc0": ["Released into the public domain under CC0 1.0 Universal."],
    "gpl": ["This work is licensed under the GNU General Public License, version 3.",
            "This program is free software under the terms of the GNU General Public License."],
    "isc": ["Released under the ISC License."],
    "lgpl": ["This library is licensed under the GNU Lesser General Public License, version 3."],
    "mit": ["Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."],
    "mpl": ["This source code form is subject to the terms of the Mozilla Public License, version 2.0."],
    "reserved": ["All rights reserved."],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
}


# The opening paragraphs of notices as they are usually given, by label.
NOTICES = {
    "apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
        BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
        language governing permissions and limitations under the License.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.""",
    "gpl": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
        use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
        the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission
        notice shall be included in all copies or substantial portions of the Software.""",
    "mpl": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means.""",
}


def normal(text: Column) -> Column:
    """Words in lower case with one space between them."""
    return F.trim(F.regexp_replace(lower_ascii(text), NOT_WORD, " "))


def template_words() -> list[tuple[int, str, list[str], int, int]]:
    """(number, label, distinct words, scale, smallest number among its variants) of every template,
    with the words `normal` finds."""
    found = _templates()
    variant = {n: n for n, *_ in found}
    for _ in found:
        for a, _, x, _ in found:
            for b, _, y, _ in found:
                if 2 * len({*x} & {*y}) >= max(len(x), len(y)):
                    variant[a] = min(variant[a], variant[b])
    return [(*t, variant[t[0]]) for t in found]


def _templates() -> list[tuple[int, str, list[str], int]]:
    out = []
    for label in sorted({*TEMPLATES, *NOTICES}):
        for text in [*TEMPLATES.get(label, []), *([NOTICES[label]] if label in NOTICES else [])]:
            words = "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()
            out.append((len(out), label, sorted(set(words)), next(s for s in SCALES if len(words) <= s)))
    return out


def word_order(docs: DataFrame, words: list[str]) -> list[str]:
    """The given words by the number of documents that have them, ties by the words; bounded by
    the size of the template table."""
    known = F.array(*[F.lit(w) for w in words])
    found = docs.select(F.explode(F.array_intersect(
        F.split(normal(F.coalesce("text", F.lit(""))), " "), known)).alias("word"))
    counts = {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return sorted(words, key=lambda w: (counts.get(w, 0), w))


def _phrase_starts(words: Column, phrase: list[str]) -> Column:
    """Word numbers at which the phrase stands."""
    last = F.size(words) - len(phrase)
    here = lambda i: [F.get(words, i + k) == w for k, w in enumerate(phrase)]

    def all_equal(i):
        first, *rest = here(i)
        for x in rest:
            first = first & x
        return first
    return F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), all_equal)


def phrase_places(docs: DataFrame, keep: list[str], also: list[str] = (), phrases: dict[str, str] = PHRASES) -> DataFrame:
    """n_words, n_base, first_word, last_word and base (labels) of every row, next to `keep`, its
    _words and _hits, which of the words `also` it has.

    Words are looked up once; the rest is computed only for the few texts with a first word of a
    phrase. `_words` is a column of its own, since a lambda would split the text for every word.
    """
    none = F.array().cast("array<int>")
    firsts = sorted({p.split()[0] for p in phrases})
    known = F.array(*[F.lit(w) for w in sorted({*firsts, *also})])
    rows = docs.withColumn("_words", F.split(normal(F.coalesce("text", F.lit(""))), " "))
    rows = rows.withColumn("_hits", F.array_intersect("_words", known))
    for i, p in enumerate(phrases):
        starts = F.when(F.array_contains("_hits", p.split()[0]), _phrase_starts(F.col("_words"), p.split()))
        rows = rows.withColumn(f"_at{i}", F.coalesce(starts, none))
    at = [F.col(f"_at{i}") for i in range(len(phrases))]
    every = F.concat(*at)
    labels = F.array_compact(F.array(*[F.when(F.size(a) > 0, F.lit(l)) for a, l in zip(at, phrases.values())]))
    n = F.when(F.col("_words")[0] == "", F.lit(0)).otherwise(F.size("_words"))
    return rows.select(
        *keep, n.cast("long").alias("n_words"), F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(labels)).alias("base"), "_hits", "_words")


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base and labels (sorted arrays), score (the
    largest share of a template's words that a block has, 1 for a phrase, 0 for neither)."""
    spark = docs.sparkSession
    templates = template_words()
    order = word_order(docs, sorted({w for _, _, words, _, _ in templates for w in words}))
    place = {w: i + 1 for i, w in enumerate(order)}
    index, whole = [], []
    for number, label, words, scale, variant in templates:
        ranks = sorted(place[w] for w in words)
        need = math.ceil(threshold * len(ranks) - 1e-9)
        whole.append((number, label, ranks, need, scale))
        index += [(r, scale, number, variant, label, i, ranks, need) for i, r in enumerate(ranks[:len(ranks) - need + 1])]
    rare = sorted({order[r - 1] for r, *_ in index})

    # Blocks around a word of some prefix of their scale, as sorted ranks of the template words they have.
    def blocks(scale: int):
        own = [order[r - 1] for r in sorted({r for r, s, *_ in index if s == scale})]
        known = F.array(*[F.lit(order[r - 1]) for r in sorted({r for *_, ranks, _, s in whole if s == scale for r in ranks})])
        ranks = {w: place[w] for w in order}
        rank = F.create_map(*[F.lit(x) for w in order for x in (w, ranks[w])])
        prefix = F.array(*[F.lit(w) for w in own])
        places = F.filter(F.sequence(F.lit(0), F.size("_words") - 1), lambda i: F.array_contains(prefix, F.get("_words", i)))
        at = F.array_distinct(F.flatten(F.transform(places, lambda p: F.array(
            F.floor(p / scale).cast("int"), (F.floor(p / scale) - 1).cast("int")))))
        formed = F.transform(F.filter(at, lambda b: b >= 0), lambda b: F.struct(
            F.lit(scale).alias("scale"), b.alias("block"), F.sort_array(F.transform(
                F.array_intersect(F.slice("_words", b * scale + 1, F.lit(2 * scale)), known), lambda w: F.element_at(rank, w))).alias("own")))
        least = min(t[3] for t in whole if t[4] == scale)
        return F.when(F.arrays_overlap("_hits", prefix), F.filter(formed, lambda x: F.size(x["own"]) >= least))
    none = F.array().cast("array<struct<scale:int,block:int,own:array<int>>>")
    pages = phrase_places(docs, ["doc_id"], rare)
    pages = pages.withColumn("_blocks", F.concat(*[F.coalesce(blocks(s), none) for s in SCALES])).drop("_hits", "_words")
    pages = stored(pages.withColumn("_row", F.monotonically_increasing_id()), "license-pages")

    schema = "rank int, scale int, number int, variant int, label string, i int, ranks array<int>, need int"
    entries = spark.createDataFrame(index, schema)
    words = pages.where(F.size("_blocks") > 0).select("_row", F.inline("_blocks"))
    words = words.select("*", F.posexplode("own").alias("j", "rank"))
    left = F.least(F.size("ranks") - F.col("i"), F.size("own") - F.col("j"))
    pairs = words.join(F.broadcast(entries), ["scale", "rank"]).where(
        (F.size("own") >= F.col("need")) & (left >= F.col("need")))
    common = F.size(F.array_intersect("own", "ranks"))
    matches = pairs.where(common >= F.col("need")).select(
        "_row", "scale", "block", "number", "variant", "label", (common / F.size("ranks")).alias("share"), common.alias("common"))
    # A word more of the prefix finds the same match again.
    matches = matches.distinct()
    # Variants share words: a stretch is named by those that it matches best.
    per_block = F.col("scale") / CELL
    cells = F.sequence((F.col("block") * per_block).cast("int"), ((F.col("block") + 2) * per_block).cast("int") - 1)
    best = F.max(F.struct("share", "common")).over(Window.partitionBy("_row", "variant", "_cell"))
    placed = matches.withColumn("_cell", F.explode(cells)).withColumn("_best", best)
    kept = placed.groupBy("_row", "number", "scale", "block", "label", "share").agg(
        F.bool_and(F.struct("share", "common") == F.col("_best")).alias("_is_best")).where("_is_best")
    found = kept.groupBy("_row").agg(F.collect_set("label").alias("_found"), F.max("share").alias("_share"))
    none = F.array().cast("array<string>")
    joined = pages.join(found, "_row", "left")
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base",
        F.array_sort(F.array_union("base", F.coalesce("_found", none))).alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("_share", F.lit(0.0))).alias("score"))
