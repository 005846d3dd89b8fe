"""License scans: MinHash bands over overlapping windows, then exact containment.

For a template of n words, windows of n + s words start every s = max(1, n // 4)
words, so every run of n words lies whole in one of them.  A window that holds
at least 0.8 of the template's five-word shingles then has a Jaccard similarity
of 0.8 m / (m + s) or more, at least 0.4 (one shingle: 0.5), and meets the
template in one of 16 one-row bands with a probability of 0.9997 or more; as
its neighbours hold most of the same run, a match is hardly ever lost.
Candidates are verified by exact containment.

Windows are only cut where a match can be: each template has anchor words, such
that too few of its shingles for a match are without one, and a text of fewer
words than a match needs has none.  A template of under five words is a single
shingle of all its words.

Only built-in functions are used.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroute.llm.staging import stage

SHINGLE = 5
MIN_CONTAINMENT = 0.8
BANDS = 16
LONG = 60                   # words from which a template counts as a whole licence
WORD = r"[^\x20\x09-\x0D.,;:()\"'<>]+(?:[.,;:'][^\x20\x09-\x0D.,;:()\"'<>]+)*"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Customary license notices.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
                          "this file except in compliance with the License"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are "
            "permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-header", "This program is free software: you can redistribute it and/or modify it under the "
                   "terms of the GNU General Public License as published by the Free Software Foundation"),
    ("MIT", "Released under the MIT License"),
    ("MIT-permission", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
                       "this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Apache-2.0-released", "Released under the Apache License, Version 2.0"),
    ("MIT-licensed", "Licensed under the MIT License"),
    ("MIT-project", "This project is licensed under the MIT License"),
    ("ISC-licensed", "Licensed under the ISC License"),
    ("BSD-2-Clause-licensed", "Licensed under the BSD 2-Clause License"),
    ("BSD-3-Clause-licensed", "Licensed under the BSD 3-Clause License"),
    ("BSD-style", "Use of this source code is governed by a BSD-style license"),
    ("GPL-licensed", "Licensed under the GNU General Public License"),
    ("LGPL-licensed", "Licensed under the GNU Lesser General Public License"),
    ("LGPL-header", "This library is free software; you can redistribute it and/or modify it under the "
                    "terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("AGPL-licensed", "Licensed under the GNU Affero General Public License"),
    ("AGPL-header", "This program is free software: you can redistribute it and/or modify it under the "
                    "terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("MPL-2.0-licensed", "Licensed under the Mozilla Public License, Version 2.0"),
    ("CC-BY-4.0-licensed", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0-licensed", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-SA-4.0-notice", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
                            "International License"),
    ("CC-BY-NC-4.0-notice", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
                            "International License"),
    ("CC0-1.0-notice", "To the extent possible under law, the author has waived all copyright and related or "
                       "neighboring rights to this work"),
    *[(f"{path.stem}-text", path.read_text(encoding="utf-8"))
      for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))],
]

# Under five words: a match is the whole run of words.
SHORT_TEMPLATES = [
    ("All-rights-reserved", "All rights reserved"),
    ("Apache-2.0-name", "Apache License 2.0"),
    ("BSD-2-Clause-name", "BSD 2-Clause License"),
    ("BSD-3-Clause-name", "BSD 3-Clause License"),
    ("CC-BY-4.0-name", "CC BY 4.0"),
    ("CC-BY-NC-4.0-name", "CC BY-NC 4.0"),
    ("CC-BY-SA-4.0-name", "CC BY-SA 4.0"),
    ("CC0-1.0-name", "CC0 1.0 Universal"),
    ("ISC-name", "ISC License"),
    ("MIT-name", "MIT License"),
]
ALL_TEMPLATES = TEMPLATES + SHORT_TEMPLATES


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def shingles(tokens: Column, k: int | Column = SHINGLE) -> Column:
    """Distinct runs of k words; none for fewer words."""
    k = F.lit(k) if isinstance(k, int) else k
    n = F.size(tokens) - (k - 1)
    return F.when(n > 0, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        # word by word, as a slice would copy the whole array each time
        lambda i: F.concat_ws(" ", *[F.when(F.lit(j) < k, F.get(tokens, i + (j - 1))) for j in range(SHINGLE)])))).otherwise(F.array().cast("array<string>"))


def template_words(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))


def _shape(text: str) -> tuple[int, int, int, int]:
    """Words, step of the windows, words of a shingle, and the least words of a text with a match."""
    w = template_words(text)
    k = min(SHINGLE, len(w))
    runs = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
    return len(w), max(1, len(w) // 4), k, math.ceil(MIN_CONTAINMENT * len(runs)) + k - 1


@lru_cache(maxsize=1000)
def _anchors(text: str) -> tuple[str, ...]:
    w = template_words(text)
    k = min(SHINGLE, len(w))
    bare = [frozenset(r) for r in {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}]
    need, chosen = math.ceil(MIN_CONTAINMENT * len(bare)), []
    left = sorted(set(w), key=lambda x: (-len(x), x))
    while len(bare) >= need:
        word = left[0]
        if len(w) > LONG:       # few words do it: the ones of most shingles first
            of = Counter(x for r in bare for x in r if len(x) >= 7)
            word = max(sorted(of), key=of.get, default=word)
        left.remove(word)
        chosen.append(word)
        bare = [r for r in bare if word not in r]
    return tuple(chosen)


def anchors(text: str) -> list[str]:
    """Longest words first, until the shingles without any can't make a match.

    Whole licences take the words of seven letters or more that most shingles hold.
    """
    return list(_anchors(text))


def template_table(spark: SparkSession, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """license, n (words), step, k, t_shingles, t_anchors; a template of under five words is one shingle."""
    rows = []
    for name, text in templates or ALL_TEMPLATES:
        n, step, k, _ = _shape(text)
        if n:
            w = template_words(text)
            runs = dict.fromkeys(" ".join(w[i:i + k]) for i in range(n - k + 1))
            rows.append((name, n, step, k, list(runs), anchors(text)))
    return spark.createDataFrame(rows, "license string, n int, step int, k int, t_shingles array<string>, "
                                       "t_anchors array<string>")


def hashes(parts: Column) -> Column:
    return F.transform(parts, lambda x: F.xxhash64(x))


def bands(hashed: Column) -> Column:
    """One minimum a hash function, each a band of its own."""
    def low(k: int) -> Column:
        return F.array_min(F.transform(hashed, lambda h: F.xxhash64(h, F.lit(k))))
    return F.array(*[F.struct(F.lit(k).alias("band"), low(k).alias("low")) for k in range(BANDS)])


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """doc_id, license, containment (best window), first_word of the earliest match.

    One row for each document and license.  Null and empty texts, and texts
    without a match, give no row; rows repeated with one doc_id count as one
    document; whole texts are scanned.
    """
    spark = docs.sparkSession
    # windows of one length and step are one class, cut about the anchors of its templates
    classes: dict[tuple[int, int, int], tuple[int, set[str]]] = {}
    for _, text in templates or ALL_TEMPLATES:
        n, s, k, least = _shape(text)
        if n:
            low, marks = classes.get((n, s, k), (least, set()))
            classes[n, s, k] = min(low, least), marks | set(anchors(text))
    if not classes:
        return spark.createDataFrame([], "doc_id long, license string, containment double, first_word int")
    table = template_table(spark, templates)
    # long templates only matter to texts that could hold them: of that many words, and a space between them
    hint = F.lit(False)
    for low, high in ((0, 40), (40, 400), (400, 1 << 30)):
        part = [(least, marks) for least, marks in classes.values() if low <= least < high]
        if part:
            known = sorted(set().union(*[marks for _, marks in part]))
            fits = F.length("text") >= 2 * min(least for least, _ in part) - 1
            known = [a for a in known if not any(a != b and a.startswith(b) for b in known)]
            # only where a word can begin, which spares most places of a text the list of anchors
            hint = hint | (fits & F.col("text").rlike(
                r"(?i)(?:^|[\x20\x09-\x0D.,;:()\"'<>])(?:" + "|".join(re.escape(a) for a in known) + ")"))
    d = docs.select(docs["doc_id"], docs["text"].alias("text")).where(hint)
    # written, as each part below refers to the words more than once
    d = stage(d.select("doc_id", words(F.col("text")).alias("w")), "license-words")

    def windows(n: int, s: int, k: int, least: int, marks: set[str]) -> Column:
        """The windows of a class that hold an anchor, by their starts."""
        held = F.array(*[F.lit(a) for a in sorted(marks)])
        places = F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.array_contains(held, F.get(F.col("w"), i)))
        begins = F.array_distinct(F.flatten(F.transform(places, lambda p: F.sequence(
            F.floor(F.greatest(p - n, F.lit(0)) / s).cast("int"), F.floor(p / s).cast("int")))))
        return F.when(F.size("w") >= least, F.transform(begins, lambda i: F.struct(
            F.lit(n).alias("n"), F.lit(k).alias("k"), (i * s).alias("start"), F.lit(s).alias("s")))).otherwise(
                F.array().cast("array<struct<n:int,k:int,start:int,s:int>>"))

    starts = F.concat(*[windows(*key, least, marks) for key, (least, marks) in sorted(classes.items())])
    v = d.select("doc_id", "w", F.explode(starts).alias("c"))
    v = v.where(F.size("w") - F.col("c.start") >= F.col("c.k"))
    v = v.select("doc_id", F.col("c.n").alias("n"), F.col("c.k").alias("k"), F.col("c.start").alias("start"),
                 F.transform(F.sequence(F.col("c.start"), F.least(F.col("c.start") + F.col("c.n") + F.col("c.s"),
                                                                  F.size("w")) - 1),
                             lambda i: F.get(F.col("w"), i)).alias("win"))
    v = v.select("doc_id", "n", "start", shingles(F.col("win"), F.col("k")).alias("sh"))
    v = v.select("*", hashes(F.col("sh")).alias("hashed"))
    # written, so that their size is known: BANDS narrow rows a template, and its shingles once
    table = stage(table.select("license", "n", "t_shingles"), "license-templates")
    t_bands = stage(table.select("license", "n", F.explode(bands(hashes(F.col("t_shingles")))).alias("b"))
                    .select("license", "n", "b.band", "b.low"), "license-bands")
    hits = (v.select("doc_id", "n", "start", "sh", F.explode(bands(F.col("hashed"))).alias("b"))
            .select("doc_id", "n", "start", "sh", "b.band", "b.low").join(t_bands, ["n", "band", "low"])
            .join(table.select("license", "t_shingles"), "license"))
    share = F.size(F.array_intersect("sh", "t_shingles")) / F.size("t_shingles")
    return (hits.select("doc_id", "license", "start", share.alias("containment"))
            .where(F.col("containment") >= MIN_CONTAINMENT)
            .groupBy("doc_id", "license")
            .agg(F.max("containment").alias("containment"), F.min("start").alias("first_word")))
