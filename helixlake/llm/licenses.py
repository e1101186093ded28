"""License scans: which license notices a text holds, in DataFrame functions alone.

A template is found where at least four fifths of its five-word shingles occur in the document. MinHash bands
over overlapping windows of shingles retrieve templates: templates are classed by their number of shingles,
from a to 2a, and read with windows of 3a shingles that start every a shingles, so some window holds any
occurrence of up to 2a shingles whole, and its similarity to the template is 0.8 a / 3.2 a = 1/4 at least.
With bands of one row, 32 of them meet with probability 1 - 0.75 ** 32 = 0.9999. A template of fewer than
five shingles has to be there in full and is read with windows of its own length, whose one band meets for
sure. What bands retrieve is verified by exact containment of shingles, as strings.

A template of fewer than five words has its whole word sequence as its one shingle and is met by windows of
that many words, as strings. A template without words is an error.

Before that, a plain filter passes over texts that cannot hold any template: more than a fifth of the
shingles of each template hold one of a few words (chosen by :func:`anchors` from the templates), so a text
without any of them holds less than four fifths of each.

Words are runs of a-z and 0-9 after A-Z became a-z. Null and empty texts give no rows; repeated rows
give rows of their own; an empty table gives an empty result; columns beyond the two named ones are not read.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

WIDTH, CONTAINED = 5, 80  # words of a shingle; per cent
BANDS = 32

# Wording of public license notices.
TEMPLATES = {
    "Apache-2.0-short": "Licensed under the Apache License, Version 2.0",
    "MIT-short": "Released under the MIT License",
    "GPL-3.0-short": "This work is licensed under the GNU General Public License, version 3",
    "CC-BY-NC-4.0-short": "Licensed under CC BY-NC 4.0",
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "MIT": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

#: What a scan looks for unless told otherwise; op4_license_scans looks for TEMPLATES, as its SQL does.
NOTICES = TEMPLATES | {"All-rights-reserved": "All rights reserved."}


def words_of(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def shingles_of(text: str) -> list[str]:
    w = words_of(text)
    return list(dict.fromkeys(" ".join(w[i : i + WIDTH]) for i in range(max(len(w) - WIDTH, 0) + 1))) if w else []


def anchors(templates: dict[str, str]) -> list[str]:
    """Words such that of each template more than 100 - CONTAINED per cent of the shingles hold one; longer words first."""
    chosen: set[str] = set()
    for text in templates.values():
        shingles = shingles_of(text)
        while 100 * sum(bool(chosen & set(s.split())) for s in shingles) <= (100 - CONTAINED) * len(shingles):
            counts = Counter(w for s in shingles if not chosen & set(s.split()) for w in set(s.split()) if len(w) > 5 or len(w) == max(map(len, s.split())))
            chosen.add(max(counts, key=lambda w: (min(counts[w], 3), len(w), w)))
    return sorted(chosen)


def band_class(n: int) -> tuple[int, int, int]:
    """(window, step, bands) for a template of n shingles."""
    if n < 5:
        return n, 1, 1
    a = 5
    while 2 * a < n:
        a *= 2
    return 3 * a, a, BANDS


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, license, n_template (its shingles) and n_found (those in the document), a row for each license of a row."""
    spark, templates = docs.sparkSession, templates or NOTICES
    if empty := [k for k, t in templates.items() if not words_of(t)]:
        raise ValueError(f"templates without words: {', '.join(empty)}")
    own = {k: shingles_of(t) for k, t in templates.items() if len(words_of(t)) >= WIDTH}
    short = [(k, len(w), " ".join(w)) for k, t in templates.items() if len(w := words_of(t)) < WIDTH]
    found = "|".join(anchors(templates))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    low = F.translate(F.col(text), upper, lower)
    near = docs.select(F.col(doc_id).cast("long").alias("doc_id"), low.alias("low")).where(F.col("low").rlike(f"(?<![a-z0-9])(?:{found})(?![a-z0-9])"))
    near = near.select("doc_id", F.filter(F.split("low", "[^a-z0-9]+"), lambda x: x != "").alias("words"))

    def windowed(width: int):
        all_ = F.transform(F.sequence(F.lit(1), F.size("words") - width + 1), lambda i: F.concat_ws(" ", F.slice("words", i, width)))
        return F.when(F.size("words") >= width, all_).otherwise(F.array().cast("array<string>"))

    shingles = windowed(WIDTH)
    kept = materialise(near.select("doc_id", F.monotonically_increasing_id().alias("row"), "words"), "words")
    # dealt by row once: windows are then grouped, and matches joined to their texts, where the texts already are
    texts = kept.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "row")

    parts = []
    if short:
        phrases = spark.createDataFrame(short, "license string, width int, s string")
        seen = F.array_distinct(F.concat(*[windowed(n) for n in sorted({n for _, n, _ in short})]))
        met = kept.select("doc_id", F.explode(seen).alias("s")).join(F.broadcast(phrases), "s")  # the short templates
        parts.append(met.select("doc_id", "license", F.lit(1).cast("long").alias("n_template"), F.lit(1).cast("long").alias("n_found")))
    if not own:
        return parts[0]

    table = spark.createDataFrame([(k, *band_class(len(s)), s) for k, s in own.items()], "license string, window int, step int, bands int, shingles array<string>")
    classes = sorted({band_class(len(s)) for s in own.values()})

    def signature(hashed):
        return [F.min(F.xxhash64(hashed, F.lit(b))).alias(f"b{b}") for b in range(BANDS)]

    def bands(df: DataFrame, *keys: str) -> DataFrame:
        each = F.posexplode(F.array(*[f"b{b}" for b in range(BANDS)])).alias("band", "value")
        return df.select(*keys, "bands", each).where(F.col("band") < F.col("bands")).drop("bands")

    known = bands(table.select("license", "window", "bands", F.explode("shingles").alias("s")).groupBy("license", "window", "bands").agg(*signature(F.xxhash64("s"))), "license", "window")
    # each shingle belongs to window / step windows; windows are numbered by their start
    numbered = texts.select("row", F.posexplode(shingles).alias("i", "s")).select("row", "i", F.xxhash64("s").alias("h"))
    kinds = F.explode(F.array(*[F.struct(F.lit(w).alias("window"), F.lit(s).alias("step"), F.lit(b).alias("bands")) for w, s, b in classes]))
    placed = numbered.select("row", "i", "h", kinds.alias("k")).select("row", "h", "k.window", "k.bands", F.explode(F.sequence(F.floor((F.col("i") - F.col("k.window")) / F.col("k.step")) + 1, F.floor(F.col("i") / F.col("k.step")))).alias("at"))
    windows = placed.groupBy("row", "window", "bands", "at").agg(*signature(F.col("h")))
    met = bands(windows, "row", "window").join(F.broadcast(known), ["window", "band", "value"]).select("row", "license").distinct()  # known: BANDS values of each template
    held = F.size(F.array_intersect(shingles, "template"))
    whole = (
        met.join(F.broadcast(table.select("license", F.col("shingles").alias("template"))), "license")  # the templates
        .join(texts, "row")
        .select("doc_id", "license", F.size("template").cast("long").alias("n_template"), held.cast("long").alias("n_found"))
        .where(f"100 * n_found >= {CONTAINED} * n_template")
    )
    return whole.unionByName(parts[0]) if parts else whole
