"""License scans: MinHash bands over overlapping windows retrieve templates, exact containment verifies them.

Texts and templates are split into words of ASCII letters and digits, lower-cased, and into shingles of five. The
templates fall into classes of similar length. For a class, windows overlap so far that each passage as long as its
longest template lies whole in one of them. That bounds from below the Jaccard similarity of such a window and a
template that it holds to the needed share, and the number of bands (of one row) follows from the probability that
at least one must agree. A retrieved pair counts if the window holds that share of the template's shingles exactly.

Before that, texts and windows drop out that can't match: they lack every anchor word, and the shingles without an
anchor word are less than the needed share of each template. The anchors are computed from the templates.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import cache
from math import ceil, log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
#: The share of a template's shingles that a window must hold, in percent.
HELD = 80
#: A matching window agrees with its template in a band with at least this probability.
CERTAINTY = 0.99995

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The wording of public licence notices.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "bsd-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mit": "Released under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}


def shingles_of(text: str) -> list[str]:
    """Distinct shingles, sorted."""
    w = re.findall("[a-z0-9]+", text.translate(str.maketrans(UPPER, LOWER)))
    return sorted({" ".join(w[k : k + SHINGLE]) for k in range(len(w) - SHINGLE + 1)})


def n_words(text: str) -> int:
    return len(re.findall("[A-Za-z0-9]+", text))


def needs(name: str, held: int = HELD) -> int:
    return -(-held * len(shingles_of(TEMPLATES[name])) // 100)


def classes(held: int = HELD, certainty: float = CERTAINTY) -> list[dict]:
    """Classes of templates: names, window and stride in shingles, bands. Lengths in a class differ by a half at most."""
    out: list[dict] = []
    for name in sorted(TEMPLATES, key=lambda k: (n_words(TEMPLATES[k]), k)):
        if not out or n_words(TEMPLATES[name]) > 1.5 * n_words(TEMPLATES[out[-1]["names"][0]]):
            out.append({"names": []})
        out[-1]["names"].append(name)
    for x in out:
        longest = max(n_words(TEMPLATES[k]) for k in x["names"]) - SHINGLE + 1
        x["stride"] = max(1, ceil(longest / 2))
        x["window"] = longest + x["stride"] - 1
        least = min(needs(k, held) / (x["window"] + len(shingles_of(TEMPLATES[k])) - needs(k, held)) for k in x["names"])
        x["bands"] = 1 if least >= 1 else ceil(log(1 - certainty) / log(1 - least))
    return out


@cache
def anchors(held: int = HELD) -> tuple[str, ...]:
    """Words chosen one by one, the one in the most shingles without a word so far first, until no template can
    hold its needed share in shingles without any of them."""
    left = {k: [set(s.split()) for s in shingles_of(t)] for k, t in TEMPLATES.items()}
    chosen: list[str] = []
    while True:
        open_ = {k: [s for s in v if not s & {*chosen}] for k, v in left.items()}
        open_ = {k: v for k, v in open_.items() if len(v) >= needs(k, held)}
        if not open_:
            return tuple(chosen)
        seen = Counter(w for v in open_.values() for s in v for w in s if len(w) > 3 and w.isalpha())
        if not seen:
            seen = Counter(w for v in open_.values() for s in v for w in s)
        chosen.append(min(seen, key=lambda w: (-seen[w], w)))


def _signature(window: Column, bands: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda k: F.array_min(F.transform(window, lambda s: F.xxhash64(s, k))))


def _shingles(text: Column) -> Column:
    words = F.filter(F.split(F.translate(text, UPPER, LOWER), "[^a-z0-9]+", -1), lambda w: w != "")
    whole = F.transform(F.array(words), lambda a: F.when(F.size(a) >= SHINGLE, F.transform(F.sequence(F.lit(1), F.size(a) - (SHINGLE - 1)), lambda i: F.array_join(F.slice(a, i, SHINGLE), " "))).otherwise(F.array().cast("array<string>")))
    return F.get(whole, F.lit(0))


def _windows(number: int, x: dict) -> Column:
    """The windows of a class that hold a shingle with an anchor word, of the columns s (shingles) and at (their places)."""
    stride, width = F.lit(x["stride"]), F.lit(x["window"])

    def over(p: Column) -> Column:
        return F.sequence(F.greatest(F.lit(0), F.floor((p - width + stride) / stride)).cast("int"), F.floor(p / stride).cast("int"))

    numbers = F.array_distinct(F.flatten(F.transform("at", over)))
    return F.transform(numbers, lambda k: F.struct(F.lit(number).alias("class"), (k * stride).alias("window_start"), F.slice("s", k * stride + 1, width).alias("window")))


def _template_signatures(spark: SparkSession, names: list[str], bands: int) -> dict[str, list[int]]:
    """Of the fixed templates alone: a dozen rows."""
    rows = spark.createDataFrame([(k, shingles_of(TEMPLATES[k])) for k in names], "name string, s array<string>")
    return {r[0]: r[1] for r in rows.select("name", _signature(F.col("s"), bands)).collect()}


def matches(docs: DataFrame, held: int = HELD) -> DataFrame:
    """(doc_id, template, window_start, held): templates that windows of docs(doc_id, text) hold, each window once.

    window_start counts shingles from 0. Null, empty and short texts match nothing; repeated rows match each on their
    own; other columns are not read.
    """
    spark = docs.sparkSession
    own_classes, words = classes(held), "|".join(anchors(held))
    could = docs.select("doc_id", "text").where(F.col("text").rlike(f"(?i){words}"))
    cut = could.select("doc_id", _shingles(F.col("text")).alias("s"))
    at = F.filter(F.transform("s", lambda x, i: F.when(x.rlike(rf"\b({words})\b"), i)), lambda i: i.isNotNull())
    cut = cut.withColumn("at", at).where(F.size("at") > 0)
    windows = cut.select("doc_id", F.explode(F.flatten(F.array(*(_windows(k, x) for k, x in enumerate(own_classes))))).alias("w")).select("doc_id", "w.*")
    bands = F.coalesce(*(F.when(F.col("class") == k, _signature(F.col("window"), x["bands"])) for k, x in enumerate(own_classes)))
    signed = windows.withColumn("bands", bands)
    options = []
    for k, x in enumerate(own_classes):
        for name, signature in _template_signatures(spark, x["names"], x["bands"]).items():
            agrees = (F.col("class") == k) & F.arrays_overlap("bands", F.array(*map(F.lit, signature)))
            own = shingles_of(TEMPLATES[name])
            n = F.when(agrees, F.size(F.array_intersect("window", F.array(*map(F.lit, own))))).otherwise(0)
            options.append(F.struct(F.lit(name).alias("template"), n.alias("n"), F.lit(len(own)).alias("of")))
    each = signed.select("doc_id", "window_start", F.explode(F.array(*options)).alias("m"))
    return each.where(100 * F.col("m.n") >= held * F.col("m.of")).select("doc_id", F.col("m.template").alias("template"), "window_start", (F.col("m.n") / F.col("m.of")).alias("held"))


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_licenses, licenses, held): one row for each of docs; the names sorted, the greatest share held.

    Rows that share a doc_id have the matches of all of them.
    """
    by = matches(docs).groupBy(F.col("doc_id").alias("_doc")).agg(F.array_sort(F.collect_set("template")).alias("names"), F.max("held").alias("most"))
    out = docs.select("doc_id").join(by, F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
    return out.select("doc_id", F.coalesce(F.size("names"), F.lit(0)).cast("long").alias("n_licenses"), F.coalesce(F.array_join("names", ","), F.lit("")).alias("licenses"), F.coalesce("most", F.lit(0.0)).alias("held"))
