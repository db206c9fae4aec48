"""License scan: MinHash bands over overlapping windows retrieve templates,
exact shingle containment verifies them.

A text's words (runs of ASCII letters and digits, in lower case) are cut into
overlapping windows, one from each word on, so that some window holds any
occurrence whole.  Only places near an anchor are cut: of a template's word
pairs, one more than an occurrence may miss are anchors, so that every
occurrence holds one.  A window is as long as an occurrence may grow by inserted
words while its Jaccard similarity to the template stays 0.5 or more.  Each
window gets ``BANDS`` MinHash values of its word pairs, one to a band: at 0.5 it
shares a band with its template with probability over 0.9999.  Retrieved pairs
match when the window holds at least 85 % of the template's word pairs.

A license has several templates: short statements, header notices, and telling
sentences of its full text.  The list is not complete (see README).

Null and empty texts have no match; whole texts are scanned; repeated rows give
equal rows; an empty table gives an empty result; other columns are ignored.
Only SQL functions run on the rows.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read

BANDS = 16
CONTAINED = 0.85
# Well-known license lines, and words of which each has one.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "all-rights-reserved": "All rights reserved.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "gpl-3.0": "you can redistribute it and/or modify it under the terms of the GNU General Public License",
}
# Further statements, notices and sentences of full texts.
VARIANTS = {
    "mit": [
        "under the MIT License", "The MIT License (MIT)", "MIT License Copyright (c)", "SPDX-License-Identifier: MIT",
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software"],
    "apache-2.0": [
        "under the Apache License, Version 2.0", "Apache License Version 2.0, January 2004", "under the Apache 2.0 license",
        "SPDX-License-Identifier: Apache-2.0", "http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"],
    "gpl-3.0": [
        "GNU General Public License, version 3", "GNU General Public License v3", "SPDX-License-Identifier: GPL-3.0",
        "under the GPLv3 license",
        "The GNU General Public License is a free, copyleft license for software and other kinds of works"],
    "gpl-2.0": [
        "GNU General Public License, version 2", "GNU General Public License v2", "SPDX-License-Identifier: GPL-2.0"],
    "lgpl": ["GNU Lesser General Public License", "GNU Library General Public License", "SPDX-License-Identifier: LGPL"],
    "agpl-3.0": ["GNU Affero General Public License", "SPDX-License-Identifier: AGPL"],
    "mpl-2.0": [
        "Mozilla Public License, v. 2.0", "Mozilla Public License Version 2.0", "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License"],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution",
        "under the BSD license", "BSD 2-Clause License", "BSD 3-Clause License", "SPDX-License-Identifier: BSD"],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted", "under the ISC License", "SPDX-License-Identifier: ISC"],
    "unlicense": [
        "This is free and unencumbered software released into the public domain", "SPDX-License-Identifier: Unlicense"],
    "cc0-1.0": [
        "CC0 1.0 Universal", "under CC0 1.0", "SPDX-License-Identifier: CC0-1.0",
        "http://creativecommons.org/publicdomain/zero/1.0"],
    "cc-by-4.0": [
        "under the CC BY 4.0 license", "Creative Commons Attribution 4.0", "creativecommons.org/licenses/by/4.0"],
    "cc-by-sa-4.0": [
        "under CC BY-SA 4.0", "CC BY-SA 4.0 license", "Creative Commons Attribution-ShareAlike 4.0",
        "creativecommons.org/licenses/by-sa/4.0"],
    "cc-by-nc-4.0": [
        "under the CC BY-NC 4.0 license", "Creative Commons Attribution-NonCommercial 4.0",
        "creativecommons.org/licenses/by-nc/4.0"],
}
LICENSES = {n: [TEMPLATES[n]] if n in TEMPLATES else [] for n in [*TEMPLATES, *VARIANTS]}
LICENSES = {n: own + VARIANTS.get(n, []) for n, own in LICENSES.items()}


def _shape(template: str) -> tuple[list[str], int, list[str]]:
    """A template's distinct word pairs, the length of its windows, its anchors."""
    words = re.findall("[a-z0-9]+", template.lower())
    pairs = list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))
    missing = len(pairs) - math.ceil(len(pairs) * CONTAINED)
    # held / (missing + window's pairs) is 0.5 or more up to this length
    length = max(len(words) + 1, int((3 * CONTAINED - 1) * len(pairs)) + 1)
    return pairs, length, sorted(pairs, key=lambda p: (-len(p), p))[:missing + 1]    # long pairs are rare ones


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def _pairs(words: Column) -> Column:
    return F.array_distinct(F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1),
                                       lambda a, b: F.concat_ws(" ", a, b)))


def _least(pairs: Column, band: int) -> Column:
    return F.array_min(F.transform(pairs, lambda s: F.xxhash64(s, F.lit(band))))


def _bands(pairs: Column) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("band"), _least(pairs, i).alias("least")) for i in range(BANDS)])


def scan(docs: DataFrame, templates: dict[str, str | list[str]] = LICENSES) -> DataFrame:
    """``doc_id, licenses array<string>`` (sorted names) for every row of
    ``docs (doc_id, text)``.  ``templates`` is a fixed list, known to all tasks:
    one text or several to a name."""
    spark = docs.sparkSession
    shapes = [(n, *_shape(t)) for n, given in templates.items() for t in ([given] if isinstance(given, str) else given)]
    shapes = [s for s in shapes if s[1]]
    anchors: dict[int, set[str]] = {}
    for _, _, length, own in shapes:
        anchors.setdefault(length, set()).update(own)
    known = spark.createDataFrame([(n, length, pairs) for n, pairs, length, _ in shapes],
                                  "name string, size int, wanted array<string>")
    keys = F.broadcast(known.withColumn("key", F.explode(_bands(F.col("wanted")))).select(
        "name", "size", "wanted", "key.band", "key.least"))         # one row per template and band
    rows = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    words = rows.select("row", _words(F.col("text")).alias("words")).where(F.size("words") > 1)
    n = F.size("words") - 1
    each = F.zip_with(F.slice("words", 1, n), F.slice("words", 2, n), lambda a, b: F.concat_ws(" ", a, b))
    every = sorted(set().union(*anchors.values()))
    hits = words.select("row", "words", F.filter(
        F.transform(each, lambda p, i: F.struct((i + 1).alias("at"), p.alias("pair"))),
        lambda h: h["pair"].isin(every)).alias("hits")).where(F.size("hits") > 0)

    def places(length: int, own: set[str]) -> Column:
        near = F.filter("hits", lambda h: h["pair"].isin(sorted(own)))
        starts = F.flatten(F.transform(near, lambda h: F.sequence(
            F.greatest(F.lit(1), h["at"] - (length - 1)), h["at"])))
        return F.struct(F.lit(length).alias("size"), F.array_distinct(starts).alias("starts"))

    # only the window leaves the row, never the whole list of words with it
    sized = hits.select("row", "words", F.explode(F.filter(
        F.array(*[places(length, own) for length, own in sorted(anchors.items())]),
        lambda p: F.size(p["starts"]) > 0)).alias("p"))
    cut = sized.select("row", F.col("p.size").alias("size"), F.explode(F.transform(
        F.col("p.starts"), lambda s: F.slice("words", s, F.col("p.size")))).alias("window"))
    near = (cut.select("row", "size", _pairs(F.col("window")).alias("pairs")).where(F.size("pairs") > 0)
            .withColumn("key", F.explode(_bands(F.col("pairs"))))
            .select("row", "size", "pairs", "key.band", "key.least").join(keys, ["size", "band", "least"]))
    held = F.size(F.array_intersect("pairs", "wanted")) >= F.size("wanted") * CONTAINED
    found = near.where(held).groupBy("row").agg(F.sort_array(F.collect_set("name")).alias("licenses"))
    return rows.select("doc_id", "row").join(found, "row", "left").select(
        "doc_id", F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("licenses").cast("long").alias("n_licenses"),
                        F.concat_ws(",", "licenses").alias("licenses"))
