"""License scans over overlapping windows (operator 3), DataFrame functions only.

Templates are grouped by length.  A group cuts the words of a document into
overlapping windows, long and dense enough that every stretch of a template's
length lies in one window.  MinHash bands of a window's five-word shingles
retrieve templates; the number of bands follows from the smallest similarity a
true match can have, so a match shares a band with probability 1 - ``MISS`` at
least.  A candidate counts if the window holds at least 80 % of the template's
shingles, compared as strings.

Only windows around an anchor are sketched.  A match misses at most a fifth of
a template's n shingles, so it holds one at least of any floor(n / 5) + 1 of
them, and with it that shingle's longest word.  The anchors of a template are
the longest words of those shingles whose longest words are longest, so
nothing is lost.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import LOWER, UPPER, ascii_lower, load, text_or_empty

SHINGLE, PERCENT, ROWS, MISS = 5, 80, 2, 1e-6
#: Templates are configuration; their bands are broadcast.
MOST_TEMPLATES = 2000
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Usual notices of public licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 header": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0 header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "MIT": "Released under the MIT License",
    "MIT notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "Unlicense": "This is free and unencumbered software released into the public domain",
}


@dataclass(frozen=True)
class Template:
    name: str
    words: tuple[str, ...]

    @property
    def shingles(self) -> list[str]:
        return sorted({" ".join(self.words[i : i + SHINGLE]) for i in range(len(self.words) - SHINGLE + 1)})


@dataclass(frozen=True)
class Group:
    """Templates that share windows of ``length`` words every ``stride``."""

    length: int
    stride: int
    bands: int
    templates: tuple[Template, ...]

    anchors: tuple[str, ...]


def anchors_of(template: Template, percent: int) -> set[str]:
    """A word of each of the fewest shingles that no match can all miss."""
    longest = [max(s.split(" "), key=lambda w: (len(w), w)) for s in template.shingles]
    missing = len(longest) - math.ceil(len(longest) * percent / 100)
    return set(sorted(longest, key=lambda w: (-len(w), w))[: missing + 1])


def template_groups(templates: dict[str, str], percent: int = PERCENT) -> list[Group]:
    """Exact length and stride 1 up to 16 words, then lengths in steps of a
    quarter with a stride of an eighth."""
    import re

    if len(templates) > MOST_TEMPLATES:
        raise ValueError(f"more than {MOST_TEMPLATES} templates")
    sizes: dict[int, list[Template]] = {}
    for name, text in sorted(templates.items()):
        words = tuple(w for w in re.split(GAP, text.translate(str.maketrans(UPPER, LOWER))) if w)
        if len(words) < SHINGLE:
            raise ValueError(f"template {name}: {SHINGLE} words at least")
        size = len(words)
        if size > 16:
            size = 16
            while size < len(words):
                size = max(size + 1, size * 5 // 4)
        sizes.setdefault(size, []).append(Template(name, words))
    groups = []
    for size, found in sorted(sizes.items()):
        stride = 1 if size <= 16 else size // 8
        length = size + stride - 1
        share, least = percent / 100, 1.0
        for t in found:
            n, window = len(t.shingles), length - SHINGLE + 1
            held = math.ceil(share * n)
            least = min(least, held / (window + n - held))
        one = least**ROWS
        bands = 1 if one >= 1 else math.ceil(math.log(MISS) / math.log(1 - one))
        anchors = sorted({a for t in found for a in anchors_of(t, percent)})
        groups.append(Group(length, stride, bands, tuple(found), tuple(anchors)))
    return groups


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), GAP), "")


def _least(hashes: Column, seed: Column) -> Column:
    return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, seed)))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row and license found: id, license, containment (best
    share of the template's shingles in a window), first_word (start of the
    first window that reaches it, from 0).

    Null texts and texts of fewer than five words have no license.  Repeated
    rows give repeated results; a null id is an ordinary value.  Empty tables
    and no templates give no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("rid"), words_of(text_or_empty(text_col)).alias("words"))
    groups = template_groups(templates, percent)
    kind = rows.schema["id"].dataType.simpleString()
    if not groups:
        return spark.createDataFrame([], f"{id_col} {kind}, license string, containment double, first_word int")
    anchors = sorted({a for g in groups for a in g.anchors})
    rows = rows.where(F.arrays_overlap("words", F.array(*map(F.lit, anchors))))
    tasks = F.array(*[
        F.struct(F.lit(i).alias("grp"), F.lit(g.length).alias("length"), F.lit(g.stride).alias("stride"), F.lit(g.bands).alias("bands"),
                 F.array(*map(F.lit, g.anchors)).alias("anchors"))
        for i, g in enumerate(groups)
    ])
    rows = rows.withColumn("g", F.explode(tasks)).withColumn("own", F.array_intersect("words", "g.anchors")).where(F.size("own") > 0)
    places = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.array_contains(F.col("own"), F.get("words", i)))
    length, stride = F.col("g.length"), F.col("g.stride")

    def starts(q: Column) -> Column:
        first = F.greatest(F.ceil((q - length + 1) / stride) * stride, F.lit(0)).cast("int")
        return F.filter(F.sequence(first, first + length, stride), lambda p: p <= q)

    rows = rows.withColumn("start", F.explode(F.array_distinct(F.flatten(F.transform(places, starts)))))
    last = F.least(F.col("start") + length, F.size("words")) - SHINGLE
    shingles = F.transform(F.sequence(F.col("start"), last), lambda i: F.concat_ws(" ", F.slice("words", i + 1, F.lit(SHINGLE))))
    windows = rows.where(last >= F.col("start")).select("id", "rid", "g", "start", F.array_distinct(shingles).alias("held")).select(
        "id", "rid", F.col("g.grp").alias("grp"), F.col("g.bands").alias("bands"), "start", "held"
    )
    known = spark.createDataFrame(
        [(i, g.bands, t.name, t.shingles) for i, g in enumerate(groups) for t in g.templates], "grp int, bands int, license string, shingles array<string>"
    )

    def keyed(df: DataFrame, column: str) -> DataFrame:
        hashes = df.withColumn("_h", F.transform(column, lambda s: F.xxhash64(s)))
        keys = F.transform(
            F.sequence(F.lit(0), F.col("bands") - 1), lambda j: F.xxhash64(j, *[_least(F.col("_h"), j * ROWS + r) for r in range(ROWS)])
        )
        return hashes.withColumn("key", F.explode(keys)).drop("_h", "bands")

    found = keyed(windows, "held").join(F.broadcast(keyed(known, "shingles")), ["grp", "key"])
    share = F.size(F.array_intersect("held", "shingles")) / F.size("shingles")
    found = found.withColumn("containment", share).where(F.size(F.array_intersect("held", "shingles")) * 100 >= F.size("shingles") * percent)
    best = found.groupBy("rid", "id", "license").agg(F.max(F.struct("containment", (-F.col("start")).alias("back"))).alias("best"))
    return best.select(
        F.col("id").alias(id_col), "license", F.col("best.containment").alias("containment"), (-F.col("best.back")).cast("int").alias("first_word")
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(load(spark, sf_dir, "documents"))


def _sql() -> str:
    values = ", ".join(
        f"({g.length}, {g.stride}, '{t.name}', {len(t.shingles)}, '{s}')" for g in template_groups(TEMPLATES) for t in g.templates for s in t.shingles
    )
    low = "translate(coalesce(text, ''), '" + UPPER + "', '" + LOWER + "')"
    return f"""
WITH t(length, stride, license, n, sh) AS (VALUES {values}
), w AS (
  SELECT doc_id, regexp_extract_all({low}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), s AS (
  SELECT doc_id, i - 1 AS pos, array_to_string(list_slice(w, i, i + 4), ' ') AS sh
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w)
), hit AS (SELECT doc_id, pos, t.* FROM s JOIN t USING (sh)
), win AS (
  SELECT doc_id, license, n, sh, unnest(range(greatest(CAST(ceil((pos + 5 - length) / stride) AS BIGINT), 0), pos // stride + 1)) * stride AS p FROM hit
), share AS (
  SELECT doc_id, license, p, count(DISTINCT sh) / n AS c FROM win GROUP BY doc_id, license, n, p HAVING 100 * count(DISTINCT sh) >= 80 * n
)
SELECT doc_id, license, max(c) AS containment, CAST(arg_min(p, (-c, p)) AS INTEGER) AS first_word FROM share GROUP BY doc_id, license
"""


OP3_SQL = _sql()
