"""License scans with MinHash bands over overlapping text windows.

A text's word shingles are looked at through windows that overlap so far that every occurrence of a template lies within one
window of its size class. Each window with any template shingle gets a MinHash signature; bands of it retrieve templates,
and what is retrieved is verified by the exact containment of the template's shingles, as words, in the window.

A window of a class is a quarter longer than the templates of it. A template found with containment 0.8 then has a Jaccard
similarity of at least 0.5 with its window, and ``BANDS`` bands of ``ROWS`` values miss it with a probability of
(1 - 0.5 ** ROWS) ** BANDS, about one in a million.

Windows without a template shingle have no similarity with any template, so they are not signed; this drops nothing. All
of it is DataFrame functions within the row of a document, but for the joins with the templates' bands.

Defined cases: null texts, and texts of fewer words than a shingle, match nothing; a template that stands several times in a
text is one row with the best window, the first of equal ones; rows are scanned one by one, so repeated rows and ids
repeat in the result; extra columns are ignored; an empty table gives no rows. Templates need five words or more.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize

SHINGLE = 5
CONTAINMENT = 0.8
ROWS, BANDS = 2, 48
SEED = 42

# Public license notices, as usually put into files.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
        an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    "MIT notice": "Released under the MIT License",
    "MIT permission": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so""",
    "BSD redistribution": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met""",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3",
    "GPL header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation""",
    "MPL-2.0 header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0",
}


@dataclass(frozen=True)
class Template:
    name: str
    words: tuple[str, ...]

    @property
    def stride(self) -> int:
        return max(1, len(self.words) // 4)

    @property
    def window(self) -> int:
        """Shingles of a window: one of these starts at most ``stride`` shingles before any occurrence."""
        return len(self.words) - SHINGLE + self.stride

    @property
    def shingles(self) -> list[str]:
        return sorted({" ".join(self.words[k: k + SHINGLE]) for k in range(len(self.words) - SHINGLE + 1)})


def template(name: str, text: str) -> Template:
    words = tuple(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}))))
    if len(words) < SHINGLE:
        raise ValueError(f"{name} has fewer than {SHINGLE} words")
    return Template(name, words)


def text_words(text: Column) -> Column:
    """The words of a text: runs of ASCII digits, letters in lower case, and characters beyond ASCII."""
    folded = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(folded, "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), lambda w: w != "")


def _signature(shingles: Column) -> Column:
    """Bands of the MinHash signature of an array of shingle hashes: each the hash of its number and its values."""
    def least(k: int) -> Column:
        return F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, F.lit(k))))

    values = [least(k) for k in range(ROWS * BANDS)]
    return F.array(*[F.xxhash64(F.lit(b), *values[b * ROWS: (b + 1) * ROWS]) for b in range(BANDS)])


def _signed(hash_: int) -> int:
    return hash_ - (1 << 64) if hash_ >= 1 << 63 else hash_


def scan(docs: DataFrame, templates: dict[str, str] | None = None, *, id_col: str = "doc_id", text_col: str = "text",
         containment: float = CONTAINMENT) -> DataFrame:
    """The id, ``license``, ``containment`` and ``word`` (0-based, of the best window) for every text and template in it."""
    spark = docs.sparkSession
    known = [template(n, t) for n, t in (TEMPLATES if templates is None else templates).items()]
    anchors = sorted({_signed(xxhash.xxh64_intdigest(s, SEED)) for t in known for s in t.shingles})
    # Taken out of an array of one, words and hashes are computed once a row: a filter is not moved below that.
    source = docs.select(F.col(id_col).alias("id"), F.explode(F.array(text_words(F.col(text_col)))).alias("words"))
    hashed = F.transform(
        F.sequence(F.lit(1), F.size("words") - SHINGLE + 1),
        lambda k: F.xxhash64(F.array_join(F.slice("words", k, SHINGLE), " ")),
    )
    enough = source.filter(F.size("words") >= SHINGLE).select("id", "words", F.explode(F.array(hashed)).alias("hashes"))
    met = enough.filter(F.exists("hashes", lambda h: h.isin(anchors)))
    found = materialize(met.withColumn("row", F.monotonically_increasing_id()), "candidates")
    places = F.filter(F.sequence(F.lit(0), F.size("hashes") - 1), lambda k: F.element_at("hashes", k + 1).isin(anchors))
    located = found.withColumn("places", places)

    def windows(size: int, stride: int) -> Column:
        """All windows of the grid that hold a place: they start at multiples of stride from place - size + 1 to place."""
        def starts(place: Column) -> Column:
            first = F.greatest(F.ceil((place - size + 1) / stride), F.lit(0)).cast("int")
            return F.transform(F.sequence(first, F.floor(place / stride).cast("int")), lambda k: k * stride)

        every = F.array_distinct(F.flatten(F.transform("places", starts)))
        return F.transform(every, lambda s: F.struct(F.lit(size).alias("size"), s.cast("int").alias("start")))

    grids = [windows(*grid) for grid in sorted({(t.window, t.stride) for t in known})]
    laid = located.select("id", "row", "words", "hashes", F.explode(F.concat(*grids)).alias("w")).select(
        "id", "row", F.col("w.size").alias("size"), F.col("w.start").alias("start"),
        F.slice("words", F.col("w.start") + 1, F.col("w.size") + SHINGLE - 1).alias("words"),
        F.slice("hashes", F.col("w.start") + 1, F.col("w.size")).alias("hashes"),
    )
    signed = laid.select("id", "row", "size", "start", "words", F.explode(_signature(F.col("hashes"))).alias("band"))

    kept = spark.createDataFrame([(t.name, t.window, t.shingles) for t in known], "license string, size int, shingles array<string>")
    band = F.explode(_signature(F.transform("shingles", lambda s: F.xxhash64(s))))
    bands = kept.select("license", "size", "shingles", band.alias("band"))
    # The templates are a parameter of this call, held by the driver already, so their bands may be broadcast.
    retrieved = signed.join(F.broadcast(bands), ["size", "band"]).dropDuplicates(["row", "size", "start", "license"])
    mine = F.transform(F.sequence(F.lit(1), F.size("words") - SHINGLE + 1), lambda k: F.array_join(F.slice("words", k, SHINGLE), " "))
    share = F.size(F.array_intersect("shingles", mine)) / F.size("shingles")
    verified = retrieved.withColumn("containment", share).filter(F.col("containment") >= containment)
    best = verified.groupBy("row", "license").agg(F.min(F.struct((-F.col("containment")).alias("c"), "start", "id")).alias("best"))
    return best.select(
        F.col("best.id").alias(id_col), "license", (-F.col("best.c")).alias("containment"), F.col("best.start").alias("word")
    )
