"""Licence texts in documents: MinHash bands over windows, then exact containment."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.session import stage

SHINGLE = 5
CONTAINMENT = 0.8
BANDS = 24
MOST_TEMPLATES = 2_000
SPLIT = r"[^\p{L}\p{N}]+"
# One row per band: with windows at most 1.5 times as long as a class of templates, a window
# over a text with 0.8 of a template's shingles has a Jaccard similarity of 0.27 or more with
# it, so 24 bands of one row miss it with probability 0.73 ** 24 = 0.0005 at most.
SEEDS = [random.Random(f"band-{b}").getrandbits(64) - (1 << 63) for b in range(BANDS)]

# Notices and opening passages of public licences.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a"
    " copy of this software and associated documentation files (the \"Software\"), to deal in"
    " the Software without restriction, including without limitation the rights to use, copy,"
    " modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "you may not use this file except in compliance with the License. You"
    " may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under"
    " the terms of the GNU General Public License as published by the Free Software Foundation",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International"
    " License.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are"
    " permitted provided that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v."
    " 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"
    " https://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.filter(F.split(F.lower(text), SPLIT), lambda w: w != "")


def shingle_hashes(words: Column) -> Column:
    """Hash of every run of five words; fewer words are one shingle."""
    return let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda each: F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(each) - SHINGLE, F.lit(0))),
            lambda i: F.xxhash64(*(F.get(each, i + k) for k in range(SHINGLE))),
        ),
    )


def shingle_texts(words: Column) -> Column:
    return F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(words) - SHINGLE + 1, F.lit(1))),
        lambda i: F.array_join(F.slice(words, i, SHINGLE), " "),
    )


def band_values(hashes: Column) -> Column:
    """The MinHash of a set of shingles in each band: the hash nearest to the band's seed."""

    def nearest(seed: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: h.bitwiseXOR(F.lit(seed))))

    return F.array(*map(nearest, SEEDS))


def size_class(shingles: int) -> int:
    return 1 << (shingles - 1).bit_length()


def stride(size: int) -> int:
    return max(1, size // 2)


def window(size: int) -> int:
    """Shingles of a window: a text of ``size`` shingles lies whole in one, wherever it is."""
    return size + stride(size) - 1


def _templates(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    rows = [(name, text) for name, text in sorted(templates.items())]
    words = words_of(F.col("text"))
    table = spark.createDataFrame(rows, "license string, text string").select(
        "license", F.array_distinct(shingle_texts(words)).alias("shingles"),
        shingle_hashes(words).alias("hashes"),
    )
    return table.withColumn("bands", band_values(F.col("hashes")))


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: dict[str, str] = TEMPLATES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """One row per document and licence found in it: id, license, containment, first_word.

    A licence is found where a window of the text holds at least ``containment`` of the
    five-word shingles of its template. ``containment`` is the largest share in a window and
    ``first_word`` the place of the first word that belongs to it in a window that matches
    (from 0). Rows repeated under one id are reported once; NULL and empty texts match
    nothing; an empty table gives no rows; other columns are not read. At most 2,000
    templates of one word or more.

    Windows overlap by half or more and come in sizes of powers of two and a half, one for
    each class of template lengths. A window and a template that share a band's MinHash are
    a candidate pair; its shingles are then compared as text. A window can only share a band
    if it holds one of the few shingles that are some template's MinHash, so windows
    without any are passed over, in the scan of the documents and without a shuffle.
    """
    if len(templates) > MOST_TEMPLATES:
        raise ValueError(f"at most {MOST_TEMPLATES} templates")
    spark = docs.sparkSession
    known = stage(_templates(spark, templates), "templates")
    rows = known.select("license", "hashes", "bands").collect()  # of bounded size
    if not all(r["hashes"] and templates[r["license"]].strip() for r in rows):
        raise ValueError("a template without words")
    decisive = sorted(
        {
            h
            for r in rows
            for seed, low in zip(SEEDS, r["bands"])
            for h in r["hashes"]
            if h ^ seed == low
        }
    )
    sizes = sorted({size_class(len(r["hashes"])) for r in rows})
    reach = max(map(window, sizes), default=1)

    def marked(words: Column) -> Column:
        """Places of decisive shingles, each with the words of every window around it."""
        places = F.filter(
            F.transform(
                shingle_hashes(words), lambda h, i: F.when(h.isin(decisive), i)
            ),
            lambda i: i.isNotNull(),
        )
        return F.transform(
            places,
            lambda i: F.struct(
                i.alias("place"),
                F.greatest(i - reach, F.lit(0)).alias("base"),
                F.slice(
                    words, F.greatest(i - reach, F.lit(0)) + 1, F.lit(2 * reach + SHINGLE)
                ).alias("words"),
            ),
        )

    marks = stage(
        docs.select(F.col(id_col).alias("id"), let(words_of(F.col(text_col)), marked).alias("marks")),
        "license-marks",
    )
    classes = F.array(
        *(
            F.struct(F.lit(s).alias("size"), F.lit(window(s)).alias("window"), F.lit(stride(s)).alias("stride"))
            for s in sizes
        )
    )
    near = (
        marks.select("id", F.explode("marks").alias("m"))
        .select("id", "m.place", "m.base", "m.words", F.explode(classes).alias("c"))
        .select("id", "place", "base", "words", "c.*")
    )
    first = F.greatest(F.ceil((F.col("place") - F.col("window") + 1) / F.col("stride")), F.lit(0))
    last = F.floor(F.col("place") / F.col("stride"))
    windows = near.select(
        "id", "base", "words", "size", "window", "stride",
        F.explode(F.sequence(first.cast("int"), last.cast("int"))).alias("number"),
    ).withColumn("start", F.col("number") * F.col("stride")).select(
        "id", "size", "start",
        F.slice("words", F.col("start") - F.col("base") + 1, F.col("window") + SHINGLE - 1).alias("words"),
    )
    banded = windows.select(
        "id", "size", "start", "words",
        F.posexplode(band_values(shingle_hashes(F.col("words")))).alias("band", "value"),
    )
    class_of = F.create_map(
        *(F.lit(x) for r in rows for x in (r["license"], size_class(len(r["hashes"]))))
    )
    bands = known.select(
        "license",
        "shingles",
        class_of[F.col("license")].alias("size"),
        F.posexplode("bands").alias("band", "value"),
    )
    # The table of bands has at most 2,000 x 24 rows.
    pairs = banded.join(F.broadcast(bands), ["size", "band", "value"])
    inside = shingle_texts(F.col("words"))
    compared = pairs.select(
        "id",
        "license",
        (
            F.size(F.array_intersect("shingles", inside)) / F.size("shingles")
        ).alias("containment"),
        (
            F.col("start")
            + F.array_position(F.transform(inside, lambda s: F.array_contains("shingles", s)), True)
            - 1
        ).alias("first_word"),
    )
    return (
        compared.where(F.col("containment") >= containment)
        .groupBy("id", "license")
        .agg(F.max("containment").alias("containment"), F.min("first_word").alias("first_word"))
        .select(F.col("id").alias(id_col), "license", "containment", "first_word")
    )
