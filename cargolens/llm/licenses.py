"""License notices in texts, with column functions only.

Words are runs of letters and digits, A-Z in lower case; shingles have five words.  A
template of n words is looked for in windows of ``size`` words every ``size / 2`` words,
with ``size`` the smallest power of two of at least 2n: any occurrence lies inside a
window.  A window has MinHash values, each a band of its own: ``BANDS`` of them, or as many
more as its templates need.  ``least_similarity`` is that of a full window of different
shingles with just 3/4 of a template's (1/12 for a template of five words, 159 bands); all
bands together miss it with a probability of at most ``MISSED``.  Windows without any shingle
of a template are not hashed at all: their minima cannot meet a template's.  What the bands
retrieve is verified on the shingles themselves, as words: the part of the template's
shingles that the window holds.

All work is inside rows, but for one shuffle of the few retrieved windows.  Templates are
a parameter, and what is broadcast is made from them alone.

Cases: null, empty and short texts hold no notice; rows are looked at one by one, so a
repeated row gives repeated results and a null doc_id stays null; texts of any length are
read whole; with several best windows the first counts; an empty table gives no rows;
templates of fewer than five words are refused; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cargolens.llm.common import let, read

WORDS = 5
BANDS = 64  # at least
MISSED = 1e-6  # highest probability that all bands miss a window
CONTAINED = 75  # percent of a template's shingles

# Public notices.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file"
        " except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met"
    ),
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms"
        " of the GNU General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version."
    ),
    "mit": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files (the Software), to deal in the Software"
        " without restriction"
    ),
}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    low = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.regexp_extract_all(low, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _starts(found: Column) -> Column:
    """1-based starts of the shingles of an array of words."""
    return F.when(
        F.size(found) >= WORDS, F.sequence(F.lit(1), F.size(found) - (WORDS - 1))
    ).otherwise(F.array().cast("array<int>"))


def _hashes(found: Column) -> Column:
    return F.transform(_starts(found), lambda i: F.xxhash64(F.slice(found, i, WORDS)))


def _shingles(found: Column) -> Column:
    joined = F.transform(_starts(found), lambda i: F.array_join(F.slice(found, i, WORDS), " "))
    return F.array_distinct(joined)


def _minima(hashes: Column, bands: int = BANDS) -> Column:
    seeds = F.sequence(F.lit(1), F.lit(bands))
    return F.transform(
        seeds, lambda s: F.array_min(F.transform(hashes, lambda x: F.xxhash64(x, s)))
    )


def window_size(words_of_template: int) -> int:
    """The smallest power of two of at least twice as many words."""
    return 1 << (2 * words_of_template - 1).bit_length()


def least_similarity(shingles: int, size: int) -> float:
    """Of a template of so many shingles and a window of ``size`` words that has enough of them."""
    held = -(-CONTAINED * shingles // 100)
    return held / (max(size - WORDS + 1, held) + shingles - held)


def bands_for(shingles: int, size: int) -> int:
    """Bands that miss such a window with a probability of at most ``MISSED``."""
    similarity = least_similarity(shingles, size)
    return BANDS if similarity == 1 else max(BANDS, math.ceil(math.log(MISSED) / math.log1p(-similarity)))


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """doc_id, license, matched, shingles, first_word of every notice in every text.

    ``matched`` of the template's ``shingles`` are in the best window, which starts at
    ``first_word`` (from 0).
    """
    spark = docs.sparkSession
    known = (
        spark.createDataFrame(sorted(templates.items()), "license string, text string")
        .select("license", words(F.col("text")).alias("w"))
        .select("license", F.size("w").alias("n"), _shingles(F.col("w")).alias("wanted"),
                _hashes(F.col("w")).alias("hashes"))
    )
    sizes = known.select("license", "n", F.size("wanted").alias("shingles")).collect()  # of the templates
    if any(row["n"] < WORDS for row in sizes):
        raise ValueError(f"templates need {WORDS} words or more")
    bands_of: dict[int, int] = {}
    for row in sizes:
        size = window_size(row["n"])
        bands_of[size] = max(bands_of.get(size, 0), bands_for(row["shingles"], size))
    most = max(bands_of.values(), default=BANDS)
    known = known.withColumn("minima", _minima(F.col("hashes"), most)).collect()
    hashes_of: dict[int, set[int]] = {}
    for row in known:
        hashes_of.setdefault(window_size(row["n"]), set()).update(row["hashes"])
    bands = spark.createDataFrame(
        [
            (window_size(row["n"]), band, value, row["license"], row["wanted"])
            for row in known for band, value in enumerate(row["minima"][:bands_of[window_size(row["n"])]])
        ],
        "size int, band int, value long, license string, wanted array<string>",
    )

    def literal(values) -> Column:
        return F.array(*[F.lit(v).cast("long") for v in sorted(values)])

    read_ = docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        let(words(F.col("text")), lambda w: F.struct(w.alias("w"), _hashes(w).alias("h"))).alias("t"),
    ).where(F.arrays_overlap(F.col("t.h"), literal(set().union(*hashes_of.values()))))
    def touched(size: int) -> Column:
        """Windows of one size that hold a shingle of one of its templates."""
        found = F.transform(
            F.sequence(F.lit(0), F.size("t.h"), F.lit(size // 2)),
            lambda start: F.struct(
                F.lit(size).alias("size"),
                start.alias("start"),
                F.slice(F.col("t.h"), start + 1, size - WORDS + 1).alias("h"),
                F.slice(F.col("t.w"), start + 1, size).alias("w"),
            ),
        )
        return F.filter(found, lambda x: F.arrays_overlap(x["h"], literal(hashes_of[size])))

    minima = F.coalesce(*[
        F.when(F.col("x.size") == size, _minima(F.col("x.h"), n)) for size, n in bands_of.items()
    ])
    each = read_.select("row", "doc_id", F.explode(F.concat(*map(touched, hashes_of))).alias("x")).select(
        "row", "doc_id", "x.size", "x.start", "x.w", F.posexplode(minima).alias("band", "value")
    )
    retrieved = (
        each.join(F.broadcast(bands), ["size", "band", "value"])
        .groupBy("row", "doc_id", "size", "start", "license")
        .agg(F.first("w").alias("w"), F.first("wanted").alias("wanted"))
    )
    matched = F.size(F.array_intersect(_shingles(F.col("w")), F.col("wanted")))
    verified = retrieved.select(
        "row", "doc_id", "license", "start", matched.alias("matched"), F.size("wanted").alias("shingles")
    ).where(f"100 * matched >= {CONTAINED} * shingles")
    best = F.max(F.struct("matched", (-F.col("start")).alias("back"), "shingles"))
    return verified.groupBy("row", "doc_id", "license").agg(best.alias("best")).select(
        "doc_id", "license", F.col("best.matched").cast("long").alias("matched"),
        F.col("best.shingles").cast("long").alias("shingles"),
        (-F.col("best.back")).cast("long").alias("first_word"),
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices of all documents."""
    return scan(read(spark, sf_dir, "documents"))


def scan_sql(templates: Mapping[str, str] = TEMPLATES) -> str:
    """The same result by plain containment in every window, for DuckDB."""
    rows = ", ".join(f"('{name}', '{text}')" for name, text in sorted(templates.items()))
    return rf"""
WITH templates(license, text) AS (VALUES {rows}),
wanted AS (
    SELECT license, w, len(w) AS n FROM (
        SELECT license, regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[\p{{L}}\p{{N}}]+') AS w
        FROM templates)
),
template_shingles AS (
    SELECT DISTINCT license, size, array_to_string(w[i:i + 4], ' ') AS shingle
    FROM (SELECT license, w, (2 ** ceil(log2(2 * n)))::BIGINT AS size, unnest(range(1, n - 3)) AS i FROM wanted)
),
totals AS (SELECT license, count(*) AS shingles FROM template_shingles GROUP BY license),
found AS (
    SELECT doc_id, i - 1 AS place, array_to_string(w[i:i + 4], ' ') AS shingle
    FROM (
        SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[\p{{L}}\p{{N}}]+') AS w
            FROM documents)
    )
),
hits AS (
    SELECT doc_id, license, shingle, place, size, (place // (size // 2)) * (size // 2) AS late
    FROM found JOIN template_shingles USING (shingle)
),
in_windows AS (
    SELECT doc_id, license, shingle, late AS start FROM hits WHERE place + 5 <= late + size
    UNION
    SELECT doc_id, license, shingle, late - size // 2 AS start FROM hits
    WHERE late >= size // 2 AND place + 5 <= late - size // 2 + size
),
counted AS (
    SELECT doc_id, license, start, count(DISTINCT shingle) AS matched
    FROM in_windows GROUP BY doc_id, license, start
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id, license ORDER BY matched DESC, start) AS place
    FROM counted JOIN totals USING (license)
)
SELECT doc_id, license, matched::BIGINT AS matched, shingles::BIGINT AS shingles, start::BIGINT AS first_word
FROM ranked WHERE place = 1 AND 100 * matched >= {CONTAINED} * shingles
"""
