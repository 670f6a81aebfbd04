"""License scans: MinHash bands over overlapping text windows, then exact shingle containment.

Templates and texts are cut into shingles of ``SHINGLE`` lower-case words without outer
punctuation. A template of s shingles is looked up in windows of 2w shingles, w the power of two
from s on, one every w shingles: whatever stands in the text as a run of s shingles lies in one
window. A text that holds the share ``SHARE`` of a template there has a Jaccard similarity to
the template of at least ``0.8 s / 2w`` or so; with ``BANDS`` bands of one row each it misses all
bands with a probability of ``(1 - j) ** BANDS``: below 1e-4 for whole templates (j of 1/4 at
worst, 32 bands), below 1e-3 at the threshold. A window retrieves the templates with which it
shares a band; exact containment of the template's shingles decides.

All of it is DataFrame functions and one pass without a shuffle of texts: a text (and a window) with no
template shingle at all shares no band with any template and goes no further. Templates are a
parameter of bounded size, so their bands are broadcast. Results: a row per text and license
found, with the best containment and the first word of the first window that holds it. NULL
and empty texts give no row; templates of fewer than ``SHINGLE`` words are refused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.llm.shared import once, table

SHINGLE = 5
BANDS = 32
SHARE = 0.8
MAX_TEMPLATES = 2000
OUTER = ".,;:!?\"'()[]{}<>*#"

# Public license notices.
LICENSES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",),
    "CC-BY-4.0": ("This work is licensed under a Creative Commons Attribution 4.0 International License.",),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
    "CC-BY-SA-4.0": ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
}


def words_of(text: Column) -> Column:
    plain = F.translate(F.lower(text), OUTER + "\t\n\x0b\x0c\r", " " * (len(OUTER) + 5))
    return F.filter(F.split(plain, " ", -1), lambda w: w != "")


def shingles_of(text: Column) -> Column:
    """Hashes of the runs of ``SHINGLE`` words, in order."""
    def hashes(words: Column) -> Column:
        run = lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(SHINGLE)))
        return F.when(F.size(words) >= SHINGLE, F.transform(F.sequence(F.lit(0), F.size(words) - SHINGLE), run)).otherwise(
            F.array().cast("array<bigint>"))

    return once(words_of(text), hashes)


def bands_of(shingles: Column) -> Column:
    """One minimum per band, each under a hash of its own."""
    def least(seed: int) -> Column:
        return F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, F.lit(seed))))

    return F.array(*map(least, range(BANDS)))


def template_table(spark: SparkSession, licenses: dict[str, tuple[str, ...]]) -> DataFrame:
    """``(license, template, shingles, w)``: the templates' distinct shingles and half the window."""
    rows = [(name, i, text) for name, texts in sorted(licenses.items()) for i, text in enumerate(texts)]
    if len(rows) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    made = spark.createDataFrame(rows, "license string, template int, text string")
    made = made.withColumn("shingles", F.array_distinct(shingles_of(F.col("text")))).withColumn("n", F.size("shingles"))
    return made.select("license", "template", "shingles", "n", F.pow(F.lit(2.0), F.ceil(F.log2("n"))).cast("int").alias("w"))


def scan(docs: DataFrame, licenses: dict[str, tuple[str, ...]] = LICENSES, share: float = SHARE) -> DataFrame:
    """doc_id, license, containment, first_word."""
    spark = docs.sparkSession
    templates = template_table(spark, licenses)
    known = templates.collect()  # the parameter itself
    if any(not t["n"] for t in known):
        raise ValueError(f"a template has fewer than {SHINGLE} words")
    own = sorted({h for t in known for h in t["shingles"]})
    widths = sorted({t["w"] for t in known})
    banded = F.broadcast(templates.select(
        "license", "template", "w", "n", F.col("shingles").alias("wanted"), F.posexplode(once(F.col("shingles"), bands_of)).alias("band", "value")))
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The explode of one element keeps the filter from making the shingles a second time.
    found = (
        text.select("doc_id", F.explode(F.array(shingles_of(F.col("text")))).alias("shingles"))
        .where(F.exists("shingles", lambda h: h.isin(own))))
    size = F.size("shingles")

    def starts_of(w: int) -> Column:
        return F.transform(F.sequence(F.lit(0), size - 1, F.lit(w)), lambda at: F.struct(F.lit(w).alias("w"), at.alias("at")))

    starts = F.flatten(F.array(*map(starts_of, widths)))
    windows = (
        found.withColumn("window", F.explode(starts)).select("doc_id", "window.*", F.slice("shingles", F.col("window.at") + 1, F.col("window.w") * 2).alias("held"))
        .where(F.exists("held", lambda h: h.isin(own))))
    met = windows.select("doc_id", "w", "at", "held", F.posexplode(once(F.col("held"), bands_of)).alias("band", "value")).join(banded, ["w", "band", "value"])
    contained = F.size(F.array_intersect("held", "wanted")) / F.col("n")
    return (
        met.withColumn("containment", contained).where(F.col("containment") >= share)
        .groupBy("doc_id", "license").agg(F.max("containment").alias("containment"), F.min("at").cast("long").alias("first_word")))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


SQL_WORDS = "list_filter(string_split(translate(lower(TEXT), " + quoted(OUTER) + " || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), repeat(' ', " + str(
    len(OUTER) + 5) + ")), ' '), lambda w: w <> '')"
OP4_SQL = f"""
WITH t AS (
  SELECT license, template, list_distinct(list_transform(generate_series(1, len(w) - {SHINGLE - 1}), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' '))) AS wanted
  FROM (SELECT license, template, {SQL_WORDS.replace("TEXT", "text")} AS w FROM (VALUES {", ".join(
      f"({quoted(name)}, {i}, {quoted(text)})" for name, texts in sorted(LICENSES.items()) for i, text in enumerate(texts))}) v(license, template, text))),
tw AS (SELECT *, len(wanted) AS n, CAST(pow(2, ceil(log2(len(wanted)))) AS BIGINT) AS width FROM t),
d AS (
  SELECT doc_id, list_transform(generate_series(1, len(w) - {SHINGLE - 1}), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' ')) AS held
  FROM (SELECT doc_id, {SQL_WORDS.replace("TEXT", "text")} AS w FROM documents WHERE text IS NOT NULL) WHERE len(w) >= {SHINGLE}),
likely AS (SELECT d.* FROM d WHERE list_has_any(held, (SELECT list_distinct(flatten(list(wanted))) FROM t))),
win AS (
  SELECT doc_id, license, n, place AS first_word,
    len(list_intersect(held[place + 1:place + 2 * width], wanted)) / n AS containment
  FROM likely, tw, unnest(generate_series(0, len(held) - 1, width)) AS s(place))
SELECT doc_id, license, max(containment) AS containment, CAST(min(first_word) AS BIGINT) AS first_word
FROM win WHERE containment >= {SHARE} GROUP BY doc_id, license
"""
