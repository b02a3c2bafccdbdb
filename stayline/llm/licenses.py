"""License scan: MinHash bands over overlapping windows of words, then exact containment.

Words are runs of ASCII letters and digits, lower case. A text is read in windows of
``SIZE`` words that start every ``STRIDE`` words, so every template of up to
``SIZE - STRIDE + 1`` words lies whole in some window, wherever it stands. Windows and
templates are sets of 3-word shingles, sketched by ``BANDS`` MinHash values of one row each:
a window that holds all of a template of t shingles has similarity of at least
t / (SIZE - 2), and meets it in some band with probability 1 - (1 - t / (SIZE - 2)) ** BANDS,
which is over 1 - 1e-8 for the shortest template here; a window that just meets
``CONTAINED`` shares no fewer shingles. A retrieved template counts if the window contains at least that share of
its shingles, counted exactly, and all that name the license: those with a number and those that begin with a
word of ``NAMING``. Licenses that differ in a version or one word of their name are so told apart.

Windows that have no rare word of any template (``signal_words``) can't contain enough of
one, and are skipped before they are sketched; this never changes the result.

Built of DataFrame functions. Nothing is shuffled but the found pairs of text and template.
The templates' sketches, a table of fixed size, are broadcast.

Null and empty texts have no license. Repeated rows each add to their id's counts; a null
doc_id is a group of its own. Columns besides ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stayline.llm.batches import documents

SIZE, STRIDE, SHINGLE, BANDS, CONTAINED = 24, 8, 3, 128, 0.85

# Words after which the GNU licenses differ.
NAMING = ("gnu", "lesser", "affero")

# The notices by which texts name their license, and passages of licenses that stand in no other
# one here, as the licenses word them.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "LGPL-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "Lesser General Public License as published by the Free Software Foundation, either version 3 of the",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "Affero General Public License as published by the Free Software Foundation, either version 3 of the",
    ],
    "MPL-2.0": ["subject to the terms of the Mozilla Public License, v. 2.0."],
    "EPL-2.0": ["made available under the terms of the Eclipse Public License 2.0"],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Neither the name of the copyright holder nor the names of its contributors may be used to",
    ],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose"],
    "Zlib": ["Altered source versions must be plainly marked as such, and must not be misrepresented as being"],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software",
    ],
    "CC0-1.0": ["dedicated to the public domain under CC0 1.0 Universal."],
    "CC-BY-4.0": ["Licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
}


def template_words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def template_shingles() -> list[tuple[int, str, list[str]]]:
    """(template number, license, distinct shingles)"""
    flat = [(name, text) for name, texts in TEMPLATES.items() for text in texts]
    out = []
    for number, (name, text) in enumerate(flat):
        words = template_words(text)
        if not SHINGLE <= len(words) <= SIZE - STRIDE + 1:
            raise ValueError(f"a template of {name} has {len(words)} words")
        out.append((number, name, sorted({" ".join(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)})))
    return out


def needed(shingles: int) -> int:
    """Shingles of a template that a window must contain."""
    return -int(-shingles * CONTAINED // 1)


def naming(shingles: list[str]) -> list[str]:
    """Shingles that a window must have in any case."""
    return [s for s in shingles if s.split()[0] in NAMING or any(w.isdigit() for w in s.split())]


def signal_words() -> list[str]:
    """Words of which every window that contains enough of any template has at least one.

    For each template the longest words are taken until the shingles without any of them
    are fewer than a match needs.
    """
    chosen: set[str] = set()
    for _, _, shingles in template_shingles():
        spare = list(shingles)
        for word in sorted({w for s in shingles for w in s.split()}, key=lambda w: (-len(w), w)):
            spare = [s for s in spare if not chosen.intersection(s.split())]
            if len(spare) < needed(len(shingles)):
                break
            chosen.add(word)
    return sorted(chosen)


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _sketch(hashes: Column) -> Column:
    """``BANDS`` MinHash values of an array of shingle hashes."""
    numbers = F.sequence(F.lit(0), F.lit(BANDS - 1))
    # The outer lambda binds the hashes, which would otherwise be computed for every band.
    return F.get(F.transform(F.array(hashes), lambda bound: F.transform(numbers, lambda k: F.array_min(F.transform(bound, lambda h: F.xxhash64(h, k))))), 0)


def windows(docs: DataFrame) -> DataFrame:
    """(doc_id, first, shingles) of every window that may hold a template; ``first`` is its first word's place."""
    signals = signal_words()
    # lower() also changes letters beyond ASCII, but keeps every ASCII word; it is much faster than translate().
    # Bound to a lambda's variable, it is computed once for all words.
    shortest = [s for s in signals if not any(t != s and t in s for t in signals)]
    screened = F.exists(F.array(F.lower("text")), lambda x: reduce(lambda a, b: a | b, (x.contains(s) for s in shortest)))
    texts = documents(docs).where(screened)
    words = texts.select("doc_id", F.filter(F.split(_lower(F.col("text")), "[^a-z0-9]+"), lambda w: w != "").alias("words"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(STRIDE))
    literal = F.array(*(F.lit(s) for s in signals))
    held = F.filter(starts, lambda i: F.arrays_overlap(F.slice("words", i + 1, F.lit(SIZE)), literal))
    window = F.slice("words", F.col("first") + 1, F.lit(SIZE))
    placed = words.select("doc_id", "words", F.explode(held).alias("first")).select("doc_id", "first", window.alias("w"))
    grams = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("w") - (SHINGLE - 1), F.lit(1))), lambda i: F.array_join(F.slice("w", i, F.lit(SHINGLE)), " ")
    )
    return placed.where(F.size("w") >= SHINGLE).select("doc_id", "first", F.array_distinct(grams).alias("shingles"))


def _templates(spark: SparkSession) -> DataFrame:
    """(template, license, wanted, needed, named, sketch): one row per template, whatever the corpus."""
    rows = [
        f"SELECT {n} AS template, '{name}' AS license, array({', '.join(repr(s) for s in shingles)}) AS wanted, {needed(len(shingles))} AS needed,"
        f" CAST(array({', '.join(repr(s) for s in naming(shingles))}) AS array<string>) AS named"
        for n, name, shingles in template_shingles()
    ]
    table = spark.sql(" UNION ALL ".join(rows))
    return table.withColumn("sketch", _sketch(F.transform("wanted", lambda s: F.xxhash64(s))))


def find_licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, license, containment, n_windows, first_word) per text id and license found."""
    spark = docs.sparkSession
    known = _templates(spark)
    bands = F.broadcast(known.select("template", F.posexplode("sketch").alias("band", "value")))  # BANDS rows a template
    sketched = windows(docs).withColumn("sketch", _sketch(F.transform("shingles", lambda s: F.xxhash64(s))))
    met = sketched.select("doc_id", "first", "shingles", F.posexplode("sketch").alias("band", "value")).join(bands, ["band", "value"])
    # A window meets a template in several bands; counting shared shingles once more is harmless, as only extremes are kept.
    checked = met.join(F.broadcast(known.select("template", "license", "wanted", "needed", "named")), "template").withColumn(
        "shared", F.size(F.array_intersect("wanted", "shingles"))
    )
    return (
        checked.where((F.col("shared") >= F.col("needed")) & (F.size(F.array_except("named", "shingles")) == 0))
        .groupBy("doc_id", "license")
        .agg(
            F.max(F.col("shared").cast("double") / F.size("wanted")).alias("containment"),
            F.countDistinct("first").alias("n_windows"),
            F.min("first").cast("bigint").alias("first_word"),
        )
    )


def oracle_sql() -> str:
    """Every window of every text against every template, without sketches."""
    values = ", ".join(f"('{name}', [{', '.join(repr(s) for s in sh)}], {needed(len(sh))}, CAST([{', '.join(repr(s) for s in naming(sh))}] AS VARCHAR[]))" for _, name, sh in template_shingles())
    return f"""
    WITH t(license, wanted, needed, named) AS (VALUES {values}
    ), w AS (
      SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+'), lambda x: x <> '') AS words FROM documents
    ), p AS (SELECT doc_id, words, unnest(range(0, greatest(len(words), 1), {STRIDE})) AS first FROM w
    ), s AS (
      SELECT doc_id, first, list_distinct(list_transform(range(first + 1, least(first + {SIZE}, len(words)) - {SHINGLE - 2}),
        lambda i: array_to_string(words[i:i + {SHINGLE - 1}], ' '))) AS shingles FROM p
    ), m AS (
      SELECT doc_id, license, first, len(list_intersect(wanted, shingles)) AS shared, len(wanted) AS n, needed
      FROM s, t WHERE list_has_any(shingles, wanted) AND list_has_all(shingles, named)
    )
    SELECT doc_id, license, max(CAST(shared AS DOUBLE) / n) AS containment, count(DISTINCT first) AS n_windows, min(first) AS first_word
    FROM m WHERE shared >= needed GROUP BY doc_id, license
    """
