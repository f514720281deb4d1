"""License scan: sparse TF-IDF cosine of headers and licence files to
templates, then inheritance from the nearest ancestor directory.

Every line, paragraph and sentence of a file is a possible header, and a file
as a whole a possible licence file. Headers are compared with short forms and
standard notices, whole files with full licence texts, too. All are bags of words, compared with the templates by the
cosine of TF-IDF vectors. A word's document frequency is counted over all
files for the templates' words; any other word has the weight of a word that
no file holds, so it only makes a header less like a template.

A whole file is compared with a full text only if the words that both hold
have ``threshold`` of the text's length; none above the threshold is lost.
A line, paragraph or sentence can only reach ``threshold`` if it holds one of a template's rarer
words: the cosine is at most the share of the template's length in the words
that both hold. The commonest words whose share stays below the threshold in
every template are therefore not searched for, and lines without the others
are skipped; no line above the threshold is.

A file without a header of its own takes the licence of the licence file in
its directory or the nearest directory above, by joining the file's ancestor
directories with those of licence files. All DataFrame operations; broadcast
are the templates (``MAX_TERMS`` words at most) and, up to
``common.BROADCAST_ROWS``, the numbers of files that may be full texts.

Defined results: NULL and empty texts have no licence of their own and may
inherit one; of equally good templates the first by name counts, of several
licence files in a directory the one with the smallest path; a NULL path
inherits nothing; rows that repeat are answered each; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import ascii_lower, rows_in, written

THRESHOLD = 0.6
MAX_TERMS = 10_000
#: Short forms of licence headers.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "bsd-3-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
#: The notices that files carry, by licence.
NOTICES = {
    "apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "gpl-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl-2.1": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}
#: Where texts are cut into units: lines; paragraphs, the runs of lines between
#: those without letters or digits; sentences, also across lines.
UNITS = ("\n", r"\n(?:[^A-Za-z0-9\n]*\n)+", r"[.!?:;](?=\s)\s*|\n(?:[^A-Za-z0-9\n]*\n)+")
#: Full licence texts, one file each; only whole files are compared with them.
FULL_TEXTS = Path(__file__).parent / "license_texts"


def full_texts() -> dict[str, str]:
    return {p.stem: p.read_text(encoding="utf-8") for p in sorted(FULL_TEXTS.glob("*.txt"))}


def _words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), "[^a-z0-9]+"), "")


def _bags(units: DataFrame, at: list[str]) -> DataFrame:
    """(*at, term, tf) of units with a ``text``."""
    return units.select(*at, F.explode(_words(F.col("text"))).alias("term")).groupBy(*at, "term").agg(
        F.count(F.lit(1)).alias("tf"))


def _rare(weights: dict[str, dict[str, float]], idf: dict[str, float], threshold: float) -> list[str]:
    """The words of which a unit above ``threshold`` holds at least one."""
    common: list[str] = []
    for term in sorted(idf, key=lambda t: (idf[t], t)):
        trial = {*common, term}
        share = max(math.sqrt(sum(w * w for t, w in v.items() if t in trial) / sum(w * w for w in v.values()))
                    for v in weights.values())
        if share >= threshold - 1e-9:
            break
        common.append(term)
    return sorted(set(idf) - set(common))


def scan_licenses(files: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD,
                  path_col: str = "path", text_col: str = "text") -> DataFrame:
    """(row, path, header, header_similarity, is_license_file, inherited,
    inherited_from, license) of each file (path, text)."""
    spark = files.sparkSession
    given_texts = [(name, text) for name, text in (templates or TEMPLATES).items()]
    given_texts += [] if templates else [*NOTICES.items(), *full_texts().items()]
    full = set() if templates else {f"{i}" for i in range(len(TEMPLATES) + len(NOTICES), len(given_texts))}
    notices = set() if templates else {f"{i}" for i in range(len(TEMPLATES), len(TEMPLATES) + len(NOTICES))}
    license_of = {f"{i}": name for i, (name, _) in enumerate(given_texts)}
    templates = {f"{i}": text for i, (_, text) in enumerate(given_texts)}
    named = spark.createDataFrame(list(templates.items()), "template string, text string")
    bags: dict[str, dict[str, int]] = {name: {} for name in templates}
    for r in _bags(named, ["template"]).collect():  # the templates' own words
        bags[r["template"]][r["term"]] = r["tf"]
    vocabulary = sorted({t for bag in bags.values() for t in bag})
    if len(vocabulary) > MAX_TERMS:
        raise ValueError(f"templates hold over {MAX_TERMS} words")

    # Numbered once (each scan would number anew, after how it splits the
    # files), and split into words once: later scans read ``held``.
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = written(files.select(
        F.monotonically_increasing_id().alias("row"), F.col(path_col).alias("path"), text.alias("text"),
        F.array_intersect(_words(text), F.array(*map(F.lit, vocabulary))).alias("held")), "numbered")
    seen = {r[0]: r[1] for r in source.select(F.explode("held").alias("term")).groupBy("term").count().collect()}  # by word of a template
    n = source.count()
    unseen = math.log(1 + n) + 1
    idf = {t: math.log((1 + n) / (1 + seen.get(t, 0))) + 1 for t in vocabulary}
    weights = {name: {t: tf * idf[t] for t, tf in bag.items()} for name, bag in bags.items()}
    short = {name: v for name, v in weights.items() if name not in full}
    rare = _rare(short, {t: idf[t] for v in short.values() for t in v}, threshold)
    sought = rf"(?i)(?<![a-z0-9])(?:{'|'.join(rare)})(?![a-z0-9])"

    is_hit = F.arrays_overlap("held", F.array(*map(F.lit, rare)))  # what ``sought`` finds in the whole text
    hits = source.where(is_hit)
    parts = F.concat(*[F.split("text", cut) for cut in UNITS])
    parts = hits.select("row", F.posexplode(parts).alias("line", "text"))
    units = parts.where(F.col("text").rlike(sought)).select("row", "line", "text").unionByName(hits.select("row", F.lit(-1).alias("line"), "text"))
    if full:  # whole texts that could reach the threshold: enough of a full text's length is in the words that both hold
        share = spark.createDataFrame(
            [(name, t, w * w / sum(x * x for x in weights[name].values())) for name in sorted(full) for t, w in weights[name].items()],
            "template string, term string, share double")
        could = written(
            source.where(~is_hit).select("row", F.explode("held").alias("term")).join(F.broadcast(share), "term")
            .groupBy("row", "template").agg(F.sum("share").alias("share"))
            .where(F.col("share") >= threshold ** 2 - 1e-9).select("row").distinct(), "could")
        could = rows_in(source, could)
        units = units.unionByName(could.select("row", F.lit(-1).alias("line"), "text"))
    at = ["row", "line"]
    terms = written(_bags(units, at), "unit_terms")
    table = spark.createDataFrame(
        [(name, t, w / math.sqrt(sum(x * x for x in v.values())), idf[t]) for name, v in weights.items() for t, w in v.items()],
        "template string, term string, weight double, idf double")
    forms = [name for name in templates if name not in full | notices]
    plain = F.col("template").isin(forms)  # short forms take all other words as unseen, those of longer templates too
    vocabulary_idf = table.groupBy("term").agg(F.max("idf").alias("idf"), F.max(F.when(plain, F.col("idf"))).alias("plain_idf"))
    norms = terms.join(F.broadcast(vocabulary_idf), "term", "left").groupBy(*at).agg(
        *[F.sqrt(F.sum(F.pow(F.col("tf") * F.coalesce(x, F.lit(unseen)), 2))).alias(f"norm_{x}") for x in ("idf", "plain_idf")])
    dots = terms.join(F.broadcast(table), "term").groupBy(*at, "template").agg(
        F.sum(F.col("tf") * F.col("idf") * F.col("weight")).alias("dot"))
    scored = dots.join(norms, at).select(*at, "template", F.round(F.col("dot") / F.when(plain, F.col("norm_plain_idf")).otherwise(F.col("norm_idf")), 9).alias("similarity"))
    scored = scored.where(F.col("similarity") >= threshold)
    scored = scored.where(~F.col("template").isin(sorted(full)) & (F.col("line") >= 0) | ~F.col("template").isin(sorted(notices)) & (F.col("line") < 0))
    names = sorted(set(license_of.values()))
    scored = scored.withColumn("template", F.element_at(F.create_map(*[F.lit(x) for pair in license_of.items() for x in pair]), F.col("template")))
    best = F.max_by(F.struct("template", "similarity"), F.struct("similarity", -F.col("line"), -_order("template", names)))
    own = scored.groupBy("row").agg(
        best.alias("best"), (F.min("line") == -1).alias("is_license_file"))
    known = written(source.select("row", "path").join(own, "row", "left").select(
        "row", "path", F.col("best.template").alias("header"), F.col("best.similarity").alias("header_similarity"),
        F.coalesce("is_license_file", F.lit(False)).alias("is_license_file"),
        F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("directory")), "headers")

    given = known.where("is_license_file and path is not null").groupBy("directory").agg(
        F.min_by(F.struct("path", "header"), "path").alias("given"))
    parts = F.split("directory", "/")
    above = known.where("header is null and path is not null").select(
        "row", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.struct(
            k.alias("depth"), F.array_join(F.slice(parts, 1, k), "/").alias("directory")))).alias("up"))
    inherited = above.select("row", "up.*").join(given, "directory").groupBy("row").agg(F.max_by("given", "depth").alias("given"))
    return known.join(inherited, "row", "left").select(
        "row", "path", "header", "header_similarity", "is_license_file",
        F.col("given.header").alias("inherited"), F.col("given.path").alias("inherited_from"),
        F.coalesce("header", "given.header").alias("license"))


def _order(column: str, templates: list[str]) -> Column:
    return F.element_at(F.create_map(*[x for i, t in enumerate(templates) for x in (F.lit(t), F.lit(i))]), F.col(column))
