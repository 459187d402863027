"""License scans (DataFrame functions only).

Sentences that speak of a licence (headers, and the text of licence files) are
compared with licence templates by cosine of sparse TF-IDF vectors. Equal
sentences are compared once, with their number as weight in the document
frequencies. A file's licence is that of its best sentence. A file whose words
are mostly licence sentences, or that is named like one, is a licence file and
speaks for its directory: files that name no licence of their own inherit that
of the nearest ancestor directory that has one, found by joining each distinct
directory's ancestors with the licensed directories.

Defined cases: null or empty texts name no licence; a null path has no
directory and inherits nothing; ties go to the licence, then the path, that
sorts first; rows that repeat get equal results; an empty table gives no rows;
further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import ascii_lower, stored, word_count

# Notices by which files name these licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
CUES = "licen[sc]e|copyright|free software|permission is|redistribution"
NAMES = "^(licen[sc]e|copying|unlicense|notice)([.-].*)?$"
COSINE = 0.6
SHARE = 0.5
_SENTENCE = "[.!?][ \\t\\r]+|\\n"
_TOKEN = "[a-z0-9]+"


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(f"({_TOKEN})"), F.lit(1))


def sentences(files: DataFrame) -> DataFrame:
    """path, sentence and length for every sentence that speaks of a licence;
    the lengths of a file's rows add up to its number of words."""
    cue = files.filter(ascii_lower(F.col("text")).rlike(CUES))
    spoken = F.filter(F.split("text", _SENTENCE), lambda s: ascii_lower(s).rlike(CUES))
    found = cue.select("path", F.size(_tokens(F.col("text"))).alias("words"), F.posexplode(spoken).alias("at", "sentence"))
    return found.select("path", "sentence", F.when(F.col("at") == 0, F.col("words")).otherwise(0).alias("length"))


def match_templates(units: DataFrame, cosine: float = COSINE) -> DataFrame:
    """sentence, license, score: the best template of each distinct sentence of
    ``units`` (sentence, n), where its cosine reaches the threshold."""
    spark = units.sparkSession
    terms = units.select("sentence", "n", F.explode(_tokens(F.col("sentence"))).alias("term")).groupBy("sentence", "n", "term").agg(F.count("*").alias("tf"))
    terms = stored(terms, "terms")
    total = units.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    df = stored(terms.groupBy("term").agg(F.sum("n").alias("df")).crossJoin(F.broadcast(total)), "frequencies")  # total is one row
    idf = (F.log((1.0 + F.col("total")) / (1.0 + F.col("df"))) + 1.0).alias("idf")
    weights = stored(terms.join(df.select("term", idf), "term").select("sentence", "term", (F.col("tf") * F.col("idf")).alias("w")), "weights")

    plates = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(TEMPLATES)], "template int, license string, notice string")
    words = plates.select("template", "license", F.explode(_tokens(F.col("notice"))).alias("term")).groupBy("template", "license", "term").agg(F.count("*").alias("tf"))
    seen = words.join(df.select("term", "total", idf), "term", "left").crossJoin(F.broadcast(total.select(F.col("total").alias("all"))))
    plate = seen.select("template", "license", "term", (F.col("tf") * F.coalesce("idf", F.log(1.0 + F.col("all")) + 1.0)).alias("v"))
    plate = stored(plate, "template-weights")
    norms = plate.groupBy("template").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("vn"))
    plate = plate.join(norms, "template")

    sizes = weights.groupBy("sentence").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("wn"))
    dots = weights.join(plate, "term").groupBy("sentence", "template", "license", "vn").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    scored = dots.join(sizes, "sentence").select("sentence", "license", F.round(F.col("dot") / (F.col("wn") * F.col("vn")), 6).alias("score"))
    best = scored.filter(F.col("score") >= cosine).groupBy("sentence").agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("b"))
    return best.select("sentence", F.col("b.license").alias("license"), (-F.col("b.s")).alias("score"))


def _directory(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def scan(files: DataFrame, cosine: float = COSINE, share: float = SHARE) -> DataFrame:
    """path, license, basis (header, file, inherited, or null), score and origin
    (the directory inherited from) per row of ``files`` (path, text)."""
    files = files.select("path", "text")
    named = stored(sentences(files), "sentences")
    units = stored(named.groupBy("sentence").agg(F.count("*").alias("n")), "units")
    best = stored(match_templates(units, cosine), "matched")
    size = F.when(F.col("license").isNotNull(), F.size(_tokens(F.col("sentence"))))
    least = F.min(F.when(F.col("license").isNotNull(), F.struct((-F.col("score")).alias("s"), "license"))).alias("b")
    of_file = named.join(best, "sentence", "left").groupBy("path").agg(least, F.sum(size).alias("licensed"), F.sum("length").alias("length"))
    own = of_file.filter("b IS NOT NULL").select("path", F.col("b.license").alias("license"), (-F.col("b.s")).alias("score"), "licensed", "length")
    own = stored(own, "own-licenses")

    is_named = F.lower(F.regexp_extract("path", "([^/]*)$", 1)).rlike(NAMES)
    speaks = own.filter(is_named | (F.col("licensed") >= share * F.col("length")))
    speaks = stored(speaks.select("path", "license", "score"), "licence-files")
    of_dir = speaks.groupBy(_directory(F.col("path")).alias("dir")).agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("b"))
    of_dir = stored(of_dir.select(F.col("dir").alias("origin"), F.col("b.license").alias("license"), (-F.col("b.s")).alias("score")), "licensed-directories")

    # Every distinct directory and its ancestors: a/b/c, a/b, a, and the root.
    dirs = files.filter("path IS NOT NULL").select(_directory(F.col("path")).alias("dir")).distinct()
    parts = F.split("dir", "/")
    steps = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    above = dirs.select("dir", F.explode(F.array_distinct(steps)).alias("origin")).join(of_dir, "origin")
    nearest = above.groupBy("dir").agg(F.max_by(F.struct("origin", "license", "score"), F.length("origin")).alias("near"))
    nearest = stored(nearest.select(F.col("dir").alias("_dir"), "near"), "inherited")

    mine = own.select(F.col("path").alias("_path"), F.struct("license", "score").alias("own"))
    mine = mine.join(speaks.select(F.col("path").alias("_path"), F.lit(True).alias("is_file")), "_path", "left")
    mine = stored(mine, "own-or-file")
    found = files.select("path").join(mine, F.col("path") == F.col("_path"), "left").join(nearest, _directory(F.col("path")) == F.col("_dir"), "left")
    basis = F.when(F.col("is_file"), "file").when(F.col("own").isNotNull(), "header").when(F.col("near").isNotNull(), "inherited")
    return found.select(
        "path",
        F.coalesce("own.license", "near.license").alias("license"),
        basis.alias("basis"),
        F.coalesce("own.score", "near.score").alias("score"),
        F.when(F.col("own").isNull(), F.col("near.origin")).alias("origin"),
    )


def op6_licenses(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    # Rows without an id share a path, as rows that repeat one do.
    path = F.concat_ws("/", F.coalesce("source", F.lit("_")), F.coalesce("lang", F.lit("_")), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    found = scan(docs.select(path.alias("path"), "text"))
    return found.select(F.element_at(F.split("path", "/"), -1).try_cast("long").alias("doc_id"), "license", "basis", "score", "origin")


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLATES = ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(TEMPLATES))
OP6_SQL = rf"""
WITH files AS (SELECT doc_id, concat_ws('/', coalesce(source, '_'), coalesce(lang, '_')) AS dir, text FROM documents),
named AS (SELECT doc_id, sentence FROM (SELECT doc_id, unnest(string_split_regex(text, '[.!?][ \t\r]+|\n')) AS sentence FROM files
  WHERE regexp_matches({_LOWER.format('text')}, '{CUES}')) WHERE regexp_matches({_LOWER.format('sentence')}, '{CUES}')),
units AS (SELECT sentence, count(*) AS n FROM named GROUP BY sentence),
terms AS (SELECT sentence, n, term, count(*) AS tf FROM (SELECT sentence, n, unnest(regexp_extract_all({_LOWER.format('sentence')}, '{_TOKEN}')) AS term FROM units) GROUP BY ALL),
tot AS (SELECT coalesce(sum(n), 0)::DOUBLE AS total FROM units),
df AS (SELECT term, ln((1.0 + total) / (1.0 + sum(n)::DOUBLE)) + 1.0 AS idf FROM terms, tot GROUP BY term, total),
weights AS (SELECT sentence, term, tf * idf AS w FROM terms JOIN df USING (term)),
plates AS (SELECT template, license, term, count(*) AS tf FROM (SELECT template, license, unnest(regexp_extract_all({_LOWER.format('notice')}, '{_TOKEN}')) AS term
  FROM (VALUES {_PLATES}) AS v(template, license, notice)) GROUP BY ALL),
plate AS (SELECT template, license, term, tf * coalesce(idf, ln(1.0 + total) + 1.0) AS v FROM plates LEFT JOIN df USING (term), tot),
pn AS (SELECT template, sqrt(sum(v * v)) AS vn FROM plate GROUP BY template),
wn AS (SELECT sentence, sqrt(sum(w * w)) AS wn FROM weights GROUP BY sentence),
dots AS (SELECT sentence, template, license, sum(w * v) AS dot FROM weights JOIN plate USING (term) GROUP BY ALL),
scored AS (SELECT sentence, license, round(dot / (wn * vn), 6) AS score FROM dots JOIN wn USING (sentence) JOIN pn USING (template)),
best AS (SELECT sentence, license, score FROM (SELECT *, row_number() OVER (PARTITION BY sentence ORDER BY score DESC, license) AS r FROM scored WHERE score >= {COSINE}) WHERE r = 1),
hits AS (SELECT doc_id, license, score, len(regexp_extract_all({_LOWER.format('sentence')}, '{_TOKEN}')) AS words FROM named JOIN best USING (sentence)),
own AS (SELECT doc_id, license, score, licensed FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license) AS r, sum(words) OVER (PARTITION BY doc_id) AS licensed FROM hits) WHERE r = 1),
speaks AS (SELECT own.doc_id, dir, license, score FROM own JOIN files USING (doc_id) WHERE licensed >= {SHARE} * len(regexp_extract_all({_LOWER.format('text')}, '{_TOKEN}'))),
dirs AS (SELECT dir, license, score FROM (SELECT *, row_number() OVER (PARTITION BY dir ORDER BY score DESC, license) AS r FROM speaks) WHERE r = 1)
SELECT f.doc_id, coalesce(o.license, d.license) AS license,
  CASE WHEN s.doc_id IS NOT NULL THEN 'file' WHEN o.doc_id IS NOT NULL THEN 'header' WHEN d.dir IS NOT NULL THEN 'inherited' END AS basis,
  coalesce(o.score, d.score) AS score, CASE WHEN o.doc_id IS NULL THEN d.dir END AS origin
FROM files f LEFT JOIN own o USING (doc_id) LEFT JOIN speaks s USING (doc_id) LEFT JOIN dirs d ON f.dir = d.dir
"""
