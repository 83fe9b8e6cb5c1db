"""License scans by diagonal voting.

Rolling word k-grams of every document are joined to the positions of the same
k-grams in license templates. A match at document word ``p`` and template word
``q`` votes for the diagonal ``p - q``; votes are aggregated by (document,
template, diagonal). For phrase templates a complete diagonal is a place of the
phrase. For long templates neighbouring diagonals (words inserted or left out
shift the diagonal) are merged into a band, and the band's span is verified: it
must cover at least ``MIN_COVER`` of the template's k-grams within a stretch at
most ``MAX_STRETCH`` times the template's length.

Scale: a document's k-gram hashes are tested in its own row against the set of
template hashes (bounded by the templates, a parameter), so only matching grams
are exploded; the join with the template positions is on the gram's words and
thereby exact. What is shuffled is matches, grouped by document.

Defined results: a null text has no words and score 0; repeated rows get equal
rows; rows that share an id but not a text are scanned apart; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edumart.llm.common import ascii_lower, materialize, table

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASE_K, LONG_K = 2, 4
GAP = 4                    # neighbouring diagonals of one band differ by at most this
MIN_COVER = 0.5
MAX_STRETCH = 1.5

# The contract's phrases, and opening passages of public licenses.
PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
            "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License. "
               "You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc", "This work is licensed under a Creative Commons Attribution"),
]


def words_of(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != "")


def template_rows(phrases=PHRASES, templates=TEMPLATES) -> list[tuple]:
    """(template, label, phrase?, k, grams in the template, position, gram)."""
    rows = []
    for t, (label, text, phrase) in enumerate([(a, b, True) for a, b in phrases] + [(a, b, False) for a, b in templates]):
        w = [x for x in re.split(NOT_WORD, text.lower()) if x]
        k = PHRASE_K if phrase else LONG_K
        rows += [(t, label, phrase, k, len(w) - k + 1, q, " ".join(w[q:q + k])) for q in range(len(w) - k + 1)]
    return rows


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", phrases=PHRASES, templates=TEMPLATES) -> tuple[DataFrame, DataFrame]:
    """(documents, spans). ``documents``: doc_id, key, n_words per row of
    ``docs``. ``spans``: doc_id, key, label, phrase (true: a place of a phrase),
    first and last word, cover."""
    spark, rows = docs.sparkSession, template_rows(phrases, templates)
    grams = spark.createDataFrame(rows, "template int, label string, phrase boolean, k int, total int, q int, gram string")
    hashes = {k: [r[0] for r in grams.filter(F.col("k") == k).select(F.xxhash64(*[
        F.get(F.split("gram", " "), F.lit(i)) for i in range(k)])).distinct().collect()] for k in sorted({r[3] for r in rows})}
    base = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("key"), words_of(F.col(text)).alias("w"))

    def found(k: int) -> Column:
        at = lambda i: [F.get(F.col("w"), i + j) for j in range(k)]
        hit = F.filter(F.sequence(F.lit(0), F.size("w") - k), lambda i: F.xxhash64(*at(i)).isin(hashes[k]))
        return F.when(F.size("w") >= k, F.transform(hit, lambda i: F.struct(i.alias("p"), F.concat_ws(" ", *at(i)).alias("gram"))))

    none = F.array().cast("array<struct<p:int,gram:string>>")
    held = materialize(base.select("doc_id", "key", F.size("w").cast("long").alias("n_words"), F.concat(
        *[F.coalesce(found(k), none) for k in hashes]).alias("hits")), "license-hits")
    # repeated rows of one text collapse here; both find the result by (doc_id, key) later
    matches = held.select("doc_id", "key", F.explode("hits").alias("x")).select("doc_id", "key", "x.p", "x.gram").distinct() \
        .join(grams, "gram")
    who = ["doc_id", "key", "template", "label", "phrase", "k", "total"]
    diagonals = matches.groupBy(*who, (F.col("p") - F.col("q")).alias("diagonal")).agg(
        F.count(F.lit(1)).alias("votes"), F.min("p").alias("lo"), F.max("p").alias("hi"), F.collect_set("q").alias("qs"))
    places = diagonals.filter("phrase and votes = total").select(
        "doc_id", "key", "label", "phrase", F.col("diagonal").cast("long").alias("first"),
        (F.col("hi") + F.col("k") - 1).cast("long").alias("last"), F.lit(1.0).alias("cover"))
    w = Window.partitionBy(*who).orderBy("diagonal")
    new = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(w) > GAP, F.lit(True))
    bands = diagonals.filter("not phrase").withColumn("new", new.cast("int")).withColumn("band", F.sum("new").over(w)) \
        .groupBy(*who, "band").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                                   F.size(F.array_distinct(F.flatten(F.collect_list("qs")))).alias("n"))
    length, limit = F.col("hi") + F.col("k") - F.col("lo"), (F.col("total") + F.col("k") - 1) * MAX_STRETCH
    spans = bands.filter(length <= limit).select(
        "doc_id", "key", "label", "phrase", F.col("lo").cast("long").alias("first"),
        (F.col("hi") + F.col("k") - 1).cast("long").alias("last"), (F.col("n") / F.col("total")).alias("cover"))
    return held.select("doc_id", "key", "n_words"), places.unionByName(spans)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, spans = scan(table(spark, sf_dir, "documents"))
    label = lambda cond: F.array_join(F.array_sort(F.collect_set(F.when(cond, F.col("label")))), ",")
    per = spans.groupBy(F.col("doc_id").alias("d"), F.col("key").alias("h")).agg(
        F.count_if("phrase").alias("n_base"), F.min(F.when(F.col("phrase"), F.col("first"))).alias("first_word"),
        F.max(F.when(F.col("phrase"), F.col("first"))).alias("last_word"), label(F.col("phrase")).alias("base_labels"),
        label(F.col("cover") >= MIN_COVER).alias("labels"), F.max("cover").alias("score"))
    out = docs.join(per, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("key").eqNullSafe(F.col("h")), "left")
    return out.select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
                      F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
                      F.coalesce("score", F.lit(0.0)).alias("score"))
