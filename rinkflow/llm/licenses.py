"""License scans by diagonal voting, in DataFrame functions alone.

Every pair of neighbouring words of a text is hashed and joined to the places
where the templates hold that pair; the words themselves decide, so a vote is
one of equal words.  A match votes for the diagonal on which the template would
lie (place in the text less place in the template).  A diagonal that all places
of a template vote for is an exact place of it.  Otherwise a diagonal is seen
with those beside it, as words put in or left out only shift the votes; each
place of the template counts once there, and of overlapping spans the one with
most places stays if it holds enough of the template.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Phrases whose exact places count, with their labels (fixed values of the contract).
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
#: Sentences of well-known public licenses, as words, with labels of our own.
TEMPLATES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "mit"),
    ("the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability", "mit"),
    ("licensed under the apache license version 2 0 you may not use this file except in compliance with the license", "apache"),
    ("unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "apache"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of", "gpl"),
    ("under the terms of the gnu lesser general public license as published by the free software foundation", "lgpl"),
    ("under the terms of the gnu affero general public license as published by the free software foundation", "agpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this work is licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("to the extent possible under law the author has dedicated all copyright and related and neighboring rights to the public domain worldwide", "cc0"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("the accompanying materials are made available under the terms of the eclipse public license", "epl"),
    ("distributed under the boost software license version 1 0", "boost"),
    ("this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages", "zlib"),
]
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Diagonals this far from one are seen with it; share of a template's pairs that a span must hold.
DRIFT, COVERAGE = 3, 0.6


def words_of(text: Column) -> Column:
    """Words of a text with A-Z lowered.

    ``lower`` treats letters beyond ASCII too, which no phrase holds; the two of
    them that would become ASCII letters are set aside first.
    """
    kept = F.replace(F.replace(text, F.lit("K"), F.lit("ÿ")), F.lit("İ"), F.lit("ÿ"))
    return F.array_remove(F.split(F.lower(kept), SEPARATORS), "")


def _pairs(words: str) -> Column:
    """All pairs of neighbouring words of a column of words, in order, with their hashes."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.struct(F.xxhash64(a, b).alias("pair"), a.alias("a"), b.alias("b")))


def _templates(spark, phrases, templates) -> DataFrame:
    rows = [(i, label, base, text) for i, (text, label, base) in enumerate([(*p, True) for p in phrases] + [(*t, False) for t in templates])]
    if any(not 2 <= len(text.split(" ")) <= 64 for *_, text in rows):
        raise ValueError("a template has two words at least and 64 at most")  # its places are bits of a number
    values = ", ".join(f"({i}, '{label}', {str(base).lower()}, '{text}')" for i, label, base, text in rows)
    t = spark.sql(f"select * from values {values} as t(template, label, base, phrase)").withColumn("words", F.split("phrase", " "))
    return t.select("template", "label", "base", (F.size("words") - 1).alias("pairs"), F.posexplode(_pairs("words")).alias("place", "known")).select("template", "label", "base", "pairs", "place", "known.*")


def spans(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """(doc_id, text_hash, template, label, base, start_word, end_word, coverage) of all verified spans."""
    known = F.broadcast(_templates(docs.sparkSession, phrases, templates))  # a table of constants
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    # the words stand in a step of their own, or each pair would split the text again
    worded = text.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("words"))
    grams = worded.select("doc_id", "text_hash", F.posexplode(_pairs("words")).alias("at", "seen")).select("doc_id", "text_hash", "at", "seen.*")
    place = ["doc_id", "text_hash", "template", "label", "base", "pairs"]
    matches = grams.join(known, ["pair", "a", "b"])
    bit = F.expr("shiftleft(1L, place)")
    votes = matches.groupBy(*place, (F.col("at") - F.col("place")).alias("diagonal")).agg(F.bit_or(bit).alias("own"), F.min("at").alias("first"), F.max("at").alias("last"))
    along = Window.partitionBy("doc_id", "text_hash", "template").orderBy("diagonal")
    beside = along.rangeBetween(-DRIFT, DRIFT)
    near = votes.select(
        *place, "diagonal",
        (F.bit_count(F.when(F.col("base"), F.col("own")).otherwise(F.bit_or("own").over(beside))) / F.col("pairs")).alias("coverage"),
        F.when(F.col("base"), F.col("diagonal")).otherwise(F.min("first").over(beside)).alias("start_word"),
        F.when(F.col("base"), F.col("diagonal") + F.col("pairs") + 1).otherwise(F.max("last").over(beside) + 2).alias("end_word"),
    )
    # of spans that share diagonals the best stays, and of equal ones the first
    before = F.max("coverage").over(along.rangeBetween(-2 * DRIFT, -1))
    after = F.max("coverage").over(along.rangeBetween(1, 2 * DRIFT))
    best = near.withColumn("best", (F.col("coverage") > F.coalesce(before, F.lit(0.0))) & (F.col("coverage") >= F.coalesce(after, F.lit(0.0))))
    fits = F.when(F.col("base"), F.col("coverage") == 1).otherwise(F.col("best") & (F.col("coverage") >= COVERAGE))
    return best.where(fits).drop("pairs", "diagonal", "best")


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """License digest of every row of ``docs(doc_id, text, ...)``.

    Columns: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score.  Base places are exact; ``labels`` adds those of template
    spans, which may differ from the template by some words.  ``score`` is the
    largest share of a template that a span holds, 1 where a phrase stands.  A null or empty text has no
    words, no labels (empty strings) and null places.  Repeated rows and null
    ids get their rows.  An empty table gives an empty result.
    """
    found = spans(docs, phrases, templates).groupBy("doc_id", "text_hash").agg(
        F.count_if("base").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("start_word"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("start_word"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("coverage").alias("score"),
    )
    found = found.withColumnsRenamed({"doc_id": "found_id", "text_hash": "found_hash"})
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.size(words_of(F.coalesce(text, F.lit("")))).cast("long").alias("n_words"))
    out = rows.join(found, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_hash") == F.col("found_hash")), "left")
    return out.select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
