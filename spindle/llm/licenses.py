"""License scan by diagonal voting, in DataFrame operations only.

Every text's rolling two-word hashes meet the positions of the same grams in
short licence templates (a fixed, broadcast table). A hit votes for a
diagonal: its word position less its template position. Votes are gathered
per text, template and diagonal as a bit set of template positions;
neighbouring diagonals (a word added or lost) are merged; a merged span is
verified by the share of the template's grams that it covers and by its
length. The base phrases are templates too, but stand only where one diagonal
covers them wholly, which is where their words stand consecutively.

Each document also sends one marker row through the same join and
aggregation, so that texts without a hit are kept without a second pass or a
join back; grouping is by (doc_id, MD5 of the text), with the number of equal rows.
Grams are compared by 64-bit hash.

Defined results: null and empty texts have no words, positions null, labels
empty, score 0; equal rows give equal results, each as often as it came; a
null doc_id is kept as null; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# Letters, digits and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NEIGHBOUR = 2  # diagonals this close belong to one span
COVER = 0.75  # of a template's grams, to accept a span of the method's own
STRETCH = 1.5  # longest accepted span, in template lengths

# Base phrases and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Well-known passages of public licences (at most 63 words each).
PASSAGES = (
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation", "gpl"),
    ("licensed under the gnu general public license version 3", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("licensed under the apache license version 2 0", "apache"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files to deal in the software without restriction", "mit"),
    ("released under the mit license", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met", "bsd"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted", "isc"),
)


def ascii_lower(text: Column) -> Column:
    """A-Z only. Two other letters have lower forms with an ASCII letter; texts with them take the slow way."""
    odd = text.contains("İ") | text.contains("K")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(odd, F.translate(text, upper, upper.lower())).otherwise(F.lower(text))


def _templates(spark, passages) -> DataFrame:
    rows = [(i, j, a, b, len(words) - 1, label, base)
            for i, (text, label, base) in enumerate(
                [(t, n, True) for t, n in BASE] + [(t, n, False) for t, n in passages])
            for words in [text.split(" ")] for j, (a, b) in enumerate(zip(words, words[1:]))]
    if any(r[4] > 63 for r in rows):
        raise ValueError("a template has at most 64 words")
    return spark.createDataFrame(
        rows, "template int, at int, a string, b string, grams int, label string, base boolean"
    ).select(F.xxhash64("a", "b").alias("gram"), "template", "at", "grams", "label", "base")


def scan(docs: DataFrame, passages: tuple = PASSAGES) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    marker = F.lit(-1).cast("long")
    templates = _templates(spark, passages)
    mark = spark.range(1).select(F.lit(None).cast("long").alias("gram"), F.lit(-1).alias("template"), F.lit(0).alias("at"),
                                 F.lit(1).alias("grams"), F.lit("").alias("label"), F.lit(False).alias("base"))
    keys = templates.withColumn("mark", F.lit(False)).unionByName(
        mark.withColumn("gram", marker).withColumn("mark", F.lit(True)))

    words = docs.select("doc_id", F.md5(text.cast("binary")).alias("key"),
                        F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0)).alias("w"))
    # Position 0 is the marker; gram i starts at word i - 1.
    grams = words.select("doc_id", "key", F.size("w").cast("long").alias("n_words"), F.posexplode(F.concat(
        F.array(marker), F.zip_with(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))),
                                    lambda a, b: F.xxhash64(a, b)))).alias("pos", "gram"))
    hits = grams.join(F.broadcast(keys), "gram").where(F.col("mark") == (F.col("pos") == 0))

    text_key = ["doc_id", "key"]
    diagonal = F.col("pos") - 1 - F.col("at")
    votes = (hits.withColumn("diagonal", diagonal).groupBy(*text_key, "template", "diagonal").agg(
        F.max("n_words").alias("n_words"), F.sum(F.col("mark").cast("long")).alias("copies"),
        F.max("grams").alias("grams"), F.max("label").alias("label"), F.max("base").alias("base"),
        F.expr("bit_or(shiftleft(1L, at))").alias("seen"),
        F.min(F.col("pos") - 1).alias("lo"), F.max(F.col("pos") + 1).alias("hi")))
    along = W.partitionBy(*text_key, "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(along)
    spans = (votes.withColumn("starts", F.coalesce(F.col("base") | (gap > NEIGHBOUR), F.lit(True)).cast("int"))
             .withColumn("span", F.sum("starts").over(along.rowsBetween(W.unboundedPreceding, 0)))
             .groupBy(*text_key, "template", "span").agg(
                 F.max("n_words").alias("n_words"), F.sum("copies").alias("copies"), F.max("grams").alias("grams"),
                 F.max("label").alias("label"), F.max("base").alias("base"),
                 F.expr("bit_or(seen)").alias("seen"), F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    cover = F.bit_count("seen") / F.col("grams")
    known = F.col("template") >= 0
    stands = known & F.col("base") & (F.bit_count("seen") == F.col("grams"))
    found = stands | (known & ~F.col("base") & (cover >= COVER)
                      & (F.col("hi") - F.col("lo") <= STRETCH * (F.col("grams") + 1)))
    names = lambda on: F.array_join(F.array_sort(F.collect_set(F.when(on, F.col("label")))), ",")
    result = spans.groupBy(*text_key).agg(
        F.max("n_words").alias("n_words"), F.sum("copies").alias("copies"),
        F.count_if(stands).alias("n_base"),
        F.min(F.when(stands, F.col("lo"))).cast("long").alias("first_word"),
        F.max(F.when(stands, F.col("lo"))).cast("long").alias("last_word"),
        names(stands).alias("base_labels"), names(found).alias("labels"),
        F.coalesce(F.max(F.when(found, cover)), F.lit(0.0)).alias("score"))
    return result.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
