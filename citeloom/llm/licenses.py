"""License scan by diagonal voting, from DataFrame operations only.

All rolling word grams of every text are joined to the grams of license notices. A hit votes
for the diagonal on which text and notice lie: its word number less its place in the notice.
Votes are counted per diagonal, neighbouring diagonals (words put in or left out) are merged,
and a merged span is accepted if it holds ``COVERAGE`` of the notice's grams and is not much
longer than the notice. Every hit is also compared word by word, so equal hashes alone do not
count.

The base phrases are notices of one gram. The notices are a fixed list of some hundred words,
which bounds what is sent to every executor.

Cases: null and empty texts have no words and no labels; a document whose id and text are
repeated is scanned once, and each of its rows gets the result; a null id is a value like
others; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from citeloom.session import stage

GRAM = 3
COVERAGE = 0.75
#: Diagonals that far apart belong to one span.
SHIFT = 2
#: A span is at most that many times as long as its notice.
LENGTH = 1.5

# Phrases and labels of the base search.
PHRASES = [
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
]

# Wording of common license notices.
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("public-domain", "this is free and unencumbered software released into the public domain"),
]

_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-case words of digits, letters and non-ASCII characters.

    ``lower`` also changes capital letters outside ASCII. They stay characters of words, so
    words keep their places, and no phrase or notice has a letter beyond ASCII.
    """
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _NO_WORD), "")


def _grams(found: Column) -> Column:
    """Three words from every place on; the later ones are null at the end."""
    return F.arrays_zip(found.alias("a"), F.slice(found, 2, F.greatest(F.size(found), F.lit(1))).alias("b"), F.slice(found, 3, F.greatest(F.size(found), F.lit(1))).alias("c"))


def _notice_grams(spark: SparkSession) -> DataFrame:
    rows = [(label, text.split(), True) for label, text in PHRASES] + [(label, text.split(), False) for label, text in NOTICES]
    grams = []
    for notice, (label, own, base) in enumerate(rows):
        size = min(GRAM, len(own))
        for place in range(len(own) - size + 1):
            a, b, c = (own[place : place + size] + [None])[:3]
            grams.append((size, a, b, c, notice, label, base, place, len(own) - size + 1, len(own)))
    return spark.createDataFrame(grams, "size int, a string, b string, c string, notice int, label string, base boolean, place int, n_grams int, length int")


def scan_licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row of ``docs``."""
    spark = docs.sparkSession
    notices = _notice_grams(spark)
    by_hash = lambda size, name: F.broadcast(
        notices.filter(F.col("size") == size)
        .groupBy((F.xxhash64("a", "b", "c") if size == 3 else F.xxhash64("a", "b")).alias(f"h{size}"))
        .agg(F.collect_list(F.struct("a", "b", "c", "notice", "label", "base", "place", "n_grams", "length")).alias(name))
    )
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("found"))
    places = keyed.select("doc_id", "text_hash", F.size("found").alias("n_words"), F.posexplode_outer(_grams(F.col("found"))).alias("at", "w"))
    places = places.select("doc_id", "text_hash", "n_words", "at", "w.a", "w.b", "w.c")
    hashed = places.withColumns({"h3": F.when(F.col("c").isNotNull(), F.xxhash64("a", "b", "c")), "h2": F.when(F.col("b").isNotNull(), F.xxhash64("a", "b"))})
    met = hashed.join(by_hash(3, "n3"), "h3", "left").join(by_hash(2, "n2"), "h2", "left")
    first = F.coalesce("at", F.lit(0)) == 0
    same = lambda x: (x.a == F.col("a")) & (x.b == F.col("b")) & (x.c.isNull() | (x.c == F.col("c")))
    none = F.array().cast(met.schema["n3"].dataType)
    hits = F.when(F.col("n3").isNotNull() | F.col("n2").isNotNull(), F.filter(F.concat(F.coalesce("n3", none), F.coalesce("n2", none)), same))
    rows = met.filter(first | F.col("n3").isNotNull() | F.col("n2").isNotNull()).select("doc_id", "text_hash", "n_words", first.alias("first"), F.col("at").cast("bigint").alias("at"), hits.alias("hits"))
    rows = stage(rows, "license-hits")

    key = ["doc_id", "text_hash"]
    votes = rows.filter("size(hits) > 0").select(*key, "at", F.explode("hits").alias("t")).select(*key, "at", "t.notice", "t.label", "t.base", "t.place", "t.n_grams", "t.length")
    by_diagonal = votes.groupBy(*key, "notice", "label", "base", "n_grams", "length", (F.col("at") - F.col("place")).alias("diagonal")).agg(
        F.count_distinct("place").alias("votes"), F.min("at").alias("begin"), F.max("at").alias("end")
    )
    order = W.partitionBy(*key, "notice").orderBy("diagonal")
    new = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(order) > SHIFT) | F.col("base"), F.lit(True))
    spans = (
        by_diagonal.withColumn("span", F.sum(new.cast("int")).over(order.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy(*key, "notice", "label", "base", "n_grams", "length", "span")
        .agg(F.sum("votes").alias("votes"), F.min("begin").alias("begin"), F.max("end").alias("end"))
        .withColumn("coverage", F.least(F.lit(1.0), F.col("votes") / F.col("n_grams")))
        .filter((F.col("coverage") >= COVERAGE) & (F.col("end") - F.col("begin") + F.least(F.lit(GRAM), F.col("length")) <= LENGTH * F.col("length")))
    )
    labelled = spans.groupBy(*key).agg(
        F.count_if("base").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("begin"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("begin"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("coverage").alias("score"),
    )
    d, s = rows.filter("first").select(*key, F.col("n_words").cast("bigint").alias("n_words")).alias("d"), stage(labelled, "licenses").alias("s")
    joined = d.join(s, F.expr("d.doc_id <=> s.doc_id AND d.text_hash = s.text_hash"), "left")
    return joined.select(
        F.col("d.doc_id").alias("doc_id"),
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
