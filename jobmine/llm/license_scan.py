"""License scan by diagonal voting.

All rolling k-grams of words are hashed and joined to the positions of the same hashes in license
templates. A hit votes for a diagonal (word position minus template position); votes are added per
document, template and diagonal, neighbouring diagonals are merged (words added or left out inside
a passage shift it), and a merged span is verified: it must cover enough of the template's words.
Phrases are templates that must stand whole, word by word.

Notices that differ in few words cover each other's templates, so words that tell them apart decide:
a template of a variant counts only if the variant's mark stands in the passage, and the plain notice
gives way to an overlapping passage of a variant unless its own mark stands there too.

The template side is a fixed list and is broadcast; windows are made and looked up in one stage and
only hits are shuffled, added up per place first.

Defined cases: null or empty texts have no words (n_words 0, no labels, score 0); equal rows get
equal results; a place that several templates share counts for each of them, but for variants
of a notice as above; a phrase counts at every place, overlapping ones too. Other columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobmine.llm.common import lowered, narrow, text_key

K = 3
MIN_COVER = 0.6
MAX_SHIFT = 4
_BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

# Phrases and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# Common license notices and their labels.
TEMPLATES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and "
     "associated documentation files the software to deal in the software without restriction including "
     "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
     "copies of the software", "mit"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in "
     "compliance with the license you may obtain a copy of the license at", "apache-2"),
    ("redistribution and use in source and binary forms with or without modification are permitted "
     "provided that the following conditions are met", "bsd"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu "
     "general public license as published by the free software foundation", "gpl"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("this library is free software you can redistribute it and or modify it under the terms of the gnu "
     "lesser general public license as published by the free software foundation", "lgpl"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("this work is licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this work is licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee "
     "is hereby granted provided that the above copyright notice and this permission notice appear in "
     "all copies", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("all rights reserved no part of this publication may be reproduced", "proprietary"),
)

# Label, the plain notice it is a variant of (or is), and its marks of one or two words.
MARKS = (
    ("gpl", "gpl", ("gnu general",)),
    ("lgpl", "gpl", ("lesser", "library general")),
    ("cc-by", "cc-by", ("attribution 1", "attribution 2", "attribution 3", "attribution 4")),
    ("cc-by-nc", "cc-by", ("noncommercial", "non commercial")),
    ("cc-by-sa", "cc-by", ("sharealike", "share alike")),
)


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(lowered(text), _BETWEEN), "")


def _grams(words: Column, at: Column) -> Column:
    return F.xxhash64(*[F.get(words, at + F.lit(i)) for i in range(K)])


def templates(spark: SparkSession) -> DataFrame:
    """template, label, phrase (whether it must stand whole), words, plain notice, marks, tpos, hash:
    a row per k-gram."""
    marks = {label: (plain, list(words)) for label, plain, words in MARKS}
    rows = [(i, label, i < len(PHRASES), text.split(), *((None, []) if i < len(PHRASES) else marks.get(label, (None, []))))
            for i, (text, label) in enumerate(PHRASES + TEMPLATES)]
    table = spark.createDataFrame(
        rows, "template int, label string, phrase boolean, twords array<string>, plain string, marks array<string>")
    place = F.explode(F.sequence(F.lit(0), F.size("twords") - K)).alias("tpos")
    return table.select("*", place).select("*", _grams(F.col("twords"), F.col("tpos")).alias("thash"))


def votes(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, template, label, phrase, plain, n_twords, diagonal, tpos, marked: one row per
    k-gram that agrees with a template word by word, with the places of the label's marks around it."""
    source = narrow(docs).select("doc_id", text_key(F.col("text")).alias("text_key"), word_list(F.col("text")).alias("words"))
    place = F.explode(F.sequence(F.lit(0), F.size("words") - K)).alias("pos")
    keyed = source.where(F.size("words") >= K).select("*", place).select(
        "*", _grams(F.col("words"), F.col("pos")).alias("hash"))
    known = templates(docs.sparkSession)
    same = F.lit(True)
    for i in range(K):
        same = same & (F.get("words", F.col("pos") + F.lit(i)) == F.get("twords", F.col("tpos") + F.lit(i)))
    hits = keyed.join(F.broadcast(known), keyed["hash"] == known["thash"]).where(same)
    around = F.sequence(F.greatest(F.col("pos") - F.size("twords"), F.lit(0)),
                        F.least(F.col("pos") + F.size("twords") + F.lit(K), F.size("words") - 1))

    def is_mark(p: Column) -> Column:
        word = F.get("words", p)
        pair = F.concat_ws(" ", word, F.get("words", p + F.lit(1)))
        return F.array_contains("marks", word) | F.array_contains("marks", pair)

    marked = F.when(F.size("marks") > 0, F.filter(around, is_mark)).otherwise(F.array().cast("array<int>"))
    return hits.select("doc_id", "text_key", "template", "label", "phrase", "plain", F.size("twords").alias("n_twords"),
                       (F.col("pos") - F.col("tpos")).alias("diagonal"), "tpos", marked.alias("marked")).distinct()


def spans(docs: DataFrame) -> DataFrame:
    """Verified passages: doc_id, text_key, label, phrase, first, last (word positions), cover.

    Diagonals of one document and template are merged while the next is within ``MAX_SHIFT`` and
    continues the passage, in text and in the template, after a gap of at most the template's length.
    """
    each = ["doc_id", "text_key", "template"]
    kind = ["label", "phrase", "plain", "n_twords"]
    voted = votes(docs).groupBy(*each, *kind, "diagonal").agg(
        F.collect_set("tpos").alias("hit"),  # at most the template's length
        F.array_distinct(F.flatten(F.collect_list("marked"))).alias("marked"))
    lines = voted.select(
        *each, *kind, "diagonal", "hit", "marked",
        (F.array_min("hit") + F.col("diagonal")).alias("lo"), (F.array_max("hit") + F.col("diagonal") + K - 1).alias("hi"))
    order = Window.partitionBy(*each).orderBy("lo", "diagonal")
    before = F.lag("hi").over(order)
    near = (F.abs(F.col("diagonal") - F.lag("diagonal").over(order)) <= MAX_SHIFT) & (
        F.col("lo") - before <= F.col("n_twords")) & (F.array_min("hit") >= F.lag(F.array_min("hit")).over(order))
    fresh = F.when(F.col("phrase") | ~F.coalesce(near, F.lit(False)), 1).otherwise(0)
    chained = lines.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(order))
    merged = chained.groupBy(*each, *kind, "run").agg(
        F.flatten(F.collect_list("hit")).alias("hit"), F.flatten(F.collect_list("marked")).alias("marked"),
        F.min("lo").alias("first"), F.max("hi").alias("last"))
    grams = F.size(F.array_distinct("hit"))
    cover = grams / (F.col("n_twords") - (K - 1))
    whole = F.when(F.col("phrase"), cover >= 1).otherwise(cover >= MIN_COVER)
    marked = F.exists("marked", lambda p: (p >= F.col("first")) & (p <= F.col("last")))
    variant = F.coalesce(F.col("plain") != F.col("label"), F.lit(False))
    verified = merged.select(
        *each, "label", "phrase", "plain", "first", "last", cover.alias("cover"), marked.alias("own"),
        variant.alias("variant"), whole.alias("whole")).where(F.col("whole") & (~F.col("variant") | F.col("own")))
    # The last end of variants that begin before or with a passage, the first begin of those after it.
    place = Window.partitionBy("doc_id", "text_key", "plain").orderBy("first")
    ends = F.max(F.when(F.col("variant"), F.col("last"))).over(place.rangeBetween(Window.unboundedPreceding, 0))
    begins = F.min(F.when(F.col("variant"), F.col("first"))).over(place.rangeBetween(0, Window.unboundedFollowing))
    meets = F.coalesce(ends >= F.col("first"), F.lit(False)) | F.coalesce(begins <= F.col("last"), F.lit(False))
    gives_way = F.col("plain").isNotNull() & ~F.col("variant") & ~F.col("own") & F.col("meets")
    return verified.withColumn("meets", meets).where(~gives_way).select(
        "doc_id", "text_key", "label", "phrase", "first", "last", "cover")


def op8(docs: DataFrame) -> DataFrame:
    found = spans(docs).groupBy("doc_id", "text_key").agg(
        F.sum(F.col("phrase").cast("long")).alias("n_base"),
        F.min(F.when(F.col("phrase"), F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("phrase"), F.col("first"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("phrase"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("cover").alias("score"),
    ).withColumnRenamed("doc_id", "_id").withColumnRenamed("text_key", "_key")
    source = narrow(docs).select("doc_id", text_key(F.col("text")).alias("text_key"),
                                 F.size(word_list(F.col("text"))).cast("long").alias("n_words"))
    same = source["doc_id"].eqNullSafe(found["_id"]) & (source["text_key"] == found["_key"])
    return source.join(found, same, "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
