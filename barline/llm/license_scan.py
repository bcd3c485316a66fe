"""License scan by diagonal voting (operator 13), in DataFrame functions only.

A template is a license notice or phrase, as words.  A diagonal of a document
and a template is the word number where the template would start.

1. Seeds.  Every run of ``GRAM`` words of every document (shorter for templates
   of fewer words) is hashed and looked up among the template runs; a hit is
   kept only if its words equal the template's, so hashes decide nothing.
2. Votes.  Hits are aggregated by document, template and diagonal.
3. Bands.  Diagonals of one template at most ``DRIFT`` apart merge, which joins
   the two sides of a few words put in or left out.
4. Verification.  A band's score is the share of the template's words that its
   hits cover; it holds if that is at least ``COVER`` and its span in the
   document is at most ``SPREAD`` times the template.  A phrase (``exact``)
   holds only where all its words stand on one diagonal; each one is a place.

The templates are a parameter, so the broadcast look-up table is bounded by it
(``MAX_WORDS`` words in all, else an error); the corpus is read once and only
hits and one narrow row per document are written.

Rows are told apart by (doc_id, text hash, text length); repeated rows get equal
results, one each.  Null and empty texts have no words: zero counts, null
positions, empty labels, score 0.  Null ids compare as equal.  Places may
overlap; positions count from 0.  Empty tables give no rows.  Columns other than
id and text are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barline.llm.decontaminate import GAP, LOWER, UPPER, words_of
from barline.llm.text import prepare, written

GRAM = 4
DRIFT = 4
COVER = (7, 10)  # a fraction, compared in integers
SPREAD = 2
MAX_WORDS = 200_000


@dataclass(frozen=True)
class Template:
    """Words to look for, the label they give, and whether only exact places count."""

    label: str
    text: str
    exact: bool = False

    @property
    def length(self) -> int:
        """Number of words, cut as in documents."""
        return sum(map(bool, re.split(GAP, self.text.translate(str.maketrans(UPPER, LOWER)))))


# The base phrases and their labels.
PHRASES = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
)

# The opening words of public licenses and their usual one-line notices.
NOTICES = (
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
             "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
             "any later version."),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    Template("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
             "compliance with the License. You may obtain a copy of the License at"),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    Template("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    Template("mit", "Released under the MIT License."),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
             'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
             "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
             "the following conditions are met"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    Template("unlicense", "This is free and unencumbered software released into the public domain."),
)
TEMPLATES = PHRASES + NOTICES

ROW = ("doc_id", "tie", "n_chars")


def gram_key(words: str, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(F.col(words), at + k) for k in range(size)])


def template_grams(spark: SparkSession, templates: tuple[Template, ...], gram: int = GRAM) -> DataFrame:
    """(size, key, posts): every distinct word run of the templates with the places (words, template, pos, ...) it has."""
    if sum(t.length for t in templates) > MAX_WORDS:
        raise ValueError(f"templates of more than {MAX_WORDS} words are not broadcast")
    rows = [F.struct(F.lit(k).alias("template"), F.lit(t.label).alias("label"), F.lit(t.exact).alias("exact"),
                     F.lit(t.text).alias("text")) for k, t in enumerate(templates)]
    empty = "array<struct<template:int,label:string,exact:boolean,text:string>>"
    told = spark.range(1).select(F.explode(F.array(*rows).cast(empty)).alias("t")).select("t.*")
    told = told.withColumn("words", words_of("text")).where(F.size("words") > 0)
    told = told.withColumn("size", F.least(F.size("words"), F.lit(gram)))
    grams = told.withColumn("pos", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("size"))))
    key = F.coalesce(*[F.when(F.col("size") == k, gram_key("words", F.col("pos"), k)) for k in range(1, gram + 1)])
    post = F.struct("template", "label", "exact", "pos", F.size("words").alias("length"),
                    F.slice("words", F.col("pos") + 1, F.col("size")).alias("gram"))
    return grams.groupBy("size", key.alias("key")).agg(F.collect_list(post).alias("posts"))


def equal_posts(posts: str, size: int) -> Column:
    """The template places whose words are those at the row's word number."""
    return F.filter(posts, lambda p: p["gram"] == F.slice("words", F.col("at") + 1, size))


def seeds(docs: DataFrame, templates: tuple[Template, ...], doc_id: str, text: str, gram: int) -> DataFrame:
    """A row marked ``first`` for every document, and one per word number ``at`` with the template places (``posts``) it equals."""
    table = template_grams(docs.sparkSession, templates, gram)
    cut = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("tie"),
                      F.length(F.col(text)).alias("n_chars"), words_of(text).alias("words"))
    rows = cut.select("*", F.posexplode_outer("words").alias("at", "_word")).drop("_word").withColumn("n_words", F.size("words"))
    none = F.array().cast("array<struct<template:int,label:string,exact:boolean,pos:int,length:int,gram:array<string>>>")
    hit, met = F.lit(False), [none]
    for size in sorted({min(t.length, gram) for t in templates} - {0}):
        posts = F.broadcast(table.where(F.col("size") == size).select(F.col("key").alias(f"k{size}"), F.col("posts").alias(f"p{size}")))
        rows = rows.withColumn(f"k{size}", F.when(F.col("at") + size <= F.col("n_words"), gram_key("words", F.col("at"), size)))
        rows = rows.join(posts, f"k{size}", "left")
        met.append(F.coalesce(equal_posts(f"p{size}", size), none))
        hit = hit | F.col(f"p{size}").isNotNull()
    first = F.coalesce(F.col("at") == 0, F.lit(True))
    return rows.where(hit | first).select(
        *ROW, "n_words", "at", first.alias("first"), F.concat(*met).alias("posts"))


def votes(found: DataFrame) -> DataFrame:
    """(row, template, label, exact, length, diagonal, places): the template positions hit on each diagonal."""
    hits = found.where(F.size("posts") > 0).select(*ROW, "at", F.explode("posts").alias("p"))
    return hits.groupBy(
        *ROW, "p.template", "p.label", "p.exact", "p.length", (F.col("at") - F.col("p.pos")).alias("diagonal"),
        F.size("p.gram").alias("size")).agg(F.collect_set("p.pos").alias("places"))


def bands(voted: DataFrame) -> DataFrame:
    """(row, label, score, holds): neighbouring diagonals of a template merged and verified."""
    line = Window.partitionBy(*ROW, "template").orderBy("diagonal")
    cut = voted.withColumn("_new", F.coalesce((F.col("diagonal") - F.lag("diagonal").over(line) > DRIFT).cast("int"), F.lit(1)))
    cut = cut.withColumn("band", F.sum("_new").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    # a band covers the template words of its hits' runs; its span goes from its first hit to its last
    covered = F.flatten(F.transform("places", lambda p: F.sequence(p, p + F.col("size") - 1)))
    merged = cut.withColumn("word", F.explode(covered)).groupBy(*ROW, "template", "label", "length", "band").agg(
        F.count_distinct("word").alias("covered"),
        F.min(F.col("diagonal") + F.array_min("places")).alias("start"),
        F.max(F.col("diagonal") + F.array_max("places") + F.col("size")).alias("end"))
    near = F.col("end") - F.col("start") <= SPREAD * F.col("length")
    return merged.select(
        *ROW, "label", (F.col("covered") / F.col("length")).alias("score"),
        (near & (F.col("covered") * COVER[1] >= F.col("length") * COVER[0])).alias("holds"))


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, doc_id: str = "doc_id", text: str = "text",
         gram: int = GRAM) -> DataFrame:
    """Per document: doc_id, n_words, n_base (places of exact phrases), first_word, last_word, base_labels, labels, score."""
    prepare(docs.sparkSession)
    found = written(seeds(docs, templates, doc_id, text, gram), "license_seeds")
    voted = written(votes(found), "license_votes")
    whole = F.size("places") == F.col("length") - F.col("size") + 1
    exact = voted.where(F.col("exact") & whole).groupBy(*ROW).agg(
        F.count(F.lit(1)).alias("n_base"), F.min("diagonal").alias("first_word"), F.max("diagonal").alias("last_word"),
        F.collect_set("label").alias("base"), F.lit(1.0).alias("score"), F.collect_set("label").alias("more"))
    loose = bands(voted.where(~F.col("exact"))).groupBy(*ROW).agg(
        F.lit(0).cast("long").alias("n_base"), F.lit(None).cast("int").alias("first_word"), F.lit(None).cast("int").alias("last_word"),
        F.array().cast("array<string>").alias("base"), F.max("score").alias("score"),
        F.collect_set(F.when(F.col("holds"), F.col("label"))).alias("more"))
    told = exact.unionByName(loose).groupBy(*[F.col(c).alias("_" + c) for c in ROW]).agg(
        F.sum("n_base").alias("n_base"), F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word"),
        F.flatten(F.collect_list("base")).alias("base"), F.max("score").alias("score"), F.flatten(F.collect_list("more")).alias("more"))
    every = found.where("first").groupBy(*ROW).agg(F.max("n_words").alias("n_words"), F.count(F.lit(1)).alias("_rows"))
    joined = every.join(told, [every[c].eqNullSafe(F.col("_" + c)) for c in ROW], "left")
    names = lambda c: F.array_join(F.array_sort(F.array_distinct(F.coalesce(c, F.array().cast("array<string>")))), ",")
    return joined.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        names("base").alias("base_labels"), names("more").alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rows"))).alias("_copy")).drop("_copy")
