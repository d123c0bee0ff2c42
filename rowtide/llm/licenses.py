"""License scans by diagonal voting, in DataFrame functions only.

Every rolling ``k``-word hash of a text is joined with the places where the
templates have that hash. A hit at word ``p`` of the text and ``q`` of the
template votes for the diagonal ``p - q``; votes are counted per text,
template and diagonal, diagonals that lie next to each other (a word more or
less in between) are merged into one span, and a span is verified by the
share of the template's words that stand in it. A short phrase is a template
of its own whose every hash must vote on one diagonal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowtide.llm.io import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: fixed values of the contract: phrase and label
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

#: notices that the method looks for besides, as they are published with the licenses
NOTICES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("all rights reserved no part of this publication may be reproduced", "all-rights-reserved"),
)


def words(text: Column) -> Column:
    """Words of a text: A-Z in lower case, runs of anything that is not ASCII
    punctuation, symbol, white space or control. Null has none."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.filter(parts, lambda w: w != "")


def _grams(text: Column, k: int) -> Column:
    """Hashes of all runs of ``k`` words, in order. The words are bound to a
    lambda variable, so they are split once per row and not once per hash."""

    def roll(w: Column) -> Column:
        run = lambda p: F.xxhash64(*[F.get(w, p + F.lit(i)) for i in range(k)])
        return F.when(F.size(w) >= k, F.transform(F.sequence(F.lit(0), F.size(w) - k), run))

    return F.flatten(F.transform(F.array(words(text)), roll))


def _templates(spark: SparkSession, phrases, notices, k: int) -> DataFrame:
    """(template, label, base, size, q, gram): one row per hash of a template.
    Its size is that of the lists passed in."""
    rows = [(i, label, base, text, len(text.split())) for i, (text, label, base) in enumerate(
        [(t, lab, True) for t, lab in phrases] + [(t, lab, False) for t, lab in notices])]
    rows = [r for r in rows if r[4] >= k]
    made = spark.createDataFrame(rows, "template int, label string, base boolean, phrase string, size int")
    return made.select("template", "label", "base", "size", F.posexplode(_grams(F.col("phrase"), k)).alias("q", "gram"))


def scan(docs: DataFrame, phrases=PHRASES, notices=NOTICES, k: int = 3, near: int = 2, least: float = 0.6) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; others ignored): doc_id,
    n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``k`` is the words a hash spans (a phrase has at least as many), ``near``
    how far diagonals of one span may lie apart, ``least`` the share of a
    notice's hashes that must stand in the span. A null or empty text has no
    words and no labels; repeated rows (by doc_id and text) get the same
    result each; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    own = docs.select("doc_id", "text")
    # rows with the same id and text are told apart from others by this key, also for null ids
    key = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("text", F.lit(""))))
    templates = _templates(spark, phrases, notices, k)
    rolled = own.select(key.alias("row_key"), F.posexplode(_grams(F.col("text"), k)).alias("p", "gram"))
    hits = rolled.join(F.broadcast(templates), "gram").select("row_key", "template", "label", "base", "size", "p", "q").distinct()
    votes = hits.groupBy("row_key", "template", "label", "base", "size", (F.col("p") - F.col("q")).alias("diagonal")).agg(
        F.count("*").alias("votes"), F.min("p").alias("low"), F.max("p").alias("high"), F.collect_set("q").alias("qs"))
    votes = settle(votes, "license-votes")
    # a phrase: all its hashes on one diagonal
    places = votes.where("base").where(F.col("votes") == F.col("size") - k + 1).select("row_key", "label", F.col("diagonal").alias("first"))
    # a notice: neighbouring diagonals merged, then the covered share of the template; the
    # window holds the spans of one notice in one text
    w = Window.partitionBy("row_key", "template").orderBy("low", "diagonal")
    step = (F.col("low") - F.lag("low").over(w) > F.col("size")) | (F.abs(F.col("diagonal") - F.lag("diagonal").over(w)) > near)
    merged = (votes.where("not base").withColumn("apart", F.coalesce(step, F.lit(True)).cast("int"))
              .withColumn("span", F.sum("apart").over(w))
              .groupBy("row_key", "template", "label", "size", "span")
              .agg(F.size(F.array_distinct(F.flatten(F.collect_list("qs")))).alias("covered")))
    found = merged.select("row_key", "label", (F.col("covered") / (F.col("size") - k + 1)).alias("share")).where(F.col("share") >= least)
    based = places.groupBy("row_key").agg(
        F.count("*").alias("n_base"), F.min("first").alias("first_word"), F.max("first").alias("last_word"),
        F.array_sort(F.collect_set("label")).alias("base_set"))
    noticed = found.groupBy("row_key").agg(F.collect_set("label").alias("label_set"), F.max("share").alias("share"))
    verdict = settle(based.join(noticed, "row_key", "full"), "license-verdicts")
    counted = own.select("doc_id", key.alias("row_key"), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    base_set, label_set = F.coalesce("base_set", none), F.coalesce("label_set", none)
    return counted.join(verdict, "row_key", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.array_join(base_set, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_set, label_set)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))
