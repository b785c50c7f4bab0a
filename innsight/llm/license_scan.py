"""License scan by diagonal voting.

Documents and license templates are sequences of words (ASCII letters and digits, any other script's characters;
A-Z lower-cased). Every rolling word k-gram of every document is joined, by hash, to the templates' positions. A
match at word p of the document and t of the template votes for the diagonal p - t. Votes are summed by document,
template and diagonal; neighbouring diagonals (words put in or left out) are merged into one span; a span counts if
the template's words that its votes confirm reach the template's least coverage. A vote's words are compared, not
only their hash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, stored

K = 3
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Diagonals so far apart still belong to one span: words put into or left out of a copy of a template.
MAX_SHIFT = 3


@dataclass(frozen=True)
class Template:
    """A license text: its label, its words, and the share of them that a span must confirm."""

    label: str
    text: str
    coverage: float = 0.8


#: Phrases that count only word for word.
BASE = (
    Template("mit", "under the mit license", 1.0),
    Template("apache-2", "apache license version 2", 1.0),
    Template("cc-by-nc", "cc by nc", 1.0),
)
# Opening words of public license notices and their usual short names.
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                    "associated documentation files the software to deal in the software without restriction"),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except "
                         "in compliance with the license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
                    "provided that the following conditions are met"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the "
                    "gnu general public license as published by the free software foundation"),
    Template("gpl", "licensed under the gnu general public license"),
    Template("lgpl", "gnu lesser general public license"),
    Template("mpl-2", "subject to the terms of the mozilla public license"),
    Template("cc-by", "creative commons attribution 4 0 international license"),
    Template("cc-by-sa", "creative commons attribution sharealike"),
    Template("cc-by-nc", "creative commons attribution noncommercial"),
    Template("proprietary", "all rights reserved", 1.0),
)
TEMPLATES = BASE + NOTICES


def words_of(text: Column) -> Column:
    """The text's words, in order."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAK), "")


def template_grams(spark: SparkSession, templates: Sequence[Template], k: int = K) -> DataFrame:
    """(hash, gram, template, t): a row for each k-gram of each template; as many as the templates have words. The
    hash is one over the gram's words as k columns, as ``votes`` computes it."""
    rows = []
    for i, x in enumerate(templates):
        words = x.text.split()
        if len(words) < k:
            raise ValueError(f"a template needs {k} words: {x.text}")
        rows += [(words[t:t + k], i, t) for t in range(len(words) - k + 1)]
    grams = spark.createDataFrame(rows, "gram array<string>, template int, t int")
    return grams.withColumn("hash", F.xxhash64(*[F.get("gram", F.lit(j)) for j in range(k)]))


def votes(docs: DataFrame, templates: Sequence[Template], k: int = K) -> DataFrame:
    """(doc_id, digest, template, p, t): the k-grams of ``docs`` (doc_id, digest, words) found in a template.
    The template side is a literal list and is broadcast; documents aren't shuffled."""
    rolled = (docs.select("doc_id", "digest", "words", F.posexplode("words").alias("p", "word"))
              .where(F.col("p") <= F.size("words") - k))
    words = [F.col("word"), *(F.get("words", F.col("p") + j) for j in range(1, k))]
    found = (rolled.withColumn("hash", F.xxhash64(*words))
             .join(F.broadcast(template_grams(docs.sparkSession, templates, k)), "hash"))
    same = F.array(*words) == F.col("gram")
    return found.where(same).select("doc_id", "digest", "template", "p", "t").distinct()


def spans(found: DataFrame, templates: Sequence[Template], k: int = K) -> DataFrame:
    """(doc_id, digest, template, first, last, confirmed, score): verified spans; first and last are words of the
    document, ``confirmed`` the template words that the span's votes cover, ``score`` their share.

    Diagonals are cut where votes are further apart than the template is long, so two copies of a template on
    diagonals that happen to be neighbours stay two spans."""
    spark = found.sparkSession
    sizes = spark.createDataFrame([(i, len(x.text.split()), x.coverage) for i, x in enumerate(templates)],
                                  "template int, size int, coverage double")
    key = ["doc_id", "digest", "template"]
    # a diagonal: votes for one place of the whole template in the document
    diagonals = (found.withColumn("diagonal", F.col("p") - F.col("t")).groupBy(*key, "diagonal")
                 .agg(F.collect_set("t").alias("at"), F.min("p").alias("first"), F.max("p").alias("last_gram")))
    inexact = F.col("coverage") < 1.0
    line = Window.partitionBy(*key).orderBy("diagonal")
    merged = (diagonals.join(F.broadcast(sizes), "template")
              .withColumn("new", F.coalesce(~(inexact & (F.col("diagonal") - F.lag("diagonal").over(line)
                                                         <= MAX_SHIFT)), F.lit(True)))
              .withColumn("span", F.sum(F.col("new").cast("int")).over(line))
              .groupBy(*key, "span", "size", "coverage")
              .agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"), F.min("first").alias("first"),
                   F.max("last_gram").alias("last_gram")))
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        "at", lambda t: F.sequence(t, t + (k - 1))))))
    return (merged.withColumn("confirmed", covered)
            .withColumn("score", F.col("confirmed") / F.col("size"))
            .where("score >= coverage")
            .select(*key, "first", (F.col("last_gram") + (k - 1)).alias("last"), "confirmed", "score"))


def license_scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, n_base: int = len(BASE),
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    The first ``n_base`` templates are the base phrases: places where their words stand consecutively. ``labels``
    adds those of the other templates; ``score`` is the best span's confirmed share, 0 without one. Null and empty
    texts have no words: 0 counts, null places, empty labels. Rows of equal id and text are found alike; null ids
    are kept; an empty table gives an empty result; other columns are not read."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("digest"), text.alias("text"))
    found = spans(votes(own.select("doc_id", "digest", words_of(F.col("text")).alias("words")), templates), templates)
    labels = spark.createDataFrame([(i, x.label, i < n_base) for i, x in enumerate(templates)],
                                   "template int, label string, base boolean")
    per_doc = (found.join(F.broadcast(labels), "template").groupBy("doc_id", "digest").agg(
        F.sum(F.col("base").cast("long")).alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("first"))).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
        F.max("score").alias("score")))
    rows = own.select("doc_id", "digest", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    joined = rows.join(per_doc.withColumnsRenamed({"doc_id": "id", "digest": "found"}),
                       F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("found")), "left")
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
