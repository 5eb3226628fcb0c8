"""License scan: an exact set-similarity join of text blocks with license templates.

A block is a run of words; blocks overlap by half, so every run as long as the longest template lies in one.
A block meets a template if it holds at least ``CONTAINMENT`` of the template's distinct words.  The words of
a template are ordered by their number of documents in the corpus, rarest first.  A block that meets it must
hold one of the first ``n - need + 1`` words (prefix filter), have ``need`` words (length filter), and, if the
first of its words there is at place i, find ``need`` words from i on (positional filter).  Only then are
the sets compared.  Blocks meet templates in a hash join on prefix words, so no block is compared with a
template it shares no rare word with.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.shared import without_empty_ends

# Phrases and their labels.
PHRASES = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}
# Notices of well-known licenses.
TEMPLATES = {
    "apache-2.0": [
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
    ],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "cc-by-nc": ["licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"],
    "cc-by-sa": ["licensed under cc by sa 4 0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"],
    "cc0": ["to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"],
    "gpl-3.0": [
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
    ],
    "mit": [
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    ],
    "mpl-2.0": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
}
CONTAINMENT = 0.9
STEP = 32  # words; at least as many as the longest template has, blocks are twice as long
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def license_words(text: Column) -> Column:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing; none for null.

    ``lower`` also changes letters beyond ASCII.  That moves no word boundary and changes no ASCII word, except
    for the two letters whose lower case is or begins with ASCII: with those, only A-Z are translated.
    """
    text = F.coalesce(text, F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    ascii_only = F.translate(text, upper, upper.lower())
    low = F.when(text.contains("K") | text.contains("İ"), ascii_only).otherwise(F.lower(text))
    return without_empty_ends(F.split(low, SEPARATORS))


def templates(texts: dict[str, list[str]]) -> list[tuple[str, list[str]]]:
    """(label, distinct words) of each template."""
    listed = [(label, list(dict.fromkeys(text.split()))) for label, each in sorted(texts.items()) for text in each]
    if any(len(text.split()) > STEP for each in texts.values() for text in each):
        raise ValueError(f"a template may have {STEP} words")
    return listed


def word_order(words: DataFrame, listed: list[tuple[str, list[str]]]) -> list[str]:
    """The templates' words by their number of documents, rarest first.  The driver sees one count per word."""
    vocabulary = F.array(*[F.lit(word) for word in sorted({word for _, each in listed for word in each})])
    counted = words.select(F.explode(F.array_intersect("words", vocabulary)).alias("token")).groupBy("token").count()
    counts = dict(counted.collect())
    return sorted({word for _, each in listed for word in each}, key=lambda word: (counts.get(word, 0), word))


def prefix_index(listed: list[tuple[str, list[str]]], order: list[str], containment: float) -> dict[str, list[tuple]]:
    """token -> (label, need, words in order) of each template that has it among its first n - need + 1 words."""
    rank = {word: i for i, word in enumerate(order)}
    index: dict[str, list[tuple]] = {}
    for label, each in listed:
        ordered = sorted(each, key=rank.__getitem__)
        need = math.ceil(round(containment * len(ordered), 9))
        for token in ordered[: len(ordered) - need + 1]:
            index.setdefault(token, []).append((label, need, ordered))
    return index


def scan(
    docs: DataFrame, texts: dict[str, list[str]] = TEMPLATES, phrases: dict[str, str] = PHRASES, containment: float = CONTAINMENT
) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``docs`` needs doc_id and text; other columns are ignored.  n_base counts the places where the words of a
    phrase stand consecutively.  ``labels`` adds the templates met by a block of the text.  The score is 1 with
    a phrase, else the largest share of a template that was met, else 0.  Null and empty texts have no words
    and no labels.  Repeated rows come back as often as they came in, a null id as null.
    """
    listed = templates(texts)
    words = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), license_words(F.col("text")).alias("words"))
    order = word_order(words, listed)
    index = prefix_index(listed, order, containment)
    known, rare = (F.array(*[F.lit(word) for word in each]) for each in (order, sorted(index)))
    entries = docs.sparkSession.createDataFrame(
        sorted(index.items()), "token string, entries array<struct<label: string, need: int, ordered: array<string>>>"
    )
    starters = F.array(*[F.lit(phrase.split()[0]) for phrase in phrases.values()])
    places = F.when(
        F.arrays_overlap("words", starters),
        F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.array_contains(starters, F.get("words", i))),
    ).otherwise(F.array().cast("array<int>"))

    def stands(phrase: str) -> Column:
        def at(i: Column) -> Column:
            found = F.lit(True)
            for k, word in enumerate(phrase.split()):
                found = found & F.coalesce(F.get("words", i + k) == word, F.lit(False))
            return found
        return F.filter("starts", at)

    def labelled(label: str) -> Column:
        return F.transform(stands(phrases[label]), lambda i: F.struct(i.alias("at"), F.lit(label).alias("label")))

    found = F.flatten(F.array(*[labelled(label) for label in sorted(phrases)]))
    # A block keeps its template words only, in the order of the templates' words.
    blocks = F.when(
        F.arrays_overlap("words", rare),
        F.filter(
            F.transform(
                F.sequence(F.lit(0), F.floor((F.size("words") - 1) / STEP).cast("int")),
                lambda i: F.array_intersect(known, F.slice("words", i * STEP + 1, 2 * STEP)),
            ),
            lambda block: F.arrays_overlap(block, rare),
        ),
    )
    marked = (
        words.withColumn("starts", places)
        .withColumn("found", found)
        .select(
            "doc_id", "text_hash", F.size("words").cast("long").alias("n_words"), F.size("found").cast("long").alias("n_base"),
            F.array_min("found.at").cast("long").alias("first_word"), F.array_max("found.at").cast("long").alias("last_word"),
            F.array_join(F.array_sort(F.array_distinct("found.label")), ",").alias("base_labels"),
            blocks.alias("blocks"),
        )
    )
    shared = ["doc_id", "text_hash", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    prefix = F.filter(
        F.transform("held", lambda word, i: F.struct(i.alias("place"), word.alias("token"))),
        lambda entry: F.array_contains(rare, entry["token"]),
    )
    by_word = (
        marked.select(*shared, F.posexplode_outer("blocks").alias("block", "held"))
        .select("*", F.posexplode_outer(prefix).alias("nth", "entry"))
        .select("*", F.col("entry.place").alias("place"), F.col("entry.token").alias("token"))
    )
    open_words = F.size("held") - F.col("place")  # from the shared word on: what the block can still hold
    shares = F.transform(
        F.filter("entries", lambda e: (F.size("held") >= e["need"]) & (open_words >= e["need"])),
        lambda e: F.struct(
            (F.size(F.array_intersect(e["ordered"], F.col("held"))) / F.size(e["ordered"])).alias("share"),
            (e["need"] / F.size(e["ordered"])).alias("least"),
            e["label"].alias("label"),
        ),
    )
    met = by_word.join(F.broadcast(entries), "token", "left").select(
        *shared, "block", "nth", F.filter(shares, lambda x: x["share"] >= x["least"]).alias("met")
    )
    per_row = met.groupBy(*shared).agg(
        F.count_if((F.coalesce("block", F.lit(0)) == 0) & (F.coalesce("nth", F.lit(0)) == 0)).alias("rows"),
        F.flatten(F.collect_set("met.label")).alias("met"),
        F.max(F.array_max("met.share")).alias("share"),
    )
    base = F.when(F.col("base_labels") != "", F.split("base_labels", ",")).otherwise(F.array().cast("array<string>"))
    return per_row.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels",
        F.array_join(F.array_sort(F.array_union("met", base)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
        F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("copy"),
    ).drop("copy")
