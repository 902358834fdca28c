"""License scans: an exact set-similarity join of text blocks with licence templates.

A block is a run of words, wherever lines end, ``SLACK`` longer than the
template; a template is found where a block contains at least ``THRESHOLD`` of
its distinct words. Words are ordered by their frequency in the corpus, rarest
first. A block that holds the o of n words which a template needs has one of its
first n - o + 1 (prefix filter), so only those meet it; enough of its words must
stand around that meeting (length filter), and enough that come after it in the
order (positional filter); what remains is verified window by window. All of it
is DataFrame functions over one table of the templates' words in the texts; the
templates are the only data that is broadcast, and their number is fixed here.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ascii_lower, written

# Base phrases of the contract.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Fixed values: (label, sentence) of common licence notices.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by", "Licensed under the Creative Commons Attribution 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
]

THRESHOLD = 0.85
#: Words that a block may have beyond its template's: a quarter, and at least four.
SLACK = (4, 4)

#: What stands between words, once A-Z is lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(lowered: Column) -> Column:
    return F.array_remove(F.split(lowered, BETWEEN, -1), "")


def template_sets(templates: Sequence[tuple[str, str]], threshold: float) -> list[tuple[str, list[str], int, int]]:
    """Label, distinct words, needed overlap and length of a block of each template."""
    import re

    between = re.compile(BETWEEN)
    out = []
    for label, sentence in templates:
        every = [w for w in between.split(sentence.lower()) if w]
        found = sorted(set(every))
        out.append((label, found, max(1, ceil(threshold * len(found) - 1e-9)), len(every) + max(SLACK[0], len(every) // SLACK[1])))
    return out


def vocabulary_hits(found: Column, sets: list[tuple[str, list[str], int, int]]) -> Column:
    """(word, at) of every word of a text that stands in some template, in order."""
    vocabulary = sorted({w for _, words_, _, _ in sets for w in words_})
    return F.array_compact(F.transform(found, lambda w, i: F.when(w.isin(vocabulary), F.struct(w.alias("word"), i.alias("at")))))


def template_matches(scanned: DataFrame, sets: list[tuple[str, list[str], int, int]]) -> DataFrame:
    """(id, text_hash, label, score): every (document, template label) with a block that contains enough of a template, and the largest containment.

    ``scanned`` has id, text_hash and hits (word, at).
    """
    scanned = scanned.filter("hits is not null").select("id", "text_hash", "hits")
    # How often the templates' words occur: as many rows as the templates have words.
    counted = {r.word: r.n for r in scanned.select(F.explode("hits.word").alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}
    order = sorted({w for _, found, _, _ in sets for w in found}, key=lambda w: (counted.get(w, 0), w))
    rank_of = {w: k for k, w in enumerate(order)}
    prefixes = []
    for number, (label, found, need, reach) in enumerate(sets):
        ranks = sorted(rank_of[w] for w in found)
        prefixes += [(rank, number, label, place, len(ranks), need, reach, ranks) for place, rank in enumerate(ranks[: len(ranks) - need + 1])]
    index = scanned.sparkSession.createDataFrame(prefixes, "rank int, template int, label string, place int, n int, need int, reach int, ranks array<int>")
    rare, widest = sorted({p[0] for p in prefixes}), max(reach for _, _, _, reach in sets)
    ranked = scanned.select("id", "text_hash", F.transform("hits", lambda h: F.struct(h["at"].alias("at"), (F.array_position(F.lit(order), h["word"]) - 1).cast("int").alias("rank"))).alias("hits"))
    # What stands around a meeting: no two hits share a place, so as many neighbours in the array are enough.
    around = lambda k: F.slice("hits", F.greatest(F.lit(1), k + 2 - widest), F.lit(2 * widest))
    meeting = F.filter(F.transform("hits", lambda h, k: F.when(h["rank"].isin(rare), F.struct(h["at"].alias("at"), h["rank"].alias("rank"), around(k).alias("near")))), lambda m: m.isNotNull())
    met = ranked.select("id", "text_hash", F.inline(meeting)).join(F.broadcast(index), "rank")
    # The meeting is the first word, in the order, of a block and the template; what counts besides comes after it.
    mine = F.filter("near", lambda h: (h["rank"] >= F.col("rank")) & (F.abs(h["at"] - F.col("at")) < F.col("reach")) & F.array_contains(F.col("ranks"), h["rank"]))
    met = met.select("id", "text_hash", "label", "at", "rank", "place", "n", "need", "reach", mine.alias("mine"))
    distinct = lambda hits: F.size(F.array_distinct(F.transform(hits, lambda h: h["rank"])))
    possible = met.filter(F.least(F.col("n") - F.col("place"), distinct(F.col("mine"))) >= F.col("need"))
    begins = F.filter("mine", lambda s: s["at"] <= F.col("at"))
    overlap = F.array_max(F.transform(begins, lambda s: distinct(F.filter(F.col("mine"), lambda h: (h["at"] >= s["at"]) & (h["at"] < s["at"] + F.col("reach"))))))
    exact = possible.withColumn("overlap", overlap).filter("overlap >= need")
    return exact.groupBy("id", "text_hash", "label").agg(F.max(F.col("overlap") / F.col("n")).alias("score"))


def phrase_starts(found: Column, phrases: dict[str, str]) -> Column:
    """Starts (from 0) of all places where a phrase's words stand consecutively in the word array."""
    last = sorted({p.split()[-1] for p in phrases})

    def here(i: Column) -> Column:
        hit = F.lit(False)
        for phrase in phrases:
            each = [F.get(found, i + k) == w for k, w in enumerate(phrase.split())]
            whole = each[0]
            for x in each[1:]:
                whole = whole & x
            hit = hit | whole
        return F.coalesce(hit, F.lit(False))

    none = F.array().cast("array<int>")
    return F.when(F.arrays_overlap(found, F.lit(last)), F.filter(F.sequence(F.lit(0), F.size(found) - 1), here)).otherwise(none)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", phrases: dict[str, str] = PHRASES, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels array, labels array, score) for every row.

    A null text is empty: no words, no labels, score 0. ``score`` is the largest
    containment of a template that was found, 0 without any. Repeated rows give
    repeated rows; rows that share a doc_id are scanned each by its own text.
    """
    whole = ascii_lower(F.coalesce(F.col(text), F.lit("")))
    # Together with the text's hash an id names a row or equal rows; -1 stands for null there.
    keyed = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(doc_id).cast("long"), F.lit(-1)).alias("id"), whole.alias("lowered")).withColumn("text_hash", F.xxhash64("lowered"))
    sets = template_sets(templates, threshold)
    listed = keyed.select("doc_id", "id", "text_hash", words(F.col("lowered")).alias("w"))
    placed = listed.withColumns({"starts": phrase_starts(F.col("w"), phrases), "hits": vocabulary_hits(F.col("w"), sets)})
    label_at = [(phrase.split(), label) for phrase, label in phrases.items()]

    def label(i: Column) -> Column:
        out = F.lit(None).cast("string")
        for each, name in label_at:
            hit = F.get(F.col("w"), i) == each[0]
            out = F.when(F.coalesce(hit, F.lit(False)), F.lit(name)).otherwise(out)
        return out

    # Texts are read once, into a table of what they hold.
    based = placed.select(
        "doc_id", "id", "text_hash", F.size("w").cast("long").alias("n_words"), F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"), F.array_max("starts").cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(F.transform("starts", label))).alias("base_labels"),
        # Fewer different words than any template needs find nothing.
        F.when(F.size(F.array_distinct("hits.word")) >= min(need for _, _, need, _ in sets), F.col("hits")).alias("hits"),
    )
    based = written(based)
    matched = template_matches(based, sets).groupBy("id", "text_hash").agg(F.collect_set("label").alias("found"), F.max("score").alias("score"))
    both = based.drop("hits").join(matched, ["id", "text_hash"], "left")
    labels = F.array_sort(F.array_union("base_labels", F.coalesce("found", F.array().cast("array<string>"))))
    return both.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", labels.alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
