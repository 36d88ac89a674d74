"""Licence scans over a positional index of rare words.

Licence notices are templates: phrases whose words stand at known places. The index lists
for every telling word of the templates where it stands in which. A file's licence words
are looked up, all of them, so that no notice pushes another out, and each occurrence says
where in the file a template would begin; occurrences that agree on the beginning are a
match, which holds if the template's mandatory phrase is in the file. Words weigh by their
rarity (by document frequency over all files).

All of a file's work is done within its row; only the frequencies are gathered, one
number per word of the index.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.arrays import running

#: Phrases and their labels which every scan has.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


@dataclass(frozen=True)
class Template:
    """A licence notice, and the phrase that must be there."""

    label: str
    text: str
    mandatory: str


#: Customary notices.
TEMPLATES = (
    Template("mit", "released under the mit license", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby granted free of charge"),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2"),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3", "general public license version 3"),
    Template("gpl-2.0", "terms of the gnu general public license version 2", "general public license version 2"),
    Template("lgpl", "terms of the gnu lesser general public license", "lesser general public license"),
    Template("agpl", "terms of the gnu affero general public license", "affero general public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    Template("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
    Template("cc0-1.0", "dedicated to the public domain under cc0 1 0 universal", "cc0 1 0"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee is hereby granted"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software released into the public domain"),
    Template("reserved", "all rights reserved", "all rights reserved"),
    Template("mit", "spdx license identifier mit", "license identifier mit"),
    Template("apache-2.0", "spdx license identifier apache 2 0", "license identifier apache 2 0"),
    Template("gpl-2.0", "spdx license identifier gpl 2 0", "license identifier gpl 2 0"),
    Template("gpl-3.0", "spdx license identifier gpl 3 0", "license identifier gpl 3 0"),
    Template("lgpl", "spdx license identifier lgpl", "license identifier lgpl"),
    Template("agpl", "spdx license identifier agpl", "license identifier agpl"),
    Template("bsd", "spdx license identifier bsd 2 clause", "license identifier bsd 2 clause"),
    Template("bsd", "spdx license identifier bsd 3 clause", "license identifier bsd 3 clause"),
    Template("mpl-2.0", "spdx license identifier mpl 2 0", "license identifier mpl 2 0"),
    Template("isc", "spdx license identifier isc", "license identifier isc"),
    Template("unlicense", "spdx license identifier unlicense", "license identifier unlicense"),
    Template("cc0-1.0", "spdx license identifier cc0 1 0", "license identifier cc0 1 0"),
)
#: Words too common in any text to be in the index.
STOPWORDS = frozenset("a all and any are by for in into is of or the this to under use v with without work 0 1 2 3 4".split())
#: Part of a template's different indexed words that must agree on its beginning, whatever its length.
AGREEING = 0.6
#: A template that is cut off at the file's first word begins before it, by fewer words than this.
_AHEAD = 1 << 16


def _padded(text: Column) -> Column:
    """The text's words, A-Z lowered, one blank before, between and after."""
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")), F.lit(" "))


def _blanks(text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(" "), F.lit("")))


def _places(padded: Column, phrase: str) -> Column:
    """Word positions, from 0, at which the phrase stands: words in the gaps before it, and in the phrases themselves."""
    size = len(phrase.split())
    gaps = F.split(padded, f"(?<= ){phrase}(?= )", -1)
    words = F.transform(gaps, lambda g: (_blanks(g) - 1).cast("bigint"))
    ends = running(F.transform(F.slice(words, F.lit(1), F.size(words) - 1), lambda gap: gap + size))
    found = F.transform(ends, lambda end: end - size)
    return F.when(F.contains(padded, F.lit(f" {phrase} ")), found).otherwise(F.array().cast("array<bigint>"))


def indexed(templates: Sequence[Template]) -> dict[str, list[tuple[int, int]]]:
    """Postings: word to template number and position."""
    postings: dict[str, list[tuple[int, int]]] = {}
    for number, template in enumerate(templates):
        for place, word in enumerate(template.text.split()):
            if word not in STOPWORDS or template.label == "reserved":
                postings.setdefault(word, []).append((number, place))
    return postings


def rarity(docs: DataFrame, text_col: str, words: Sequence[str]) -> dict[str, float]:
    """Inverse document frequency of the given words over all documents; the driver gets one number per word."""
    padded = docs.select(_padded(F.col(text_col)).alias("t"))
    held = F.array_distinct(F.regexp_extract_all("t", F.lit(f"(?<= )({'|'.join(sorted(words))})(?= )"), F.lit(1)))
    counts = padded.select(F.explode(F.concat(F.array(F.lit("")), held)).alias("w")).groupBy("w").count()
    found = {r["w"]: r["count"] for r in counts.collect()}
    total = found.pop("", 0)
    return {w: math.log((total + 1) / (found.get(w, 0) + 1)) for w in words}


def scan_licences(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: Sequence[Template] = TEMPLATES,
    agreeing: float = AGREEING,
) -> DataFrame:
    """Per document ``doc_id, n_words, places, base_labels, matches``.

    ``places`` are the word positions of the base phrases. ``matches`` are structs of
    ``label``, ``start`` (the word at which the template would begin) and ``score`` (the
    part of the weight of the file's different licence words that agrees on it).

    Defined cases: a null text is empty, has no words and no labels. Rows without id and
    repeated rows are rows like any other. An empty table gives an empty result. Other
    columns are not read.
    """
    postings = indexed(templates)
    weights = rarity(docs, text_col, sorted(postings))
    rows = docs.select(F.col(id_col).alias("doc_id"), _padded(F.col(text_col)).alias("_t"))
    rows = rows.withColumn("n_words", F.when(F.col("_t") == "  ", F.lit(0)).otherwise(_blanks(F.col("_t")) - 1).cast("bigint"))
    found = [_places(F.col("_t"), p) for p in BASE_PHRASES]
    rows = rows.withColumn("places", F.sort_array(F.concat(*found)))
    labels = [F.when(F.contains("_t", F.lit(f" {p} ")), F.lit(label)) for p, label in BASE_PHRASES.items()]
    rows = rows.withColumn("base_labels", F.filter(F.array(*labels), lambda x: x.isNotNull()))
    matched = _matched(rows, postings, weights, templates, agreeing)
    return matched.select("doc_id", "n_words", "places", "base_labels", "matches")


def _matched(rows: DataFrame, postings, weights, templates, agreeing: float) -> DataFrame:
    """The rows with ``matches``, worked out from their padded text column step by step."""
    entry = "array<struct<template:int,place:int>>"
    order = sorted(postings)

    def looked(held: list[tuple[int, int]]) -> Column:
        return F.array(*[F.struct(F.lit(t).alias("template"), F.lit(p).alias("place")) for t, p in held]).cast(entry)

    index = F.create_map(*[x for w in order for x in (F.lit(w), looked(postings[w]))])
    number = F.create_map(*[F.lit(x) for k, w in enumerate(order) for x in (w, k)])
    rare = F.array(*[F.lit(float(weights[w])) for w in order])
    sizes = [sum(any(t == k for t, _ in held) for held in postings.values()) for k in range(len(templates))]
    # a word that stands twice in a template agrees with a beginning once
    asked = F.array(*[F.lit(math.ceil(round(size * agreeing, 9))) for size in sizes])
    labels = F.array(*[F.lit(t.label) for t in templates])

    # only templates whose mandatory phrase is there can match
    able = F.array(*[F.when(F.contains("_t", F.lit(f" {t.mandatory} ")), F.lit(k)) for k, t in enumerate(templates)])
    rows = rows.withColumn("_able", F.filter(able, lambda k: k.isNotNull()))
    words = F.transform(F.split(F.trim("_t"), " ", -1), lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    placed = F.filter(words, lambda x: F.map_contains_key(index, x["w"]))
    none = F.array().cast("array<struct<w:string,i:int>>")
    rows = rows.withColumn("_placed", F.when(F.size("_able") > 0, placed).otherwise(none))
    every = F.aggregate(F.array_distinct("_placed.w"), F.lit(0.0), lambda a, w: a + F.get(rare, number[w]))
    rows = rows.withColumn("_every", every)

    # every occurrence votes for the beginnings that its postings imply: template, beginning and word in one number
    def vote(x: Column, p: Column) -> Column:
        begin = p["template"].cast("bigint") * (1 << 32) + (x["i"] - p["place"] + _AHEAD)
        return begin * (1 << 16) + number[x["w"]]

    def votes(x: Column) -> Column:
        held = F.filter(index[x["w"]], lambda p: F.array_contains("_able", p["template"]))
        return F.transform(held, lambda p: vote(x, p))

    rows = rows.withColumn("_votes", F.sort_array(F.array_distinct(F.flatten(F.transform("_placed", votes)))))

    def begin_of(v: Column) -> Column:
        return F.shiftright(v, 16)

    def template_of(v: Column) -> Column:
        return F.shiftright(v, 48).cast("int")

    # in order, votes for one beginning are neighbours: the first of enough of them is a match
    numbered = F.transform("_votes", lambda v, i: F.struct(v.alias("v"), i.alias("i")))
    held = F.filter(
        numbered,
        lambda x: ~begin_of(x["v"]).eqNullSafe(begin_of(F.get("_votes", x["i"] - 1)))
        & (begin_of(F.get("_votes", x["i"] + F.greatest(F.get(asked, template_of(x["v"])), F.lit(1)) - 1)) == begin_of(x["v"])),
    )

    def told(x: Column) -> Column:
        same = F.filter(F.slice("_votes", x["i"] + 1, max(sizes)), lambda v: begin_of(v) == begin_of(x["v"]))
        weight = F.aggregate(same, F.lit(0.0), lambda a, v: a + F.get(rare, v.bitwiseAND(F.lit(0xFFFF)).cast("int")))
        score = F.when(F.col("_every") > 0, weight / F.col("_every")).otherwise(F.lit(1.0))
        start = (begin_of(x["v"]).bitwiseAND(F.lit((1 << 32) - 1)) - _AHEAD).cast("int")
        return F.struct(F.get(labels, template_of(x["v"])).alias("label"), start.alias("start"), score.alias("score"))

    return rows.withColumn("matches", F.transform(held, told))


def digest(scanned: DataFrame) -> DataFrame:
    """Counts, first and last places, labels and the best score (six places; a base phrase alone: 0.5), one row per document."""
    own = F.transform("matches", lambda m: m["label"])
    every = F.array_sort(F.array_distinct(F.concat("base_labels", own)))
    best = F.array_max(F.concat(F.transform("matches", lambda m: m["score"]), F.array(F.lit(0.0))))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min("places").alias("first_word"),
        F.array_max("places").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base_labels")), ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.round(F.least(F.lit(1.0), F.when(F.size("places") > 0, F.greatest(best, F.lit(0.5))).otherwise(best)), 6).alias("score"),
    )
