"""License scans by diagonal voting (DataFrame functions only).

All rolling three-word grams of all documents are joined by 64-bit hash to the
grams of the license templates. A hit votes for the diagonal (document position less
template position). Full diagonals are exact occurrences; neighbouring
diagonals of a template, shifted by inserted or dropped words, are merged and
kept as a span if they cover enough of the template within a bounded length,
and if the words found tell the template from those of other labels. Of
overlapping spans the one that covers most stays.
"""

from __future__ import annotations

import json
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verdigris.llm.common import let

K = 3
SHIFT = 3
COVER, STRETCH = 0.6, 1.5
TEMPLATE = ("array<struct<template: int, label: string, is_base: boolean, words: array<string>, "
            "rivals: array<array<int>>>>")
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOKEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# The base phrases and their labels.
BASE = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))

# Opening or characteristic sentences of widespread licenses (public texts).
OPENINGS = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("apache-2", "licensed under the apache license version 2 0 you may not use this file except in compliance "
                 "with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu "
             "lesser general public license as published by the free software foundation"),
    ("agpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
             "affero general public license as published by the free software foundation"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee "
            "is hereby granted"),
    ("all-rights-reserved", "all rights reserved no part of this publication may be reproduced"),
)

# Versions that follow an opening, and names by which short notices tell a license.
VERSIONS = (("gpl", "2"), ("gpl", "3"), ("lgpl", "2.1"), ("lgpl", "3"), ("agpl", "3"))
GNU = (("gpl", "gnu general public license"), ("lgpl", "gnu lesser general public license"),
       ("agpl", "gnu affero general public license"))
NAMES = (
    ("mit", "the mit license"), ("isc", "the isc license"),
    ("apache-2", "apache license version 2 0"), ("apache-2", "apache license 2 0"), ("apache-2", "apache 2 0 license"),
    ("bsd", "the bsd license"), ("bsd-2", "2 clause bsd license"), ("bsd-2", "bsd 2 clause license"),
    ("bsd-2", "simplified bsd license"), ("bsd-3", "3 clause bsd license"), ("bsd-3", "bsd 3 clause license"),
    ("bsd-3", "new bsd license"),
    ("mpl", "mozilla public license"), ("mpl-1.1", "mozilla public license version 1 1"),
    ("mpl-2", "mozilla public license version 2 0"), ("mpl-2", "mozilla public license 2 0"),
    *GNU, *((f"{label}-{v}", f"{name} {how}{v.replace('.', ' ')}") for label, v in VERSIONS
            for name in (dict(GNU)[label], f"gnu {label}") for how in ("version ", "v")),
    ("cc0", "creative commons zero"), ("cc0", "cc0 1 0 universal"), ("all-rights-reserved", "all rights reserved"),
)
CC = (("cc-by", "", ""), ("cc-by-sa", "sharealike ", " sa"), ("cc-by-nc", "noncommercial ", " nc"),
      ("cc-by-nd", "noderivatives ", " nd"), ("cc-by-nc-sa", "noncommercial sharealike ", " nc sa"),
      ("cc-by-nc-nd", "noncommercial noderivatives ", " nc nd"))


def _templates() -> tuple:
    """Openings, openings with a version, names alone and in a notice, names of the Creative Commons variants."""
    notice = "this work is licensed under "
    opening = dict(OPENINGS)
    cc = []
    for label, long, short in CC:
        for kind in ("4 0 international license", "3 0 unported license", "license"):
            cc += [(label, f"{lead}creative commons attribution {long}{kind}") for lead in (notice + "a ", "")]
        cc += [(label, f"{lead}cc by{short} {v} 0") for lead in (notice, "") for v in (4, 3)]
        cc += [(label, f"cc by{short}")] if short else []
    return (*OPENINGS, *((f"{label}-{v}", f"{opening[label]} either version {v.replace('.', ' ')} of the license")
                         for label, v in VERSIONS),
            *NAMES, *((label, notice + ("" if name.startswith("the ") else "the ") + name) for label, name in NAMES
                      if not name.startswith(("all ", "cc0 "))), *cc)


TEMPLATES = _templates()


def license_words(text: Column) -> Column:
    """Words of a lower-cased text. Only ASCII capitals can matter to the ASCII templates; the Kelvin
    sign, the one other character whose lower case is ASCII, is taken out of the way first."""
    return F.regexp_extract_all(
        F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit(""))), F.lit(TOKEN), F.lit(0))


def _grams(words: Column) -> Column:
    """64-bit hashes of the rolling word grams."""
    return F.when(F.size(words) >= K, F.transform(
        F.sequence(F.lit(0), F.size(words) - K), lambda i: F.xxhash64(*[words[i + j] for j in range(K)]))
    ).otherwise(F.array().cast("array<bigint>"))


def _rivals(templates: list) -> list:
    """Per template and gram: the templates of other labels that hold the gram, but not the whole template."""
    grams = [[tuple(w[j:j + K]) for j in range(len(w) - K + 1)] for w in (text.split(" ") for _, text in templates)]
    sets, holders = [set(g) for g in grams], defaultdict(list)
    for i, g in enumerate(sets):
        for x in g:
            holders[x].append(i)
    return [[[j for j in holders[x] if templates[j][0] != templates[i][0] and not sets[i] <= sets[j]] for x in g]
            for i, g in enumerate(grams)]


def template_grams(spark: SparkSession, base: tuple = BASE, templates: tuple = TEMPLATES) -> DataFrame:
    """Rows (hash, template, label, is_base, tpos, n_grams, rivals); a few words per template, so broadcast."""
    rivals = [*([[]] * (len(t.split(" ")) - K + 1) for _, t in base), *_rivals(list(templates))]
    rows = [{"template": i, "label": label, "is_base": i < len(base), "words": text.split(" "), "rivals": rivals[i]}
            for i, (label, text) in enumerate([*base, *templates])]
    t = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), TEMPLATE)))
    return (t.select(F.posexplode(_grams(F.col("words"))).alias("tpos", "hash"), "template", "label", "is_base",
                     (F.size("words") - (K - 1)).alias("n_grams"), "rivals")
            .withColumn("rivals", F.get("rivals", F.col("tpos"))))


def gram_hits(docs: DataFrame, base: tuple = BASE, templates: tuple = TEMPLATES) -> DataFrame:
    """One row per document and distinct vote, and one without template per document: keys, ``n_words`` and ``copies``.

    A gram that marks the document itself goes before its grams, so documents
    without a hit come out of the same join, and only hits and marks are aggregated.
    """
    marks = template_grams(docs.sparkSession, base, templates).withColumn("from", F.lit(1))
    known = marks.unionByName(docs.sparkSession.range(1).select(
        F.lit(0).cast("long").alias("hash"), F.lit(0).alias("from")), allowMissingColumns=True)
    mark = F.array(F.lit(0).cast("long"))
    grams = docs.select(
        "doc_id", F.xxhash64("text").alias("__text"),
        let(license_words(F.col("text")),
            lambda w: F.struct(F.size(w).alias("n"), F.concat(mark, _grams(w)).alias("grams"))).alias("w"))
    every = grams.select("doc_id", "__text", F.col("w.n").alias("n_words"), F.posexplode("w.grams").alias("pos", "hash"))
    return (every.join(F.broadcast(known), "hash").where(F.least("pos", F.lit(1)) == F.col("from"))
            .withColumn("diagonal", F.col("pos") - 1 - F.col("tpos"))
            .groupBy("doc_id", "__text", "n_words", "template", "label", "is_base", "n_grams", "diagonal", "tpos")
            .agg(F.first("rivals").alias("rivals"), F.count(F.lit(1)).alias("copies")))


def _best(spans: str) -> Column:
    """Of overlapping spans the one with most grams, then the higher coverage, the first, the earlier template."""
    ranked = F.array_sort(F.transform(spans, lambda x: F.struct(
        x["order"], (-x["coverage"]).alias("short"), x["first"], x["template"], x["end"], x["label"], x["coverage"])))
    none = F.filter(ranked, lambda x: F.lit(False))
    kept = F.aggregate(ranked, none, lambda held, x: F.when(
        F.exists(held, lambda y: (y["first"] < x["end"]) & (x["first"] < y["end"])), held).otherwise(F.concat(held, F.array(x))))
    return F.array_sort(F.transform(kept, lambda x: F.struct(x["first"], x["end"], x["label"], x["coverage"])))


def license_scan(docs: DataFrame, base: tuple = BASE, templates: tuple = TEMPLATES) -> DataFrame:
    """License spans of every document.

    Returns per distinct (doc_id, text): n_words, ``copies`` (rows that repeat
    it), ``base`` (array of full base places: start, label) and ``spans``
    (array of verified template spans: first word, end, label, coverage). Null
    and empty texts have no words; rows without doc_id are scanned like all
    others; an empty table gives no rows.
    """
    of = ["doc_id", "__text", "n_words"]
    votes = gram_hits(docs, base, templates)
    # merge neighbouring diagonals of one template
    along = Window.partitionBy(*of, "template").orderBy("diagonal", "tpos")
    # a short template is shifted by fewer words, so that copies of it side by side stay apart
    shift = F.least(F.lit(SHIFT), F.floor((F.col("n_grams") + (K - 1)) / 3))
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > shift, F.lit(True))
    # base places: diagonals on which every gram of the phrase has voted
    on = F.count(F.lit(1)).over(Window.partitionBy(*of, "template", "diagonal"))
    merged = (votes.withColumn("__new", apart.cast("int")).withColumn("__on", on)
              .withColumn("__span", F.sum("__new").over(along))
              .groupBy(*of, "template", "label", "is_base", "n_grams", "__span")
              .agg(F.size(F.collect_set("tpos")).alias("covered"), F.collect_set("rivals").alias("rivals"),
                   F.collect_set(F.when(F.col("is_base") & (F.col("__on") == F.col("n_grams")), F.col("diagonal"))).alias("starts"),
                   F.min(F.col("diagonal") + F.col("tpos")).alias("first"),
                   (F.max(F.col("diagonal") + F.col("tpos")) + K).alias("end"),
                   F.max(F.when(F.col("template").isNull(), F.col("copies"))).alias("copies")))
    length = F.col("n_grams") + (K - 1)
    # a template of another label that holds all grams found explains them as well: they tell nothing
    told = F.size(F.aggregate("rivals", F.get("rivals", F.lit(0)), F.array_intersect)) == 0
    verified = (~F.col("is_base") & (F.col("covered") >= F.ceil(F.col("n_grams") * COVER))
                & (F.col("end") - F.col("first") <= length * STRETCH) & told)
    places = F.transform("starts", lambda x: F.struct(x.alias("start"), F.col("label").alias("label")))
    found = merged.groupBy(*of).agg(
        F.max("copies").alias("copies"), F.sort_array(F.flatten(F.collect_list(places))).alias("base"),
        F.collect_list(F.when(verified, F.struct(
            (-F.col("covered")).alias("order"), (F.col("covered") / F.col("n_grams")).alias("coverage"), "first", "end",
            "label", "template"))).alias("spans"))
    return found.withColumn("spans", _best("spans"))


def license_documents(docs: DataFrame, base: tuple = BASE, templates: tuple = TEMPLATES) -> DataFrame:
    """One row per document row with counts, places and labels; see ``license_scan``."""
    found = license_scan(docs, base, templates)
    names = F.transform("base", lambda x: x["label"])
    more = F.transform("spans", lambda x: x["label"])
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    starts = F.transform("base", lambda x: x["start"].cast("long"))
    per = found.select(
        "doc_id", "copies", F.col("n_words").cast("long").alias("n_words"), F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(names).alias("base_labels"), joined(F.concat(names, more)).alias("labels"),
        F.greatest(F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.lit(0.0)),
                   F.coalesce(F.array_max(F.transform("spans", lambda x: x["coverage"])), F.lit(0.0))).alias("score"))
    return per.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies", "__copy")
