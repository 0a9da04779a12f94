"""License scans: an exact set-similarity join of text blocks with license templates, in DataFrame expressions only.

Blocks are windows of ``BLOCK`` words, ``STEP`` apart, so any passage of ``STEP`` words lies whole in one.  A block meets a
template if it holds at least ``least`` of the template's different words.  Words of templates are counted over all documents
and put in order, rarest first.  A block that meets a template has one of the template's first words in that order (prefix),
enough template words altogether (length), and, from the first word both share, enough words left on both sides
(positional); blocks that pass are joined with templates on prefix words and verified.  Blocks of documents without any prefix
word are never made.

Besides, three phrases are found wherever their words stand one after another.

Defined results: a null or empty text has no words; a document meets a template if one of its blocks does; rows that agree in
id and text get the same labels.  The templates are the query set; their words, a few hundred, are the only thing broadcast.
"""
from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, functions as F

from .common import whole_text, written

BLOCK, STEP, LEAST = 64, 32, 0.8
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases by label (fixed values).
PHRASES = {"mit": ("mit", "license"), "apache": ("apache", "license"), "gpl": ("general", "public", "license")}
#: The first sentences of well-known notices, by label (fixed values).
TEMPLATES = {
    "agpl-3.0": "under the terms of the gnu affero general public license as published by the free software foundation version 3",
    "apache-2.0": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "cc-by-4.0": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "mit-license": "released under the mit license",
    "mit-notice": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
}


def words(text: Column) -> Column:
    """Runs of ASCII letters and digits and of characters outside ASCII, in lower case."""
    parts = F.split(F.lower(text), _GAP)
    first, last = (F.element_at(parts, 1) == "").cast("int"), ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("int")
    return F.slice(parts, first + 1, F.size(parts) - first - last)


def _texts(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def phrase_places(w: Column) -> Column:
    """start and label of each place where a phrase's words stand one after another."""
    def ends(label: str, phrase: tuple[str, ...]) -> Column:
        n = len(phrase)
        def here(_: Column, i: Column) -> Column:
            test = F.get(w, i) == phrase[-1]
            for k in range(2, n + 1):
                test = test & (i >= k - 1) & (F.get(w, i - (k - 1)) == phrase[-k])
            return F.when(test, F.struct((i - (n - 1)).cast("long").alias("start"), F.lit(label).alias("label")))
        return F.filter(F.transform(w, here), lambda x: x.isNotNull())
    return F.concat(*[ends(k, p) for k, p in PHRASES.items()])


def ordered_words(docs: DataFrame, templates: dict[str, str], text: str) -> list[str]:
    """The templates' words, rarest first by the number of documents that hold them."""
    vocabulary = sorted({w for t in templates.values() for w in t.split()})
    found = docs.select(F.explode(F.array_intersect(_texts(vocabulary), words(whole_text(text)))).alias("word"))
    counts = {r.word: r["count"] for r in found.groupBy("word").count().collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def _prefixes(templates: dict[str, str], order: list[str], least: float) -> list[tuple[str, str, int, int, int]]:
    """(word, label, place of the word, size, words needed) for each template and prefix word."""
    out = []
    for label, text in templates.items():
        own = sorted(set(text.split()), key=order.index)
        need = ceil(least * len(own) - 1e-9)
        out += [(w, label, p, len(own), need) for p, w in enumerate(own[:len(own) - need + 1])]
    return out


def met_templates(blocks: DataFrame, templates: dict[str, str], order: list[str], least: float) -> DataFrame:
    """doc, label and containment of each template that a block of a document meets.  ``blocks``: doc, own (words)."""
    spark = blocks.sparkSession
    prefixes = F.broadcast(spark.createDataFrame(_prefixes(templates, order, least), "word string, label string, p int, size int, need int"))
    whole = F.broadcast(spark.createDataFrame([(k, sorted(set(t.split()))) for k, t in templates.items()], "of string, tokens array<string>"))
    ranked = blocks.select("doc", F.array_intersect(_texts(order), F.col("own")).alias("ranked"))
    places = ranked.select("doc", "ranked", F.posexplode("ranked").alias("q", "word"))
    enough = F.least(F.col("size") - F.col("p"), F.size("ranked") - F.col("q")) >= F.col("need")
    pairs = places.join(prefixes, "word").where((F.size("ranked") >= F.col("need")) & enough)
    shared = F.size(F.array_intersect("ranked", "tokens"))
    met = pairs.join(whole, F.col("label") == F.col("of")).where(shared >= F.col("need"))
    return met.groupBy("doc", "label").agg(F.max(shared / F.col("size")).alias("containment"))


def license_labels(docs: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = LEAST, text: str = "text",
                   doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of each row."""
    order = ordered_words(docs, templates, text)
    rare = sorted({w for w, *_ in _prefixes(templates, order, least)})
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("body")).withColumn("w", words(F.col("body")))
    none = F.array().cast("array<struct<start: bigint, label: string>>")
    places = F.when(F.lower("body").contains("license"), phrase_places(F.col("w"))).otherwise(none)
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.sha2("body", 256))
    hit = F.arrays_overlap(F.col("w"), _texts(rare))
    step = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil((F.size("w") - BLOCK) / STEP)).cast("int"))
    blocks = F.transform(step, lambda i: F.array_distinct(F.slice(F.col("w"), i * STEP + 1, BLOCK)))
    blocks = F.filter(blocks, lambda b: F.arrays_overlap(b, _texts(rare)))
    rows = rows.select("doc_id", F.size("w").cast("long").alias("n_words"), places.alias("places"), F.when(hit, key).alias("doc"),
                       F.when(hit, blocks).alias("blocks"))
    rows = written(rows, "licences")
    seen = rows.where("doc is not null").dropDuplicates(["doc"]).select("doc", F.explode("blocks").alias("own"))
    met = met_templates(seen, templates, order, least).groupBy(F.col("doc").alias("d")).agg(
        F.collect_set("label").alias("met"), F.max("containment").alias("best"))
    # Documents without a candidate have no key to look up; they are spread over keys that nothing has.
    other = F.concat(F.lit("none "), F.pmod(F.xxhash64("doc_id", "n_words"), F.lit(4096)).cast("string"))
    rows = rows.join(met, F.coalesce("doc", other) == F.col("d"), "left")
    base = F.array_sort(F.array_distinct(F.col("places.label")))
    both = F.array_sort(F.array_union(base, F.coalesce("met", F.array().cast("array<string>"))))
    return rows.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min("places.start").alias("first_word"),
        F.array_max("places.start").alias("last_word"), F.array_join(base, ",").alias("base_labels"), F.array_join(both, ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))
