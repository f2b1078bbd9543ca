"""License scan: an exact set-similarity join of text blocks with license notices.

A block is a window of a document's words, across line breaks, a template one license notice; both are
token sets.  Windows come in a few lengths (``WINDOWS``) and start at every quarter of their length, so
wherever a notice stands, wrapped or not, some window of its length class holds it whole, and words
scattered over long prose are in none together.
A block meets a template of its class if it holds at least ``THRESHOLD`` of the template's tokens; a template met
inside a larger one that the same block meets (GPL's words inside LGPL's) gives no label.
Only template tokens can add to that overlap, so blocks are cut to them; their global
order is by document frequency over all documents, rarest first.  With o = the overlap a
template needs, a meeting block shares a token with the template's first |T| - o + 1
tokens inside its own first |B| - o + 1 (prefix filter), has |B| >= o (length filter), and
enough tokens left after that shared one (positional filter).  So only windows around a token of
some template's prefix are made at all.  Survivors are checked on their whole sets: no meeting block
is lost and no other reported.

Beside that, the places of the base phrases are counted word by word.

Defined cases: null and empty texts have no words (no places, empty labels, score 0);
repeated rows are reported each; equal frequencies are ordered by token; null ids are
kept; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.9
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Base phrases and their labels.
BASE_PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
# License notices and their labels.
TEMPLATES = (
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at www apache org"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "licensed under the gnu general public license"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("public-domain", "this is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "copyright all rights reserved"),
)
#: words of a window, by class; a quarter of it is the stride, so a notice of 3/4 of it and one word more always fits
WINDOWS = (8, 16, 32, 64)


def need(size: int, threshold: float) -> int:
    """Smallest overlap that meets the containment threshold (guarded against rounding up)."""
    return math.ceil(threshold * size - 1e-9)


def supersets(templates) -> list[list[int]]:
    """For each template, those whose token sets hold its own and more."""
    sets = [set(t.split()) for _, t in templates]
    return [[j for j, other in enumerate(sets) if own < other] for own in sets]


def classes(templates) -> list[int]:
    """The window of each template: the least that holds it wherever it stands, and so the templates that hold its tokens."""
    longest = [max([len(text.split()), *(len(templates[j][1].split()) for j in above)]) for (_, text), above in zip(templates, supersets(templates))]
    return [next(w for w in WINDOWS if n <= w - w // 4 + 1) for n in longest]


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SEPARATORS), "")


def _lower(text_col: str) -> Column:
    return F.translate(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def token_order(docs: DataFrame, templates, text_col: str = "text") -> list[str]:
    """Template tokens, rarest first, by the number of documents (all of them) that hold each."""
    vocabulary = sorted({w for _, t in templates for w in t.split()})
    held = docs.select(F.explode(F.array_intersect(_strings(vocabulary), _words(_lower(text_col)))).alias("w"))
    count = {r["w"]: r["n"] for r in held.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a template token
    return sorted(vocabulary, key=lambda w: (count.get(w, 0), w))


def _places(words: str, lower: str, phrase: str) -> Column:
    """Word positions where the phrase's words stand consecutively."""
    parts = phrase.split()
    w = F.col(words)

    def here(i):
        hit = F.get(w, i) == parts[0]
        for k, part in enumerate(parts[1:], start=1):
            hit = hit & (F.get(w, i + k) == part)
        return hit
    may = F.col(lower).contains(parts[0])
    for part in parts[1:]:
        may = may & F.col(lower).contains(part)
    every = F.filter(F.sequence(F.lit(0), F.size(w) - 1), here)
    return F.when(may & (F.size(w) >= len(parts)), every).otherwise(F.array().cast("array<int>"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, phrases=BASE_PHRASES,
         threshold: float = THRESHOLD) -> DataFrame:
    """Per document: words, places of base phrases, labels, score and the number of meeting blocks."""
    spark = docs.sparkSession
    order = token_order(docs, templates, text_col)
    rank = {w: i for i, w in enumerate(order)}
    above, window = supersets(templates), classes(templates)
    index = []
    for tid, (label, text) in enumerate(templates):
        tokens = sorted(set(text.split()), key=rank.__getitem__)
        o = need(len(tokens), threshold)
        index += [(w, j, tid, label, tokens, o, window[tid], above[tid]) for j, w in enumerate(tokens[:len(tokens) - o + 1])]
    least = {c: min(need(len(set(t.split())), threshold) for (_, t), k in zip(templates, window) if k == c) for c in set(window)}
    index_df = spark.createDataFrame(index, "t_token string, t_pos int, tid int, t_label string, t_tokens array<string>, t_need int, "
                                            "t_window int, t_above array<int>")

    base = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.monotonically_increasing_id().alias("row"), _lower(text_col).alias("lower"))
    base = base.withColumn("words", _words(F.col("lower")))
    for k, (phrase, _) in enumerate(phrases):
        base = base.withColumn(f"at{k}", _places("words", "lower", phrase))
    places = F.concat(*[F.col(f"at{k}") for k in range(len(phrases))])
    held = F.array_distinct(F.concat(*[F.when(F.size(f"at{k}") > 0, F.array(F.lit(label))).otherwise(F.array().cast("array<string>"))
                                       for k, (_, label) in enumerate(phrases)]))
    def places_of(rare: list[str]) -> Column:
        return F.filter(F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0))), lambda i: F.get("words", i).isin(rare))
    for c in least:
        base = base.withColumn(f"near{c}", places_of(sorted({x[0] for x in index if x[6] == c})))

    def blocks_of(c: int) -> Column:
        """Windows of one class that hold a token of a prefix, each with its number."""
        last = F.transform(f"near{c}", lambda i: F.floor(i / (c // 4)).cast("int"))
        starts = F.array_distinct(F.flatten(F.transform(F.array_distinct(last), lambda k: F.sequence(F.greatest(k - 3, F.lit(0)), k))))
        made = F.transform(starts, lambda k: F.struct(F.lit(c).alias("window"), k.alias("k"), F.array_intersect(
            _strings(order), F.slice("words", k * (c // 4) + 1, c)).alias("tokens")))
        return F.filter(made, lambda b: F.size(b["tokens"]) >= least[c])
    base = base.select("doc_id", "row", F.size("words").cast("bigint").alias("n_words"), places.alias("places"), held.alias("held"),
                       F.concat(*[blocks_of(c) for c in least]).alias("blocks"))
    keys = ["doc_id", "row", "n_words", "n_base", "first_word", "last_word", "held"]
    base = base.select("doc_id", "row", "n_words", F.size("places").cast("bigint").alias("n_base"),
                       F.array_min("places").cast("bigint").alias("first_word"), F.array_max("places").cast("bigint").alias("last_word"),
                       F.sort_array("held").alias("held"), F.explode_outer("blocks").alias("b"))
    base = base.select(*keys, F.struct("b.window", "b.k").alias("b"), F.col("b.tokens").alias("block"))
    # probe with the tokens that can stand in a prefix of the block for some template
    fewest = F.coalesce(*[F.when(F.col("b.window") == c, n) for c, n in least.items()])
    prefix = F.filter("block", lambda w, i: i <= F.size("block") - fewest)
    probe = base.select(*keys, "b", "block", F.posexplode_outer(prefix).alias("b_pos", "b_token"))
    size, pos = F.size("block"), F.col("b_pos")
    meets = ((F.col("b_token") == F.col("t_token")) & (F.col("b.window") == F.col("t_window")) & (size >= F.col("t_need")) & (pos <= size - F.col("t_need"))
             & (1 + F.least(F.size("t_tokens") - F.col("t_pos") - 1, size - pos - 1) >= F.col("t_need")))
    pairs = probe.join(F.broadcast(index_df), meets, "left")  # the index is as long as the stated templates
    overlap = F.size(F.array_intersect("block", "t_tokens"))
    meeting = F.col("tid").isNotNull() & (overlap >= F.col("t_need"))
    met = F.struct("b", "tid", F.col("t_label").alias("label"), (overlap / F.size("t_tokens")).alias("share"), F.col("t_above").alias("above"))
    found = pairs.groupBy(*keys).agg(F.collect_set(F.when(meeting, met)).alias("met"))  # at most a few for each window that meets
    inner = lambda m: F.exists("met", lambda o: (o["b"] == m["b"]) & F.array_contains(m["above"], o["tid"]))
    found = found.withColumn("own", F.filter("met", lambda m: ~inner(m)))
    labels = F.transform("own", lambda m: m["label"])
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("held", ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union("held", labels)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.transform("own", lambda m: m["share"])), F.lit(0.0))).alias("score"),
        F.size(F.array_distinct(F.transform("own", lambda m: m["b"]))).cast("bigint").alias("n_blocks"))
