"""License scans: places of known phrases, and an exact set-similarity join against notice templates.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A text block is a window
of ``BLOCK`` words; one starts at every ``BLOCK / 2`` words, so that every passage of up to half a
block lies in one whole. A template matches a block that holds at least ``THRESHOLD`` of its
distinct words. The join is exact: the corpus frequency orders all words of the templates, rarest
first; of a template with ``n`` words of which ``need`` must be there, one of the first
``n - need + 1`` is in every matching block (prefix filter). Candidates then need enough words in
the block (length filter) and enough words from the shared one onwards in both orders (positional
filter); the words they share are counted last.

The templates are a fixed list, so their words and frequencies are a table of fixed size. Blocks
are spread by document and block; no step gathers the rows of a template or of a word.

Nulls and ties: a null text is empty: no words, no labels, score 0. Rows with equal doc_id are told
apart by their text; repeated rows get equal results. Texts are split whole, whatever their length. An empty
table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewinds.llm._shared import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Word characters of a text that isn't lower-cased yet, and all others.
WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Phrases whose every place counts, with their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
#: Notices: label and words. None has more words than half a block.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
)
BLOCK = 48
THRESHOLD = 0.9


def needed(n: int, threshold: float = THRESHOLD) -> int:
    """Words of a template of ``n`` that a block must hold."""
    return math.ceil(threshold * n - 1e-9)


def word_list(text: Column) -> Column:
    """The words of a text, in order."""
    return F.filter(F.split(F.translate(text, UPPER, LOWER), BREAK), lambda w: w != "")


def frequencies(docs: DataFrame, words: list[str]) -> dict[str, int]:
    """How often each of ``words``, a fixed list, stands in the corpus."""
    found = docs.select(F.explode(F.filter(F.split(F.lower("text"), BREAK), lambda w: w.isin(words))).alias("word"))
    return {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}


def postings(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> list[tuple]:
    """``(template, label, n, need, word, place, order)``: the words of each template, rarest first.

    ``place`` counts within the template from 1, ``order`` over the words of all templates.
    """
    sets = [(label, sorted(set(text.split()))) for label, text in templates]
    words = sorted({w for _, s in sets for w in s})
    n = frequencies(docs, words)
    order = {w: i for i, w in enumerate(sorted(words, key=lambda w: (n.get(w, 0), w)))}
    return [(t, label, len(s), needed(len(s), threshold), w, place, order[w]) for t, (label, s) in enumerate(sets) for place, w in enumerate(sorted(s, key=order.get), 1)]


def _phrase_places(words: Column, phrase: str) -> Column:
    """Starts of a phrase in a list of words, from 0."""
    first, *rest = phrase.split()
    n = len(rest) + 1

    def here(i: Column) -> Column:
        said = F.element_at(words, i + 1) == first
        for k, word in enumerate(rest, 2):
            said = said & (F.element_at(words, i + F.lit(k)) == word)
        return said

    starts = F.sequence(F.lit(0), F.size(words) - n)
    return F.when(F.size(words) >= n, F.filter(starts, here)).otherwise(F.array().cast("array<int>"))


def matches(hits: DataFrame, table: list[tuple], block: int = BLOCK) -> DataFrame:
    """``doc_id, text_key, block, template, label, containment``: every match in rows with ``words``.

    ``hits`` needs every row that can match; ``table`` comes from ``postings``.
    """
    spark = hits.sparkSession
    lists = spark.createDataFrame(table, "template int, label string, n int, need int, word string, place int, order int")
    known = sorted({r[4] for r in table})
    spots = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("at"))), lambda s: s["word"].isin(known))
    rows = hits.select("doc_id", "text_key", F.explode(spots).alias("spot")).select("doc_id", "text_key", "spot.word", "spot.at").distinct()
    half = block // 2
    starts = F.filter(F.array(F.expr(f"at DIV {half} - 1"), F.expr(f"at DIV {half}")), lambda b: b >= 0)
    rows = rows.select("doc_id", "text_key", "word", F.explode(starts).alias("block")).distinct()
    orders = F.broadcast(lists.select("word", "order").distinct())  # as many rows as the templates have words
    sets = rows.join(orders, "word").groupBy("doc_id", "text_key", "block").agg(F.sort_array(F.collect_set(F.struct("order", "word"))).alias("known"))  # at most a block's words
    firsts = F.broadcast(lists.where("place <= n - need + 1").select("template", "label", "n", "need", "place", "word"))
    pairs = sets.select("*", F.posexplode("known").alias("nth", "one")).withColumn("word", F.col("one.word")).join(firsts, "word")
    pairs = pairs.where("size(known) >= need AND 1 + least(n - place, size(known) - nth - 1) >= need")
    pairs = pairs.select("doc_id", "text_key", "block", "template", "label", "n", "need", "known").distinct()
    whole = F.broadcast(lists.groupBy("template").agg(F.collect_set("word").alias("all")))
    shared = F.size(F.array_intersect(F.transform("known", lambda k: k["word"]), F.col("all")))
    found = pairs.join(whole, "template").withColumn("shared", shared).where("shared >= need")
    return found.select("doc_id", "text_key", "block", "template", "label", (F.col("shared") / F.col("n")).alias("containment"))


def license_scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` for each row."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    table = postings(texts, templates, threshold)
    rare = sorted({r[4] for r in table if r[5] <= r[2] - r[3] + 1})
    low = F.col("low")
    may = F.lit(False)
    for phrase, _ in PHRASES:  # a text that lacks one of its words has no place of a phrase
        every_word = F.lit(True)
        for word in phrase.split():
            every_word = every_word & low.contains(word)
        may = may | every_word
    for word in rare:
        may = may | low.contains(word)
    rows = texts.select("doc_id", "text", F.lower("text").alias("low")).withColumn("may", may)
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_key"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"), F.when(F.col("may"), word_list(F.col("text"))).alias("words"))
    hits = written(rows.where("words IS NOT NULL").select("doc_id", "text_key", "words"), "license-hits")  # split once
    starts = [f"_at{k}" for k in range(len(PHRASES))]
    hits_known = hits.select("doc_id", "text_key", "words", *(_phrase_places(F.col("words"), p).alias(s) for (p, _), s in zip(PHRASES, starts, strict=True)))
    every = F.concat(*starts)
    base = F.array_compact(F.array(*(F.when(F.size(s) > 0, F.lit(label)) for (_, label), s in zip(PHRASES, starts, strict=True))))
    base_rows = hits_known.select("doc_id", "text_key", F.size(every).cast("long").alias("n_base"), F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"), F.array_sort(F.array_distinct(base)).alias("base")).where("n_base > 0").distinct()
    near = matches(hits, table, block).groupBy("doc_id", "text_key").agg(F.collect_set("label").alias("near"), F.max("containment").alias("best"))
    empty = {"n_base": "long", "first_word": "long", "last_word": "long", "base": "array<string>"}
    both = base_rows.unionByName(near, allowMissingColumns=True).groupBy(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"))
    marked = both.agg(*(F.max(c).cast(kind).alias(c) for c, kind in empty.items()), F.max("near").alias("near"), F.max("best").alias("best"))
    marked = written(marked, "license-marked")
    out = rows.select("doc_id", "text_key", "n_words").join(marked, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_key") == F.col("_key")), "left")
    none = F.array().cast("array<string>")
    labels = F.array_sort(F.array_union(F.coalesce("base", none), F.coalesce("near", none)))
    return out.select("doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word", F.array_join(F.coalesce("base", none), ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))
