"""License scans: exact set-similarity join of text blocks and templates.

A text block is a run of ``BLOCK_WORDS`` words; blocks start every
``BLOCK_WORDS / 2`` words, so any passage of up to half a block lies whole in
some block, however the text is broken into lines. A block meets a template
when it holds at least ``threshold`` of the template's distinct words.

Join, as set-similarity joins do it: the templates' words are put in order of
their document frequency over the whole corpus (rarest first); a block that
meets a template of t words with overlap o = ceil(threshold * t) must hold
one of its t - o + 1 rarest words (prefix), must have at least o distinct
words (length), and, with the first shared word at place i of the template
and j of the block, can share at most 1 + min(t - i - 1, b - j - 1) words
(position). Pairs that pass are verified exactly. Filters only skip work:
the result does not depend on the order.

Everything is DataFrame functions. The template index holds one row per
prefix word of a fixed template list, whatever the corpus; only it is
broadcast. Documents are never joined with each other and never shuffled
with their text: one row per document (ids, counts, labels) is grouped after
the join.

Defined cases: null or empty text has no words, no places and score 0; every
input row gives one row, also with a null or repeated id; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import LOWER, UPPER

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.9
BLOCK_WORDS = 64

# Base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# License statements (label, words).
TEMPLATES = [
    ("all-rights-reserved", "all rights reserved"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "released under the bsd license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the "
            "software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
            "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject "
            "to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the software the software is provided as is without warranty of any kind express or implied including but not limited "
            "to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or "
            "copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising "
            "from out of or in connection with the software or the use or other dealings in the software"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the "
            "above copyright notice and this permission notice appear in all copies"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("public-domain", "this is free and unencumbered software released into the public domain"),
]


# ASCII characters that WORD excludes, lower-case letters being left: each one
# becomes a blank, upper-case letters their lower case, in one translation;
# the words are then what a split at blanks leaves.
_SEPARATORS = "".join(c for c in map(chr, range(128)) if not c.isalnum())


def words_of(text: Column) -> Column:
    """Matches of WORD in the text with A-Z lower-cased."""
    spaced = F.translate(F.coalesce(text, F.lit("")), _SEPARATORS + UPPER, " " * len(_SEPARATORS) + LOWER)
    return F.array_remove(F.split(spaced, " ", -1), "")


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def window_of(n_words: int, least: int = BLOCK_WORDS) -> int:
    """Words of the blocks a template of ``n_words`` is held against: the
    least power-of-two multiple of ``least`` that is twice as long, so that the
    template stands whole in one of the blocks, which overlap by half."""
    window = least
    while window < 2 * n_words:
        window *= 2
    return window


def template_index(templates=TEMPLATES, threshold=THRESHOLD, frequency: dict[str, int] | None = None,
                   block_words: int = BLOCK_WORDS) -> list[dict]:
    """Each template's distinct words, rarest first, with its overlap bound
    and prefix length."""
    frequency = frequency or {}
    out = []
    for n, (label, text) in enumerate(templates):
        words = sorted(set(text.split()), key=lambda w: (frequency.get(w, 0), w))
        need = math.ceil(threshold * len(words) - 1e-9)
        out.append({"template": n, "label": label, "words": words, "need": need, "prefix": len(words) - need + 1,
                    "window": window_of(len(text.split()), block_words)})
    return out


def word_frequency(words: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Documents of the whole corpus that hold each template word; one row
    per word of the fixed template list at most."""
    rows = (words.select(F.explode(F.array_intersect("words", _strings(vocabulary))).alias("w"))
            .groupBy("w").count().collect())
    return {r["w"]: r["count"] for r in rows}


def _places(words_text: Column, n_words: Column, phrase: str) -> tuple[Column, Column, Column]:
    """Count, first and last start of a phrase in ' w0 w1 ... ' text."""
    n = len(phrase.split())
    parts = F.split(words_text, f" {phrase}(?= )", -1)
    spaces = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    count = F.size(parts) - 1
    if any(phrase.split()[k:] == phrase.split()[:-k] for k in range(1, n)):        # places can overlap
        words, own = F.split(F.trim(words_text), " "), _strings(phrase.split())
        at = F.filter(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(words) - n)), lambda i: F.slice(words, i + 1, n) == own)
        return F.size(at), F.array_min(at), F.array_max(at)
    first = F.when(count > 0, spaces(F.element_at(parts, 1)))
    last = F.when(count > 0, n_words - (spaces(F.element_at(parts, -1)) - 1) - n)
    return count, first, last


def scan(docs: DataFrame, *, id_col="doc_id", text_col="text", templates=TEMPLATES, threshold=THRESHOLD,
         phrases=PHRASES, block_words=BLOCK_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels (arrays), score (largest containment, 1 for a base
    phrase, 0 without any), ``matches``: (block, template, label,
    containment) of every block that meets a template; blocks are counted
    from 0 among those of the template's window (``window_of``)."""
    words = docs.select(F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("words"))
    vocabulary = sorted({w for _, t in templates for w in t.split()})
    frequency = word_frequency(words, vocabulary)
    index = template_index(templates, threshold, frequency, block_words)
    by_rank = sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w))
    prefix_words = sorted({w for t in index for w in t["words"][:t["prefix"]]})

    n_words = F.size("words").cast("long")
    line = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    line = F.when(F.arrays_overlap("words", _strings(sorted({p.split()[-1] for p in phrases}))), line).otherwise(F.lit(" "))
    base = words.withColumns({"key": F.monotonically_increasing_id(), "n_words": n_words, "line": line})
    found = {p: _places(F.col("line"), F.col("n_words"), p) for p in phrases}
    base = base.withColumns({f"_{k}{i}": c for i, p in enumerate(phrases) for k, c in zip("nfl", found[p], strict=True)})
    each = lambda k: [F.col(f"_{k}{i}") for i in range(len(phrases))]
    one_or = lambda f, cs: f(*cs) if len(cs) > 1 else cs[0]
    base_labels = F.array_compact(F.array(*[F.when(F.col(f"_n{i}") > 0, F.lit(x)) for i, x in enumerate(phrases.values())]))
    def blocks_of(window: int) -> Column:
        step = window // 2
        prefix = sorted({w for t in index if t["window"] == window for w in t["words"][:t["prefix"]]})
        starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("words") - 1), F.lit(step))
        blocks = F.transform(starts, lambda s: F.struct((s / step).cast("int").alias("block"), F.lit(window).alias("window"),
                                                        F.slice("words", s + 1, window).alias("w")))
        return F.when(F.arrays_overlap("words", _strings(prefix)), blocks).otherwise(
            F.array().cast("array<struct<block:int,window:int,w:array<string>>>"))

    windows = sorted({t["window"] for t in index})
    blocks = F.concat(*[blocks_of(w) for w in windows]) if windows else F.array().cast("array<struct<block:int,window:int,w:array<string>>>")
    doc = base.select(
        "key", "doc_id", "n_words",
        sum(each("n"), F.lit(0)).cast("long").alias("n_base"),
        one_or(F.least, each("f")).cast("long").alias("first_word"),
        one_or(F.greatest, each("l")).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(base_labels)).alias("base_labels"), F.explode_outer(blocks).alias("b"))
    # the block's template words, in the global order; its count of distinct words
    vocab = _strings(by_rank)
    doc = doc.withColumn("own", F.array_intersect(vocab, F.col("b.w"))).withColumn("size", F.size(F.array_distinct("b.w")))
    hits = doc.withColumn("hit", F.explode_outer(F.array_intersect(F.col("own"), _strings(prefix_words))))
    pairs = hits.join(F.broadcast(_index_table(docs.sparkSession, index)), (F.col("hit") == F.col("word")) & (F.col("b.window") == F.col("t_window")), "left")
    j = F.array_position("own", F.col("hit"))                       # from 1
    first_shared = ~F.arrays_overlap(F.slice("own", F.lit(1), (j - 1).cast("int")), F.slice("t_words", F.lit(1), F.col("at")))
    could_share = 1 + F.least(F.size("t_words") - F.col("at") - 1, F.size("own") - j)
    shared = F.size(F.array_intersect("own", "t_words"))
    match = (F.when(F.col("size") >= F.col("need"),
                    F.when(first_shared & (could_share >= F.col("need")),
                           F.when(shared >= F.col("need"),
                                  F.struct(F.col("b.block").alias("block"), "template", "label",
                                           (shared / F.size("t_words")).alias("containment"))))))
    groups = (pairs.withColumn("match", match)
              .groupBy("key", "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
              .agg(F.array_sort(F.collect_set("match")).alias("matches")))
    labels = F.array_sort(F.array_union("base_labels", F.transform("matches", lambda m: m["label"])))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0)))
    out = groups.withColumns({"labels": labels, "score": score})
    return out


def _index_table(spark: SparkSession, index: list[dict]) -> DataFrame:
    """(word, template, label, at, t_words, need, t_window): a row per prefix word."""
    rows = [F.struct(F.lit(w).alias("word"), F.lit(t["template"]).alias("template"), F.lit(t["label"]).alias("label"),
                     F.lit(i).alias("at"), _strings(t["words"]).alias("t_words"), F.lit(t["need"]).alias("need"),
                     F.lit(t["window"]).alias("t_window"))
            for t in index for i, w in enumerate(t["words"][:t["prefix"]])]
    return spark.range(1).select(F.inline(F.array(*rows)))
