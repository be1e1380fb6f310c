"""License scans: exact containment join of text blocks with license templates.

Native: DataFrame functions only. A block is one line of a text. A template meets a block
when the block holds at least ``threshold`` of the template's distinct words. A notice may be
wrapped: a template of n words also meets a run of ceil(n / ``threshold``) consecutive words of
the text, over line ends, that holds as many of its distinct words.

1. Every text is read once; per line only the words that occur in some template are kept
   (no other word can add to an overlap), beside the word count and the base phrases.
   These narrow rows are written to the shared folder.
2. The number of blocks that hold each template word is counted over all documents; this
   gives the global order (rare words first). It has one row per template word, so its
   size is bounded by the template list, a parameter.
3. With overlap bound a = ceil(threshold * |T|), a block that meets T holds one of the
   |T| - a + 1 rarest words of T (prefix filter), has at least a template words (length
   filter), and the rarest shared word leaves room for a (positional filter). Survivors
   are checked exactly. All of this runs in map tasks; only matches are shuffled.
4. Runs over lines are looked for in documents that hold enough words of some template as
   wholes; the places of template words of these few documents are written as well. Each
   place is taken as a run's start, and only the words within the run's length are looked at.

Nulls and empty texts: no words, no labels, score 0. Repeated rows and ids: each row of
the input gives one row, numbered before the first write. Empty table: no rows.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import LOWER, UPPER, WORD, ascii_lower, literal_table, matches, written

#: Fixed values of the contract: phrase and label.
BASE_PHRASES = [
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
]

#: Customary notices and their labels.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software you can redistribute it and or modify it under the terms of the "
            "GNU General Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License"),
]


def template_words(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))


def _phrase_starts(words: Column, phrase: str) -> Column:
    parts = phrase.split(" ")

    def at(x, i):
        hit = x == parts[0]
        for k, p in enumerate(parts[1:], 1):
            hit = hit & (F.get(words, i + k) == p)
        return F.when(hit, i.cast("long"))

    return F.filter(F.transform(words, at), lambda x: x.isNotNull())


def template_sets(templates, threshold: float) -> list[tuple[int, str, list[str], int, int]]:
    """Per template: number, label, distinct words, how many of them a match holds, words of a run."""
    words = [template_words(t) for _, t in templates]
    return [(k, label, sorted(set(w)), max(1, math.ceil(threshold * len(set(w)) - 1e-9)), math.ceil(len(w) / threshold - 1e-9))
            for k, ((label, _), w) in enumerate(zip(templates, words)) if w]


def block_features(docs: DataFrame, templates, text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """One row per document: ``_row``, the id columns, words, base phrase places, the template
    words of each line, and (``places``; null where no template can be met) the place and line of
    each template word. Reads each text once."""
    vocab = sorted({w for _, t in templates for w in template_words(t)})
    seps = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    any_phrase = "|".join(p.replace(" ", seps) for p, _ in BASE_PHRASES)
    low = docs.select(
        F.col("doc_id"), F.monotonically_increasing_id().alias("_row"),
        ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("_low"))
    lined = low.select(
        "doc_id", "_row", F.col("_low").rlike(any_phrase).alias("_flag"),
        F.transform(F.split("_low", "\n"), lambda x: matches(x, f"({WORD})")).alias("_lines"))
    flat = lined.select(
        "doc_id", "_row", "_lines",
        F.when(F.col("_flag"), F.flatten("_lines")).otherwise(F.array().cast("array<string>")).alias("_words"))
    starts = [_phrase_starts(F.col("_words"), p).alias(f"_s{k}") for k, (p, _) in enumerate(BASE_PHRASES)]
    vocab_lit = F.array(*map(F.lit, vocab)) if vocab else F.array().cast("array<string>")
    placed = flat.select(
        "doc_id", "_row",
        F.aggregate("_lines", F.lit(0).cast("long"), lambda a, x: a + F.size(x)).alias("n_words"),
        "_lines", F.transform("_lines", lambda x: F.array_intersect(x, vocab_lit)).alias("blocks"), *starts)
    held = F.array_distinct(F.flatten("blocks"))
    placed = placed.withColumn("_held", held)
    enough = reduce(lambda a, t: a | (F.size(F.array_intersect("_held", F.array(*map(F.lit, t[2])))) >= t[3]),
                    template_sets(templates, threshold), F.lit(False))
    lines = F.flatten(F.transform("_lines", lambda x, i: F.transform(x, lambda y: F.struct(y.alias("word"), i.alias("line")))))
    places = F.filter(F.transform(lines, lambda x, i: F.struct(x["word"].alias("word"), x["line"].alias("line"), i.alias("p"))),
                      lambda x: F.array_contains(vocab_lit, x["word"]))
    each = [F.col(f"_s{k}") for k in range(len(BASE_PHRASES))]
    both = F.concat(*each)
    labels = F.array_sort(F.array_distinct(F.filter(F.array(*[
        F.when(F.size(s) > 0, F.lit(label)) for s, (_, label) in zip(each, BASE_PHRASES)]), lambda x: x.isNotNull())))
    return placed.select(
        "doc_id", "_row", "n_words", F.size(both).cast("long").alias("n_base"),
        F.array_min(both).alias("first_word"), F.array_max(both).alias("last_word"),
        labels.alias("base_label_list"), "blocks", F.when(enough, places).alias("places"))


def containment_join(features: DataFrame, templates, threshold: float = 0.8) -> DataFrame:
    """All (row, block, template) whose containment reaches ``threshold``: columns ``_row``,
    ``block`` (line number from 0), ``template``, ``label``, ``containment``."""
    spark = features.sparkSession
    sets = [(label, sorted(set(template_words(t)))) for label, t in templates]
    counts = (features.select(F.explode("blocks").alias("_b")).select(F.explode("_b").alias("word"))
              .groupBy("word").count())
    # one row per template word: bounded by the template list
    freq = {r["word"]: r["count"] for r in counts.collect()}
    order = sorted({w for _, s in sets for w in s}, key=lambda w: (freq.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    prefixes, whole = [], []
    for k, (label, s) in enumerate(sets):
        s = sorted(s, key=rank.__getitem__)
        need = max(1, math.ceil(threshold * len(s) - 1e-9))
        whole.append((k, label, s, need))
        prefixes += [(w, k, i, len(s), need) for i, w in enumerate(s[: len(s) - need + 1])]
    if not prefixes:
        return spark.range(0).selectExpr("id AS _row", "0 AS block", "0 AS template", "'' AS label", "0D AS containment")
    least = min(n for *_, n in whole)
    ordered = F.array_intersect(F.array(*map(F.lit, order)), F.col("_b"))
    blocks = (features.select("_row", F.posexplode("blocks").alias("block", "_b"))
              .where(F.size("_b") >= least)
              .select("_row", "block", ordered.alias("_b")))
    probe = blocks.select("_row", "block", "_b", F.posexplode("_b").alias("_j", "word"))
    index = literal_table(spark, prefixes, ["word", "template", "_i", "_size", "_need"],
                          ["string", "int", "int", "int", "int"])
    near = probe.join(F.broadcast(index), "word").where(
        (F.size("_b") >= F.col("_need"))
        & (F.least(F.col("_size") - F.col("_i"), F.size("_b") - F.col("_j")) >= F.col("_need")))
    texts = literal_table(spark, whole, ["template", "label", "_t", "_n"], ["int", "string", "array<string>", "int"])
    shared = F.size(F.array_intersect("_b", "_t"))
    return (near.select("_row", "block", "_b", "template").join(F.broadcast(texts), "template")
            .withColumn("_shared", shared).where(F.col("_shared") >= F.col("_n"))
            .groupBy("_row", "block", "template", "label")
            .agg(F.max(F.col("_shared") / F.size("_t")).alias("containment")))


def wrapped_matches(features: DataFrame, lines: DataFrame, templates, threshold: float = 0.8) -> DataFrame:
    """Runs of words over line ends that meet a template: the columns of ``lines`` (the matches of
    :func:`containment_join`). ``block`` is the line of the run's first template word; null where a line
    within the run meets the template by itself, and in all but the first of runs that lie over each other."""
    spark = features.sparkSession
    sets = template_sets(templates, threshold)
    if not sets:
        return lines.limit(0)
    index = literal_table(spark, [(w, k, label, len(s), need, run) for k, label, s, need, run in sets for w in s],
                          ["word", "template", "label", "_size", "_need", "_run"], ["string", "int", "string", "int", "int", "int"])
    longest = max(run for *_, run in sets)
    at = (features.where(F.col("places").isNotNull()).select("_row", F.inline("places"))
          .join(F.broadcast(index), "word"))
    # the frame is no longer than the longest run, whatever the text's length
    w = Window.partitionBy("_row", "template").orderBy("p")
    near = F.collect_list(F.struct("p", "word", "line")).over(w.rangeBetween(0, longest - 1))
    runs = (at.withColumn("_near", near)
            .withColumn("_near", F.filter("_near", lambda x: x["p"] < F.col("p") + F.col("_run")))
            .withColumn("_shared", F.size(F.array_distinct(F.transform("_near", lambda x: x["word"]))))
            .where(F.col("_shared") >= F.col("_need"))
            .select("_row", "template", "label", "p", "line", "_run", F.array_max(F.transform("_near", lambda x: x["line"])).alias("_last"),
                    (F.col("_shared") / F.col("_size")).alias("containment"))
            .where(F.col("_last") > F.col("line")))
    own = lines.select(F.col("_row").alias("_r"), F.col("template").alias("_t"), "block")
    by_line = ((F.col("_row") == F.col("_r")) & (F.col("template") == F.col("_t"))
               & F.col("block").between(F.col("line"), F.col("_last")))
    free = runs.join(own, by_line, "left_anti")
    before = F.lag("p").over(w)
    first = F.when(before.isNull() | (F.col("p") - before >= F.col("_run")), F.col("line"))
    shown = ["_row", "template", "label", "containment"]
    return (free.withColumn("block", first).select("_row", "block", *shown[1:])
            .unionByName(runs.join(own, by_line, "left_semi").select(*shown, F.lit(None).cast("int").alias("block"))))


def license_scan(docs: DataFrame, templates=None, threshold: float = 0.8, text_col: str = "text") -> DataFrame:
    """Per document: base phrase places, labels of base and templates, and ``score``: the
    highest containment of a matching template, 1 where a base phrase stands, else 0."""
    templates = TEMPLATES if templates is None else templates
    features = written(block_features(docs, templates, text_col, threshold), "license_features")
    lines = written(containment_join(features, templates, threshold), "license_lines")
    found = (lines.unionByName(wrapped_matches(features, lines, templates, threshold))
             .groupBy("_row").agg(F.collect_set("label").alias("_more"), F.max("containment").alias("_best"),
                                  F.countDistinct("block").cast("long").alias("n_blocks")))
    base = F.col("base_label_list")
    return (features.drop("blocks", "places").join(found, "_row", "left")
            .select("doc_id", "n_words", "n_base", "first_word", "last_word",
                    F.array_join(base, ",").alias("base_labels"),
                    F.array_join(F.array_sort(F.array_union(base, F.coalesce("_more", F.array().cast("array<string>")))),
                                 ",").alias("labels"),
                    F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"),
                    F.coalesce("n_blocks", F.lit(0).cast("long")).alias("n_blocks")))
