"""License scan as an exact set-similarity join of word windows with license templates.

Everything runs on DataFrame functions. A text meets a template if some window of consecutive words, as long as the
template divided by the threshold, holds at least ``THRESHOLD`` of the template's distinct words; line breaks and comment
marks play no part. Template words are ordered by their frequency in the corpus, rarest first. A window can only meet a
template if it holds one of the first ``size - needed + 1`` words of that order (prefix filter), so only the surroundings of
such words are looked at: they must hold enough template words at all (length filter), enough of them behind the prefix
word on both sides (positional filter), and enough of this template. What survives has every window around the word counted
exactly, so no qualifying window is missed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

# The phrases that always count, with their labels.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# Templates of this operator: label and notice.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
            "and associated documentation files"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without "
            "fee is hereby granted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("public-domain", "this is free and unencumbered software released into the public domain"),
    ("proprietary", "all rights reserved"),
]
THRESHOLD = 0.8
PART_WORDS = 256  # texts are searched in parts of so many words that overlap by the longest window on both sides
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def needed(words: set[str], threshold: float = THRESHOLD) -> int:
    return math.ceil(round(threshold * len(words), 9))


def span(words: list[str], threshold: float = THRESHOLD) -> int:
    """Words in a window for a template of these words, repeats included."""
    return math.ceil(round(len(words) / threshold, 9))


def _split(text: Column) -> Column:
    """Words with an empty string wherever the text starts or ends with a break."""
    return F.split(text, BREAKS, -1)


def _literals(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def word_order(docs: DataFrame, templates=TEMPLATES) -> list[str]:
    """Template words by the number of documents that hold them, rarest first. At most one row a word comes back."""
    vocabulary = sorted({w for _, t in templates for w in t.split()})
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER)
    held = docs.select(F.explode(F.array_intersect(_literals(vocabulary), _split(text))).alias("word"))
    count = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (count.get(w, 0), w))


def prefix_index(order: list[str], templates=TEMPLATES, threshold: float = THRESHOLD) -> list[dict]:
    rank = {w: i for i, w in enumerate(order)}
    out = []
    for i, (label, notice) in enumerate(templates):
        words = sorted(set(notice.split()), key=rank.__getitem__)
        need = needed(set(words), threshold)
        for pos, word in enumerate(words[: len(words) - need + 1]):
            out.append({"word": word, "template": i, "label": label, "t_pos": pos, "need": need, "t_words": words,
                        "span": span(notice.split(), threshold)})
    return out


def _places(words: Column) -> Column:
    """Base places as ``(start, label)``, counted in array positions."""
    def at(i: Column) -> Column:
        one, two = F.get(words, i - 1), F.get(words, i - 2)
        label = (F.when(one == "mit", "mit").when(one == "apache", "apache")
                 .when((one == "public") & (i >= 2) & (two == "general"), "gpl"))
        return F.struct((i - F.when(label == "gpl", 2).otherwise(1)).alias("start"), label.alias("label"))

    ends = F.filter(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.get(words, i) == "license")
    found = F.filter(F.transform(ends, at), lambda p: p["label"].isNotNull())
    return F.when(F.array_contains(words, "license") & (F.size(words) > 1), found).otherwise(F.filter(F.array(
        F.struct(F.lit(0).alias("start"), F.lit("").alias("label"))), lambda p: F.lit(False)))


def _parts(words: Column, margin: int) -> Column:
    """Overlapping parts: each window of up to ``margin + 1`` words lies whole in the part of every word it holds."""
    def part(i: Column) -> Column:
        start = F.greatest(i * PART_WORDS - margin, F.lit(0))
        return F.slice(words, start + 1, i * PART_WORDS + PART_WORDS + margin - start)

    return F.transform(F.sequence(F.lit(0), F.floor((F.size(words) - 1) / PART_WORDS).cast("int")), part)


def _most_shared(near: Column, t_words: Column, length: Column) -> Column:
    """The most distinct template words in any window of ``length`` words."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(near) - length + 1, F.lit(1)))
    return F.array_max(F.transform(starts, lambda i: F.size(F.array_intersect(t_words, F.slice(near, i, length)))))


def license_scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of ``docs``: words, base places and labels, all labels, and the best containment as score.

    A null or empty text has no words, no place (first and last null), empty labels and score 0. A base place
    scores 1. Repeated rows give repeated results; other columns are not read. A very long text is searched in parts, so
    no row ever carries more than a part of it.
    """
    order = word_order(docs, templates)
    index = prefix_index(order, templates, threshold)
    prefix = _literals(sorted({r["word"] for r in index}))
    margin = max(r["span"] for r in index) - 1

    rows = F.array(*[F.struct(*[
        (_literals(v) if isinstance(v, list) else F.lit(v)).alias(k) for k, v in r.items()]) for r in index])
    lookup = docs.sparkSession.range(1).select(F.explode(rows).alias("r")).select("r.*")

    keyed = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col("doc_id").cast("bigint").alias("doc_id"),
        F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER).alias("_text"))
    cut = keyed.select("_row", "doc_id", _split(F.col("_text")).alias("_words"))
    cut = cut.withColumn("_base", _places(F.col("_words")))
    first = F.when(F.get("_words", F.lit(0)) == "", 1).otherwise(0)
    last = F.when(F.element_at("_words", -1) == "", 1).otherwise(0)
    hit = lambda words: F.arrays_overlap(words, prefix)
    starts = F.transform("_base", lambda p: (p["start"] - first).cast("bigint"))
    scanned = cut.select(
        "_row", "doc_id",
        F.greatest(F.size("_words") - first - last, F.lit(0)).cast("bigint").alias("n_words"),
        F.size("_base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_distinct(F.transform("_base", lambda p: p["label"])).alias("_labels"),
        F.when(hit(F.col("_words")), F.filter(_parts(F.col("_words"), margin), hit)).alias("_parts"))

    own = ["_row", "doc_id", "n_words", "n_base", "first_word", "last_word", "_labels"]
    part = scanned.select(*own, F.explode_outer("_parts").alias("_part"))
    places = F.filter(F.sequence(F.lit(0), F.size("_part") - 1), lambda i: F.array_contains(prefix, F.get("_part", i)))
    token = part.select(*own, "_part", F.explode_outer(F.when(F.col("_part").isNotNull(), places)).alias("_at"))
    token = token.withColumn("word", F.get("_part", F.col("_at")))
    joined = token.join(F.broadcast(lookup), "word", "left")  # as many rows as the templates have prefix words
    begin = F.greatest(F.col("_at") - F.col("span") + 1, F.lit(0))
    near = joined.withColumn("_near", F.slice("_part", begin + 1, F.col("_at") + F.col("span") - begin)).drop("_part")
    near = near.withColumn("_held", F.array_intersect(_literals(order), F.col("_near")))
    t_size, b_size = F.size("t_words"), F.size("_held")
    b_pos = F.array_position("_held", F.col("word")) - 1
    possible = (b_size >= F.col("need")) & (F.least(t_size - F.col("t_pos"), b_size - b_pos) >= F.col("need"))
    enough = F.size(F.array_intersect("t_words", "_near")) >= F.col("need")
    counted = near.withColumn("_shared", F.when(
        possible, F.when(enough, _most_shared(F.col("_near"), F.col("t_words"), F.col("span")))))
    met = F.col("_shared") >= F.col("need")
    per = counted.groupBy("_row").agg(
        *[F.first(c).alias(c) for c in own[1:]],
        F.collect_set(F.when(met, F.col("label"))).alias("_found"),
        F.max(F.when(met, F.col("_shared") / t_size)).alias("_best"))
    return per.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.sort_array("_labels"), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_distinct(F.concat("_labels", "_found"))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"))
