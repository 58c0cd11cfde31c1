"""Robust multivariate outliers among documents: a minimum covariance determinant for each language and source.

Counts come from one pass over the texts. The fit alternates distances and concentration steps as aggregations: rows
are folded into at most ``BINS`` classes of distance per group, with their counts, sums and products, and the inner
``INNER`` share of these classes gives the next centre and covariance. No group is ever gathered.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cellcast.llm.common import staged, texts, unused

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
# Transformed statistics, with the smallest standard deviation that the fit may assume: most texts have no symbols and no
# repetition at all, so their own spread is 0. One repeated line among few is common in clean texts, 5% symbols are not.
STATS = {"log_word_length": 0.15, "root_symbols": 0.05, "root_dup_lines": 0.15, "root_repeats": 0.15, "root_capitals": 0.1}
INNER = 0.75
INNER_QUANTILE = 6.626  # chi-squared, 5 degrees of freedom, at INNER
CUTOFF = 35.9  # the same at 0.999999
STEPS = 5
BINS = 1024
LEAST = 40  # usable rows from which on a group has an estimate of its own
EVERYTHING = "all"  # the estimate of all rows


def n_repeat_words(words: list[str]) -> int:
    """Words inside 3-word windows that the text has at least twice, the first time included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen, more = set(), set()
    for w in windows:
        (more if w in seen else seen).add(w)
    total, free = 0, 0
    for i, w in enumerate(windows):
        if w in more:
            total += i + 3 - max(i, free)
            free = i + 3
    return total


def text_counts(text: str) -> tuple[int, int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines with a word, and letters A-Z."""
    words = WORD.findall(text)
    seen, dups, lines = set(), 0, 0
    for line in text.split("\n"):
        if line and not (line[0] in BLANKS and not line.strip(BLANKS)):
            lines += 1
            dups += line in seen
            seen.add(line)
    chars = len(text) - sum(map(text.count, BLANKS))
    raw = np.frombuffer(text.encode(), np.uint8)
    capitals = int(((raw >= 65) & (raw <= 90)).sum())
    return len(words), chars, sum(map(text.count, SYMBOLS)), dups, n_repeat_words(words), lines, capitals


def text_stats(docs: DataFrame) -> DataFrame:
    """Counts and transformed statistics of every row, with ``grp`` (language and source, nulls their own) and ``text_hash``."""
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = np.array([text_counts(t.as_py()) for t in batch.column(1)], dtype=np.int64).reshape(-1, len(counts))
            cols = [batch.column(0), batch.column(2), batch.column(3), *[pa.array(c) for c in got.T]]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "grp", "text_hash", *counts])

    grp = F.to_json(F.struct(F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source")))
    rows = texts(docs, grp.alias("grp"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    out = rows.mapInArrow(run, "doc_id bigint, grp string, text_hash bigint, " + ", ".join(f"{c} bigint" for c in counts))
    share = lambda a, b: F.sqrt(F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0)))
    log_length = F.log(F.greatest(F.coalesce(F.try_divide(F.col("word_chars"), F.col("n_words")), F.lit(1.0)), F.lit(1.0)))
    values = [log_length, share("n_symbols", "word_chars"), share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words"),
              share("n_capitals", "word_chars")]
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.select("*", *[v.alias(s) for v, s in zip(values, STATS)], failed.alias("base_failed"))


PAIRS = list(combinations_with_replacement(range(len(STATS)), 2))


def _distance() -> Column:
    """Squared Mahalanobis distance from the columns ``centre`` and ``precision``."""
    d = [F.col(s) - F.get("centre", F.lit(i)) for i, s in enumerate(STATS)]
    terms = [d[i] * d[j] * F.get("precision", F.lit(k)) * (1 if i == j else 2) for k, (i, j) in enumerate(PAIRS)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return F.greatest(total, F.lit(0.0))


def _invert(rows: DataFrame) -> DataFrame:
    """From sums and products of each group to its centre and precision; one small matrix a row."""
    size, floor = len(STATS), np.array(list(STATS.values()))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for grp, n, sums, products in zip(frame.grp, frame.n, frame.sums, frame.products):
                centre = np.asarray(sums) / n
                cov = np.zeros((size, size))
                for (i, j), p in zip(PAIRS, products):
                    cov[i, j] = cov[j, i] = p / n - centre[i] * centre[j]
                values, vectors = np.linalg.eigh(cov / np.outer(floor, floor))
                cov = (vectors * np.maximum(values, 1.0)) @ vectors.T * np.outer(floor, floor)
                inverse = np.linalg.inv(cov)
                out.append((grp, centre.tolist(), [float(inverse[i, j]) for i, j in PAIRS]))
            yield pd.DataFrame(out, columns=["grp", "centre", "precision"])

    return rows.mapInPandas(run, "grp string, centre array<double>, precision array<double>")


def _classes(rows: DataFrame, models: DataFrame) -> DataFrame:
    """Inner classes of distance of each group: n, sums, products, and the distance where each class ends."""
    bin_ = F.least(F.floor(32 * F.log2(1 + _distance())), F.lit(BINS - 1)).cast("int").alias("bin")
    near = rows.join(models, "grp").select("grp", *STATS, bin_)
    x = [F.col(s) for s in STATS]
    folded = near.groupBy("grp", "bin").agg(
        F.count("*").alias("n"), *[F.sum(c).alias(f"s{i}") for i, c in enumerate(x)],
        *[F.sum(x[i] * x[j]).alias(f"p{k}") for k, (i, j) in enumerate(PAIRS)])
    below = W.partitionBy("grp").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    inner = F.coalesce(F.sum("n").over(below), F.lit(0)) < INNER * F.sum("n").over(W.partitionBy("grp"))
    return folded.withColumn("inner", inner).filter("inner").withColumn("edge", F.pow(F.lit(2.0), (F.col("bin") + 1) / 32) - 1)


def model_of_group(stats: DataFrame) -> DataFrame:
    """``grp, model, models``: the estimate that judges a group, and all that its rows take part in.

    That is its own from ``LEAST`` usable rows on, else that of its language, else that of all rows, so every group has one.
    """
    language = F.concat(F.lit("language "), F.to_json(F.struct(F.get_json_object("grp", "$.lang").alias("lang"))))
    sizes = staged(stats.filter("not base_failed").groupBy("grp").agg(F.count("*").alias("n")).withColumn("language", language), "groups")
    whole = sizes.groupBy("language").agg(F.sum("n").alias("n_language"))
    wider = F.when(F.col("n_language") >= LEAST, F.col("language")).otherwise(F.lit(EVERYTHING))
    named = staged(sizes.join(whole, "language").withColumn("model", F.when(F.col("n") >= LEAST, F.col("grp")).otherwise(wider)), "groups")
    # A wider estimate is made of all rows of its language, or of all, where any group needs it.
    needed = named.select(F.col("model").alias("m")).distinct()
    parts = named.select("grp", "model", F.explode(F.array("grp", "language", F.lit(EVERYTHING))).alias("m")).join(needed, "m", "left_semi")
    return staged(parts.groupBy("grp", "model").agg(F.collect_set("m").alias("models")), "groups")


def fit(stats: DataFrame, groups: DataFrame, steps: int = STEPS) -> DataFrame:
    """``grp, centre, precision, factor`` of each estimate, from all rows that pass the base rules (both tables are staged)."""
    rows = stats.filter("not base_failed").join(groups.select("grp", "models"), "grp").select(F.explode("models").alias("grp"), *STATS)
    # The start: median and interquartile range of each statistic, exact over values rounded to hundredths.
    quarts = [F.percentile(F.round(s, 2), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q{i}") for i, s in enumerate(STATS)]
    start = rows.groupBy("grp").agg(*quarts)
    spread = lambda i, s: F.greatest((F.get(f"q{i}", F.lit(2)) - F.get(f"q{i}", F.lit(0))) / 1.349, F.lit(s))
    centre = F.array(*[F.get(f"q{i}", F.lit(1)) for i in range(len(STATS))])
    precision = F.array(*[1 / F.pow(spread(i, list(STATS.values())[i]), F.lit(2.0)) if i == j else F.lit(0.0) for i, j in PAIRS])
    models = staged(start.select("grp", centre.alias("centre"), precision.alias("precision")), "mcd")
    for _ in range(steps):
        inner = _classes(rows, models)
        total = inner.groupBy("grp").agg(
            F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(len(STATS))],
            *[F.sum(f"p{k}").alias(f"p{k}") for k in range(len(PAIRS))])
        models = staged(_invert(total.select(
            "grp", "n", F.array(*[f"s{i}" for i in range(len(STATS))]).alias("sums"),
            F.array(*[f"p{k}" for k in range(len(PAIRS))]).alias("products"))), "mcd")
    # Consistency: the inner share must end where it would for a normal distribution; distances only shrink by it.
    edge = _classes(rows, models).groupBy("grp").agg(F.max("edge").alias("edge"))
    factor = F.greatest(F.col("edge") / INNER_QUANTILE, F.lit(1.0)).alias("factor")
    return staged(models.join(edge, "grp").select("grp", "centre", "precision", factor), "mcd")


def judged(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """One row for each row of ``docs``: counts, ``base_failed``, ``distance`` (null only where no row of the group passes the base
    rules) and ``kept``.

    Null and empty texts have no words and so fail the base rules. Null language or source is a group of its own.
    """
    stats = staged(text_stats(docs), "stats")
    groups = model_of_group(stats)
    models = fit(stats, groups).withColumnRenamed("grp", "model")
    joined = stats.join(groups.select("grp", "model"), "grp", "left").join(models, "model", "left").withColumn("distance", _distance() / F.col("factor"))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))
    return joined.select(
        "doc_id", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "distance", kept.alias("kept"))


def accepted(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """The rows of ``docs`` that stay, all columns. Rejects are looked up by id and text, so repeated ids are safe."""
    own, id_, hash_ = unused(docs, "_own", "_id", "_hash")
    out = judged(docs, cutoff).filter("not kept").select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_))
    keyed = docs.withColumn(own, F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col(id_)) & (F.col(own) == F.col(hash_))
    return keyed.join(out.distinct(), same, "left_anti").drop(own)
