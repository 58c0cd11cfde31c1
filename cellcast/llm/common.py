"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from cellcast.session import discard, shared_dir, staged

__all__ = ["discard", "shared_dir", "staged", "table", "texts", "shuffle_parts", "unused", "word_hashes", "mix"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty), plus the named columns; every other column goes."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more
    )


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_hashes(words: list[str]) -> np.ndarray:
    """64-bit hashes. Hashing anew costs less than looking words up: most texts bring many new ones."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit words, so that equal inputs and only they give equal outputs."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until none is a column of ``df`` (Spark compares them without case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
