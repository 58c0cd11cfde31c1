"""Near-duplicate vectors by Euclidean p-stable hashing with exact cosine checks.

Normalised vectors fall into buckets of ``PROJECTIONS`` quantised Gaussian projections, in ``TABLES`` tables. Vectors of
one bucket and label are candidates; a pair is checked once, in the first table where it meets. At cosine 0.98 (Euclidean
distance 0.2, a fifth of a cell) one table misses a pair with probability 0.75, all tables together with 0.0005.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cellcast.llm.common import mix, staged
from cellcast.llm.components import components

COSINE = 0.98
TABLES = 26
PROJECTIONS = 8
CELL = 1.0
SEED = 7


class StableHash:
    """Bucket keys of unit vectors, the same on every worker: projections follow from seed and dimension."""

    def __init__(self, tables: int, projections: int, cell: float):
        self.tables, self.projections, self.cell = tables, projections, cell
        self.made: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def keys(self, unit: np.ndarray) -> np.ndarray:
        dim = unit.shape[1]
        if dim not in self.made:
            rng = np.random.default_rng([SEED, dim])
            n = self.tables * self.projections
            self.made[dim] = rng.standard_normal((dim, n)), rng.uniform(0, self.cell, n)
        a, b = self.made[dim]
        cells = np.floor((unit @ a + b) / self.cell).astype(np.int64).view(np.uint64)
        cells = cells.reshape(len(unit), self.tables, self.projections)
        key = np.zeros(cells.shape[:2], dtype=np.uint64) + np.arange(self.tables, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for j in range(self.projections):
                key = mix(key * np.uint64(31) + cells[:, :, j])
        return key.view(np.int64)


def hashed(vectors: DataFrame, tables: int, projections: int, cell: float) -> DataFrame:
    """``node, label, vec, keys`` of distinct vectors that may link (finite, not zero)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = StableHash(tables, projections, cell)
        for batch in batches:
            vecs = [np.array(v.as_py(), dtype=np.float64) for v in batch.column(2)]
            keys: list = [None] * len(vecs)
            by_dim: dict[int, list[int]] = {}
            for i, v in enumerate(vecs):
                by_dim.setdefault(len(v), []).append(i)
            for rows in by_dim.values():
                x = np.stack([vecs[i] for i in rows])
                x = x / np.abs(x).max(axis=1, keepdims=True)
                for i, k in zip(rows, hasher.keys(x / np.linalg.norm(x, axis=1, keepdims=True))):
                    keys[i] = k.tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(keys, pa.list_(pa.int64()))],
                names=["node", "label", "vec", "keys"])

    return vectors.mapInArrow(run, "node bigint, label bigint, vec array<double>, keys array<bigint>")


def _checked(pairs: DataFrame, cosine: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                a, b = np.array(x.as_py(), np.float64), np.array(y.as_py(), np.float64)
                if len(a) == len(b):
                    a, b = a / np.abs(a).max(), b / np.abs(b).max()
                    if a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine:
                        keep.append(i)
            yield batch.select([0, 1]).take(pa.array(keep, pa.int32()))

    return pairs.mapInArrow(run, "a bigint, b bigint")


def links_of(hashes: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Linked pairs ``(a, b)`` with a < b of distinct vectors (``hashes`` is staged: it is read again)."""
    side = lambda n: hashes.select(F.col("node").alias(n), "label", F.col("keys").alias(f"{n}_keys"), F.posexplode("keys").alias("t", "key"))
    met = side("a").join(side("b"), ["key", "t", "label"]).filter("a < b")
    first = F.array_position(F.zip_with("a_keys", "b_keys", lambda x, y: x == y), True) == F.col("t") + 1
    pairs = met.filter(first).select("a", "b")
    vec = lambda n: hashes.select(F.col("node").alias(n), F.col("vec").alias(f"{n}_vec"))
    return _checked(pairs.join(vec("a"), "a").join(vec("b"), "b").select("a", "b", "a_vec", "b_vec"), cosine)


def vector_links(embeddings: DataFrame, cosine: float = COSINE, tables: int = TABLES, projections: int = PROJECTIONS,
                 cell: float = CELL) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    A vector that is null, empty, zero or not finite, or whose label is null, links with nothing. Equal vectors of a
    label are one node and count as links of each other, so copies are never paired. A null ``vec_id`` counts as a link of
    others but names no component.
    """
    vec = F.col("embedding").cast("array<double>")
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    live = F.col("label").isNotNull() & F.coalesce(F.size("vec") > 0, F.lit(False)) & ~F.coalesce(bad, F.lit(True))
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), vec.alias("vec"))
    rows = rows.withColumn("live", live & F.coalesce(F.exists("vec", lambda x: x != 0), F.lit(False)))
    # -0.0 and 0.0 are one value: adding 0.0 makes the text of equal vectors equal.
    digest = F.when(F.col("live"), F.sha2(F.concat_ws(",", F.transform("vec", lambda x: (x + F.lit(0.0)).cast("string"))), 256))
    rows = staged(rows.withColumn("digest", digest), "vectors")
    live_rows = rows.filter("live")
    groups = live_rows.groupBy("label", "digest").agg(
        F.count("*").alias("n"), F.min("vec_id").alias("low"), F.min_by("vec", F.coalesce("vec_id", F.lit((1 << 63) - 1))).alias("vec"))
    # A node is named by a number of its own, so that null or repeated ids do not meet.
    node = F.xxhash64("label", "digest").alias("node")
    nodes = staged(groups.select(node, "label", "digest", "n", "low", "vec"), "nodes")
    hashes = staged(hashed(nodes.select("node", "label", "vec"), tables, projections, cell), "hashes")
    links = staged(links_of(hashes, cosine), "pairs")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    other = nodes.select(F.col("node").alias("b"), "n")
    reached = both.join(other, "b").groupBy("a").agg(F.sum("n").alias("more")).withColumnRenamed("a", "node")
    found = components(links, "a", "b")
    whole = nodes.join(reached, "node", "left").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    whole = staged(whole.select("label", "digest", "component", "low", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links")), "whole")
    low = whole.groupBy("component").agg(F.min("low").alias("component_id"))
    named = whole.join(low, "component").select("label", "digest", "n_links", "component_id")
    out = rows.join(named, ["label", "digest"], "left")
    component = F.coalesce("component_id", "vec_id").alias("component_id")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
