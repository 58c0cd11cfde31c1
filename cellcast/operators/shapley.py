"""Shapley contributions of the forest's features to single predictions.

Path-dependent tree Shapley values (Lundberg et al. 2020), in the form of one independent game per leaf:
a leaf counts fully when the row satisfies its conditions on the known features, and with the training
share that passes them on the unknown ones. The Shapley value of such a product game is the integral over
t in (0, 1) of a polynomial (Owen's multilinear extension), which Gauss-Legendre nodes evaluate exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cellcast import fixed
from cellcast.operators.forest import Forest
from cellcast.operators.sampling import ROW_KEY, sample_n
from cellcast.session import staged

TREES_PER_TASK = 4
ROWS_PER_BLOCK = 1024
CHUNK, ROWS_PER_CHUNK = 1 << 14, 128  # leaf-row pairs, and rows, worked on at once: what a core's own cache holds
PACKED_BYTES = 256 << 20  # up to so many bytes of leaves are broadcast


def leaf_games(nodes: pd.DataFrame, width: int) -> tuple[np.ndarray, ...]:
    """Value, lower and upper bounds and passing share per feature of every leaf of one tree, level by level."""
    place = pd.Index(nodes["id"])
    left, right = (place.get_indexer(nodes[side]) for side in ("left", "right"))
    feature, threshold, cover, value = (nodes[c].to_numpy() for c in ("feature", "threshold", "cover", "value"))
    inner = nodes["left"].to_numpy() >= 0
    at = place.get_indexer([0])
    low, high, share = np.full((1, width), -np.inf), np.full((1, width), np.inf), np.ones((1, width))
    leaves = []
    while at.size:
        split = inner[at]
        leaves.append((value[at[~split]], low[~split], high[~split], share[~split]))
        at, low, high, share = at[split], low[split], high[split], share[split]
        row, f, children = np.arange(len(at)), feature[at].astype(int), (left[at], right[at])
        highs, lows, shares = [high.copy(), high], [low, low.copy()], [share.copy(), share.copy()]
        highs[0][row, f] = np.minimum(high[row, f], threshold[at])
        lows[1][row, f] = np.maximum(low[row, f], threshold[at])
        for child, part in zip(children, shares):
            part[row, f] *= cover[child] / cover[at]
        at, low, high, share = (np.concatenate(x) for x in (children, lows, highs, shares))
    return tuple(np.concatenate(part) for part in zip(*leaves))


def contributions(x: np.ndarray, games: tuple[np.ndarray, ...]) -> np.ndarray:
    """Shapley values of one tree, given as ``leaf_games``, for rows x, with the tree's mean value as an extra last column.

    A leaf's factor for a feature is ``met`` where the row satisfies its condition and ``unmet`` where not;
    arrays are (rows, leaves), one feature at a time.
    """
    width = x.shape[1]
    value, low, high, share = games
    used = np.flatnonzero((share < 1).any(axis=0))
    points, weights = np.polynomial.legendre.leggauss((width + 1) // 2)
    out = np.zeros((len(x), width + 1))
    out[:, width] = (value * share.prod(axis=1)).sum()
    if not used.size:
        return out
    leaves = max(1, min(len(value), CHUNK // max(1, min(len(x), ROWS_PER_CHUNK))))
    for start in range(0, len(x), ROWS_PER_CHUNK):
        rows = slice(start, start + ROWS_PER_CHUNK)
        for first in range(0, len(value), leaves):
            some = slice(first, first + leaves)
            hits = [((x[rows, f, None] > low[some, f]) & (x[rows, f, None] <= high[some, f])).astype(float) for f in used]
            part = share[some][:, used]
            for t, w in zip((points + 1) / 2, weights / 2):
                met, unmet = part * (1 - t) + t, part * (1 - t)
                product = np.broadcast_to(w * value[some], hits[0].shape).copy()
                for hit, more, least in zip(hits, (met - unmet).T, unmet.T):
                    factor = hit * more
                    factor += least
                    product *= factor
                # (hit - share) / factor: a constant per leaf either way.
                gain, loss = (1 - part) / met, -part / unmet
                out[rows, used] += product @ loss
                for f, hit, change in zip(used, hits, (gain - loss).T):
                    out[rows, f] += (product * hit) @ change
    return out


def tree_shap(rows: DataFrame, nodes: DataFrame, trees: int, features: list[str] | None = None, keys: list[str] | None = None,
              tasks: int | None = None) -> DataFrame:
    """Keys, <feature>_shap for every feature and base_value, for any number of rows.

    The forest is packed once, tree by tree, as arrays of its leaves. Up to ``PACKED_BYTES`` of them are broadcast and the rows
    pass by once; neither nodes nor parts of sums are shuffled. A larger forest is worked through in groups instead.
    """
    features, keys = features or fixed.MODEL_FEATURES, keys or ROW_KEY
    packed = staged(packed_forest(nodes, len(features)), "forest-leaves")
    size = packed.agg(F.sum(F.octet_length("leaves"))).first()[0] or 0
    if size > PACKED_BYTES:
        return _shap_in_groups(rows, packed, trees, features, keys, tasks)
    spark = rows.sparkSession
    forest = spark.sparkContext.broadcast([bytes(r["leaves"]) for r in packed.select("leaves").toLocalIterator()])
    width = len(features)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        games = [unpacked(leaves, width) for leaves in forest.value]
        for batch in batches:
            x = np.array(batch.column(len(keys)).to_pylist(), dtype=float).reshape(-1, width)
            total = sum((contributions(x, game) for game in games), np.zeros((len(x), width + 1)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keys)], *[pa.array(c) for c in (total / trees).T]], names=[*keys, *_outputs(features)])

    # Few rows are much work: they are dealt out evenly, and not gathered again for their size in bytes.
    tasks = tasks or spark.sparkContext.defaultParallelism
    types = dict(rows.dtypes)
    schema = ", ".join([*[f"{k} {types[k]}" for k in keys], *[f"{c} double" for c in _outputs(features)]])
    return rows.select(*keys, _values(features).alias("x")).repartition(tasks).mapInArrow(work, schema)


def _outputs(features: list[str]) -> list[str]:
    return [*[f"{f}_shap" for f in features], "base_value"]


def _values(features: list[str]) -> Column:
    return F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features])


def packed_forest(nodes: DataFrame, width: int) -> DataFrame:
    """``tree_id, leaves``: each tree's ``leaf_games`` as bytes."""
    def pack(tree: pd.DataFrame) -> pd.DataFrame:
        value, low, high, share = leaf_games(tree, width)
        leaves = np.concatenate([value[:, None], low, high, share], axis=1).astype("<f8").tobytes()
        return pd.DataFrame({"tree_id": [int(tree["tree_id"].iloc[0])], "leaves": [leaves]})

    return nodes.groupBy("tree_id").applyInPandas(pack, "tree_id bigint, leaves binary")


def unpacked(leaves: bytes, width: int) -> tuple[np.ndarray, ...]:
    table = np.frombuffer(leaves, dtype="<f8").reshape(-1, 1 + 3 * width)
    return (table[:, 0].copy(), *(table[:, 1 + i * width:1 + (i + 1) * width].copy() for i in range(3)))


def _shap_in_groups(rows: DataFrame, packed: DataFrame, trees: int, features: list[str], keys: list[str], tasks: int | None) -> DataFrame:
    """Groups of (bundle of trees) x (block of rows), both of bounded size; each returns sums over its trees,
    and a second, partial-aggregated sum joins the bundles."""
    outputs, width = _outputs(features), len(features)
    bundles = -(-trees // TREES_PER_TASK)
    values = _values(features)
    blocks = rows.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / ROWS_PER_BLOCK))).scalar()
    left = (
        rows.select(*keys, values.alias("x")).withColumn("_blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64(*keys), F.col("_blocks")))
        .select(*keys, "x", "block", F.explode(F.sequence(F.lit(0), F.lit(bundles - 1))).alias("bundle"))
    )
    right = (
        packed.withColumn("bundle", F.floor(F.col("tree_id") / TREES_PER_TASK).cast("int")).withColumn("_blocks", blocks)
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_blocks") - 1))).drop("_blocks")
    )
    key_types = ", ".join(f"{k} {dict(rows.dtypes)[k]}" for k in keys)

    def work(row_part: pd.DataFrame, node_part: pd.DataFrame) -> pd.DataFrame:
        if row_part.empty or node_part.empty:
            return pd.DataFrame(columns=[*keys, "parts"])
        x = np.array(row_part["x"].tolist(), dtype=float)
        total = sum(contributions(x, unpacked(leaves, width)) for leaves in node_part["leaves"])
        return row_part[keys].assign(parts=list(total))

    # The keyed exchanges carry an explicit count: the groups are small in bytes but heavy in work, so
    # they must not be coalesced.
    tasks = tasks or 4 * rows.sparkSession.sparkContext.defaultParallelism
    parts = (
        left.repartition(tasks, "bundle", "block").groupBy("bundle", "block")
        .cogroup(right.repartition(tasks, "bundle", "block").groupBy("bundle", "block"))
        .applyInPandas(work, f"{key_types}, parts array<double>")
    )
    sums = [(F.sum(F.get("parts", F.lit(i))) / trees).alias(name) for i, name in enumerate(outputs)]
    return parts.groupBy(*keys).agg(*sums)


def explain_forest(rows: DataFrame, forest: Forest) -> DataFrame:
    """Rows with their contributions attached. The explained set is given, so both sides are of its size."""
    shap = tree_shap(rows, forest.nodes, forest.model.getNumTrees)
    return rows.join(shap, ROW_KEY)


def contributions_long(explained: DataFrame, features: list[str] | None = None) -> DataFrame:
    """Key, base_value, feature, place, shap, value: one row per contribution."""
    features = features or fixed.MODEL_FEATURES
    entries = F.array(*[
        F.struct(F.lit(f).alias("feature"), F.lit(i).alias("place"), F.col(f"{f}_shap").alias("shap"),
                 F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias("value"))
        for i, f in enumerate(features)
    ])
    return explained.select(*ROW_KEY, "base_value", F.explode(entries).alias("e")).select(*ROW_KEY, "base_value", "e.*")


def shap_sample(scored: DataFrame, n: int = 500) -> DataFrame:
    return sample_n(scored, n)


def shap_summary(long: DataFrame) -> DataFrame:
    """Mean absolute contribution per feature with its rank."""
    means = long.groupBy("feature").agg(F.avg(F.abs("shap")).alias("mean_abs_shap"))
    # One row per feature.
    return means.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("mean_abs_shap"), "feature")))


def shap_waterfall(long: DataFrame) -> DataFrame:
    """Per row, contributions from the largest down and the running value from base to prediction."""
    order = Window.partitionBy(*ROW_KEY).orderBy(F.desc(F.abs("shap")), "place")
    running = F.col("base_value") + F.sum("shap").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return long.withColumns({"step": F.row_number().over(order), "running": running}).drop("place")
