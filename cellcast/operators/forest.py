"""Random forest over cell-day features."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, inheritable_thread_target
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cellcast import fixed
from cellcast.functions import trees as grown
from cellcast.operators.grid import scalar
from cellcast.operators.hotspot import apply_threshold, best_f1_threshold
from cellcast.operators.ranking import running_totals
from cellcast.operators.split import cell_codes, encode_grid_id
from cellcast.session import shared_dir, staged

PART_BYTES = 128 << 20
GIVEN_NODES = 4096  # of a given forest that is written out as one expression
TREES_PER_FIT = 20  # in passes over distributed rows
TREES_PER_TASK = 4  # grown from folded rows
PASS_ROWS = 1 << 16  # up to so many train rows a fit in passes takes its cut points from all of them, and is kept
FOLDED_BYTES = 256 << 20  # up to so many bytes of folded train rows are broadcast
NODE_SCHEMA = "tree_id int, id int, left int, right int, feature int, threshold double, cover double, value double"


class Group:
    """Trees fitted together, as ``NODE`` records."""

    def __init__(self, packed: list[bytes]):
        self.trees = [np.frombuffer(p, grown.NODE) for p in packed]

    @property
    def getNumTrees(self) -> int:  # noqa: N802
        return len(self.trees)


class Trees:
    """A forest fitted in groups of trees: the mean over all trees, whatever the groups' sizes.

    ``packed`` (tree_id, nodes) is the forest at rest. The driver holds it once (34 bytes a node) to hand it to the tasks that score.
    """

    def __init__(self, packed: DataFrame, trees: int, per_group: int):
        found = {r["tree_id"]: bytes(r["nodes"]) for r in packed.toLocalIterator()}
        self.packed = packed
        self.groups = [Group([found[i] for i in range(at, min(at + per_group, trees))]) for at in range(0, trees, per_group)]
        self._sent: Broadcast | None = None

    @property
    def trees(self) -> list[np.ndarray]:
        return [t for g in self.groups for t in g.trees]

    @property
    def getNumTrees(self) -> int:  # noqa: N802
        return sum(g.getNumTrees for g in self.groups)

    @property
    def featureImportances(self) -> np.ndarray:  # noqa: N802
        """Shares of the features: the mean of the trees' shares. A stump only has zeros, which no other tree's shares replace."""
        total = sum(grown.split_decreases(t, len(fixed.MODEL_FEATURES)) for t in self.trees)
        return total / total.sum() if total.sum() else total

    def sent(self) -> Broadcast:
        self._sent = self._sent or self.packed.sparkSession.sparkContext.broadcast([t.tobytes() for t in self.trees])
        return self._sent

    def transform(self, rows: DataFrame) -> DataFrame:
        """Add rf_prob. Few bytes are much work here, so rows are dealt out evenly, by a count that does not shrink."""
        forest, width = self.sent(), len(fixed.MODEL_FEATURES)

        @F.arrow_udf("double")
        def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            steps = _walks(forest)
            for batch in batches:
                yield pa.array(grown.mean_scores(_matrix(batch, width), steps))

        return rows.repartition(_tasks(rows.sparkSession)).select(*rows.columns, score("features").alias("rf_prob"))


def _tasks(spark: SparkSession) -> int:
    return max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _walks(forest: Broadcast) -> list[tuple[np.ndarray, ...]]:
    return grown.walks([np.frombuffer(t, grown.NODE) for t in forest.value])


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


@dataclass
class Forest:
    """A fitted forest, its nodes as rows, the cell codes it was trained with, its tuned threshold (one row)."""

    model: Trees
    nodes: DataFrame
    codes: DataFrame
    threshold: DataFrame


def feature_rows(rows: DataFrame, codes: DataFrame) -> DataFrame:
    """Rows plus the cell code and an array of features with nulls as 0; their own columns stay as they are."""
    coded = encode_grid_id(rows, codes)
    return coded.withColumn("features", F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in fixed.MODEL_FEATURES]))


def split_points(rows: DataFrame, label: str, bins: int) -> tuple[list[np.ndarray], int, int]:
    """Ascending cut points of every feature, and how many rows have target 0 and 1.

    A feature of at most ``bins`` distinct values is cut between all of them, others into ``bins`` of about equal weight (both classes
    weigh the same), from exact running totals over all rows. Not more than ``bins`` - 1 points a feature come to the driver.
    """
    width = len(fixed.MODEL_FEATURES)
    values = staged(
        rows.select(label, F.posexplode("features").alias("feature", "value")).groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("n1"), F.count_if(F.col(label).isin(0, 1)).alias("known"))
        .select("feature", "value", (F.col("n") - F.col("n1")).alias("n0"), "n1", (F.col("n") - F.col("known")).alias("unknown")),
        "forest-values",
    )
    n0, n1, unknown = values.filter("feature = 0").agg(F.sum("n0"), F.sum("n1"), F.sum("unknown")).first()
    if n0 is None or unknown:
        raise ValueError("a forest needs train rows, with targets 0 or 1 only")
    bins = max(2, min(bins, n0 + n1))
    values = values.filter(~F.isnan("value"))
    sizes = {r["feature"]: r["count"] for r in values.groupBy("feature").count().collect()}
    cuts = [np.zeros(0) for _ in range(width)]
    few = [f for f, n in sizes.items() if n <= bins]
    known: dict[int, list[float]] = {}
    for r in values.filter(F.col("feature").isin(few)).select("feature", "value").collect():
        known.setdefault(r["feature"], []).append(r["value"])
    for f, found in known.items():
        found.sort()
        cuts[f] = (np.array(found[:-1]) + found[1:]) / 2
    many = [f for f, n in sizes.items() if n > bins]
    if many:
        # From the highest value down: cuts at the value borders that come nearest to the multiples of a bin's share.
        wide = values.filter(F.col("feature").isin(many)).select("feature", "value", "n0", "n1", F.col("value").alias("v"))
        sums = running_totals(wide, ["feature"], "value", ["n0", "n1", "v"])
        share = ((n0 > 0) + (n1 > 0)) / bins

        def bin_at(zeros: Column, ones: Column) -> Column:
            return F.least(F.floor((zeros / max(n0, 1) + ones / max(n1, 1)) / share), F.lit(bins - 1))

        middle = bin_at(*[F.col(f"cum_{n}") - F.col(n) / 2 for n in ("n0", "n1")])
        middle_of_next = bin_at(*[F.col(f"cum_{n}") + F.col(f"next_{n}") / 2 for n in ("n0", "n1")])
        at = sums.filter(F.col("next_v").isNotNull() & (middle_of_next > middle)).select("feature", ((F.col("v") + F.col("next_v")) / 2).alias("cut"))
        for f, found in at.groupBy("feature").agg(F.sort_array(F.collect_set("cut"))).collect():
            cuts[f] = np.array(found)
    return [c[np.isfinite(c)] for c in cuts], n0, n1


def folded_rows(rows: DataFrame, label: str, cuts: list[np.ndarray]) -> DataFrame:
    """``first, codes, n0, n1``: the train rows as bin codes, equal ones folded into their counts by target, packed in ascending order.

    Splits only see bins and counts, so nothing is lost, and what a forest draws depends neither on the rows' order nor on their parts.
    """
    kind, width = _code_type(cuts), len(cuts)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.ascontiguousarray(grown.bin_codes(_matrix(batch.column(0), width), cuts, kind))
            ends = np.arange(len(codes) + 1, dtype=np.int32) * (width * codes.itemsize)
            keys = pa.Array.from_buffers(pa.binary(), len(codes), [None, pa.py_buffer(ends), pa.py_buffer(codes)])
            yield pa.RecordBatch.from_arrays([keys, batch.column(1)], names=["codes", "ones"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys, counts = batch.column(0).to_pylist(), [batch.column(i).to_numpy().astype("<i8").tobytes() for i in (1, 2)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], pa.binary()) for x in (keys[0], b"".join(keys), *counts)], names=["first", "codes", "n0", "n1"])

    spark = rows.sparkSession
    folded = (
        rows.select("features", F.col(label).cast("bigint").alias("ones")).mapInArrow(coded, "codes binary, ones bigint")
        .groupBy("codes").agg((F.count(F.lit(1)) - F.sum("ones")).alias("n0"), F.sum("ones").alias("n1"))
    )
    ranged = folded.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "codes").sortWithinPartitions("codes")
    return ranged.mapInArrow(packed, "first binary, codes binary, n0 binary, n1 binary")


def _code_type(cuts: list[np.ndarray]) -> type:
    return np.uint8 if max(map(len, cuts)) < 256 else np.uint16


def fit_folded(packed: DataFrame, cuts: list[np.ndarray], classes: tuple[int, int], trees: int, depth: int = fixed.FOREST["depth"],
               min_leaf: int = fixed.FOREST["min_leaf"], seed: int = fixed.SEED) -> Trees:
    """A balanced forest on folded train rows, a few trees a task, each tree with a seed of its own.

    A regression tree on 0/1 splits exactly like a Gini tree (its variance is half the Gini impurity) and
    its leaves hold the share of class 1, whose mean over trees is the class probability.
    """
    spark, kind, width = packed.sparkSession, _code_type(cuts), len(cuts)
    step = width * np.dtype(kind).itemsize
    firsts = sorted((bytes(r["first"]), r["n"]) for r in packed.select("first", (F.octet_length("codes") / step).cast("int").alias("n")).collect())
    starts = dict(zip([f for f, _ in firsts], np.cumsum([0, *[n for _, n in firsts]]).tolist()))
    size = sum(n for _, n in firsts)
    x, n0, n1 = np.empty((width, size), kind), np.empty(size, np.int64), np.empty(size, np.int64)
    for r in packed.toLocalIterator():
        codes = np.frombuffer(r["codes"], kind).reshape(-1, width)
        at = slice(starts[bytes(r["first"])], starts[bytes(r["first"])] + len(codes))
        x[:, at], n0[at], n1[at] = codes.T, np.frombuffer(r["n0"], "<i8"), np.frombuffer(r["n1"], "<i8")
    sent = spark.sparkContext.broadcast((x, n0, n1))
    c0, c1 = (sum(classes) / (2 * max(c, 1)) for c in classes)
    subset = int(np.ceil(np.sqrt(width)))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree in batch.column(0).to_pylist():
                rng = np.random.default_rng([seed % (1 << 64), tree])
                nodes = grown.grow(*sent.value, c0, c1, cuts, rng, depth, min_leaf, subset)
                yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([nodes.tobytes()], pa.binary())], names=["tree_id", "nodes"])

    ids = spark.range(0, trees, 1, -(-trees // TREES_PER_TASK))
    forest = staged(ids.mapInArrow(fit, "tree_id int, nodes binary"), "forest-trees")
    sent.destroy()
    return Trees(forest, trees, TREES_PER_TASK)


def fit_forest(rows: DataFrame, label: str = fixed.TARGET, trees: int = fixed.FOREST["trees"], depth: int = fixed.FOREST["depth"],
               min_leaf: int = fixed.FOREST["min_leaf"], seed: int = fixed.SEED, bins: int = 256) -> RandomForestRegressionModel:
    """Balanced forest on 0/1 targets, in passes over distributed rows.

    The classifier is not used because it merges sibling leaves that vote for the same class and so loses probabilities.
    """
    sizes = scalar(rows.agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("ones")))
    balanced = rows.withColumn("_c", sizes).withColumn(
        "_weight",
        F.when(F.col(label) == 1, F.col("_c.n") / (2 * F.col("_c.ones"))).otherwise(F.col("_c.n") / (2 * (F.col("_c.n") - F.col("_c.ones")))),
    )
    learner = RandomForestRegressor(
        featuresCol="features", labelCol=label, weightCol="_weight", predictionCol="rf_prob", numTrees=trees, maxDepth=depth,
        minInstancesPerNode=min_leaf, seed=seed, featureSubsetStrategy="sqrt", maxBins=bins, maxMemoryInMB=1024, cacheNodeIds=True,
    )
    return learner.fit(balanced.select(array_to_vector("features").alias("features"), F.col(label).cast("double").alias(label), "_weight"))


def fit_groups(rows: DataFrame, label: str = fixed.TARGET, trees: int = fixed.FOREST["trees"], parts: int = 1,
               seed: int = fixed.SEED, **settings) -> Trees:
    """A forest of ``trees`` trees, fitted ``TREES_PER_FIT`` at a time, as many fits at once as it takes to keep every core busy.

    Each task of a fit keeps statistics of all open nodes of all its trees and sends them on, so that work and shuffle grow with
    trees x parts. Few parts and several fits share the cores just as well without that product. Every group has its own
    seed, and neither groups nor parts follow from the number of cores, so the draws are the same on any cluster.
    """
    sizes = [min(TREES_PER_FIT, trees - at) for at in range(0, trees, TREES_PER_FIT)]
    spark = rows.sparkSession
    at_once = -(-2 * spark.sparkContext.defaultParallelism // parts)  # tasks wait for cores rather than cores for tasks

    def fit(i: int) -> RandomForestRegressionModel:
        return fit_forest(rows.coalesce(parts), label, sizes[i], seed=seed + i, **settings)

    with ThreadPoolExecutor(min(at_once, len(sizes))) as pool:
        models = list(pool.map(inheritable_thread_target(spark)(fit), range(len(sizes))))
    return Trees(staged(saved_trees(models, spark), "forest-trees"), trees, TREES_PER_FIT)


def saved_trees(models: list[RandomForestRegressionModel], spark: SparkSession) -> DataFrame:
    """``tree_id, nodes``: fitted models as packed trees."""
    path = f"{shared_dir(spark)}/forest-{uuid.uuid4().hex}"
    node, first, groups = F.col("nodeData"), 0, []
    for i, g in enumerate(models):
        g.save(f"{path}/{i}")
        groups.append(spark.read.parquet(f"{path}/{i}/data").withColumn("treeID", F.col("treeID") + first))
        first += g.getNumTrees
    nodes = reduce(DataFrame.unionByName, groups).select(
        F.col("treeID").cast("int").alias("tree_id"), node["id"].alias("id"), node["leftChild"].alias("left"), node["rightChild"].alias("right"),
        node["split"]["featureIndex"].alias("feature"), F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        F.get(node["impurityStats"], F.lit(0)).alias("cover"), node["prediction"].alias("value"),
    )
    return nodes.groupBy("tree_id").applyInPandas(_pack_tree, "tree_id int, nodes binary")


def _pack_tree(tree: pd.DataFrame) -> pd.DataFrame:
    """Nodes under ids by which children stand side by side."""
    at, order = tree.set_index("id"), [0]
    left, right = at["left"].to_dict(), at["right"].to_dict()
    for i in order:
        order += [left[i], right[i]] if left[i] >= 0 else []
    new = {old: i for i, old in enumerate(order)}
    out = np.zeros(len(order), grown.NODE)
    for name in ("feature", "threshold", "cover", "value"):
        out[name] = at[name].reindex(order).to_numpy()
    out["left"] = [new[left[i]] if left[i] >= 0 else -1 for i in order]
    return pd.DataFrame({"tree_id": [int(tree["tree_id"].iloc[0])], "nodes": [out.tobytes()]})


def tree_nodes(model: Trees) -> DataFrame:
    """The forest as rows: tree_id, id, left, right, feature, threshold, cover, value."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, nodes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                t = np.frombuffer(nodes, grown.NODE)
                inner = t["left"] >= 0
                columns = [
                    pa.array(np.full(len(t), tree, np.int32)), pa.array(np.arange(len(t), dtype=np.int32)), pa.array(t["left"].copy()),
                    pa.array(np.where(inner, t["left"] + 1, -1).astype(np.int32)), pa.array(t["feature"].copy()),
                    pa.array(t["threshold"].copy(), mask=~inner), pa.array(t["cover"].copy()), pa.array(t["value"].copy()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["tree_id", "id", "left", "right", "feature", "threshold", "cover", "value"])

    return model.packed.mapInArrow(unpack, NODE_SCHEMA)


def folded_scores(packed: DataFrame, cuts: list[np.ndarray], model: Trees) -> DataFrame:
    """``rf_prob, ones, n``: one row per folded train row."""
    forest, kind, width = model.sent(), _code_type(cuts), len(cuts)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = _walks(forest)
        for batch in batches:
            for codes, n0, n1 in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                values = grown.code_values(np.frombuffer(codes, kind).reshape(-1, width), cuts)
                ones = np.frombuffer(n1, "<i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grown.mean_scores(values, steps)), pa.array(ones), pa.array(ones + np.frombuffer(n0, "<i8"))], names=["rf_prob", "ones", "n"])

    return packed.select("codes", "n0", "n1").repartition(_tasks(packed.sparkSession)).mapInArrow(score, "rf_prob double, ones bigint, n bigint")


def feature_parts(rows: int) -> int:
    """Parts for the feature vectors of so many rows: doubles for every feature, and the label."""
    return -(-rows * 8 * (len(fixed.MODEL_FEATURES) + 1) // PART_BYTES)


def train_forest(train: DataFrame, label: str = fixed.TARGET, tasks: int | None = None, trees: int = fixed.FOREST["trees"], bins: int = 256,
                 **settings) -> Forest:
    """Fit and tune. Codes and features are written once.

    More than ``PASS_ROWS`` train rows are folded: trees are grown by tasks that hold all of them as bin codes, equal ones once with their
    counts, as long as these are ``FOLDED_BYTES`` at most. Fewer or longer ones are fitted in passes over the rows, in as many parts
    as keep a part's features to ``PART_BYTES``, unless ``tasks`` is given. The two ways draw differently from the same distribution.
    """
    spark = train.sparkSession
    n = train.count()
    codes, parts = staged(cell_codes(train), "cell-codes"), tasks or max(1, feature_parts(n))
    dealt = parts if n <= PASS_ROWS else max(parts, _tasks(spark))
    rows = staged(feature_rows(train, codes).select("features", label).repartition(dealt), "forest-features")
    if n > PASS_ROWS:
        cuts, *classes = split_points(rows, label, bins)
        packed = staged(folded_rows(rows, label, cuts), "forest-rows")
        size = packed.agg(F.sum(F.octet_length("codes") + F.octet_length("n0") + F.octet_length("n1"))).first()[0]
        if size <= FOLDED_BYTES:
            model = fit_folded(packed, cuts, classes, trees, **settings)
            limit = best_f1_threshold(folded_scores(packed, cuts, model), "rf_prob", "ones", "n")
            return Forest(model, tree_nodes(model), codes, staged(limit, "forest-threshold"))
    model = fit_groups(rows, label, trees, parts, bins=bins, **settings)
    limit = best_f1_threshold(model.transform(rows), "rf_prob", label)
    return Forest(model, tree_nodes(model), codes, staged(limit, "forest-threshold"))


def forest_predict(rows: DataFrame, forest: Forest, threshold: float | None = None) -> DataFrame:
    """Add rf_prob and rf_pred: by the tuned threshold, or by a fixed one."""
    limit = forest.threshold.select("threshold").scalar() if threshold is None else F.lit(threshold)
    scored = forest.model.transform(feature_rows(rows, forest.codes))
    return apply_threshold(scored.select(*rows.columns, "rf_prob"), "rf_prob", "rf_pred", limit)


def path_conditions(nodes: DataFrame, inputs: list[str]) -> Column:
    """The mean over the trees of a given forest, as one expression over the columns ``inputs`` (nulls as 0).

    ``nodes``: tree_id, id, left, right, feature (a place in ``inputs``), threshold, value, as ``tree_nodes`` has them; a leaf
    has a negative left child, the root id 0. A value up to the threshold goes left. A forest of more than ``GIVEN_NODES`` nodes
    is refused, since a plan cannot hold it: that is what ``forest_predict`` is for.
    """
    found = nodes.select("tree_id", "id", "left", "right", "feature", "threshold", "value").limit(GIVEN_NODES + 1).collect()
    if not found or len(found) > GIVEN_NODES:
        raise ValueError(f"a given forest has 1 to {GIVEN_NODES} nodes")
    node = {(r["tree_id"], r["id"]): r for r in found}

    def below(tree: int, place: int) -> Column:
        r = node[tree, place]
        if r["left"] < 0:
            return F.lit(float(r["value"]))
        value = F.coalesce(F.col(inputs[r["feature"]]).cast("double"), F.lit(0.0))
        return F.when(value <= float(r["threshold"]), below(tree, r["left"])).otherwise(below(tree, r["right"]))

    trees = sorted({tree for tree, _ in node})
    return sum((below(tree, 0) for tree in trees), F.lit(0.0)) / len(trees)


def given_forest_predict(rows: DataFrame, nodes: DataFrame, codes: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Add rf_prob and rf_pred by a given small forest: no model object, one expression in the scan's own stage."""
    coded = encode_grid_id(rows, codes)
    scored = coded.withColumn("rf_prob", path_conditions(nodes, fixed.MODEL_FEATURES))
    return apply_threshold(scored.select(*rows.columns, "rf_prob"), "rf_prob", "rf_pred", F.lit(threshold))


def forest_scores(rows: DataFrame, forest: Forest, threshold: float = 0.5) -> DataFrame:
    """Key, features, cell code, rf_prob and rf_pred by a fixed threshold: where explanations start from."""
    scored = forest.model.transform(feature_rows(rows, forest.codes))
    return apply_threshold(scored.select("grid_id", "date", *fixed.MODEL_FEATURES, "rf_prob"), "rf_prob", "rf_pred", F.lit(threshold))


def forest_importance(forest: Forest) -> DataFrame:
    """One row per feature; the model itself is the data, so this is bounded by the feature list."""
    spark = forest.codes.sparkSession
    values = forest.model.featureImportances.tolist()
    return spark.createDataFrame(list(zip(fixed.MODEL_FEATURES, values)), "feature string, importance double")
