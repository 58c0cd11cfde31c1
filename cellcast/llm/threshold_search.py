"""Hard negatives by Fagin's threshold algorithm over sorted lists of vector components.

Vectors become whole numbers. Rows are dealt into blocks; in each block every dimension has a list of the rows sorted by that
component. For an anchor the lists are read from the end that its component's sign favours, a round of rows from all of them at
a time; every row met is scored in full. No row not yet met can score above the threshold, the sum of the anchor's components
times the last values read, so reading ends once the threshold is strictly below the last score needed (ties must all be met)
or below a window's lower end. The blocks' answers are merged by score and id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cellcast.llm.common import staged

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # percent of the positive's score
BLOCK, PACK = 4096, 1024  # rows of a block, anchors that meet it at once
FIRST = 32  # rows of each list in the first round
_LONG = (1 << 63) - 1


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled with zeros."""
    out = np.zeros((len(column), width), dtype=np.int64)
    for i, x in enumerate(column):
        own = x.values.to_numpy()
        out[i, :len(own)] = own
    return out


def _size(x: np.ndarray) -> int:
    return max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))


class Lists:
    """A block of rows and, for each dimension, its rows in the order of that component."""

    def __init__(self, rows: np.ndarray, largest: int) -> None:
        """``largest``: the greatest absolute component of any anchor. Sums beyond doubles are taken in Python's integers."""
        self.exact = _size(rows) * largest * max(1, rows.shape[1]) < 1 << 53
        self.rows = rows.astype(np.float64 if self.exact else object)
        self.order = np.argsort(rows, axis=0, kind="stable")

    def best(self, anchor: np.ndarray, fits: np.ndarray, windows: list[tuple[int, int]], most: int) -> list[list[tuple[int, int]]]:
        """For each window of scores (both ends included) the rows of ``fits`` in it with the ``most`` highest scores.

        All rows tied with the last one are among them, as ``(score, row)`` in no order.
        """
        n = len(self.rows)
        a = anchor.astype(self.rows.dtype)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        met, scores = np.zeros(n, dtype=bool), np.zeros(n, dtype=self.rows.dtype)
        if not len(up) and not len(down):
            met[:] = True
        at, step, open_ = 0, FIRST, list(range(len(windows)))
        out: list[list[tuple[int, int]]] = [[] for _ in windows]
        while open_:
            if met.all():
                threshold = None
            else:
                to = min(n, at + step)
                new = np.zeros(n, dtype=bool)
                new[self.order[n - to:n - at, up].ravel()] = True
                new[self.order[at:to, down].ravel()] = True
                new = np.flatnonzero(new & ~met)
                met[new] = True
                scores[new] = self.rows[new] @ a
                threshold = (self.rows[self.order[n - to, up], up] * a[up]).sum() + (self.rows[self.order[to - 1, down], down] * a[down]).sum()
                at, step = to, step * 2
                if at == n:
                    threshold = None  # every row is met
            some = np.flatnonzero(met & fits)
            own = scores[some]
            for w in list(open_):
                low, high = windows[w]
                inside = np.flatnonzero((own >= low) & (own <= high))
                kth = np.sort(own[inside])[-most] if len(inside) >= most else None
                if threshold is None or threshold < low or (kth is not None and threshold < kth):
                    keep = inside if kth is None else inside[own[inside] >= kth]
                    out[w] = [(int(own[i]), int(some[i])) for i in keep]
                    open_.remove(w)
        return out


def prepared(embeddings: DataFrame, label: Column | None = None) -> DataFrame:
    """``vec_id, label, row, parts``: the rows that take part, vectors as floor(256 x), the label as given.

    A null id, label or vector and any null or non-finite component exclude a row. Rows equal in all three count once.
    ``row`` tells rows of one id apart.
    """
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    label = F.col("label") if label is None else label
    rows = embeddings.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & usable)
    rows = rows.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).cast("array<bigint>").alias("parts"))
    return rows.withColumn("row", F.xxhash64("vec_id", "label", "parts")).dropDuplicates(["vec_id", "label", "row"])


def _met(rows: DataFrame, anchors: DataFrame, by: list[str], find, schema: str) -> DataFrame:
    """``find(rows, anchors)`` for every block of rows and pack of anchors with equal ``by``."""
    blocks = F.greatest(F.ceil(F.col("n_rows") / BLOCK), F.lit(1)).cast("int")
    packs = F.greatest(F.ceil(F.col("n_anchors") / PACK), F.lit(1)).cast("int")
    sizes = rows.groupBy(*by).agg(F.count("*").alias("n_rows")).join(
        anchors.groupBy(*by).agg(F.count("*").alias("n_anchors")), by) if by else rows.agg(F.count("*").alias("n_rows")).withColumn(
        "n_anchors", F.lit(anchors.count()))
    sizes = sizes.select(*by, blocks.alias("blocks"), packs.alias("packs"))
    if by:
        with_sizes = lambda df: df.join(sizes, by)
    else:
        whole = sizes.first()
        with_sizes = lambda df: df.withColumns({"blocks": F.lit(whole["blocks"]), "packs": F.lit(whole["packs"])})
    own = F.xxhash64("vec_id", "row")
    left = with_sizes(rows).withColumn("block", F.pmod(own, "blocks")).withColumn("pack", F.explode(F.sequence(F.lit(0), F.col("packs") - 1)))
    right = with_sizes(anchors).withColumn("pack", F.pmod(own, "packs")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    key = [*by, F.col("block").cast("bigint").alias("block"), F.col("pack").cast("bigint").alias("pack")]
    left = left.select(*key, *(c for c in rows.columns if c not in by))
    right = right.select(*key, *(c for c in anchors.columns if c not in by))
    names = [*by, "block", "pack"]
    return left.groupBy(*names).cogroup(right.groupBy(*names)).applyInArrow(find, schema)


def _both(rows: pa.Table, anchors: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    width = max((len(x) for t in (rows, anchors) for x in t.column("parts")), default=0)
    return _matrix(rows.column("parts"), width), _matrix(anchors.column("parts"), width)


def _found(out: list[tuple], names: list[str]) -> pa.Table:
    columns = list(zip(*out)) or [()] * len(names)
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})


def _score(score: int) -> int:
    return max(-_LONG - 1, min(_LONG, score))


def positives(rows: DataFrame, anchors: DataFrame, most: int = POSITIVES) -> DataFrame:
    """``vec_id, row, positives``: each anchor's ``most`` best other rows of its label, as structs (slot, positive_id, positive_score)."""
    names = ["anchor_id", "anchor", "positive_id", "positive", "score"]

    def find(block: pa.Table, own: pa.Table) -> pa.Table:
        if not block.num_rows or not own.num_rows:
            return _found([], names)
        x, a = _both(block, own)
        ids, keys = block.column("vec_id").to_numpy(), block.column("row").to_numpy()
        lists, out = Lists(x, _size(a)), []
        for anchor, vec_id, row in zip(a, own.column("vec_id").to_pylist(), own.column("row").to_pylist()):
            other = ids != vec_id
            (got,) = lists.best(anchor, other, [(-_LONG ** 2, _LONG ** 2)], most)
            got = sorted((-s, int(ids[i]), int(keys[i])) for s, i in got)[:most]
            out += [(vec_id, row, i, k, _score(-s)) for s, i, k in got]
        return _found(out, names)

    local = _met(rows, anchors, ["label"], find, ", ".join(f"{n} bigint" for n in names))
    slot = F.row_number().over(Window.partitionBy("anchor_id", "anchor").orderBy(F.desc("score"), "positive_id", "positive"))
    best = local.withColumn("slot", slot).filter(F.col("slot") <= most)
    return best.groupBy(F.col("anchor_id").alias("vec_id"), F.col("anchor").alias("row")).agg(F.sort_array(F.collect_list(F.struct(
        F.col("slot").cast("bigint").alias("slot"), "positive_id", F.col("score").alias("positive_score")))).alias("positives"))


def hard_negatives(rows: DataFrame, anchors: DataFrame, low: int = LOW, high: int = HIGH, most: int = NEGATIVES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``, all scores whole numbers.

    ``anchors`` are some of ``rows`` (both as from ``prepared``). The negatives of an anchor and one of its positives are the best
    ``most`` rows of another label that score from ``low`` to ``high`` percent of the positive, ties by the smaller id. "Other
    rows" have another id; shorter vectors count as filled with zeros; scores beyond 64 bits are held at their ends. An
    anchor without positives, or a pair without negatives, gives no rows.
    """
    names = ["anchor_id", "anchor", "slot", "positive_id", "positive_score", "negative_id", "negative", "negative_score"]

    def find(block: pa.Table, own: pa.Table) -> pa.Table:
        if not block.num_rows or not own.num_rows:
            return _found([], names)
        x, a = _both(block, own)
        ids, keys, labels = (block.column(c).to_numpy() for c in ("vec_id", "row", "label"))
        lists, out = Lists(x, _size(a)), []
        for anchor, vec_id, row, label, wanted in zip(a, *(own.column(c).to_pylist() for c in ("vec_id", "row", "label", "positives"))):
            windows = [(-(-low * p["positive_score"] // 100), high * p["positive_score"] // 100) for p in wanted]
            for p, got in zip(wanted, lists.best(anchor, labels != label, windows, most)):
                got = sorted((-s, int(ids[i]), int(keys[i])) for s, i in got)[:most]
                out += [(vec_id, row, p["slot"], p["positive_id"], p["positive_score"], i, k, _score(-s)) for s, i, k in got]
        return _found(out, names)

    rows, anchors = staged(rows, "vectors"), staged(anchors, "anchors")
    wanted = staged(anchors.join(positives(rows, anchors), ["vec_id", "row"]), "anchors")
    local = _met(rows, wanted, [], find, ", ".join(f"{n} bigint" for n in names))
    order = Window.partitionBy("anchor_id", "anchor", "slot").orderBy(F.desc("negative_score"), "negative_id", "negative")
    best = local.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return best.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
