"""Density hotspot: a Gaussian kernel density over cell centroids weighted by incident count."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cellcast import fixed
from cellcast.operators.aggregates import cell_totals, normalize_minmax
from cellcast.operators.grid import scalar
from cellcast.operators.split import lookup_cell_score
from cellcast.session import discard, staged

BLOCK = 32  # a pack holds at most BLOCK x BLOCK grid cells
TILES = 2  # tiles along one reach
PARTS = 8  # parts of a pack along one reach
PER_KEY = 4  # about so many target packs of a tile share one join key
TOLERANCE = 1e-18  # of one kernel's peak: what all kernels left out may add to a density together
HELD = 1024  # tiles whose moments a task holds before it passes them on
STEPS = [(i, j) for i in range(-TILES - 1, TILES + 2) for j in range(-TILES - 1, TILES + 2)  # to tiles that may be within reach
         if max(abs(i) - 1, 0) ** 2 + max(abs(j) - 1, 0) ** 2 <= TILES**2]


def bandwidth(sources: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """One row: count, mean, whitening factors, constant and reach of the kernel; none if degenerate.

    Covariance is the weighted sample one (n - 1) times Scott's factor n^(-1/6) squared.
    """
    mean = sources.agg(
        F.sum("w").cast("double").alias("n"),
        (F.sum(F.col("w") * F.col("lat")) / F.sum("w")).alias("lat"),
        (F.sum(F.col("w") * F.col("lon")) / F.sum("w")).alias("lon"),
    )
    centred = sources.withColumn("_m", scalar(mean)).select(
        "w", "_m", (F.col("lat") - F.col("_m.lat")).alias("u"), (F.col("lon") - F.col("_m.lon")).alias("v")
    )
    scale = F.pow("n", F.lit(-1 / 3)) / (F.col("n") - 1)
    sums = centred.agg(
        F.max("_m.n").alias("n"), F.max("_m.lat").alias("lat"), F.max("_m.lon").alias("lon"),
        F.sum(F.col("w") * F.col("u") * F.col("u")).alias("uu"),
        F.sum(F.col("w") * F.col("u") * F.col("v")).alias("uv"),
        F.sum(F.col("w") * F.col("v") * F.col("v")).alias("vv"),
    ).filter("n > 1")
    cov = sums.select("n", "lat", "lon", *[(F.col(c) * scale).alias(c) for c in ("uu", "uv", "vv")])
    cov = cov.withColumn("det", F.col("uu") * F.col("vv") - F.col("uv") * F.col("uv")).filter("det > 0 AND uu > 0")
    # Inverse covariance = M'M with M = [[a, b], [0, c]]: distances in M-space are in bandwidths.
    return cov.select(
        "n", "lat", "lon",
        F.sqrt(F.col("vv") / F.col("det")).alias("a"),
        (-F.col("uv") / F.sqrt(F.col("vv") * F.col("det"))).alias("b"),
        F.sqrt(1 / F.col("vv")).alias("c"),
        (1 / (F.col("n") * 2 * F.pi() * F.sqrt("det"))).alias("k"),
        # Beyond this distance all n kernels together add less than the tolerance, whose default is below
        # what a double can hold next to one kernel's peak.
        F.sqrt(2 * F.log(F.greatest(F.col("n") / tolerance, F.lit(2.0)))).alias("reach"),
    )


def _white(df: DataFrame) -> DataFrame:
    """Add p, q (position in bandwidths) and its tile, by the kernel in ``_k``."""
    du, dv = F.col("lat") - F.col("_k.lat"), F.col("lon") - F.col("_k.lon")
    df = df.withColumns({"p": F.col("_k.a") * du + F.col("_k.b") * dv, "q": F.col("_k.c") * dv})
    return df.withColumns({f"tile_{x}": F.floor(F.col(x) * TILES / F.col("_k.reach")) for x in "pq"})


def _packs(white: DataFrame, name: str, *more: Column) -> DataFrame:
    """One row for each tile and grid block: the rows as an array ``name``, and their bounding box ``name_box``."""
    blocks = [F.floor(F.col(f"cell_{x}") / BLOCK).alias(f"_{x}") for x in ("row", "col")]
    box = F.struct(*[f(x).alias(f"{f.__name__}_{x}") for x in "pq" for f in (F.min, F.max)])
    packed = F.collect_list(F.struct("p", "q", *more))
    return white.groupBy("tile_p", "tile_q", *blocks).agg(
        packed.alias(name), box.alias(f"{name}_box"), F.first("_k.k").alias("k"), F.first("_k.reach").alias("reach"))


def _gap(x: str) -> Column:
    """How far the boxes of targets and sources lie apart along one axis."""
    t, s = "targets_box", "sources_box"
    return F.greatest(F.col(f"{t}.min_{x}") - F.col(f"{s}.max_{x}"), F.col(f"{s}.min_{x}") - F.col(f"{t}.max_{x}"), F.lit(0.0))


def _steps() -> Column:
    return F.array(*[F.struct(F.lit(i).alias("p"), F.lit(j).alias("q")) for i, j in STEPS])


def _fold(tp, tq, sp, sq, sw, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Kernel sums of one pack of sources at one pack of targets, and how many kernels each target evaluated.

    The sources are parted finely; a part whose box is beyond the reach of a target is not evaluated there.
    """
    total, kernels = np.zeros(len(tp)), np.zeros(len(tp), dtype=np.int64)
    u, v = np.floor(sp * (PARTS / reach)), np.floor(sq * (PARTS / reach))
    order = np.lexsort((v, u))
    sp, sq, sw, u, v = sp[order], sq[order], sw[order], u[order], v[order]
    cuts = np.flatnonzero((np.diff(u) != 0) | (np.diff(v) != 0)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(sp)]):
        x, y = sp[a:b], sq[a:b]
        dp = np.maximum(np.maximum(x.min() - tp, tp - x.max()), 0)
        dq = np.maximum(np.maximum(y.min() - tq, tq - y.max()), 0)
        near = np.flatnonzero(dp * dp + dq * dq <= reach * reach)
        if len(near):
            apart = np.square(tp[near, None] - x) + np.square(tq[near, None] - y)
            total[near] += np.exp(apart * -0.5) @ sw[a:b]
            kernels[near] += b - a
    return total, kernels


def _fold_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def at(column: pa.ListArray, i: int) -> pa.Array:
        return column.values[column.offsets[i].as_py():column.offsets[i + 1].as_py()]

    for batch in batches:
        ids, *numbers = (batch.column(c) for c in ("ids", "tp", "tq", "sp", "sq", "sw"))
        for i, (k, reach) in enumerate(zip(batch.column("k").to_pylist(), batch.column("reach").to_pylist())):
            total, kernels = _fold(*[at(c, i).to_numpy(zero_copy_only=False) for c in numbers], reach)
            yield pa.RecordBatch.from_arrays([at(ids, i), pa.array(k * total), pa.array(kernels)], names=["grid_id", "part", "kernels"])


def kernel_parts(targets: DataFrame, sources: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """``grid_id, part, kernels``: what a pack of sources adds to a target, and from how many kernels.

    The direct sum: its work grows with targets times sources within reach. ``kernel_density`` takes the fields below instead.

    Targets and sources are packed by tile (half a reach wide) and grid block, so that a pack is bounded. A pack of sources
    goes to the tiles within its reach that hold targets, meets their packs by an equi-join on tile and salt, and only if the
    two boxes are within reach; inside, finer parts are pruned for each target. Pairs are never rows. A tile has as many
    salts as its own packs need.
    """
    kernel = scalar(bandwidth(sources, tolerance))
    tile = ["tile_p", "tile_q"]
    to = _packs(_white(targets.withColumn("_k", kernel).filter("_k.k IS NOT NULL")), "targets", F.col("grid_id"))
    of = _packs(_white(sources.withColumn("_k", kernel).filter("_k.k IS NOT NULL")), "sources", F.col("w").cast("double").alias("w"))
    # One small row per tile with targets.
    tiles = to.groupBy(*tile).agg(F.ceil(F.count(F.lit(1)) / PER_KEY).cast("int").alias("salts"))
    sent = of.drop("k", "reach").withColumn("_step", F.explode(_steps())).withColumns({f"tile_{x}": F.col(f"tile_{x}") + F.col(f"_step.{x}") for x in "pq"})
    sent = sent.join(tiles, tile).select("sources", "sources_box", *tile, F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    # Packs are small rows with much work each: an explicit count keeps them spread over all cores.
    spark = targets.sparkSession
    tasks = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    salt = F.pmod(F.hash("_row", "_col"), F.col("salts")).alias("salt")
    spread = to.join(tiles, tile).select("targets", "targets_box", "k", "reach", *tile, salt).repartition(tasks, *tile, "salt")
    met = spread.hint("shuffle_hash").join(sent, [*tile, "salt"]).filter(
        _gap("p") * _gap("p") + _gap("q") * _gap("q") <= F.col("reach") * F.col("reach"))
    pairs = met.select(F.col("targets.grid_id").alias("ids"), F.col("targets.p").alias("tp"), F.col("targets.q").alias("tq"),
                       F.col("sources.p").alias("sp"), F.col("sources.q").alias("sq"), F.col("sources.w").alias("sw"), "k", "reach")
    kind = targets.schema["grid_id"].dataType.simpleString()
    return pairs.mapInArrow(_fold_pairs, f"grid_id {kind}, part double, kernels bigint")


def expansion_order(reach: float) -> int:
    """Chebyshev nodes a side of a tile at which interpolating a kernel errs by less than 1e-17 of its peak.

    On a side of 2a bandwidths the error of n nodes is at most 2.2 (a / 2)^n / sqrt(n!), from the bound of Hermite functions.
    """
    half = reach / TILES / 2
    n = 8
    while math.log(2.2) + n * math.log(half / 2) - math.lgamma(n + 1) / 2 > math.log(1e-17):
        n += 1
    return n


def _nodes(order: int) -> np.ndarray:
    return np.cos((np.arange(order) + 0.5) * (np.pi / order))


def _basis(x: np.ndarray, tile: int, reach: float, order: int) -> np.ndarray:
    """Each node's polynomial (columns) at positions ``x`` of a tile (rows)."""
    terms = np.polynomial.chebyshev.chebvander(_nodes(order), order - 1) * (2 / order)
    terms[:, 0] /= 2
    return np.polynomial.chebyshev.chebvander(x * (2 * TILES / reach) - (2 * tile + 1), order - 1) @ terms.T


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    lengths = np.concatenate([[0], np.cumsum([r.size for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(lengths), pa.array(np.concatenate([r.ravel() for r in rows]) if rows else np.zeros(0)))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sources -> for each tile of this task, their weights carried to the nodes of the tile."""
    held: dict[tuple, np.ndarray] = {}

    def passed_on() -> pa.RecordBatch:
        tiles = [pa.array([key[i] for key in held], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64()))]
        return pa.RecordBatch.from_arrays([*tiles, _lists(list(held.values()))], names=["tile_p", "tile_q", "reach", "moments"])

    for batch in batches:
        u, v, p, q, w, reaches = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("tile_p", "tile_q", "p", "q", "w", "reach"))
        order = np.lexsort((v, u))
        cuts = np.flatnonzero((np.diff(u[order]) != 0) | (np.diff(v[order]) != 0)) + 1
        for rows in np.split(order, cuts) if len(order) else []:
            tp, tq, reach = int(u[rows[0]]), int(v[rows[0]]), float(reaches[rows[0]])
            n = expansion_order(reach)
            found = _basis(p[rows], tp, reach, n).T @ (w[rows, None] * _basis(q[rows], tq, reach, n))
            held[tp, tq, reach] = held.get((tp, tq, reach), 0.0) + found
            if len(held) >= HELD:
                yield passed_on()
                held.clear()
    if held:
        yield passed_on()


def _matrix(lists: pa.ListArray, i: int, order: int) -> np.ndarray:
    return lists.values[lists.offsets[i].as_py():lists.offsets[i + 1].as_py()].to_numpy(zero_copy_only=False).reshape(order, order)


def _added(group: pa.Table) -> pa.Table:
    """Moments of one tile from several tasks -> one row."""
    group = group.combine_chunks()
    lists = group.column("moments").chunk(0)
    order = expansion_order(group.column("reach")[0].as_py())
    total = sum(_matrix(lists, i, order) for i in range(len(lists)))
    return group.slice(0, 1).drop_columns("moments").append_column("moments", _lists([total]))


def _field(group: pa.Table) -> pa.Table:
    """Moments that reached one tile -> the density's values at its nodes, before the kernel's constant.

    The kernel is a product over the axes, so a pair of tiles takes two small matrix products.
    """
    group = group.combine_chunks()
    lists = group.column("moments").chunk(0)
    reach = group.column("reach")[0].as_py()
    order = expansion_order(reach)
    nodes = _nodes(order)

    def kernel(step: int) -> np.ndarray:
        apart = ((nodes[:, None] - nodes) / 2 + step) * (reach / TILES)
        return np.exp(apart * apart * -0.5)

    steps = zip(group.column("step_p").to_pylist(), group.column("step_q").to_pylist())
    total = sum(kernel(i) @ _matrix(lists, row, order) @ kernel(j).T for row, (i, j) in enumerate(steps))
    return group.slice(0, 1).select(["tile_p", "tile_q", "reach"]).append_column("field", _lists([total]))


def _read_fields(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def at(column: pa.ListArray, i: int) -> pa.Array:
        return column.values[column.offsets[i].as_py():column.offsets[i + 1].as_py()]

    for batch in batches:
        ids, p, q, field = (batch.column(c) for c in ("ids", "p", "q", "field"))
        scalars = zip(*(batch.column(c).to_pylist() for c in ("tile_p", "tile_q", "k", "reach")))
        for i, (tp, tq, k, reach) in enumerate(scalars):
            n = expansion_order(reach)
            x, y = (at(c, i).to_numpy(zero_copy_only=False) for c in (p, q))
            values = ((_basis(x, tp, reach, n) @ _matrix(field, i, n)) * _basis(y, tq, reach, n)).sum(axis=1)
            yield pa.RecordBatch.from_arrays([at(ids, i), pa.array(k * np.maximum(values, 0.0))], names=["grid_id", "part"])


def kernel_fields(targets: DataFrame, sources: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """``grid_id, part``: the density at each target that has a tile of sources within reach.

    A fast Gauss transform, whose work grows with targets plus sources, not with their pairs: the sources of a tile (half a
    reach wide) are carried to its Chebyshev nodes, tiles meet by their nodes, and targets are read off the nodes of their tile.
    The order is such that an interpolated kernel errs by less than 1e-17 of its peak, so that rounding (below 1e-13 of the
    weight within reach) is what remains. The tiles hold the sources within a few n^(1/6) bandwidths, so there are few of them.
    """
    kernel = scalar(bandwidth(sources, tolerance))
    tile = ["tile_p", "tile_q"]
    of = _white(sources.withColumn("_k", kernel).filter("_k.k IS NOT NULL")).filter("tile_p IS NOT NULL AND tile_q IS NOT NULL AND w IS NOT NULL")
    beyond = {f"tile_{x}": F.col(f"tile_{x}") + F.col(f"_step.{x}") for x in "pq"}
    # Bounded like the tiles of sources, hence the broadcast: most cells of a wide grid are out of reach and are not shuffled.
    near = of.select(*tile).distinct().withColumn("_step", F.explode(_steps())).withColumns(beyond).select(*tile).distinct()
    white = _white(targets.withColumn("_k", kernel).filter("_k.k IS NOT NULL")).join(F.broadcast(near), tile, "left_semi")
    to = _packs(white, "targets", F.col("grid_id"))
    tiles = to.groupBy(*tile).agg(F.ceil(F.count(F.lit(1)) / PER_KEY).cast("int").alias("salts"))

    rows = of.select(*tile, "p", "q", F.col("w").cast("double").alias("w"), F.col("_k.reach").alias("reach"))
    schema = "tile_p bigint, tile_q bigint, reach double, {} array<double>"
    moments = rows.mapInArrow(_moments, schema.format("moments")).groupBy(*tile).applyInArrow(_added, schema.format("moments"))
    sent = moments.withColumn("_step", F.explode(_steps())).withColumns(beyond).join(F.broadcast(tiles.select(*tile)), tile, "left_semi")
    sent = sent.select(*tile, "reach", "moments", *[F.col(f"_step.{x}").cast("int").alias(f"step_{x}") for x in "pq"])
    fields = sent.groupBy(*tile).applyInArrow(_field, schema.format("field"))

    salted = fields.drop("reach").join(tiles, tile).select(*tile, "field", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    salt = F.pmod(F.hash("_row", "_col"), F.col("salts")).alias("salt")
    spread = to.join(tiles, tile).select(*tile, salt, "targets", "k", "reach")
    met = spread.join(salted, [*tile, "salt"]).select(
        *tile, F.col("targets.grid_id").alias("ids"), F.col("targets.p").alias("p"), F.col("targets.q").alias("q"), "field", "k", "reach")
    kind = targets.schema["grid_id"].dataType.simpleString()
    return met.mapInArrow(_read_fields, f"grid_id {kind}, part double")


def kernel_density(targets: DataFrame, sources: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Density at each target (grid_id, cell_row, cell_col, lat, lon) from sources (the same plus w), read several times.

    No rows if the kernel is degenerate; 0 where no source is within reach.
    """
    usable = scalar(bandwidth(sources, tolerance).select("k"))
    everywhere = targets.filter(usable.isNotNull()).select("grid_id", F.lit(0.0).alias("part"))
    parts = kernel_fields(targets, sources, tolerance)
    return everywhere.unionByName(parts).groupBy("grid_id").agg(F.sum("part").alias("density"))


def hotspot_kde(train: DataFrame, centroids: DataFrame) -> DataFrame:
    """Min-max scaled density (grid_id, score) of every grid cell; no rows without usable incidents.

    Counts and density, one row per cell each, are written when this is called: both are read several times, and the train
    rows are folded once.
    """
    totals = staged(cell_totals(train, centroids).filter("incident_count > 0"), "cell-totals")
    position = [F.col("lat_center").alias("lat"), F.col("lon_center").alias("lon")]
    targets = centroids.select("grid_id", "cell_row", "cell_col", *position)
    sources = totals.select("grid_id", "cell_row", "cell_col", *position, F.col("incident_count").alias("w"))
    density = staged(kernel_density(targets, sources), "density")
    discard(totals)
    return normalize_minmax(density, "density", "score").select("grid_id", "score")


def threshold(i: Column) -> Column:
    """The i-th candidate; always start + i * step, so that it is the same double everywhere."""
    return F.lit(fixed.THRESHOLD_STEP) + i * F.lit(fixed.THRESHOLD_STEP)


def threshold_bucket(score: Column) -> Column:
    """How many candidates are <= score: guess by division, corrected by comparing the real doubles."""
    last = fixed.THRESHOLD_COUNT
    guess = F.least(F.greatest(F.floor(score / fixed.THRESHOLD_STEP), F.lit(1)), F.lit(last)).cast("int")
    return (
        F.when((guess < last) & (score >= threshold(guess)), guess + 1)
        .when(score >= threshold(guess - 1), guess)
        .otherwise(guess - 1)
    )


def best_f1_threshold(rows: DataFrame, score: str, label: str = fixed.TARGET, count: str | None = None) -> DataFrame:
    """One row (threshold, f1): the first candidate with the highest F1 over all rows, else the default.

    A row stands for ``count`` rows if given, of which ``label`` are positive.

    One pass: rows fold into at most 99 buckets before any shuffle, the rest is arithmetic on those.
    """
    hist = rows.groupBy(threshold_bucket(F.col(score)).alias("b")).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"), (F.sum(count) if count else F.count(F.lit(1))).alias("n")
    )
    table = hist.agg(F.map_from_entries(F.collect_list(F.struct("b", F.struct("pos", "n")))).alias("m"), F.sum("pos").alias("all"))
    steps = table.select("m", "all", F.explode(F.sequence(F.lit(0), F.lit(fixed.THRESHOLD_COUNT - 1))).alias("i"))
    above = F.sequence(F.col("i") + 1, F.lit(fixed.THRESHOLD_COUNT))

    def total(name: str) -> Column:
        return F.aggregate(above, F.lit(0).cast("bigint"), lambda acc, b: acc + F.coalesce(F.element_at("m", b)[name], F.lit(0)))

    # F1 = 2 TP / (predicted + actual positives)
    f1 = F.coalesce(F.try_divide(2.0 * total("pos"), total("n") + F.col("all")), F.lit(0.0))
    scored = steps.select("i", f1.alias("f1"))
    best = scored.agg(F.max_by("i", F.struct("f1", -F.col("i"))).alias("i"), F.max("f1").alias("f1"))
    found = F.coalesce(F.col("f1") > 0, F.lit(False))
    return best.select(
        F.when(found, threshold(F.col("i"))).otherwise(fixed.THRESHOLD_DEFAULT).alias("threshold"),
        F.coalesce("f1", F.lit(0.0)).alias("f1"),
    )


def hotspot_threshold(train: DataFrame, scores: DataFrame) -> DataFrame:
    """Best threshold of the cell scores on the train rows; the default if there are no scores."""
    return best_f1_threshold(lookup_cell_score(train, scores, "score"), "score")


def apply_threshold(rows: DataFrame, score: str, out: str, limit: Column) -> DataFrame:
    return rows.withColumn("_limit", limit).withColumn(out, (F.col(score) >= F.col("_limit")).cast("int")).drop("_limit")


def hotspot_predict(rows: DataFrame, scores: DataFrame, limit: Column) -> DataFrame:
    """Add hotspot_prob and hotspot_pred."""
    return apply_threshold(lookup_cell_score(rows, scores, "hotspot_prob"), "hotspot_prob", "hotspot_pred", limit)
