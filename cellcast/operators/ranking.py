"""Order statistics over unbounded columns without a single-task sort.

A plain window without partitions would pull every distinct score into one task. Here the distinct
scores are cut into buckets of about equal count (a bounded sketch finds the cut points, exactness does
not depend on them), buckets that are still large are cut once more in the same way, each bucket runs its own
window, and bucket totals supply the offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cellcast.session import staged

CUT_LEVELS = 8  # 2^8 buckets per group, and as many again in a bucket that is still large
BUCKET_ROWS = 1 << 20  # distinct values a bucket may hold before it is cut once more


def _bucket(value: Column, cuts: Column) -> Column:
    """How many of the 2^levels - 1 ascending cut points are <= value, by bisection."""
    steps = F.array(*[F.lit(2**k) for k in reversed(range(CUT_LEVELS))])
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(cuts, at + step - 1) <= value, at + step).otherwise(at)
    )


def _cuts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    ways = 2**CUT_LEVELS
    return df.groupBy(*keys).agg(F.percentile_approx(value, [i / ways for i in range(1, ways)], 10 * ways).alias("_cuts"))


def placed_in_buckets(df: DataFrame, groups: list[str], value: str, sums: list[str], bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``df`` with ``_bucket``: higher values never have a lower bucket. At most 2^16 buckets a group, by the row count.

    The second cutting reads nothing unless a first bucket holds more than ``bucket_rows`` rows.
    """
    # The filter keeps every row; it makes side branches read the same columns as the main one, so that
    # the shuffle behind ``df`` is shared.
    every = F.coalesce(*sums).isNotNull() | F.col(value).isNull()
    placed = _join(df, _cuts(df.filter(every), groups, value), groups).withColumn("_first", _bucket(F.col(value), F.col("_cuts"))).drop("_cuts")
    keys = [*groups, "_first"]
    large = placed.filter(every).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > bucket_rows).drop("_n")
    finer = _cuts(placed.filter(every).join(F.broadcast(large), keys, "left_semi"), keys, value)
    second = F.when(F.col("_cuts").isNotNull(), _bucket(F.col(value), F.col("_cuts"))).otherwise(0)
    return _join(placed, finer, keys).withColumn("_bucket", F.col("_first") * 2**CUT_LEVELS + second).drop("_first", "_cuts")


def running_totals(df: DataFrame, groups: list[str], value: str, sums: list[str], bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Per group, totals of ``sums`` over rows with a higher or equal ``value``, as ``cum_<name>``.

    ``df`` holds one row per (group, value). Also adds ``next_<name>``: the numbers of the next lower
    value (null on the lowest).
    """
    placed = placed_in_buckets(df, groups, value, sums, bucket_rows)
    per_bucket = placed.groupBy(*groups, "_bucket").agg(
        *[F.sum(s).alias(f"_sum_{s}") for s in sums],
        F.max_by(F.struct(*sums), value).alias("_top"),
    )
    higher = Window.partitionBy(*groups).orderBy(F.desc("_bucket"))
    offsets = per_bucket.select(
        *groups, "_bucket",
        *[F.coalesce(F.sum(f"_sum_{s}").over(higher.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"_off_{s}") for s in sums],
        F.lead("_top").over(higher).alias("_next"),
    )
    inside = Window.partitionBy(*groups, "_bucket").orderBy(F.desc(value))
    joined = _join(placed, offsets, [*groups, "_bucket"])
    cum = [(F.sum(s).over(inside.rowsBetween(Window.unboundedPreceding, 0)) + F.col(f"_off_{s}")).alias(f"cum_{s}") for s in sums]
    ahead = [F.coalesce(F.lead(s).over(inside), F.col(f"_next.{s}")).alias(f"next_{s}") for s in sums]
    return joined.select(*df.columns, *cum, *ahead)


def _join(rows: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """``small`` has at most 2^16 short rows per group of evaluation (a handful of models), or 2^8 with 2^8 cut points each,
    whatever the number of scores: a proven bound; hence the broadcast.

    The outer join keeps the optimizer from adding null checks to some branches, which would stop them from
    sharing one shuffle.
    """
    if keys:
        return rows.join(F.broadcast(small), keys, "left")
    return rows.withColumn("_cuts", small.select("_cuts").scalar())


def exact_quantiles(df: DataFrame, value: str, at: list[float]) -> DataFrame:
    """One row with columns q0, q1, ...: exact quantiles with linear interpolation, nulls left out.

    The built-in exact percentile keeps every distinct value in one task; this finds the wanted ranks
    from running counts instead.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    ranked = running_totals(counted, [], value, ["n"])
    total = counted.filter(F.col(value).isNotNull()).agg(F.sum("n").alias("total")).scalar()
    ranked = ranked.withColumn("_total", total).withColumn("_below", F.col("_total") - F.col("cum_n"))

    def value_at(rank: Column) -> Column:
        inside = (F.col("_below") <= rank) & (rank < F.col("_below") + F.col("n"))
        return F.max(F.when(inside, F.col(value)))

    picks = []
    for i, q in enumerate(at):
        place = (F.col("_total") - 1) * F.lit(float(q))
        picks += [value_at(F.floor(place)).alias(f"lo{i}"), value_at(F.ceil(place)).alias(f"hi{i}"),
                  F.max(place - F.floor(place)).alias(f"w{i}")]
    found = ranked.agg(*picks)
    return found.select(*[
        (F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.col(f"w{i}")).alias(f"q{i}") for i in range(len(at))
    ])


def rank_by_text(keys: DataFrame, key: str) -> DataFrame:
    """Distinct texts with their 0-based alphabetic rank.

    A range sort deals the texts out evenly, whatever they begin with; it is written once, so that each text keeps its
    range. Ranks run inside a range, and the sizes of the ranges before it (at most one per shuffle partition) are added.
    """
    ranged = keys.select(key).distinct().repartitionByRange(key).withColumn("_range", F.spark_partition_id())
    ranged = staged(ranged, "ranges")
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
    all_sizes = sizes.agg(F.collect_list(F.struct("_range", "n")).alias("sizes")).scalar()
    before = F.filter("_sizes", lambda s: s["_range"] < F.col("_range"))
    offset = F.aggregate(before, F.lit(0).cast("bigint"), lambda total, s: total + s["n"])
    inside = Window.partitionBy("_range").orderBy(key)
    return ranged.withColumn("_sizes", all_sizes).select(key, (offset + F.row_number().over(inside) - 1).cast("int").alias("rank"))
