"""Per-cell, per-day and overall aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cellcast import fixed
from cellcast.operators.grid import scalar


def cell_totals(train: DataFrame, centroids: DataFrame) -> DataFrame:
    """Incidents per cell with its centroid; cells without a centroid drop out.

    Summed before the join, so the join sees one row per cell.
    """
    sums = train.groupBy("grid_id").agg(F.sum("incident_count").alias("incident_count"))
    return sums.join(centroids, "grid_id").filter("lat_center IS NOT NULL AND lon_center IS NOT NULL")


def cell_activity(train: DataFrame) -> DataFrame:
    return train.groupBy("grid_id").agg(
        F.sum((F.col("incident_count") > 0).cast("int")).alias("nonzero_days"),
        F.sum("incident_count").alias("total_incidents"),
    )


def historical_rate(train: DataFrame) -> DataFrame:
    """Incidents per train day for each cell."""
    days = train.agg(F.count_distinct("date").alias("n")).scalar()
    sums = train.groupBy("grid_id").agg(F.sum("incident_count").alias("n"))
    return sums.select("grid_id", (F.col("n") / days).alias("rate"))


AGGREGATES = {"mean": F.avg, "min": F.min, "max": F.max, "sum": F.sum, "median": F.median}


def per_cell_metrics(scored: DataFrame, metric: str, hows: list[str]) -> DataFrame:
    """Several aggregates of a score per cell, named by their kind, in one pass."""
    if unknown := [h for h in hows if h not in AGGREGATES]:
        raise ValueError(f"unknown aggregate {unknown[0]!r}")
    return scored.groupBy("grid_id").agg(*[AGGREGATES[h](metric).alias(h) for h in hows])


def per_cell_metric(scored: DataFrame, metric: str, how: str = "mean") -> DataFrame:
    """One aggregate of a score per cell: mean, min, max, sum or median."""
    return per_cell_metrics(scored, metric, [how]).withColumnRenamed(how, "score")


def normalize_minmax(df: DataFrame, value: str, out: str) -> DataFrame:
    bounds = scalar(df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")))
    scaled = (F.col(value) - F.col("_b.lo")) / (F.col("_b.hi") - F.col("_b.lo") + fixed.SCALE_EPSILON)
    return df.withColumn("_b", bounds).withColumn(out, scaled).drop("_b")


def normalize_max(df: DataFrame, value: str, out: str) -> DataFrame:
    """Scaled by the largest value of this very frame (the test rows, for forecasts)."""
    top = df.agg(F.max(value).alias("top")).scalar()
    return df.withColumn("_top", top).withColumn(out, F.col(value) / (F.col("_top") + fixed.SCALE_EPSILON)).drop("_top")


def day_metric_extent(scored: DataFrame, metric: str) -> DataFrame:
    """Colour range per day: nulls ignored, a single value widened, a day without values gets [0, 1]."""
    bounds = scored.groupBy("date").agg(
        F.min(F.nanvl(F.col(metric).cast("double"), F.lit(None))).alias("lo"),
        F.max(F.nanvl(F.col(metric).cast("double"), F.lit(None))).alias("hi"),
    )
    high = F.when(F.col("hi") == F.col("lo"), F.col("lo") + 1e-9).otherwise(F.col("hi"))
    return bounds.select("date", F.coalesce("lo", F.lit(0.0)).alias("lo"), F.coalesce(high, F.lit(1.0)).alias("hi"))


def day_summary(scored: DataFrame) -> DataFrame:
    return scored.groupBy("date").agg(F.count(F.lit(1)).alias("cells"))


def table_summary(scored: DataFrame) -> DataFrame:
    return scored.agg(F.count_distinct("date").alias("dates"), F.count(F.lit(1)).alias("rows"))


def target_summary(rows: DataFrame, label: str = fixed.TARGET) -> DataFrame:
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(label), F.lit(0)).cast("bigint").alias("positives"),
        F.sum((F.col(label) == 0).cast("int")).alias("negatives"),
        F.avg(label).alias("positive_share"),
        (1 - F.avg(label)).alias("negative_share"),
    )
