"""Top-k, quantile bands and repeatable samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from cellcast import fixed
from cellcast.operators.grid import scalar
from cellcast.operators.ranking import exact_quantiles
from cellcast.operators.split import dates_of

ROW_KEY = ["grid_id", "date"]


def select_active_cells(activity: DataFrame, min_days: int = fixed.ARIMA["min_nonzero_days"], most: int = fixed.ARIMA["max_cells"]) -> DataFrame:
    """Busiest cells with enough active days; equal totals are ordered by cell."""
    return activity.filter(F.col("nonzero_days") >= min_days).orderBy(F.desc("total_incidents"), "grid_id").limit(most)


def topk_rows(df: DataFrame, score: str, k: int, largest: bool = True) -> DataFrame:
    """The k highest or lowest scores; ties by date and cell."""
    order = F.desc_nulls_last(score) if largest else F.asc_nulls_last(score)
    return df.filter(F.col(score).isNotNull()).orderBy(order, "date", "grid_id").limit(k)


def quantile_band(df: DataFrame, score: str, low: float, high: float) -> DataFrame:
    """Rows whose score lies between two exact quantiles, both included."""
    band = scalar(exact_quantiles(df, score, [low, high]))
    inside = F.col(score).between(F.col("_band.q0"), F.col("_band.q1"))
    return df.withColumn("_band", band).filter(inside).drop("_band")


def sample_order(keys: list[str], seed: int = fixed.SEED) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]).cast("binary"))


def sample_n(df: DataFrame, n: int, keys: list[str] | None = None, seed: int = fixed.SEED) -> DataFrame:
    """At most n rows without replacement, the same ones on every run and any partitioning."""
    keys = keys or ROW_KEY
    return df.orderBy(sample_order(keys, seed), *keys).limit(n)


def select_explain_rows(scored: DataFrame, score: str = "rf_prob", high: int = fixed.EXPLAIN_SETTINGS["high"],
                        mid: int = fixed.EXPLAIN_SETTINGS["mid"], low: int = fixed.EXPLAIN_SETTINGS["low"],
                        low_pool: int = fixed.EXPLAIN_SETTINGS["low_pool"],
                        band: tuple[float, float] = fixed.EXPLAIN_SETTINGS["band"]) -> DataFrame:
    """High, middle and low scores worth explaining, with ``stratum`` and ``position`` (1, 2, ... in order of choice).

    High ones are chosen by score, the others in the order of their sample; a row chosen twice stays in its first stratum.
    """
    drawn = [sample_order(ROW_KEY), *ROW_KEY]
    strata = {
        "high": (topk_rows(scored, score, high), [F.desc(score), "date", "grid_id"]),
        "mid": (sample_n(quantile_band(scored, score, *band), mid), drawn),
        "low": (sample_n(topk_rows(scored, score, low_pool, largest=False), low), drawn),
    }
    # At most high + mid + low rows from here on.
    named = [
        df.withColumns({"stratum": F.lit(name), "_rank": F.lit(i), "_place": F.row_number().over(Window.partitionBy(F.lit(i)).orderBy(*order))})
        for i, (name, (df, order)) in enumerate(strata.items())
    ]
    together = reduce(DataFrame.unionByName, named)
    first = Window.partitionBy(*ROW_KEY).orderBy("_rank")
    chosen = together.withColumn("_n", F.row_number().over(first)).filter("_n = 1")
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_rank", "_place")).alias("position")
    return chosen.select(*scored.columns, "stratum", place)


def sample_dates(df: DataFrame, n: int = 3) -> DataFrame:
    """n evenly spaced dates of the table, first and last included."""
    spark = df.sparkSession
    one = spark.range(1).select(dates_of(df).alias("dates")).withColumn("m", F.least(F.lit(n), F.size("dates")))
    # Whole numbers: the last place is the last date exactly.
    place = F.expr("i * (size(dates) - 1) div greatest(m - 1, 1)")
    return (
        one.filter("m > 0")
        .select("dates", "m", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("i"))
        .select(F.get("dates", place.cast("int")).alias("date"))
    )


def topk_importance(importance: DataFrame, k: int = 15) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(k)


def topk_drivers(rows: DataFrame, features: list[str] | None = None, k: int = 3) -> DataFrame:
    """Add top_driver_i and top_driver_i_shap: the largest absolute contributions, ties in feature order."""
    features = features or fixed.MODEL_FEATURES
    entries = F.array(*[
        F.struct((-F.abs(F.col(f"{f}_shap"))).alias("size"), F.lit(i).alias("place"), F.lit(f).alias("name"), F.col(f"{f}_shap").alias("value"))
        for i, f in enumerate(features)
    ])
    ranked = rows.withColumn("_ranked", F.array_sort(entries))
    names = {f"top_driver_{i}": F.get("_ranked", F.lit(i - 1))["name"] for i in range(1, k + 1)}
    values = {f"top_driver_{i}_shap": F.get("_ranked", F.lit(i - 1))["value"] for i in range(1, k + 1)}
    return ranked.withColumns({**names, **values}).drop("_ranked")
