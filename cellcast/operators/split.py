"""Temporal split, lookups and encodings keyed by day or cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cellcast import fixed
from cellcast.operators.ranking import rank_by_text


def dates_of(df: DataFrame) -> Column:
    """All distinct dates in order as one array subquery; bounded by the calendar."""
    return df.agg(F.array_sort(F.collect_set("date")).alias("dates")).scalar()


def split_temporal(df: DataFrame, fraction: float = fixed.TRAIN_FRACTION) -> DataFrame:
    """Add ``split``: 'train' on the first int(n * fraction) distinct dates, else 'test'."""
    dates = F.col("_dates")
    first_test = F.get(dates, F.floor(F.size(dates) * F.lit(float(fraction))).cast("int"))
    is_test = F.coalesce(F.col("date") >= first_test, F.lit(False))
    return df.withColumn("_dates", dates_of(df)).select(*df.columns, F.when(is_test, "test").otherwise("train").alias("split"))


def parts(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train and test rows of a split table."""
    return df.filter("split = 'train'").drop("split"), df.filter("split = 'test'").drop("split")


def lookup_cell_score(rows: DataFrame, scores: DataFrame, out: str, score: str = "score") -> DataFrame:
    """Per-cell score onto rows, 0 where the cell has none. Cells may be many, so no forced broadcast."""
    found = scores.select("grid_id", F.col(score).alias("_score"))
    return rows.join(found, "grid_id", "left").select(*rows.columns, F.coalesce("_score", F.lit(0.0)).alias(out))


def cell_codes(train: DataFrame) -> DataFrame:
    """grid_id -> 0-based alphabetic rank among the cells of the train part."""
    return rank_by_text(train, "grid_id").withColumnRenamed("rank", fixed.CELL_CODE)


def encode_grid_id(rows: DataFrame, codes: DataFrame) -> DataFrame:
    """Add grid_id_enc; a cell not seen in training gets -1."""
    joined = rows.join(codes, "grid_id", "left")
    return joined.select(*rows.columns, F.coalesce(fixed.CELL_CODE, F.lit(-1)).cast("int").alias(fixed.CELL_CODE))


def lookup_forecast(rows: DataFrame, forecasts: DataFrame, rates: DataFrame, out: str = "arima_forecast") -> DataFrame:
    """Modelled cell: its forecast for the date, else 0. Other cells: their historical rate, else 0.

    No join is forced: the forecasts of a few dozen cells are broadcast once their size is known, and a
    larger selection is shuffled by key.
    """
    by_day = forecasts.select("grid_id", "date", F.col("forecast").alias("_forecast"))
    modelled = forecasts.select("grid_id").distinct().withColumn("_modelled", F.lit(True))
    joined = rows.join(by_day, ["grid_id", "date"], "left").join(modelled, "grid_id", "left")
    joined = joined.join(rates.select("grid_id", F.col("rate").alias("_rate")), "grid_id", "left")
    value = F.when(F.col("_modelled"), F.coalesce("_forecast", F.lit(0.0))).otherwise(F.coalesce("_rate", F.lit(0.0)))
    return joined.select(*rows.columns, value.alias(out))


def class_weights(rows: DataFrame, label: str = fixed.TARGET) -> DataFrame:
    """Balanced weights: n / (2 * size of the class)."""
    sizes = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # Two rows at most, so the window over all of them costs nothing and spares a second scan.
    total = F.sum("n").over(Window.partitionBy())
    return sizes.select(label, "n", (total / (2 * F.col("n"))).alias("weight"))
