"""Per-cell ARIMA forecasts: every (cell, order) is one row, fitted independently on the cluster."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from cellcast import fixed
from cellcast.functions.arma import fit_forecast
from cellcast.operators.aggregates import cell_activity, historical_rate, normalize_max
from cellcast.operators.sampling import select_active_cells
from cellcast.operators.split import dates_of, lookup_forecast
from cellcast.session import staged

FIT = StructType([StructField("aic", DoubleType()), StructField("forecast", ArrayType(DoubleType()))])


@F.pandas_udf(FIT)
def _fit(series: pd.Series, p: pd.Series, d: pd.Series, q: pd.Series, ahead: pd.Series) -> pd.DataFrame:
    rows = []
    for counts, *order in zip(series, p, d, q, ahead):
        found = fit_forecast(np.asarray(counts, dtype=float), *(int(v) for v in order))
        rows.append(found or (None, None))
    return pd.DataFrame(rows, columns=["aic", "forecast"])


def orders(p=fixed.ARIMA["p"], d=fixed.ARIMA["d"], q=fixed.ARIMA["q"]) -> list[tuple[int, int, int]]:
    return [(a, b, c) for a in p for b in d for c in q if (a, c) != (0, 0)]


def arima_grid_forecast(train: DataFrame, cells: DataFrame, test_dates: Column, grid: list[tuple[int, int, int]] | None = None,
                        tasks: int | None = None) -> DataFrame:
    """(grid_id, date, forecast) for the chosen cells over all test dates, from the order with least AIC.

    ``cells`` is the selection of busy cells. A series has one number per day. The explicit partition
    count (twice the cores unless ``tasks`` is given) keeps the fits spread out: their rows are small, so adaptive coalescing would put
    all of this heavy work into one task. An order that cannot be fitted drops out; if all do, the
    cell's mean is the forecast.
    """
    tasks = tasks or 2 * train.sparkSession.sparkContext.defaultParallelism
    chosen = train.join(cells.select("grid_id"), "grid_id")
    series = chosen.groupBy("grid_id").agg(
        F.array_sort(F.collect_list(F.struct("date", F.col("incident_count").cast("double").alias("n"))))["n"].alias("series")
    )
    options = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(d).alias("d"), F.lit(q).alias("q")) for p, d, q in grid or orders()])
    jobs = series.withColumn("dates", test_dates).withColumn("o", F.explode(options)).select("grid_id", "series", "dates", "o.*")
    fits = jobs.repartition(tasks, "grid_id", "p", "d", "q").withColumn("fit", _fit("series", "p", "d", "q", F.size("dates")))
    mean = F.aggregate("series", F.lit(0.0), lambda a, x: a + x) / F.size("series")
    best = fits.groupBy("grid_id").agg(
        F.min_by("fit.forecast", F.when(F.col("fit.aic").isNotNull(), F.struct("fit.aic", "p", "d", "q"))).alias("values"),
        F.first(mean).alias("mean"), F.first("dates").alias("dates"),
    )
    flat = F.transform("dates", lambda d: F.col("mean"))
    pairs = F.arrays_zip(F.col("dates").alias("date"), F.coalesce("values", flat).alias("forecast"))
    return best.select("grid_id", F.inline(pairs)).toDF("grid_id", "date", "forecast")


def arima_predict(test: DataFrame, forecasts: DataFrame, rates: DataFrame, alarm: float = fixed.ARIMA["alarm"]) -> DataFrame:
    """Add arima_forecast, arima_prob (scaled by the largest test forecast) and arima_pred."""
    found = normalize_max(lookup_forecast(test, forecasts, rates), "arima_forecast", "arima_prob")
    return found.withColumn("arima_pred", (F.col("arima_forecast") >= alarm).cast("int"))


def train_and_predict(train: DataFrame, test: DataFrame, min_days: int = fixed.ARIMA["min_nonzero_days"], most: int = fixed.ARIMA["max_cells"],
                      grid: list[tuple[int, int, int]] | None = None, alarm: float = fixed.ARIMA["alarm"]) -> DataFrame:
    """Choice of cells, fits and lookup. The forecasts are written once, since the lookup reads them twice."""
    cells = select_active_cells(cell_activity(train), min_days, most)
    forecasts = staged(arima_grid_forecast(train, cells, dates_of(test), grid), "forecasts")
    return arima_predict(test, forecasts, historical_rate(train), alarm)
