"""From incidents to one row per cell and day, with calendar, history and target columns."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from cellcast import fixed
from cellcast.functions import calendar
from cellcast.operators.grid import scalar


def by_cell() -> WindowSpec:
    return Window.partitionBy("grid_id").orderBy("date")


def day_range(incidents: DataFrame) -> DataFrame:
    return incidents.agg(F.min("date").alias("first"), F.max("date").alias("last"))


def date_spine(incidents: DataFrame) -> DataFrame:
    """Every day from the first to the last incident."""
    return day_range(incidents).select(F.explode(F.sequence("first", "last")).alias("date"))


def count_cell_day(incidents: DataFrame) -> DataFrame:
    return incidents.groupBy("grid_id", "date").agg(F.count(F.lit(1)).alias("incident_count"))


def densify_cell_day(counts: DataFrame, days: Column | None = None) -> DataFrame:
    """One row per seen cell and day of the range, 0 where nothing happened.

    Works by filling gaps: each counted day unfolds up to the day before the cell's next counted day
    (the first one also backwards to the range start). Only the sparse counts are shuffled, by cell, and
    the filled rows stay in that partitioning for every later window; there is no cells x days product
    to build and join. A cell holds at most one row per day, so no cell can grow into a hot spot.
    """
    days = scalar(day_range(counts)) if days is None else days
    ahead = F.lead("date").over(by_cell())
    gaps = counts.withColumn("_days", days).select(
        "grid_id", F.col("date").alias("_seen"), "incident_count",
        F.when(F.lag("date").over(by_cell()).isNull(), F.col("_days.first")).otherwise(F.col("date")).alias("_from"),
        F.coalesce(F.date_sub(ahead, 1), F.col("_days.last")).alias("_to"),
    )
    filled = gaps.select("grid_id", "_seen", "incident_count", F.explode(F.sequence("_from", "_to")).alias("date"))
    seen = F.when(F.col("date") == F.col("_seen"), F.col("incident_count")).otherwise(F.lit(0)).cast("bigint")
    return filled.select("grid_id", "date", seen.alias("incident_count"))


def join_weather(cell_days: DataFrame, weather: DataFrame) -> DataFrame:
    """Left join by day. A second weather row for one day fails the job.

    The weather side holds one row per calendar day, whatever the data volume, hence the broadcast.
    """
    columns = [c for c in weather.columns if c != "date"]
    once = weather.groupBy("date").agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in columns])
    checked = F.when(
        F.col("_n") > 1, F.raise_error(F.concat(F.lit("several weather rows for "), F.col("date").cast("string"))).cast("date")
    ).otherwise(F.col("date"))
    once = once.select(checked.alias("date"), *columns)
    return cell_days.join(F.broadcast(once), "date", "left").select(*cell_days.columns, *columns)


def join_holidays(df: DataFrame, country: str = "US", calendar_days: DataFrame | None = None) -> DataFrame:
    """Add is_holiday from the country's rules, or from a frame of dates (bounded by the calendar)."""
    if calendar_days is None:
        return df.withColumn("is_holiday", calendar.holiday(F.col("date"), country).cast("int"))
    days = calendar_days.select("date").distinct().withColumn("_holiday", F.lit(1))
    joined = df.join(F.broadcast(days), "date", "left")
    return joined.select(*df.columns, F.coalesce("_holiday", F.lit(0)).alias("is_holiday"))


def feat_calendar(df: DataFrame) -> DataFrame:
    """day_of_week (Monday = 0), month, season, is_weekend."""
    weekday, month = F.weekday("date"), F.month("date")
    return df.withColumns({
        "day_of_week": weekday, "month": month, "season": calendar.season(month),
        "is_weekend": (weekday >= 5).cast("int"),
    })


def lag_columns(value: str = "incident_count") -> dict[str, Column]:
    return {
        f"lag_{n}": F.coalesce(F.lag(value, n).over(by_cell()), F.lit(0)).cast("double") for n in fixed.LAGS
    }


def rolling_columns(value: str = "incident_count") -> dict[str, Column]:
    return {
        f"rolling_sum_{n}": F.coalesce(F.sum(value).over(by_cell().rowsBetween(-n, -1)), F.lit(0)).cast("double")
        for n in fixed.ROLLING_DAYS
    }


def target_columns(horizon: int = 1, value: str = "incident_count") -> dict[str, Column]:
    """Whether the next ``horizon`` days hold an incident, and whether all of them are known.

    The sum of leads is null as soon as one of them is, and null counts as no incident.
    """
    if horizon < 1:
        raise ValueError("the horizon is at least one day")
    leads = [F.lead(value, n).over(by_cell()) for n in range(1, horizon + 1)]
    return {
        fixed.TARGET: F.coalesce((reduce(add, leads) > 0).cast("int"), F.lit(0)),
        "target_available": leads[-1].isNotNull().cast("int"),
    }


def feat_lags(df: DataFrame) -> DataFrame:
    return df.withColumns(lag_columns())


def feat_rolling(df: DataFrame) -> DataFrame:
    return df.withColumns(rolling_columns())


def target_forward(df: DataFrame, horizon: int = 1) -> DataFrame:
    return df.withColumn(fixed.TARGET, target_columns(horizon)[fixed.TARGET])


def target_available(df: DataFrame, horizon: int = 1) -> DataFrame:
    return df.withColumn("target_available", target_columns(horizon)["target_available"])


def build_cell_days(
    cell_incidents: DataFrame,
    weather: DataFrame,
    horizon: int = 1,
    country: str = "US",
    calendar_days: DataFrame | None = None,
    days: Column | None = None,
) -> DataFrame:
    """Incidents with grid_id and date -> the full cell-day table (19 columns).

    All history and target columns share one window, hence one sort, on top of densify's partitioning.
    Weather comes in after them: it is a lookup by day and must not widen the rows that are sorted.
    """
    days = scalar(day_range(cell_incidents)) if days is None else days
    dense = densify_cell_day(count_cell_day(cell_incidents), days)
    history = dense.select("*", *[c.alias(n) for n, c in {**lag_columns(), **rolling_columns(), **target_columns(horizon)}.items()])
    full = join_holidays(feat_calendar(join_weather(history, weather)), country, calendar_days)
    return full.select("grid_id", "date", "incident_count", *fixed.WEATHER_METRICS, "day_of_week", "month", "season",
                       "is_weekend", "is_holiday", *lag_columns(), *rolling_columns(), fixed.TARGET, "target_available")


def known_targets(cell_days: DataFrame) -> DataFrame:
    """The model table: only rows whose target lies inside the data."""
    return cell_days.filter("target_available = 1").drop("target_available")
