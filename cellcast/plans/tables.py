"""Raw incidents and weather -> clean incidents, grid, cell-day table, model table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from cellcast.operators import clean, daily, grid
from cellcast.session import staged


@dataclass
class Frame:
    """Where the data lies: lazily computed scalars shared by all later steps.

    ``bounds`` holds the UTM zone and the first and last day, from one scan; the metre extent needs the
    zone and so a second one.
    """

    bounds: Column
    extent_row: DataFrame

    @property
    def extent(self) -> Column:
        return grid.scalar(self.extent_row)


def frame_of(incidents: DataFrame, size: float = 1000.0) -> Frame:
    """Bounds do not change with repeated rows, so ``incidents`` may be the rows before de-duplication:
    then the bounds cost narrow scans and no shuffle."""
    bounds = grid.scalar(grid.utm_frame(incidents, first=F.min("date"), last=F.max("date")))
    return Frame(bounds, grid.spatial_extent(grid.project_utm(incidents, bounds), size))


def place(incidents: DataFrame, frame: Frame, size: float = 1000.0) -> DataFrame:
    """Add cell_col, cell_row, grid_id to clean incidents."""
    return grid.assign_grid_cell(grid.project_utm(incidents, frame.bounds), size, frame.extent)


def located_incidents(raw: DataFrame, size: float = 1000.0, only: list[str] | None = None, **options) -> tuple[DataFrame, Frame]:
    """Clean incidents in their cells. With ``only``, the raw rows are parsed once: these columns of the valid rows (and what
    identifies and places them) are written to the shared folder when called, and bounds, extent and rows are read from there."""
    if clean.ROW_ID not in raw.columns:
        raw = clean.with_row_id(raw)
    valid = clean.valid_incidents(raw, **options)
    if only is not None:
        needed = [*clean.identity_columns(valid.columns), "date", "latitude", "longitude", clean.ROW_ID, *only]
        valid = staged(valid.select(*dict.fromkeys(needed)), "valid-incidents")
    frame = frame_of(valid, size)
    return place(clean.dedupe_incidents(valid), frame, size), frame


def grid_cells(frame: Frame, size: float = 1000.0) -> DataFrame:
    return grid.unproject_cells(grid.generate_grid(frame.extent_row, size), frame.bounds)


def cell_day_table(raw: DataFrame, weather_raw: DataFrame, size: float = 1000.0, horizon: int = 1,
                   country: str = "US", weather_columns: dict | None = None, calendar_days: DataFrame | None = None,
                   **options) -> DataFrame:
    """``calendar_days`` (date) replaces the country's holiday rules. The raw incidents are read once, when called."""
    incidents, frame = located_incidents(raw, size, only=[], **options)
    weather = clean.clean_weather(clean.standardize_weather(weather_raw, **(weather_columns or {})))
    return daily.build_cell_days(incidents, weather, horizon, country, calendar_days, frame.bounds)


def model_table(raw: DataFrame, weather_raw: DataFrame, **options) -> DataFrame:
    return daily.known_targets(cell_day_table(raw, weather_raw, **options))


@dataclass
class Tables:
    incidents: DataFrame
    cells: DataFrame
    cell_days: DataFrame
    model: DataFrame


def build_tables(raw: DataFrame, weather_raw: DataFrame, out: str, size: float = 1000.0, horizon: int = 1,
                 country: str = "US", weather_columns: dict | None = None, calendar_days: DataFrame | None = None,
                 **options) -> Tables:
    """The batch job: every product is written once and the next step reads it back, so the raw input
    is scanned once for the rows and once for the bounds, whatever comes after."""
    from cellcast.sources import tables as sink

    spark = raw.sparkSession
    if clean.ROW_ID not in raw.columns:
        raw = clean.with_row_id(raw)
    deduped = clean.clean_incidents(raw, **options)
    kept = sink.write_parquet(deduped, f"{out}/incidents_valid.parquet")
    frame = frame_of(kept, size)
    placed = place(kept, frame, size).drop("x", "y", clean.ROW_ID)
    incidents = sink.write_parquet(placed, f"{out}/incidents_clean.parquet")
    cells = grid_cells(frame, size)
    sink.write_grid_geojson(cells, f"{out}/grid_cells.geojsonl")
    weather = clean.clean_weather(clean.standardize_weather(weather_raw, **(weather_columns or {})))
    days = daily.build_cell_days(incidents, weather, horizon, country, calendar_days, frame.bounds)
    by_month = days.withColumn("part_month", F.trunc("date", "month"))
    sink.write_parquet(by_month, f"{out}/cell_day_table.parquet", ["part_month"])
    cell_days = spark.read.schema(by_month.schema).parquet(f"{out}/cell_day_table.parquet").drop("part_month")
    model = sink.write_parquet(daily.known_targets(cell_days), f"{out}/model_table.parquet")
    return Tables(incidents, cells, cell_days, model)
