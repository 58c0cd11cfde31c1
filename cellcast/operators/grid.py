"""The square metre grid: projection, extent, cells.

Extents travel as scalar subqueries: one struct computed once per query and then a constant inside the
generated code. Nothing is collected to the driver and no one-row join is planned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cellcast.functions import geo

BLOCK = 32  # cells a side of what one row unfolds to


def scalar(df: DataFrame) -> Column:
    """A one-row frame as one struct-valued scalar subquery."""
    return df.select(F.struct(*df.columns).alias("_row")).scalar()


def utm_frame(points: DataFrame, lon: str = "longitude", lat: str = "latitude", **more: Column) -> DataFrame:
    """One row: zone, central meridian and hemisphere at the centre of the data, and ``more`` aggregates
    that should come out of the same scan."""
    middle_lon = (F.min(lon) + F.max(lon)) / 2
    middle_lat = (F.min(lat) + F.max(lat)) / 2
    return points.agg(geo.utm_zone(middle_lon).alias("zone"), (middle_lat < 0).alias("south"),
                      *[c.alias(name) for name, c in more.items()]).withColumn(
        "meridian", geo.zone_meridian(F.col("zone"))
    )


def in_layers(df: DataFrame, layers: list[dict[str, Column]], keep: list[str]) -> DataFrame:
    for layer in layers:
        df = df.withColumns(layer)
    return df.select(*keep)


def project_utm(points: DataFrame, frame: Column | None = None, lon: str = "longitude", lat: str = "latitude") -> DataFrame:
    """Add x, y in metres; the zone is that of the data's centre unless a frame is given."""
    frame = scalar(utm_frame(points, lon, lat)) if frame is None else frame
    layers = geo.utm_layers(lon, lat, F.col("_utm.meridian"), F.col("_utm.south"))
    return in_layers(points.withColumn("_utm", frame), layers, [*points.columns, "x", "y"])


def spatial_extent(points: DataFrame, size: float = 1000.0) -> DataFrame:
    """One row: bounds of x, y and the number of grid rows and columns."""

    def count(span: Column) -> Column:
        return F.greatest(F.lit(1), F.ceil(span / size)).cast("int")

    bounds = points.agg(
        F.min("x").alias("minx"), F.min("y").alias("miny"), F.max("x").alias("maxx"), F.max("y").alias("maxy")
    )
    return bounds.withColumns(
        {"n_cols": count(F.col("maxx") - F.col("minx")), "n_rows": count(F.col("maxy") - F.col("miny"))}
    )


def cell_id(row: Column, col: Column) -> Column:
    return F.concat(F.lit("r"), row.cast("string"), F.lit("_c"), col.cast("string"))


def assign_grid_cell(points: DataFrame, size: float = 1000.0, extent: Column | None = None) -> DataFrame:
    """Add cell_col, cell_row and grid_id to projected points; the far edge belongs to the last cell."""
    extent = scalar(spatial_extent(points, size)) if extent is None else extent

    def index(value: str, low: str, n: str) -> Column:
        step = F.floor((F.col(value) - F.col(f"_ext.{low}")) / size)
        return F.least(F.greatest(step, F.lit(0)), F.col(f"_ext.{n}") - 1).cast("int")

    layers = [
        {"_ext": extent},
        {"cell_col": index("x", "minx", "n_cols"), "cell_row": index("y", "miny", "n_rows")},
        {"grid_id": cell_id(F.col("cell_row"), F.col("cell_col"))},
    ]
    return in_layers(points, layers, [*points.columns, "cell_col", "cell_row", "grid_id"])


def generate_grid(extent: DataFrame, size: float = 1000.0) -> DataFrame:
    """Every cell of the extent with its square, empty ones too.

    The extent is one row. It is cut into square blocks of ``BLOCK`` cells a side, which are spread over the cluster
    before each unfolds, so that a grid of one row or one column is as parallel as a square one.
    """

    def blocks(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.floor((F.col(n) - 1) / BLOCK).cast("int")))

    def inside(block: str, n: str) -> Column:
        first = F.col(block) * BLOCK
        return F.explode(F.sequence(first, F.least(first + (BLOCK - 1), F.col(n) - 1)))

    parts = int(extent.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    squares = extent.select("*", blocks("n_rows").alias("block_row")).select("*", blocks("n_cols").alias("block_col"))
    cells = squares.repartition(parts, "block_row", "block_col").select("*", inside("block_row", "n_rows").alias("cell_row"))
    cells = cells.select("*", inside("block_col", "n_cols").alias("cell_col"))
    x0, y0 = F.col("minx") + F.col("cell_col") * size, F.col("miny") + F.col("cell_row") * size
    return cells.select(
        cell_id(F.col("cell_row"), F.col("cell_col")).alias("grid_id"), "cell_row", "cell_col",
        x0.alias("x0"), y0.alias("y0"), (x0 + size).alias("x1"), (y0 + size).alias("y1"),
    )


def unproject_cells(cells: DataFrame, frame: Column) -> DataFrame:
    """Replace the metre square by a closed WGS84 ring, counter-clockwise from the lower right corner."""

    corners = {"se": ("x1", "y0"), "ne": ("x1", "y1"), "nw": ("x0", "y1"), "sw": ("x0", "y0")}
    layers = [{"_utm": frame}, *geo.wgs84_layers(corners, F.col("_utm.meridian"), F.col("_utm.south"))]
    vertices = [F.struct(F.col(f"lon_{k}").alias("lon"), F.col(f"lat_{k}").alias("lat")) for k in [*corners, "se"]]
    kept = [c for c in cells.columns if c not in ("x0", "y0", "x1", "y1")]
    return in_layers(cells, [*layers, {"ring": F.array(*vertices)}], [*kept, "ring"])


def cell_centroids(cells: DataFrame) -> DataFrame:
    lon, lat = geo.ring_centroid(F.col("ring"))
    return cells.select("grid_id", "cell_row", "cell_col", lat.alias("lat_center"), lon.alias("lon_center"))


def grid_center(cells: DataFrame) -> DataFrame:
    """One row: the middle of the bounding box of all ring vertices."""
    per_cell = cells.select(
        F.array_min("ring.lat").alias("lat0"), F.array_max("ring.lat").alias("lat1"),
        F.array_min("ring.lon").alias("lon0"), F.array_max("ring.lon").alias("lon1"),
    )
    return per_cell.agg(
        ((F.min("lat0") + F.max("lat1")) / 2).alias("lat"), ((F.min("lon0") + F.max("lon1")) / 2).alias("lon")
    )
