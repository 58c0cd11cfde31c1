"""Files in and out: CSV, parquet, GeoJSON points, the daily weather response, result tables."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import PurePosixPath

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from cellcast import fixed
from cellcast.session import staged

GEOMETRY = "struct<type:string,coordinates:array<double>>"


ODD_RANGES = 100_000  # up to so many (file, offset) pairs, some 20 MB, are broadcast


def read_table(spark: SparkSession, path: str, multi_line: bool | None = None, **geojson_options) -> DataFrame:
    """Reader by suffix. CSV values stay text until they are coerced, so no inference pass is spent.

    A quoted CSV value may hold line breaks, and the file is split all the same, see ``read_csv``. ``multi_line=False`` saves the
    scan for quotes where no value has a break; ``multi_line=True`` gives each file to one task.
    """
    suffix = PurePosixPath(path).suffix.lower()
    if suffix in (".csv", ".txt"):
        return read_csv(spark, path) if multi_line is None else _csv(spark, path, multi_line)
    if suffix == ".parquet":
        return spark.read.parquet(path)
    if suffix in (".geojson", ".json", ".geojsonl"):
        return read_geojson_points(spark, path, lines=suffix == ".geojsonl", **geojson_options)
    raise ValueError(f"unsupported file type {suffix!r}")


def _csv(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    return spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line).csv(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, split into byte ranges although quoted values may hold line breaks. All columns are text.

    A line break ends a record if the quotes before it are even in number. So each range's quotes are counted (one row a range),
    running sums tell which ranges begin within a value, and each range joins its own lines into records. What begins
    in one range and ends in a later one is put together from its pieces, at most two a range. Files in which no line has an
    odd number of quotes are left to Spark's own reader. Quotes must be paired: where a file has an odd number
    (a bare inch sign, say) no running sum can be trusted, and each file is read by one task.
    """
    # Only \n ends a line here: whatever else is between stands in the line as it is.
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))
    marks = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    ranges = staged(lines.groupBy("file", "start").agg(F.sum(marks).alias("marks"), F.count_if(marks % 2 == 1).alias("odd")), "csv-ranges")
    if ranges.filter("odd > 0").isEmpty():
        return _csv(spark, path, False)
    if not ranges.groupBy("file").agg(F.sum("marks").alias("marks")).filter("marks % 2 = 1").isEmpty():
        return _csv(spark, path, True)
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = ranges.withColumn("before", F.sum("marks").over(earlier)).filter("before % 2 = 1")
    inside = staged(inside.select("file", "start", F.lit(True).alias("inside")), "csv-ranges")
    if inside.count() <= ODD_RANGES:
        told = lines.join(F.broadcast(inside), ["file", "start"], "left")
    else:
        told = lines.withColumn("_at", F.monotonically_increasing_id()).join(inside, ["file", "start"], "left")
        told = told.repartition("file", "start").sortWithinPartitions("file", "start", "_at")
    pieces = told.select("file", "start", F.coalesce("inside", F.lit(False)), "line").mapInArrow(
        _records, "file string, start bigint, part int, text string")
    cut = pieces.filter(F.col("part") != WHOLE)
    begun = F.sum((F.col("part") == BEGINNING).cast("int")).over(Window.partitionBy("file").orderBy("start", "part"))
    cut = cut.withColumn("record", begun).groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("start", "part", "text"))).alias("pieces"))
    records = pieces.filter(F.col("part") == WHOLE).select("text").unionByName(cut.select(F.array_join("pieces.text", "\n").alias("text")))
    names = ", ".join("`{}` string".format(n.replace("`", "``")) for n in _csv(spark, path, True).columns)
    parsed = F.from_csv("text", names, {"escape": '"'})
    return records.filter(F.trim("text") != "").select(parsed.alias("r")).select("r.*")


# Pieces of records in a range: the end of an earlier one's, a whole one, a beginning, a range within one record.
END, WHOLE, BEGINNING, MIDDLE = range(4)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines in order -> records. A file's first record is its header and is left out."""
    here, inside, begun, header = None, False, True, False
    lines: list[str] = []
    out: list[tuple] = []

    def close(part: int) -> None:
        out.append((*here, part, "\n".join(lines)))
        lines.clear()

    for batch in batches:
        for file, start, odd, line in zip(*(column.to_pylist() for column in batch.columns)):
            if (file, start) != here:
                if lines:
                    close(BEGINNING if begun else MIDDLE)
                here, inside, begun, header = (file, start), odd, not odd, start == 0
            lines.append(line.removesuffix("\r"))
            inside ^= line.count('"') % 2 == 1
            if not inside:
                if header:
                    lines.clear()
                else:
                    close(WHOLE if begun else END)
                begun, header = True, False
        yield _as_batch(out)
        out.clear()
    if lines:
        close(BEGINNING if begun else MIDDLE)
    yield _as_batch(out)


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    files, starts, parts, texts = zip(*rows) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(files, pa.string()), pa.array(starts, pa.int64()), pa.array(parts, pa.int32()), pa.array(texts, pa.string())],
        names=["file", "start", "part", "text"])


def read_geojson_points(spark: SparkSession, path: str, properties: str | None = None, lines: bool = False) -> DataFrame:
    """Point features -> property columns, geometry, longitude, latitude.

    ``properties`` is a column list such as "INC_NO: string, Score: double"; it saves the inference pass. ``lines`` reads one
    feature per line, the splittable layout to use for anything large; it also accepts a collection
    written with one feature per line. A collection on one line is one JSON document, read by one task.
    """
    feature = f"type string, properties struct<{properties}>, geometry {GEOMETRY}" if properties else None
    if lines:
        features = _feature_lines(spark, path, feature)
    else:
        reader = spark.read.option("multiLine", True)
        if feature:
            reader = reader.schema(f"type string, features array<struct<{feature}>>")
        document = reader.json(path)
        if "features" not in document.columns:
            raise ValueError("not a GeoJSON feature collection")
        features = document.select(F.explode("features").alias("f"))
    point = F.col("f.geometry.coordinates")
    return features.select(
        "f.properties.*", F.col("f.geometry").alias("geometry"),
        F.get(point, 0).cast("double").alias("longitude"), F.get(point, 1).cast("double").alias("latitude"),
    )


def _feature_lines(spark: SparkSession, path: str, feature: str | None) -> DataFrame:
    """One struct ``f`` for each line with a feature; a line that is neither a feature nor part of a collection's frame fails.

    A line is parsed as one value, so the outcome does not depend on the columns that are read later.
    """
    line = F.rtrim(F.trim(F.col("value"), F.lit(" \t\r\ufeff")), F.lit(", \t\r"))
    lines = spark.read.text(path).select(line.alias("line"))
    # The frame: the collection's opening (its own members, up to the feature list) and its closing.
    opening = r'^\{?\s*("type"\s*:\s*"FeatureCollection".*|"(name|crs|features|bbox)"\s*:.*)?\[?$'
    frame = F.col("line").rlike(r"^[\[\]{}]*$") | (F.col("line").rlike(opening) & ~F.col("line").rlike(r'"type"\s*:\s*"Feature"'))
    rows = lines.filter(~frame)
    # Without given properties the schema is inferred; a line that does not fit it still fails below.
    kind = feature or spark.read.option("mode", "DROPMALFORMED").json(path).schema
    parsed = rows.select(F.from_json("line", kind, {"mode": "FAILFAST"}).alias("f"))
    is_feature = F.when(F.col("f.type") == "Feature", True).otherwise(F.raise_error(F.lit("a line is not a GeoJSON feature")).cast("boolean"))
    return parsed.filter(is_feature)


def read_columnar_weather(spark: SparkSession, path: str) -> DataFrame:
    """Weather response whose ``daily`` object holds parallel arrays -> one row per day."""
    document = spark.read.option("multiLine", True).json(path)
    if "daily" not in document.columns:
        raise ValueError("the weather response has no daily object")
    names = fixed.WEATHER_RESPONSE_FIELDS
    zipped = F.arrays_zip(*[F.col(f"daily.{c}").alias(c) for c in names])
    return document.select(F.inline(zipped)).select(*[F.col(c).alias(name) for c, name in names.items()])


def extract_predicate(df: DataFrame, state: str, city: str) -> DataFrame:
    """The extract's server-side filter and projection: plain comparisons on raw columns, so all of it
    is pushed to the scan. Type codes compare as text."""
    kind = F.col("INC_TYPE")
    keep = (
        (F.col("STATE_ID") == state) & (F.col("CITY") == city) & F.col("AID").isin(fixed.EXTRACT_AID_CODES)
        & (kind >= fixed.EXTRACT_TYPE_FROM) & (kind < fixed.EXTRACT_TYPE_BELOW)
    )
    extra = [c for c in ("geometry", "OBJECTID") if c in df.columns]
    out = df.filter(keep).select(*fixed.EXTRACT_FIELDS, *extra)
    return out.orderBy("OBJECTID") if "OBJECTID" in extra else out


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write and read back. With partition columns, rows are first gathered by them (AQE splits the
    large groups), so that a partition does not get one small file from every task."""
    if partition_by:
        df.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(path)
    else:
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def geojson_feature(ring: Column, *properties: str) -> Column:
    """One GeoJSON polygon feature as text."""
    pairs = F.transform(ring, lambda p: F.array(p["lon"], p["lat"]))
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(pairs).alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), geometry.alias("geometry")))


def write_grid_geojson(cells: DataFrame, path: str) -> None:
    """Cells as newline-delimited GeoJSON features, written in parallel."""
    cells.select(geojson_feature(F.col("ring"), "grid_id", "cell_row", "cell_col").alias("value")).write.text(path)


def read_grid_geojson(spark: SparkSession, path: str) -> DataFrame:
    schema = ("type string, properties struct<grid_id:string,cell_row:int,cell_col:int>, "
              "geometry struct<type:string,coordinates:array<array<array<double>>>>")
    outer = F.get("geometry.coordinates", F.lit(0))
    ring = F.transform(outer, lambda p: F.struct(F.get(p, 0).alias("lon"), F.get(p, 1).alias("lat")))
    return spark.read.schema(schema).json(path).select("properties.*", ring.alias("ring"))


def write_csv_results(df: DataFrame, path: str) -> None:
    """Result rows as CSV with a header and ISO dates."""
    dated = [F.date_format(c, "yyyy-MM-dd").alias(c) if t == "date" else F.col(c) for c, t in df.dtypes]
    df.select(*dated).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("escape", '"').csv(path)


def read_csv_results(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Result rows with their types back."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').option("dateFormat", "yyyy-MM-dd").csv(path)
