"""Every query of the engine over the driver tables, with the SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from cellcast import fixed
from cellcast.operators import aggregates, arima, clean, daily, evaluate, explain, forest, grid, hotspot, sampling, shapley, split
from cellcast.operators import views as read_views
from cellcast.plans import scoring, tables
from cellcast.session import shared_dir, staged
from cellcast.sources import tables as files
from checks import views
from checks.sql import cte, label_sql, r6, with_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded so that the last bits of two engines do not matter."""
    return df.select(*[
        (F.round(f"`{c}`", digits) + F.lit(0.0)).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes
    ])


def query(name: str, sql: str | None = None, digits: int = 6):
    def add(build):
        QUERIES[name] = lambda spark, sf_dir: tidy(build(spark, sf_dir), digits)
        if sql is not None:
            ORACLES[name] = with_ctes(sql)
        return build

    return add


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{uuid.uuid4().hex}-{name}"


def raw(spark, d):
    return views.kept(spark, d, "incidents")


def model(spark, d):
    return views.kept(spark, d, "model")


def scored(spark, d):
    return views.kept(spark, d, "scored")


def train_test(spark, d):
    return scoring.split_model_table(model(spark, d))


def valid(spark, d):
    return clean.valid_incidents(raw(spark, d), **views.CITY)


def located(spark, d):
    return views.kept(spark, d, "located")


RAW = ["row_id", "city", "state_id", "fdid", "inc_no", "inc_date", "latitude", "longitude", "inc_type"]
RAW_SQL = ", ".join(RAW)

# --- sources and sinks -------------------------------------------------------------------


@query("src_read_table", "SELECT CAST(row_id AS VARCHAR) AS row_id, city, state_id, fdid, CAST(inc_no AS VARCHAR) AS inc_no, inc_date, latitude, longitude, inc_type FROM raw_incidents")
def src_read_table(spark, d):
    path = new_path(spark, "incidents.csv")
    files.write_csv_results(raw(spark, d).select(*RAW), path)
    return files.read_table(spark, path)


@query("src_geojson_points", "SELECT inc_no, fdid, inc_type, round(longitude, 6) AS longitude, round(latitude, 6) AS latitude FROM valid")
def src_geojson_points(spark, d):
    path = new_path(spark, "incidents.geojsonl")
    point = F.struct(F.lit("Point").alias("type"), F.array("longitude", "latitude").alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct("inc_no", "fdid", "inc_type").alias("properties"), point.alias("geometry"))
    rows = clean.filter_valid_coords(typed(spark, d))
    rows.select(F.to_json(feature).alias("value")).write.text(path)
    return files.read_table(spark, path, properties="inc_no:bigint,fdid:string,inc_type:string").drop("geometry")


@query("src_columnar_json", f"SELECT CAST(date AS VARCHAR) AS date, {', '.join(r6(m, m) for m in fixed.WEATHER_METRICS)} FROM weather")
def src_columnar_json(spark, d):
    path = new_path(spark, "weather.json")
    days = clean.clean_weather(views.kept(spark, d, "weather"))
    # One array entry per calendar day, as the archive answers.
    ordered = days.agg(F.array_sort(F.collect_list(F.struct("date", *fixed.WEATHER_METRICS))).alias("days"))
    arrays = [F.col(f"days.{name}").alias(field) for field, name in fixed.WEATHER_RESPONSE_FIELDS.items()]
    ordered.select(F.to_json(F.struct(F.struct(*arrays).alias("daily"))).alias("value")).write.text(path)
    return files.read_columnar_weather(spark, path)


@query("src_extract_predicate", r"""
SELECT 'K' || row_id AS "INCIDENT_KEY", fdid AS "FDID", inc_date AS "INC_DATE", CAST(inc_no AS VARCHAR) AS "INC_NO", left(inc_type, 3) AS "INC_TYPE",
  CASE row_id % 4 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '3' ELSE 'N' END AS "AID", 21 AS n_fields
FROM raw_incidents WHERE lower(trim(city)) = 'atlanta' AND row_id % 4 <> 2 AND left(inc_type, 3) >= '100' AND left(inc_type, 3) < '200'
""")
def src_extract_predicate(spark, d):
    out = files.extract_predicate(views.extract_source(spark, d), "GA", "Atlanta")
    fields = len([c for c in out.columns if c != "OBJECTID"])
    return out.select("INCIDENT_KEY", "FDID", "INC_DATE", "INC_NO", "INC_TYPE", "AID", F.lit(fields).alias("n_fields"))


@query("sink_parquet", "SELECT * FROM cell_days")
def sink_parquet(spark, d):
    days = tables.cell_day_table(raw(spark, d), views.kept(spark, d, "weather"), **views.CITY)
    monthly = days.withColumn("part_month", F.trunc("date", "month"))
    return files.write_parquet(monthly, new_path(spark, "cell_day_table.parquet"), ["part_month"]).drop("part_month")


@query("sink_grid_geojson", f"SELECT grid_id, cell_row, cell_col, CAST(k AS INTEGER) AS k, {r6('lon', 'lon')}, {r6('lat', 'lat')} FROM vertices")
def sink_grid_geojson(spark, d):
    path = new_path(spark, "grid_cells.geojsonl")
    files.write_grid_geojson(views.cells(spark, d), path)
    back = files.read_grid_geojson(spark, path)
    return back.select("grid_id", "cell_row", "cell_col", F.posexplode("ring").alias("k", "v")).select("grid_id", "cell_row", "cell_col", "k", "v.*")


@query("sink_csv_results", "SELECT grid_id, CAST(date AS VARCHAR) AS date, CAST(incident_count AS VARCHAR) AS incident_count, season, CAST(rf_pred AS VARCHAR) AS rf_pred FROM scored")
def sink_csv_results(spark, d):
    path = new_path(spark, "model_results.csv")
    files.write_csv_results(scored(spark, d), path)
    return files.read_table(spark, path).select("grid_id", "date", "incident_count", "season", "rf_pred")


@query("src_csv_results", "SELECT grid_id, date, incident_count, season, temperature, hotspot_prob, hotspot_pred, arima_forecast, arima_prob, arima_pred, rf_prob, rf_pred, target_next_interval FROM scored")
def src_csv_results(spark, d):
    path = new_path(spark, "model_results.csv")
    rows = scored(spark, d)
    files.write_csv_results(rows, path)
    return files.read_csv_results(spark, path, rows.schema).select(
        "grid_id", "date", "incident_count", "season", "temperature", "hotspot_prob", "hotspot_pred", "arima_forecast",
        "arima_prob", "arima_pred", "rf_prob", "rf_pred", "target_next_interval")


# --- schema resolution and cleaning ------------------------------------------------------


@query("standardize_incidents", "SELECT row_id, city, state_id, fdid, inc_date AS date, latitude AS lat, longitude AS lon, inc_type AS type FROM raw_incidents")
def standardize_incidents(spark, d):
    return clean.standardize_incidents(raw(spark, d), keep=["row_id"])


@query("standardize_weather", "SELECT date, temperature, humidity, precipitation, wind FROM raw_weather")
def standardize_weather(spark, d):
    odd = {"date": "Observation Date", "temperature": "TAVG", "humidity": "Relative Humidity", "precipitation": "prcp_mm", "wind": "AWND"}
    return clean.standardize_weather(views.kept(spark, d, "weather").withColumnsRenamed(odd))


@query("filter_field_values", f"SELECT {RAW_SQL} FROM raw_incidents WHERE lower(trim(city)) = 'atlanta' AND lower(trim(fdid)) = '1007'")
def filter_field_values(spark, d):
    return clean.filter_field_values(raw(spark, d), ["city", "fdid"], [" atlanta", "1007"]).select(*RAW)


@query("coerce_coordinates", f"SELECT row_id, {r6('TRY_CAST(latitude AS DOUBLE)', 'latitude')}, {r6('TRY_CAST(longitude AS DOUBLE)', 'longitude')} FROM raw_incidents")
def coerce_coordinates(spark, d):
    return clean.coerce_coordinates(raw(spark, d), "latitude", "longitude").select("row_id", "latitude", "longitude")


@query("coerce_event_date", "SELECT row_id, CAST(try_strptime(inc_date, '%Y-%m-%d %H:%M:%S') AS DATE) AS date FROM raw_incidents")
def coerce_event_date(spark, d):
    return clean.coerce_event_date(raw(spark, d), "inc_date").select("row_id", "date")


def typed(spark, d):
    chosen = clean.filter_field_values(raw(spark, d), ["city"], ["Atlanta"])
    return clean.coerce_event_date(clean.coerce_coordinates(chosen, "latitude", "longitude"), "inc_date")


@query("reject_counts", f"""
SELECT reason, count(row_id) AS n FROM (VALUES {', '.join(f"('{r}')" for r in [*fixed.REJECT_REASONS, 'kept'])}) AS reasons(reason) LEFT JOIN (
  SELECT row_id, CASE WHEN lower(trim(city)) <> 'atlanta' THEN 'other place' WHEN date IS NULL THEN 'no date'
    WHEN lat IS NULL OR lon IS NULL THEN 'no coordinates' WHEN abs(lat) > 90 OR abs(lon) > 180 THEN 'coordinates out of range'
    WHEN row_id NOT IN (SELECT row_id FROM fires) THEN 'not a fire' ELSE 'kept' END AS reason
  FROM (SELECT row_id, city, TRY_CAST(latitude AS DOUBLE) AS lat, TRY_CAST(longitude AS DOUBLE) AS lon,
          try_strptime(inc_date, '%Y-%m-%d %H:%M:%S') AS date FROM raw_incidents)) USING (reason) GROUP BY reason
""")
def reject_counts(spark, d):
    return clean.reject_counts(raw(spark, d), **views.CITY)


# Every raw stamp in other spellings: an offset, epoch milliseconds as a number and as text, long forms.
@query("event_date_spellings", r"""
SELECT event_id AS row_id, kind, CASE WHEN event_id % 101 <> 0 THEN CAST(ts AS DATE) END AS day
FROM events, (VALUES ('epoch'), ('epoch_text'), ('long'), ('month_first'), ('offset')) AS kinds(kind)
""")
def event_date_spellings(spark, d):
    stamp = F.col("ts").cast("timestamp")
    known = views.table(spark, d, "events").select(F.col("event_id").alias("row_id"), F.when(F.col("event_id") % 101 != 0, stamp).alias("ts"))
    rows = known.select(
        "row_id", F.unix_millis("ts").alias("epoch"), F.unix_millis("ts").cast("string").alias("epoch_text"), F.date_format("ts", "d MMM yyyy H:mm").alias("long"),
        F.date_format("ts", "MMMM d, yyyy").alias("month_first"), F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05:00")).alias("offset"))
    kinds = [c for c in rows.columns if c != "row_id"]
    days = [clean.coerce_event_date(rows, c).select("row_id", F.lit(c).alias("kind"), F.col("date").alias("day")) for c in kinds]
    return reduce(DataFrame.unionByName, days)


@query("filter_valid_coords", f"SELECT row_id, date, {r6('latitude', 'latitude')}, {r6('longitude', 'longitude')} FROM valid")
def filter_valid_coords(spark, d):
    return clean.filter_valid_coords(typed(spark, d)).select("row_id", "date", "latitude", "longitude")


@query("filter_fire_types", "SELECT row_id, inc_type FROM fires")
def filter_fire_types(spark, d):
    return clean.filter_fire_types(clean.filter_valid_coords(typed(spark, d)), "inc_type").select("row_id", "inc_type")


CLEAN_SQL = f"SELECT row_id, city, state_id, fdid, inc_no, inc_date, inc_type, date, {r6('latitude', 'latitude')}, {r6('longitude', 'longitude')} FROM clean_inc"


@query("dedupe_incidents", CLEAN_SQL)
def dedupe_incidents(spark, d):
    return clean.dedupe_incidents(valid(spark, d)).drop(clean.ROW_ID)


@query("clean_weather", f"SELECT date, {', '.join(r6(m, m) for m in fixed.WEATHER_METRICS)} FROM weather")
def clean_weather(spark, d):
    return clean.clean_weather(views.kept(spark, d, "weather"))


@query("fill_features", "SELECT grid_id, date, " + ", ".join(f"coalesce({f}, 0) AS {f}" for f in fixed.FEATURES) + " FROM model")
def fill_features(spark, d):
    return clean.fill_features(model(spark, d)).select("grid_id", "date", *fixed.FEATURES)


@query("clean_incidents", CLEAN_SQL)
def clean_incidents(spark, d):
    return clean.clean_incidents(raw(spark, d), **views.CITY).drop(clean.ROW_ID)


# --- grid --------------------------------------------------------------------------------


def projected(spark, d):
    rows = clean.clean_incidents(raw(spark, d), **views.CITY)
    return grid.project_utm(rows, grid.scalar(grid.utm_frame(valid(spark, d))))


@query("spatial_extent", "SELECT round(minx, 3) AS minx, round(miny, 3) AS miny, round(maxx, 3) AS maxx, round(maxy, 3) AS maxy, n_cols, n_rows FROM extent", 3)
def spatial_extent(spark, d):
    return grid.spatial_extent(projected(spark, d))


@query("project_utm", "SELECT row_id, round(x, 3) AS x, round(y, 3) AS y FROM projected", 3)
def project_utm(spark, d):
    return projected(spark, d).select("row_id", "x", "y")


@query("assign_grid_cell", "SELECT row_id, cell_col, cell_row, grid_id FROM placed")
def assign_grid_cell(spark, d):
    return grid.assign_grid_cell(projected(spark, d)).select("row_id", "cell_col", "cell_row", "grid_id")


@query("generate_grid", "SELECT grid_id, cell_row, cell_col, round(x0, 3) AS x0, round(y0, 3) AS y0, round(x1, 3) AS x1, round(y1, 3) AS y1 FROM squares", 3)
def generate_grid(spark, d):
    return grid.generate_grid(grid.spatial_extent(projected(spark, d)))


@query("unproject_cells", f"SELECT grid_id, CAST(k AS INTEGER) AS k, {r6('lon', 'lon')}, {r6('lat', 'lat')} FROM vertices")
def unproject_cells(spark, d):
    return views.cells(spark, d).select("grid_id", F.posexplode("ring").alias("k", "v")).select("grid_id", "k", "v.*")


@query("cell_centroids", f"SELECT grid_id, cell_row, cell_col, {r6('lat_center', 'lat_center')}, {r6('lon_center', 'lon_center')} FROM centroids")
def cell_centroids(spark, d):
    return grid.cell_centroids(views.cells(spark, d))


@query("grid_center", f"SELECT {r6('(min(lat) + max(lat)) / 2', 'lat')}, {r6('(min(lon) + max(lon)) / 2', 'lon')} FROM vertices")
def grid_center(spark, d):
    return grid.grid_center(views.cells(spark, d))


# --- densify, joins, lookups -------------------------------------------------------------


@query("date_spine", "SELECT date FROM spine")
def date_spine(spark, d):
    return daily.date_spine(located(spark, d))


@query("count_cell_day", "SELECT grid_id, date, incident_count FROM counts")
def count_cell_day(spark, d):
    return daily.count_cell_day(located(spark, d))


def dense(spark, d):
    rows = located(spark, d)
    return daily.densify_cell_day(daily.count_cell_day(rows), grid.scalar(daily.day_range(rows)))


@query("densify_cell_day", "SELECT grid_id, date, incident_count FROM dense")
def densify_cell_day(spark, d):
    return dense(spark, d)


@query("join_weather", f"SELECT grid_id, date, incident_count, {', '.join(r6(m, m) for m in fixed.WEATHER_METRICS)} FROM dense LEFT JOIN weather USING (date)")
def join_weather(spark, d):
    return daily.join_weather(dense(spark, d), clean.clean_weather(views.kept(spark, d, "weather")))


@query("join_holidays", """
SELECT o.o_orderkey, CAST(o.o_orderdate AS DATE) AS date, CAST(h.date IS NOT NULL AS INTEGER) AS is_holiday
FROM orders o LEFT JOIN holiday_dates h ON h.date = CAST(o.o_orderdate AS DATE)
""")
def join_holidays(spark, d):
    orders = views.table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))
    return daily.join_holidays(orders)


@query("split_temporal", "SELECT grid_id, date, split FROM split")
def split_temporal(spark, d):
    return split.split_temporal(model(spark, d)).select("grid_id", "date", "split")


@query("lookup_cell_score", f"SELECT t.grid_id, t.date, {r6('coalesce(h.score, 0)', 'hotspot_prob')} FROM test t LEFT JOIN hotspot h USING (grid_id)")
def lookup_cell_score(spark, d):
    _, test = train_test(spark, d)
    return split.lookup_cell_score(test, views.kept(spark, d, "hotspot"), "hotspot_prob").select("grid_id", "date", "hotspot_prob")


@query("encode_grid_id", """
SELECT t.grid_id, t.date, CAST(coalesce(c.code, -1) AS INTEGER) AS grid_id_enc FROM test t LEFT JOIN (
  SELECT grid_id, row_number() OVER (ORDER BY grid_id) - 1 AS code FROM (SELECT DISTINCT grid_id FROM train)) c USING (grid_id)
""")
def encode_grid_id(spark, d):
    train, test = train_test(spark, d)
    return split.encode_grid_id(test, split.cell_codes(train)).select("grid_id", "date", "grid_id_enc")


@query("lookup_forecast", """
SELECT t.grid_id, t.date, round(CASE WHEN a.grid_id IS NOT NULL THEN coalesce(f.forecast, 0) ELSE coalesce(r.rate, 0) END, 6) + 0.0 AS arima_forecast
FROM test t LEFT JOIN active a ON a.grid_id = t.grid_id LEFT JOIN rates r ON r.grid_id = t.grid_id
LEFT JOIN (SELECT m.grid_id, m.date, m.lag_7 / 2 AS forecast FROM test m JOIN active n ON n.grid_id = m.grid_id) f
  ON f.grid_id = t.grid_id AND f.date = t.date
""")
def lookup_forecast(spark, d):
    train, test = train_test(spark, d)
    cells = sampling.select_active_cells(aggregates.cell_activity(train))
    known = test.join(F.broadcast(cells.select("grid_id")), "grid_id")
    forecasts = known.select("grid_id", "date", (F.col("lag_7") / 2).alias("forecast"))
    return split.lookup_forecast(test, forecasts, aggregates.historical_rate(train)).select("grid_id", "date", "arima_forecast")


@query("stamp_cell_metric", """
SELECT c.grid_id, c.cell_row, c.cell_col, round_even(coalesce(s.score, 0), 4) AS risk
FROM centroids c LEFT JOIN (SELECT grid_id, avg(rf_prob) AS score FROM scored GROUP BY grid_id) s USING (grid_id)
""")
def stamp_cell_metric(spark, d):
    scores = aggregates.per_cell_metric(scored(spark, d), "rf_prob")
    return read_views.stamp_cell_metric(views.kept(spark, d, "centroids").select("grid_id", "cell_row", "cell_col"), scores)


@query("day_layer", """
SELECT c.grid_id, s.rf_prob AS value, s.rf_prob IS NULL AS no_data FROM centroids c
LEFT JOIN (SELECT * FROM scored WHERE date = (SELECT max(date) FROM scored)) s USING (grid_id)
""")
def day_layer(spark, d):
    rows = scored(spark, d)
    return read_views.day_layer(views.kept(spark, d, "centroids"), rows, "rf_prob", read_views.last_date(rows))


@query("actual_vs_predicted_day", """
SELECT c.grid_id, coalesce(s.target_next_interval, 0) AS actual, coalesce(s.rf_pred, 0) AS predicted FROM centroids c
LEFT JOIN (SELECT * FROM scored WHERE date = (SELECT max(date) FROM scored)) s USING (grid_id)
""")
def actual_vs_predicted_day(spark, d):
    rows = scored(spark, d)
    return read_views.actual_vs_predicted_day(views.kept(spark, d, "centroids"), rows, read_views.last_date(rows))


@query("nearest_date", """
SELECT row_id, date, nearest FROM (
  SELECT i.row_id, i.date, s.date AS nearest, row_number() OVER (PARTITION BY i.row_id ORDER BY abs(date_diff('day', s.date, i.date)), s.date) AS rn
  FROM clean_inc i CROSS JOIN (SELECT DISTINCT date FROM scored) s) WHERE rn = 1
""")
def nearest_date(spark, d):
    return read_views.nearest_date(located(spark, d).select("row_id", "date"), split.dates_of(scored(spark, d)))


SNAPSHOT_SQL = "\nUNION ALL\n".join(
    f"SELECT grid_id, date AS day, '{f}' AS field, " + ("CAST(date AS VARCHAR)" if f == "date" else f"printf('%.2f', CAST({f} AS DOUBLE))") + f" AS value FROM scored WHERE {f} IS NOT NULL"
    for f in fixed.SNAPSHOT_FIELDS)


@query("cell_snapshot", SNAPSHOT_SQL)
def cell_snapshot(spark, d):
    # Halves are rounded up here and to even by the other engine, so numbers go in with 6 digits.
    return read_views.cell_snapshot(tidy(scored(spark, d)))


@query("explanation_lookup", """
SELECT grid_id, date, position, explanation_text FROM (
  SELECT *, row_number() OVER (PARTITION BY grid_id, date ORDER BY position) AS rn FROM explanation_rows) WHERE rn = 1
""")
def explanation_lookup(spark, d):
    return read_views.explanation_lookup(views.explanations(spark, d))


@query("explanation_dates", "SELECT grid_id, string_agg(CAST(date AS VARCHAR), ',' ORDER BY date) AS dates FROM explanation_rows GROUP BY grid_id")
def explanation_dates(spark, d):
    found = read_views.explanation_dates(views.explanations(spark, d))
    return found.select("grid_id", F.array_join(F.col("dates").cast("array<string>"), ",").alias("dates"))


# --- aggregates --------------------------------------------------------------------------


@query("cell_totals", f"SELECT grid_id, incident_count, {r6('lat_center', 'lat_center')}, {r6('lon_center', 'lon_center')} FROM totals")
def cell_totals(spark, d):
    return aggregates.cell_totals(train_test(spark, d)[0], views.kept(spark, d, "centroids")).select("grid_id", "incident_count", "lat_center", "lon_center")


@query("cell_activity", "SELECT grid_id, nonzero_days, total_incidents FROM activity")
def cell_activity(spark, d):
    return aggregates.cell_activity(train_test(spark, d)[0])


@query("historical_rate", f"SELECT grid_id, {r6('rate', 'rate')} FROM rates")
def historical_rate(spark, d):
    return aggregates.historical_rate(train_test(spark, d)[0])


@query("per_cell_metric", f"SELECT grid_id, {r6('avg(rf_prob)', 'mean')}, {r6('median(rf_prob)', 'median')}, {r6('max(rf_prob)', 'max')}, {r6('min(rf_prob)', 'min')}, {r6('sum(rf_prob)', 'sum')} FROM scored GROUP BY grid_id")
def per_cell_metric(spark, d):
    return aggregates.per_cell_metrics(scored(spark, d), "rf_prob", ["mean", "median", "max", "min", "sum"])


@query("normalize_minmax", f"SELECT grid_id, {r6('(rate - min(rate) OVER ()) / (max(rate) OVER () - min(rate) OVER () + 1e-12)', 'score')} FROM rates")
def normalize_minmax(spark, d):
    return aggregates.normalize_minmax(aggregates.historical_rate(train_test(spark, d)[0]), "rate", "score").select("grid_id", "score")


@query("normalize_max", f"SELECT grid_id, {r6('rate / (max(rate) OVER () + 1e-12)', 'score')} FROM rates")
def normalize_max(spark, d):
    return aggregates.normalize_max(aggregates.historical_rate(train_test(spark, d)[0]), "rate", "score").select("grid_id", "score")


@query("day_metric_extent", f"""
SELECT date, {r6('coalesce(min(temperature), 0)', 'lo')}, {r6('coalesce(CASE WHEN min(temperature) = max(temperature) THEN min(temperature) + 1e-9 ELSE max(temperature) END, 1)', 'hi')}, 'temperature' AS metric FROM model GROUP BY date
UNION ALL SELECT date, {r6('min(rolling_sum_14)')}, {r6('CASE WHEN min(rolling_sum_14) = max(rolling_sum_14) THEN min(rolling_sum_14) + 1e-9 ELSE max(rolling_sum_14) END')}, 'rolling_sum_14' FROM model GROUP BY date
""")
def day_metric_extent(spark, d):
    rows = model(spark, d)
    both = [aggregates.day_metric_extent(rows, m).withColumn("metric", F.lit(m)) for m in ("temperature", "rolling_sum_14")]
    return both[0].unionByName(both[1])


HISTOGRAM_SQL = """
WITH v AS (SELECT date, hotspot_prob AS v FROM scored WHERE hotspot_prob IS NOT NULL),
s AS (SELECT date, min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / 14 AS raw FROM v GROUP BY date HAVING count(*) >= 2),
e AS (SELECT *, floor(log10(CASE WHEN raw > 0 THEN raw END)) AS e FROM s),
f AS (SELECT *, CASE WHEN raw / 10 ** e >= sqrt(50) THEN 10 WHEN raw / 10 ** e >= sqrt(10) THEN 5 WHEN raw / 10 ** e >= sqrt(2) THEN 2 ELSE 1 END AS f FROM e),
k AS (SELECT date, lo, hi, unnest(range(CAST(floor(lo / (f * 10 ** e)) AS BIGINT) - 2, CAST(ceil(hi / (f * 10 ** e)) AS BIGINT) + 3)) AS k, e, f FROM f WHERE raw > 0),
c AS (SELECT date, lo, hi, CASE WHEN e < 0 THEN k / (10 ** (-e) / f) ELSE k * f * 10 ** e END AS cut FROM k),
inner_cuts AS (SELECT date, cut FROM c WHERE cut > lo AND cut < hi),
edges AS (SELECT date, lo AS x0 FROM s UNION ALL SELECT date, cut FROM inner_cuts),
bins AS (SELECT s.date, CAST(row_number() OVER (PARTITION BY s.date ORDER BY x0) - 1 AS INTEGER) AS bin, x0, coalesce(lead(x0) OVER (PARTITION BY s.date ORDER BY x0), hi) AS x1
  FROM edges JOIN s ON s.date = edges.date),
placed_values AS (SELECT v.date, v.v, count(i.cut) AS bin FROM (SELECT date, v, row_number() OVER () AS id FROM v) v LEFT JOIN inner_cuts i ON i.date = v.date AND i.cut <= v.v GROUP BY v.date, v.v, v.id)
SELECT b.date, b.bin, round(b.x0, 6) + 0.0 AS x0, round(b.x1, 6) + 0.0 AS x1, CAST(count(p.v) AS BIGINT) AS n
FROM bins b LEFT JOIN placed_values p ON p.date = b.date AND p.bin = b.bin GROUP BY b.date, b.bin, b.x0, b.x1
"""


@query("day_histogram", "SELECT * FROM (" + HISTOGRAM_SQL + ")")
def day_histogram(spark, d):
    return read_views.day_histogram(scored(spark, d), "hotspot_prob")


@query("day_summary", "SELECT date, count(*) AS cells, (SELECT count(DISTINCT date) FROM scored) AS dates, (SELECT count(*) FROM scored) AS rows FROM scored GROUP BY date")
def day_summary(spark, d):
    overall = grid.scalar(aggregates.table_summary(scored(spark, d)))
    return aggregates.day_summary(scored(spark, d)).withColumn("o", overall).select("date", "cells", "o.dates", "o.rows")


@query("target_summary", f"""
SELECT count(*) AS rows, CAST(sum(target_next_interval) AS BIGINT) AS positives, CAST(sum(CASE WHEN target_next_interval = 0 THEN 1 ELSE 0 END) AS BIGINT) AS negatives,
  {r6('avg(target_next_interval)', 'positive_share')}, {r6('1 - avg(target_next_interval)', 'negative_share')} FROM test
""")
def target_summary(spark, d):
    return aggregates.target_summary(train_test(spark, d)[1])


# --- windows -----------------------------------------------------------------------------


@query("feat_calendar", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS day_of_week, CAST(month(o_orderdate) AS INTEGER) AS month,
  CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'winter' WHEN month(o_orderdate) BETWEEN 3 AND 5 THEN 'spring' WHEN month(o_orderdate) BETWEEN 6 AND 8 THEN 'summer' ELSE 'fall' END AS season,
  CAST(isodow(o_orderdate) >= 6 AS INTEGER) AS is_weekend FROM orders
""")
def feat_calendar(spark, d):
    return daily.feat_calendar(views.table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date")))


@query("feat_lags", "SELECT grid_id, date, lag_1, lag_3, lag_7 FROM cell_days")
def feat_lags(spark, d):
    return daily.feat_lags(dense(spark, d)).drop("incident_count")


@query("feat_rolling", "SELECT grid_id, date, rolling_sum_7, rolling_sum_14 FROM cell_days")
def feat_rolling(spark, d):
    return daily.feat_rolling(dense(spark, d)).drop("incident_count")


@query("target_forward", """
SELECT grid_id, date, CAST(coalesce(lead(incident_count, 1) OVER w + lead(incident_count, 2) OVER w + lead(incident_count, 3) OVER w, 0) > 0 AS INTEGER) AS target_next_interval
FROM dense WINDOW w AS (PARTITION BY grid_id ORDER BY date)
""")
def target_forward(spark, d):
    return daily.target_forward(dense(spark, d), 3).drop("incident_count")


@query("target_available", """
SELECT grid_id, date, CAST(lead(incident_count, 3) OVER (PARTITION BY grid_id ORDER BY date) IS NOT NULL AS INTEGER) AS target_available FROM dense
""")
def target_available(spark, d):
    return daily.target_available(dense(spark, d), 3).drop("incident_count")


@query("cell_day_table", "SELECT * FROM cell_days")
def cell_day_table(spark, d):
    return tables.cell_day_table(raw(spark, d), views.kept(spark, d, "weather"), **views.CITY)


@query("model_table", "SELECT * FROM model")
def model_table(spark, d):
    return tables.model_table(raw(spark, d), views.kept(spark, d, "weather"), **views.CITY)


SERIES_SQL = "\nUNION ALL\n".join(
    f"SELECT grid_id, date, '{name}' AS series, {c} AS value FROM scored WHERE {c} IS NOT NULL" for c, name in fixed.SERIES_METRICS.items())


@query("cell_series", SERIES_SQL)
def cell_series(spark, d):
    return read_views.cell_series(scored(spark, d))


# --- sort, top-k, sampling ---------------------------------------------------------------


@query("select_active_cells", "SELECT grid_id, nonzero_days, total_incidents FROM activity WHERE nonzero_days >= 5 ORDER BY total_incidents DESC, grid_id LIMIT 50")
def select_active_cells(spark, d):
    return sampling.select_active_cells(aggregates.cell_activity(train_test(spark, d)[0]))


TOP_SQL = """
SELECT 'high' AS part, grid_id, date, rf_prob FROM (SELECT * FROM scored ORDER BY rf_prob DESC, date, grid_id LIMIT 50)
UNION ALL SELECT 'low', grid_id, date, rf_prob FROM (SELECT * FROM scored ORDER BY rf_prob, date, grid_id LIMIT 200)
"""


@query("topk_rows", TOP_SQL)
def topk_rows(spark, d):
    rows = scored(spark, d).select("grid_id", "date", "rf_prob")
    high = sampling.topk_rows(rows, "rf_prob", 50).withColumn("part", F.lit("high"))
    return high.unionByName(sampling.topk_rows(rows, "rf_prob", 200, largest=False).withColumn("part", F.lit("low")))


BAND_SQL = "SELECT grid_id, date, rf_prob FROM scored WHERE rf_prob BETWEEN (SELECT quantile_cont(rf_prob, 0.4) FROM scored) AND (SELECT quantile_cont(rf_prob, 0.6) FROM scored)"


@query("quantile_band", BAND_SQL)
def quantile_band(spark, d):
    return sampling.quantile_band(scored(spark, d), "rf_prob", 0.4, 0.6).select("grid_id", "date", "rf_prob")


@query("sample_n", "SELECT grid_id, date FROM scored ORDER BY md5('42|' || grid_id || '|' || CAST(date AS VARCHAR)), grid_id, date LIMIT 500")
def sample_n(spark, d):
    return sampling.sample_n(scored(spark, d), 500).select("grid_id", "date")


cte("strata", f"""
  SELECT 0 AS r, 'high' AS stratum, grid_id, date FROM (SELECT * FROM scored ORDER BY rf_prob DESC, date, grid_id LIMIT 50)
  UNION ALL SELECT 1, 'mid', grid_id, date FROM (SELECT * FROM ({BAND_SQL}) ORDER BY md5('42|' || grid_id || '|' || CAST(date AS VARCHAR)), grid_id, date LIMIT 25)
  UNION ALL SELECT 2, 'low', grid_id, date FROM (SELECT * FROM (SELECT * FROM scored ORDER BY rf_prob, date, grid_id LIMIT 200)
    ORDER BY md5('42|' || grid_id || '|' || CAST(date AS VARCHAR)), grid_id, date LIMIT 25)
""")


@query("select_explain_rows", """
SELECT grid_id, date, stratum, CAST(row_number() OVER (ORDER BY r, CASE WHEN r = 0 THEN -rf_prob END, CASE WHEN r > 0 THEN md5('42|' || grid_id || '|' || CAST(date AS VARCHAR)) END,
    CASE WHEN r = 0 THEN date END, grid_id, date) AS INTEGER) AS position
FROM (SELECT *, row_number() OVER (PARTITION BY grid_id, date ORDER BY r) AS n FROM strata JOIN scored USING (grid_id, date)) WHERE n = 1
""")
def select_explain_rows(spark, d):
    return sampling.select_explain_rows(scored(spark, d)).select("grid_id", "date", "stratum", "position")


@query("sample_dates", """
SELECT date FROM (SELECT date, row_number() OVER (ORDER BY date) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT date FROM model))
WHERE i IN (SELECT j * (n - 1) // 6 FROM range(0, 7) AS r(j))
""")
def sample_dates(spark, d):
    return sampling.sample_dates(model(spark, d), 7)


@query("topk_drivers", "SELECT grid_id, date, top_driver_1, top_driver_1_shap, top_driver_2, top_driver_2_shap, top_driver_3, top_driver_3_shap FROM drivers")
def topk_drivers(spark, d):
    names = [c for i in (1, 2, 3) for c in (f"top_driver_{i}", f"top_driver_{i}_shap")]
    return sampling.topk_drivers(views.contributions(spark, d)).select("grid_id", "date", *names)


# --- texts and reshapes ------------------------------------------------------------------


IMPORTANCE = "SELECT feature, avg(abs(shap)) AS mean_abs_shap FROM drivers_long GROUP BY feature"


@query("shap_summary", f"""
SELECT feature, {r6('mean_abs_shap', 'mean_abs_shap')}, CAST(row_number() OVER (ORDER BY mean_abs_shap DESC, feature) AS INTEGER) AS rank FROM ({IMPORTANCE})
""")
def shap_summary(spark, d):
    return shapley.shap_summary(views.contributions_long(spark, d))


@query("shap_waterfall", f"""
SELECT grid_id, date, CAST(0.25 AS DOUBLE) AS base_value, feature, {r6('shap', 'shap')}, {r6('2 * shap', 'value')},
  CAST(row_number() OVER w AS INTEGER) AS step, {r6('0.25 + sum(shap) OVER (w ROWS UNBOUNDED PRECEDING)', 'running')}
FROM drivers_long WINDOW w AS (PARTITION BY grid_id, date ORDER BY abs(shap) DESC, place)
""")
def shap_waterfall(spark, d):
    return shapley.shap_waterfall(views.contributions_long(spark, d))


@query("topk_importance", f"SELECT feature, {r6('mean_abs_shap', 'importance')} FROM ({IMPORTANCE}) ORDER BY mean_abs_shap DESC, feature LIMIT 10")
def topk_importance(spark, d):
    means = shapley.shap_summary(views.contributions_long(spark, d))
    return sampling.topk_importance(means.select("feature", F.col("mean_abs_shap").alias("importance")), 10)


@query("driver_label", f"SELECT grid_id, date, top_driver_1, {label_sql('top_driver_1')} AS label FROM drivers")
def driver_label(spark, d):
    rows = sampling.topk_drivers(views.contributions(spark, d))
    return rows.select("grid_id", "date", "top_driver_1", explain.driver_label(F.col("top_driver_1")).alias("label"))


@query("explanation_text", "SELECT grid_id, date, explanation_text FROM texts")
def explanation_text(spark, d):
    rows = explain.explanation_text(sampling.topk_drivers(views.contributions(spark, d)))
    return rows.select("grid_id", "date", "explanation_text")


@query("melt_metrics", "\nUNION ALL\n".join(
    f"SELECT \"Model\", '{m}' AS \"Metric\", {r6(chr(34) + m + chr(34), chr(34) + 'Score' + chr(34))} FROM evaluation" for m in fixed.CHART_METRICS))
def melt_metrics(spark, d):
    return evaluate.melt_metrics(evaluate.evaluate_models(scored(spark, d)))


# --- hotspot -----------------------------------------------------------------------------


@query("hotspot_kde", f"SELECT grid_id, {r6('score', 'score')} FROM hotspot")
def hotspot_kde(spark, d):
    return hotspot.hotspot_kde(train_test(spark, d)[0], views.kept(spark, d, "centroids"))


@query("best_f1_threshold", f"SELECT {r6('threshold', 'threshold')}, {r6('f1', 'f1')} FROM hotspot_limit")
def best_f1_threshold(spark, d):
    return hotspot.hotspot_threshold(train_test(spark, d)[0], views.kept(spark, d, "hotspot"))


@query("hotspot_predict", "SELECT grid_id, date, hotspot_prob, hotspot_pred FROM scored")
def hotspot_predict(spark, d):
    train, test = train_test(spark, d)
    scores = views.kept(spark, d, "hotspot")
    limit = hotspot.hotspot_threshold(train, scores).select("threshold").scalar()
    return hotspot.hotspot_predict(test, scores, limit).select("grid_id", "date", "hotspot_prob", "hotspot_pred")


@query("class_weights", f"""
SELECT target_next_interval, count(*) AS n, {r6('(SELECT count(*) FROM train) / CAST(2 * count(*) AS DOUBLE)', 'weight')} FROM train GROUP BY target_next_interval
""")
def class_weights(spark, d):
    return split.class_weights(train_test(spark, d)[0])


# --- evaluation --------------------------------------------------------------------------


@query("confusion_matrix", "SELECT * FROM confusion")
def confusion_matrix(spark, d):
    return evaluate.confusion_matrix(evaluate.long_scores(scored(spark, d)))


def quoted(names):
    return ", ".join(["\"Model\""] + [f'round("{n}", 6) + 0.0 AS "{n}"' for n in names])


@query("binary_metrics", f"SELECT {quoted(fixed.METRICS[:4])} FROM metrics")
def binary_metrics(spark, d):
    return evaluate.binary_metrics(evaluate.confusion_matrix(evaluate.long_scores(scored(spark, d))))


@query("roc_auc", f"SELECT {quoted(['ROC-AUC'])} FROM areas")
def roc_auc(spark, d):
    return evaluate.roc_auc(evaluate.long_scores(scored(spark, d)))


@query("average_precision", f"SELECT {quoted(['PR-AUC'])} FROM areas")
def average_precision(spark, d):
    return evaluate.average_precision(evaluate.long_scores(scored(spark, d)))


@query("roc_points", f"""
SELECT "Model", {r6('cum_neg / n', 'fpr')}, {r6('cum_pos / p', 'tpr')}, prob AS threshold FROM steps
WHERE rn = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
UNION ALL SELECT DISTINCT "Model", CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST('infinity' AS DOUBLE) FROM steps
""")
def roc_points(spark, d):
    return evaluate.roc_points(evaluate.long_scores(scored(spark, d)))


@query("pr_points", f"""
SELECT "Model", {r6('cum_pos / (cum_pos + cum_neg)', 'precision')}, {r6('cum_pos / p', 'recall')}, prob AS threshold FROM steps
UNION ALL SELECT DISTINCT "Model", CAST(1 AS DOUBLE), CAST(0 AS DOUBLE), CAST(NULL AS DOUBLE) FROM steps
""")
def pr_points(spark, d):
    return evaluate.pr_points(evaluate.long_scores(scored(spark, d)))


@query("classification_report", f"""
SELECT "Model", 'No Fire' AS label, {r6('p0', 'precision')}, {r6('r0', 'recall')}, {r6('f0', 'f1')}, tn + fp AS support FROM report_rows
UNION ALL SELECT "Model", 'Fire', {r6('p1')}, {r6('r1')}, {r6('f1')}, tp + fn FROM report_rows
UNION ALL SELECT "Model", 'accuracy', NULL, NULL, {r6('(tp + tn) / n')}, CAST(n AS BIGINT) FROM report_rows
UNION ALL SELECT "Model", 'macro avg', {r6('(p0 + p1) / 2')}, {r6('(r0 + r1) / 2')}, {r6('(f0 + f1) / 2')}, CAST(n AS BIGINT) FROM report_rows
UNION ALL SELECT "Model", 'weighted avg', {r6('(p0 * (tn + fp) + p1 * (tp + fn)) / n')}, {r6('(r0 * (tn + fp) + r1 * (tp + fn)) / n')}, {r6('(f0 * (tn + fp) + f1 * (tp + fn)) / n')}, CAST(n AS BIGINT) FROM report_rows
""")
def classification_report(spark, d):
    return evaluate.classification_report(evaluate.confusion_matrix(evaluate.long_scores(scored(spark, d))))


@query("evaluate_models", f"SELECT {quoted(fixed.METRICS)} FROM evaluation")
def evaluate_models(spark, d):
    return evaluate.evaluate_models(scored(spark, d))


# --- prediction from given models ---------------------------------------------------------


@query("arima_predict", f"""
SELECT * FROM (WITH f AS (SELECT m.grid_id, m.date, m.lag_7 / 2 AS forecast FROM test m JOIN active n ON n.grid_id = m.grid_id),
l AS (SELECT t.grid_id, t.date, CASE WHEN a.grid_id IS NOT NULL THEN coalesce(f.forecast, 0) ELSE coalesce(r.rate, 0) END AS forecast
  FROM test t LEFT JOIN (SELECT DISTINCT grid_id FROM f) a ON a.grid_id = t.grid_id LEFT JOIN rates r ON r.grid_id = t.grid_id
  LEFT JOIN f ON f.grid_id = t.grid_id AND f.date = t.date)
SELECT grid_id, date, {r6('forecast', 'arima_forecast')}, {r6('forecast / (max(forecast) OVER () + 1e-12)', 'arima_prob')},
  CAST(forecast >= 0.1 AS INTEGER) AS arima_pred FROM l)
""")
def arima_predict(spark, d):
    train, test = train_test(spark, d)
    cells = sampling.select_active_cells(aggregates.cell_activity(train))
    known = test.join(cells.select("grid_id"), "grid_id").select("grid_id", "date", (F.col("lag_7") / 2).alias("forecast"))
    out = arima.arima_predict(test, known, aggregates.historical_rate(train))
    return out.select("grid_id", "date", *[(F.round(c, 6) + 0.0).alias(c) for c in ("arima_forecast", "arima_prob")], "arima_pred")


def given_forest(spark):
    """Three small trees as a node table."""
    at = fixed.MODEL_FEATURES.index
    split_, leaf = (lambda f, t, a, b: (a, b, at(f), t, 0.0)), (lambda v: (-1, -1, -1, 0.0, v))
    trees = [
        [split_("rolling_sum_14", 0.5, 1, 2), split_("lag_7", 0.5, 3, 4), split_("rolling_sum_7", 1.5, 5, 6), leaf(0.0625), leaf(0.25), leaf(0.5), leaf(0.875)],
        [split_("grid_id_enc", 20.5, 1, 2), split_("temperature", 15.0, 3, 4), leaf(0.75), leaf(0.125), leaf(0.375)],
        [split_("is_weekend", 0.5, 1, 2), leaf(0.25), split_("month", 6.0, 3, 4), leaf(0.5), leaf(1.0)],
    ]
    rows = [(t, i, *node) for t, tree in enumerate(trees) for i, node in enumerate(tree)]
    return spark.createDataFrame(rows, "tree_id int, id int, left int, right int, feature int, threshold double, value double")


@query("rf_predict", f"""
SELECT * FROM (WITH c AS (SELECT grid_id, row_number() OVER (ORDER BY grid_id) - 1 AS code FROM (SELECT DISTINCT grid_id FROM train)),
p AS (SELECT t.grid_id, t.date, (
    CASE WHEN coalesce(rolling_sum_14, 0) <= 0.5 THEN CASE WHEN coalesce(lag_7, 0) <= 0.5 THEN 0.0625::DOUBLE ELSE 0.25 END
      ELSE CASE WHEN coalesce(rolling_sum_7, 0) <= 1.5 THEN 0.5 ELSE 0.875 END END
    + CASE WHEN coalesce(c.code, -1) <= 20.5 THEN CASE WHEN coalesce(temperature, 0) <= 15 THEN 0.125::DOUBLE ELSE 0.375 END ELSE 0.75 END
    + CASE WHEN coalesce(is_weekend, 0) <= 0.5 THEN 0.25::DOUBLE ELSE CASE WHEN coalesce(month, 0) <= 6 THEN 0.5 ELSE 1.0 END END) / 3 AS p
  FROM test t LEFT JOIN c USING (grid_id))
SELECT grid_id, date, {r6('p', 'rf_prob')}, CAST(p >= 0.5 AS INTEGER) AS rf_pred FROM p)
""")
def rf_predict(spark, d):
    train, test = train_test(spark, d)
    out = forest.given_forest_predict(test, given_forest(spark), split.cell_codes(train))
    return out.select("grid_id", "date", (F.round("rf_prob", 6) + 0.0).alias("rf_prob"), "rf_pred")


# --- models without a SQL twin (invariants are tested in tests/) --------------------------


@query("arima_grid_forecast")
def arima_grid_forecast(spark, d):
    train, test = train_test(spark, d)
    return arima.arima_grid_forecast(train, sampling.select_active_cells(aggregates.cell_activity(train)), split.dates_of(test))


@query("arima_fit_predict")
def arima_fit_predict(spark, d):
    train, test = train_test(spark, d)
    return arima.train_and_predict(train, test).select("grid_id", "date", "arima_forecast", "arima_prob", "arima_pred")


@query("rf_train")
def rf_train(spark, d):
    nodes = views.fitted(spark, d).nodes
    return nodes.groupBy("tree_id").agg(F.count(F.lit(1)).alias("nodes"), F.sum((F.col("left") < 0).cast("int")).alias("leaves"))


@query("rf_fit_predict")
def rf_fit_predict(spark, d):
    rows = forest.forest_predict(train_test(spark, d)[1], views.fitted(spark, d))
    return rows.select("grid_id", "date", "rf_prob", "rf_pred")


@query("rf_importance")
def rf_importance(spark, d):
    return forest.forest_importance(views.fitted(spark, d))


@query("tree_shap")
def tree_shap(spark, d):
    fitted = views.fitted(spark, d)
    scores = staged(forest.forest_scores(train_test(spark, d)[1], fitted), "forest-scored")
    chosen = staged(sampling.select_explain_rows(scores), "explain-rows")
    return shapley.explain_forest(chosen, fitted).select("grid_id", "date", "rf_prob", "base_value", *[f"{f}_shap" for f in fixed.MODEL_FEATURES])


@query("explain_predictions")
def explain_predictions(spark, d):
    out = scoring.explain_predictions(train_test(spark, d)[1], views.fitted(spark, d))
    return out.rows.select(*scoring.explanation_columns())


@query("score_pipeline")
def score_pipeline(spark, d):
    return scoring.score_pipeline(model(spark, d), views.kept(spark, d, "centroids")).metrics
