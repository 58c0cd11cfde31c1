"""Edge cases of single operators on tiny frames."""

import datetime as dt
import json
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Row, functions as F

from cellcast import fixed
from cellcast.functions import geo
from cellcast.functions.text import pick_column
from cellcast.operators import aggregates, clean, daily, evaluate, explain, grid, hotspot, ranking, sampling, split, views
from cellcast.sources import tables as files

D = dt.date


def day(n):
    return D(2024, 1, 1) + dt.timedelta(days=n)


def series(spark, counts, cell="r0_c0"):
    return spark.createDataFrame([(cell, day(i), c) for i, c in enumerate(counts)], "grid_id string, date date, incident_count bigint")


def column(df, name, order="date"):
    return [r[name] for r in df.orderBy(order).collect()]


# --- names and coercion ------------------------------------------------------------------


def test_column_roles():
    columns = ["Plate", "INC-DATE", "Y Coord", "Lng", "Type", "State_ID", "Zip Code"]
    assert clean.incident_roles(columns) == {"date": "INC-DATE", "lat": "Y Coord", "lon": "Lng", "type": "Type"}
    # Without an exact match a substring decides, even an unlucky one; a caller's choice wins.
    assert clean.incident_roles(["Plate", "when"])["lat"] == "Plate"
    assert clean.incident_roles(columns, lat="Plate")["lat"] == "Plate"
    assert clean.incident_roles(["foo"])["date"] is None
    assert clean.location_columns(columns) == ["State_ID", "Zip Code"]
    # Candidates are tried in priority order, not in column order.
    assert pick_column(["date", "inc_date"], fixed.INCIDENT_NAMES["date"], []) == "inc_date"


def test_weather_roles_name_all_that_is_missing():
    with pytest.raises(ValueError, match="humidity.*wind"):
        clean.weather_roles(["date", "temp_c", "rain_mm"])


def test_filter_errors(spark):
    df = spark.createDataFrame([(" ATL ", 2), ("x", 3)], "city string, n int")
    assert clean.filter_field_values(df, ["city", "n"], ["atl", 2]).count() == 1
    with pytest.raises(ValueError):
        clean.filter_field_values(df, ["city"], [])
    with pytest.raises(ValueError):
        clean.filter_field_values(df, ["town"], ["x"])


def test_coordinates(spark):
    df = spark.createDataFrame([("1.5", "2"), ("bad", " 7 "), ("NaN", "1d"), (None, "-3e1")], "a string, b string")
    got = [(r.latitude, r.longitude) for r in clean.coerce_coordinates(df, "a", "b").collect()]
    assert got == [(1.5, 2.0), (None, 7.0), (None, None), (None, -30.0)]
    with pytest.raises(ValueError):
        clean.coerce_coordinates(df, None, None)


def test_dates(spark):
    texts = ["2024-02-29 23:59:59", "2024-02-30", "2023-02-29", "2024-03-01T05:06:07", "2024-03-01T05:06:07Z", "3/4/2024", "20240305", "soon", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.date for r in clean.coerce_event_date(df, "t").collect()]
    assert got == [D(2024, 2, 29), None, None, D(2024, 3, 1), D(2024, 3, 1), D(2024, 3, 4), D(2024, 3, 5), None, None, None]
    stamp = spark.createDataFrame([(dt.datetime(2024, 5, 6, 7),)], "t timestamp")
    assert clean.coerce_event_date(stamp, "t").first().date == D(2024, 5, 6)


def test_valid_bounds_are_inclusive(spark):
    df = spark.createDataFrame([(day(0), 90.0, -180.0), (day(0), -90.0, 180.0), (day(0), 90.1, 0.0), (None, 0.0, 0.0), (day(0), None, 0.0)],
                               "date date, latitude double, longitude double")
    assert clean.filter_valid_coords(df).count() == 2


def test_fire_types(spark):
    texts = {"1110": True, "100 - Fire": True, "199": True, "200 gas": False, "EMS 321, 111": False, "wildFIRE": True, "12 call": False, None: False, "x": False}
    df = spark.createDataFrame([(t,) for t in texts], "kind string")
    kept = {r.kind for r in clean.filter_fire_types(df, "kind").collect()}
    assert kept == {t for t, keep in texts.items() if keep}
    assert clean.filter_fire_types(df, None).count() == len(texts)


def test_dedupe_keeps_the_first_and_groups_nulls(spark):
    rows = [(3, None, "a", day(0), "late"), (1, None, "a", day(0), "first"), (2, "7", "a", day(0), "other"), (4, None, "a", day(1), "next")]
    df = spark.createDataFrame(rows, "_row_id bigint, INC_NO string, fdid string, date date, note string")
    assert {r.note for r in clean.dedupe_incidents(df).collect()} == {"first", "other", "next"}
    assert clean.identity_columns(["Exp-No", "State Id", "note"]) == ["Exp-No", "State Id"]


def test_weather_means_skip_bad_values(spark):
    rows = [("2024-01-01", "10", "NaN", "x", None), ("2024-01-01", "20", "4", "6", None), ("never", "1", "1", "1", "1")]
    df = spark.createDataFrame(rows, "date string, temperature string, humidity string, precipitation string, wind string")
    assert clean.clean_weather(df).collect() == [Row(date=day(0), temperature=15.0, humidity=4.0, precipitation=6.0, wind=None)]


# --- grid --------------------------------------------------------------------------------


def test_projection_round_trip_and_known_point(spark):
    rows = [(33.749, -84.388), (-33.0, 151.2), (0.0, 3.0), (60.5, 5.9)]
    for lat, lon in rows:
        one = spark.createDataFrame([(lat, lon)], "latitude double, longitude double")
        frame = grid.scalar(grid.utm_frame(one))
        p = grid.project_utm(one, frame)
        if lat == 33.749:
            assert (p.first().x, p.first().y) == (pytest.approx(741952.0105, abs=1e-3), pytest.approx(3737391.3602, abs=1e-3))
        layers = [{"_utm": frame}, *geo.wgs84_layers({"p": ("x", "y")}, F.col("_utm.meridian"), F.col("_utm.south"))]
        back = grid.in_layers(p, layers, ["lon_p", "lat_p"]).first()
        assert (back.lat_p, back.lon_p) == (pytest.approx(lat, abs=1e-8), pytest.approx(lon, abs=1e-8))


def test_cells_at_the_edges(spark):
    pts = spark.createDataFrame([(0.0, 0.0), (1999.9, 0.0), (2000.0, 500.0), (1000.0, 0.0)], "x double, y double")
    got = [(r.cell_col, r.cell_row) for r in grid.assign_grid_cell(pts).orderBy("x").collect()]
    assert got == [(0, 0), (1, 0), (1, 0), (1, 0)]
    same = spark.createDataFrame([(5.0, 5.0)] * 3, "x double, y double")
    extent = grid.spatial_extent(same)
    assert (extent.first().n_cols, extent.first().n_rows) == (1, 1)
    assert grid.generate_grid(extent).count() == 1
    assert {r.grid_id for r in grid.assign_grid_cell(same).collect()} == {"r0_c0"}


def test_centroid_of_a_square(spark):
    ring = [(2.0, 0.0), (2.0, 2.0), (0.0, 2.0), (0.0, 0.0), (2.0, 0.0)]
    df = spark.createDataFrame([("a", 0, 0, ring)], "grid_id string, cell_row int, cell_col int, ring array<struct<lon:double,lat:double>>")
    assert grid.cell_centroids(df).first()[3:] == (1.0, 1.0)
    assert grid.grid_center(df).first() == (1.0, 1.0)


# --- days --------------------------------------------------------------------------------


def test_dense_days(spark):
    rows = [("a", day(2), 3), ("a", day(5), 1), ("b", day(0), 2), ("b", day(6), 4)]
    counts = spark.createDataFrame(rows, "grid_id string, date date, incident_count bigint")
    got = {(r.grid_id, r.date): r.incident_count for r in daily.densify_cell_day(counts).collect()}
    want = {(g, day(i)): 0 for g in "ab" for i in range(7)} | {(g, d): n for g, d, n in rows}
    assert got == want


def test_target_tail_is_null_propagating(spark):
    df = series(spark, [0, 0, 0, 1, 1])
    assert column(daily.target_forward(df, 3), fixed.TARGET) == [1, 1, 0, 0, 0]
    assert column(daily.target_available(df, 3), "target_available") == [1, 1, 0, 0, 0]
    with pytest.raises(ValueError):
        daily.target_forward(df, 0)


def test_history_features(spark):
    out = daily.feat_rolling(daily.feat_lags(series(spark, [1, 0, 2, 0, 0, 3, 0, 1, 5])))
    assert column(out, "lag_3") == [0, 0, 0, 1, 0, 2, 0, 0, 3]
    assert column(out, "rolling_sum_7") == [0, 1, 1, 3, 3, 3, 6, 6, 6]
    assert column(out, "rolling_sum_14") == [0, 1, 1, 3, 3, 3, 6, 6, 7]


def test_weather_join_refuses_two_rows_for_a_day(spark):
    two = spark.createDataFrame([(day(0), 1.0), (day(0), 2.0)], "date date, temperature double")
    assert column(daily.join_weather(series(spark, [1, 1]), two.limit(1)), "temperature") == [1.0, None]
    with pytest.raises(Exception, match="several weather rows"):
        daily.join_weather(series(spark, [1]), two).collect()


def test_holidays(spark):
    want = {D(2024, 1, 1), D(2024, 1, 15), D(2024, 2, 19), D(2024, 5, 27), D(2024, 6, 19), D(2024, 7, 4), D(2024, 9, 2), D(2024, 10, 14),
            D(2024, 11, 11), D(2024, 11, 28), D(2024, 12, 25)}
    days = spark.range(366).select(F.date_add(F.lit(day(0)), F.col("id").cast("int")).alias("date"))
    assert {r.date for r in daily.join_holidays(days).filter("is_holiday = 1").collect()} == want
    odd = {D(2021, 12, 31): 1, D(2022, 1, 1): 1, D(2021, 7, 5): 1, D(2020, 7, 3): 1, D(2020, 6, 19): 0, D(2021, 6, 18): 1, D(2023, 11, 10): 1}
    df = spark.createDataFrame([(d,) for d in odd], "date date")
    assert {r.date: r.is_holiday for r in daily.join_holidays(df).collect()} == odd
    own = spark.createDataFrame([(D(2020, 6, 19),)] * 2, "date date")
    assert daily.join_holidays(df, calendar_days=own).filter("is_holiday = 1").count() == 1
    with pytest.raises(ValueError):
        daily.join_holidays(df, country="XX")


# --- split, ranking, sampling ------------------------------------------------------------


def test_split_and_codes(spark):
    table = series(spark, range(7)).unionByName(series(spark, [1], "r10_c0")).unionByName(series(spark, [1], "r2_c0"))
    got = split.split_temporal(table)
    assert {r.date for r in got.filter("split = 'train'").collect()} == {day(i) for i in range(5)}
    assert split.split_temporal(table, 1.0).filter("split = 'test'").count() == 0
    codes = split.cell_codes(table)
    assert {r.grid_id: r.grid_id_enc for r in codes.collect()} == {"r0_c0": 0, "r10_c0": 1, "r2_c0": 2}
    new = spark.createDataFrame([("r9_c9",), ("r2_c0",)], "grid_id string")
    assert {r.grid_id: r.grid_id_enc for r in split.encode_grid_id(new, codes).collect()} == {"r9_c9": -1, "r2_c0": 2}


def test_text_ranks_match_sorting(spark):
    ids = sorted({f"r{r}_c{c}" for r in range(0, 230, 7) for c in range(0, 120, 11)})
    got = {r.grid_id: r["rank"] for r in ranking.rank_by_text(spark.createDataFrame([(i,) for i in ids], "grid_id string"), "grid_id").collect()}
    assert got == {g: i for i, g in enumerate(ids)}


def test_running_totals_and_quantiles_against_numpy(spark):
    rng = np.random.default_rng(0)
    for values in (rng.normal(size=3000), rng.integers(0, 5, 1000).astype(float), np.array([2.5]), np.zeros(50), rng.lognormal(sigma=4, size=999)):
        df = spark.createDataFrame([(float(v),) for v in values], "v double").unionByName(spark.createDataFrame([(None,)], "v double"))
        got = ranking.exact_quantiles(df, "v", [0.0, 0.4, 0.6, 1.0]).first()
        assert list(got) == pytest.approx(np.quantile(values, [0, 0.4, 0.6, 1.0]).tolist(), rel=1e-12)
        steps = df.dropna().groupBy("v").agg(F.count("*").alias("n"))
        totals = {r.v: (r.cum_n, r.next_n) for r in ranking.running_totals(steps, [], "v", ["n"]).collect()}
        distinct, counts = np.unique(values, return_counts=True)
        for i, v in enumerate(distinct):
            assert totals[v] == ((values >= v).sum(), counts[i - 1] if i else None)


def test_large_buckets_are_cut_once_more(spark):
    """With a small limit the second cutting is at work: buckets shrink, stay in order, and the totals equal NumPy's."""
    rng = np.random.default_rng(1)
    values = {"a": rng.lognormal(sigma=3, size=4000), "b": np.round(rng.normal(size=3000), 2), "c": np.array([1.0])}
    rows = [(g, float(v)) for g, vs in values.items() for v in vs]
    steps = spark.createDataFrame(rows, "g string, v double").groupBy("g", "v").agg(F.count("*").alias("n")).cache()

    def buckets(limit):
        return ranking.placed_in_buckets(steps, ["g"], "v", ["n"], limit).collect()

    sizes = {limit: Counter((r.g, r._bucket) for r in buckets(limit)) for limit in (4, 10_000)}
    assert max(sizes[4].values()) <= 4 < max(sizes[10_000].values())
    for g in values:
        placed = [r._bucket for r in sorted((r for r in buckets(4) if r.g == g), key=lambda r: r.v)]
        assert placed == sorted(placed)
    totals = {(r.g, r.v): (r.cum_n, r.next_n) for r in ranking.running_totals(steps, ["g"], "v", ["n"], 4).collect()}
    for g, vs in values.items():
        distinct, counts = np.unique(vs, return_counts=True)
        above = np.cumsum(counts[::-1])[::-1]
        assert [totals[g, v] for v in distinct] == [(above[i], counts[i - 1] if i else None) for i in range(len(distinct))]
    assert len(totals) == steps.count()


def test_sampling_is_repeatable_and_bounded(spark):
    df = series(spark, range(30))
    first = {r.date for r in sampling.sample_n(df, 10).collect()}
    assert len(first) == 10 and first == {r.date for r in sampling.sample_n(df.repartition(7), 10).collect()}
    assert sampling.sample_n(df, 99).count() == 30
    assert column(sampling.sample_dates(df, 3), "date") == [day(0), day(14), day(29)]
    assert column(sampling.sample_dates(df, 1), "date") == [day(0)]
    assert sampling.sample_dates(df, 99).count() == 30


def test_explain_rows_have_no_duplicates(spark):
    df = series(spark, range(60)).withColumn("rf_prob", F.col("incident_count") / 60.0)
    got = sampling.select_explain_rows(df).toPandas()
    assert not got.duplicated(["grid_id", "date"]).any()
    assert (got.stratum == "high").sum() == 50  # the others come from the rows that are left
    assert set(got[got.stratum == "low"].rf_prob) <= {i / 60 for i in range(10)}


def test_drivers_ties_and_text(spark):
    rows = spark.createDataFrame([(0.5, 0.1, -0.3, 0.3, 0.0), (0.4, 0.0, 0.0, 0.0, 0.0)], "rf_prob double, lag_1_shap double, month_shap double, grid_id_enc_shap double, wind_shap double")
    got = explain.explanation_text(sampling.topk_drivers(rows, ["lag_1", "month", "grid_id_enc", "wind"])).collect()
    assert got[0].explanation_text == ("Risk is elevated mainly because month (decreases risk), location history (increases risk), "
                                       "and last-period incidents (increases risk).")
    assert got[1].explanation_text == ("Risk remains lower mainly because last-period incidents (decreases risk), month (decreases risk), "
                                       "and location history (decreases risk).")
    labels = spark.createDataFrame([("is_weekend",), ("some_new_name",)], "n string")
    assert [r.l for r in labels.select(explain.driver_label(F.col("n")).alias("l")).collect()] == ["weekend timing", "some new name"]


# --- thresholds and metrics --------------------------------------------------------------


def test_threshold_buckets_compare_real_doubles(spark):
    candidates = [0.01 + i * 0.01 for i in range(98)]
    scores = [0.0, 0.29, 0.009999, 1.0, 0.98, 0.985, -3.0, 7.0, *candidates, *[math.nextafter(c, 0) for c in candidates], *[i / 100 for i in range(101)]]
    df = spark.createDataFrame([(s,) for s in scores], "s double").withColumn("b", hotspot.threshold_bucket(F.col("s")))
    for r in df.collect():
        assert r.b == sum(c <= r.s for c in candidates), r


def test_best_threshold_against_a_scan(spark):
    rng = np.random.default_rng(3)
    for y, s in ((rng.integers(0, 2, 400), rng.random(400)), (np.zeros(50, int), rng.random(50)), (np.ones(5, int), np.full(5, 0.5)), (np.ones(3, int), np.zeros(3))):
        df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], f"{fixed.TARGET} int, s double")
        best, best_f = 0.5, 0.0
        for i in range(98):
            t = 0.01 + i * 0.01
            p = s >= t
            f = 2 * (p & (y == 1)).sum() / (p.sum() + y.sum()) if p.sum() + y.sum() else 0.0
            if f > best_f:
                best, best_f = t, f
        got = hotspot.best_f1_threshold(df, "s").first()
        assert (got.threshold, got.f1) == (best, pytest.approx(best_f))
    empty = spark.createDataFrame([], f"{fixed.TARGET} int, s double")
    assert hotspot.best_f1_threshold(empty, "s").first().threshold == 0.5


def scored(spark, y, p):
    return spark.createDataFrame([(int(a), float(b), int(b >= 0.5)) for a, b in zip(y, p)], f"{fixed.TARGET} int, rf_prob double, rf_pred int")


def test_curve_metrics_against_pair_counting(spark):
    rng = np.random.default_rng(5)
    y, p = rng.integers(0, 2, 300), np.round(rng.random(300), 2)
    got = evaluate.evaluate_models(scored(spark, y, p)).first()
    pairs = [(a > b) + 0.5 * (a == b) for a in p[y == 1] for b in p[y == 0]]
    assert got["ROC-AUC"] == pytest.approx(np.mean(pairs))
    ap, recall = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        hit = p >= t
        r = (hit & (y == 1)).sum() / y.sum()
        ap, recall = ap + (r - recall) * (hit & (y == 1)).sum() / hit.sum(), r
    assert got["PR-AUC"] == pytest.approx(ap)
    points = evaluate.roc_points(evaluate.long_scores(scored(spark, y, p))).toPandas().sort_values(["fpr", "tpr"])
    assert np.trapezoid(points.tpr, points.fpr) == pytest.approx(np.mean(pairs))
    assert points.iloc[0].threshold == math.inf and tuple(points.iloc[-1][["fpr", "tpr"]]) == (1.0, 1.0)


def test_one_class_and_equal_scores(spark):
    one = evaluate.evaluate_models(scored(spark, [0, 0, 0], [0.1, 0.6, 0.2])).first()
    assert one["ROC-AUC"] is None and one["PR-AUC"] == 0.0 and one["Recall"] == 0.0 and one["Accuracy"] == pytest.approx(2 / 3)
    flat = evaluate.evaluate_models(scored(spark, [0, 1, 0, 1], [0.3] * 4)).first()
    assert flat["ROC-AUC"] == 0.5 and flat["PR-AUC"] == 0.5 and flat["Precision"] == 0.0
    with pytest.raises(ValueError):
        evaluate.evaluate_models(spark.createDataFrame([(1,)], f"{fixed.TARGET} int"))


def test_straight_runs_are_dropped_from_roc(spark):
    points = evaluate.roc_points(evaluate.long_scores(scored(spark, [1, 1, 1, 0, 0, 0], [0.9, 0.8, 0.7, 0.3, 0.2, 0.1]))).collect()
    assert sorted((r.fpr, r.tpr) for r in points) == [(0.0, 0.0), (0.0, pytest.approx(1 / 3)), (0.0, 1.0), (1.0, 1.0)]


# --- views -------------------------------------------------------------------------------


def test_histogram_bins(spark):
    def bins(values):
        df = spark.createDataFrame([(day(0), v) for v in values], "date date, m double")
        return [(round(r.x0, 9), round(r.x1, 9), r.n) for r in views.day_histogram(df, "m").orderBy("bin").collect()]

    assert bins([1.0]) == []
    assert bins([2.0, 2.0, None]) == [(2.0, 2.0, 2)]
    got = bins([0.03, 0.1, 0.3, 0.95])
    assert [b[0] for b in got] == [0.03, *[round(0.05 * k, 9) for k in range(1, 19)]] and got[-1][1] == 0.95
    assert sum(b[2] for b in got) == 4 and got[0][2] == 1 and dict((b[0], b[2]) for b in got)[0.3] == 1 and got[-1][2] == 1
    wide = bins([0.0, 140.0, 70.0])
    assert len(wide) == 14 and wide[0][:2] == (0.0, 10.0) and wide[-1] == (130.0, 140.0, 1)


def test_extents_snapshot_and_nearest(spark):
    df = spark.createDataFrame([("a", day(0), 1.0), ("b", day(0), 1.0), ("a", day(1), None), ("a", day(2), 1.0), ("b", day(2), 4.0)],
                               "grid_id string, date date, rf_prob double")
    got = {r.date: (r.lo, r.hi) for r in aggregates.day_metric_extent(df, "rf_prob").collect()}
    assert got == {day(0): (1.0, 1.0 + 1e-9), day(1): (0.0, 1.0), day(2): (1.0, 4.0)}
    shown = {(r.field, r.value) for r in views.cell_snapshot(df, "a", F.lit(day(1))).collect()}
    assert shown == {("date", "2024-01-02")}
    probes = spark.createDataFrame([(day(-9),), (day(1),), (day(50),)], "date date")
    dates = split.dates_of(df.filter("date <> '2024-01-02'"))
    assert column(views.nearest_date(probes, dates), "nearest") == [day(0), day(0), day(2)]
    assert views.cell_series(df.filter("grid_id = 'b' OR date = '2024-01-01'")).filter("grid_id = 'a'").count() == 0
    layer = {r.grid_id: (r.value, r.no_data) for r in views.day_layer(spark.createDataFrame([("a",), ("z",)], "grid_id string"), df, "rf_prob", F.lit(day(0))).collect()}
    assert layer == {"a": (1.0, False), "z": (None, True)}


def test_median_and_unknown_aggregate(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 9.0)], "grid_id string, s double")
    assert aggregates.per_cell_metric(df, "s", "median").first().score == 2.0
    with pytest.raises(ValueError):
        aggregates.per_cell_metric(df, "s", "mode")


# --- files -------------------------------------------------------------------------------


def test_geojson_layouts(spark, tmp_path):
    features = [{"type": "Feature", "properties": {"INC_NO": f"{i}", "Score": i / 2}, "geometry": {"type": "Point", "coordinates": [-84.0 - i, 33.0 + i]}} for i in range(200)]
    (tmp_path / "one.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    body = ",\n".join(json.dumps(f) for f in features)
    (tmp_path / "rows.geojsonl").write_text('{"type": "FeatureCollection", "features": [\n' + body + "\n]}\n")
    (tmp_path / "plain.geojsonl").write_text("\n".join(json.dumps(f) for f in features))
    for name in ("one.geojson", "rows.geojsonl", "plain.geojsonl"):
        for schema in (None, "INC_NO: string, Score: double"):
            got = files.read_table(spark, str(tmp_path / name), properties=schema)
            rows = {r.INC_NO: (r.Score, r.longitude, r.latitude) for r in got.collect()}
            assert rows == {f"{i}": (i / 2, -84.0 - i, 33.0 + i) for i in range(200)}, (name, schema)
    (tmp_path / "bad.json").write_text('{"error": 1}')
    with pytest.raises(ValueError):
        files.read_table(spark, str(tmp_path / "bad.json"))
    with pytest.raises(ValueError):
        files.read_table(spark, "x.gpkg")


def test_weather_response(spark, tmp_path):
    daily_part = {"time": ["2024-01-01", "2024-01-02"], "temperature_2m_mean": [1.5, None], "relative_humidity_2m_mean": [50, 60],
                  "precipitation_sum": [0.0, 2.5], "wind_speed_10m_max": [9.0, 8.0]}
    (tmp_path / "w.json").write_text(json.dumps({"daily": daily_part}, indent=1))
    got = clean.clean_weather(clean.standardize_weather(files.read_columnar_weather(spark, str(tmp_path / "w.json"))))
    assert [tuple(r) for r in got.orderBy("date").collect()] == [(day(0), 1.5, 50.0, 0.0, 9.0), (day(1), None, 60.0, 2.5, 8.0)]
    (tmp_path / "e.json").write_text('{"reason": "no"}')
    with pytest.raises(ValueError):
        files.read_columnar_weather(spark, str(tmp_path / "e.json"))


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a b", day(0), 1.25, 'say "x", y'), (" c ", day(1), None, None)], "grid_id string, date date, p double, text string")
    files.write_csv_results(df, str(tmp_path / "r.csv"))
    assert sorted(files.read_csv_results(spark, str(tmp_path / "r.csv"), df.schema).collect()) == sorted(df.collect())
    assert files.read_table(spark, str(tmp_path / "r.csv")).dtypes == [("grid_id", "string"), ("date", "string"), ("p", "string"), ("text", "string")]


def test_feature_lines_fail_instead_of_vanishing(spark, tmp_path):
    good = '{"type": "Feature", "properties": {"a": "x", "s": 1.5}, "geometry": {"type": "Point", "coordinates": [1.0, 2.0]}}'
    for i, bad in enumerate((good.replace("1.5", '"text"'), good[:60])):
        path = tmp_path / f"bad{i}.geojsonl"
        path.write_text(good + "\n" + bad + "\n")
        for columns in (["a", "s"], ["a"]):
            with pytest.raises(Exception):
                files.read_table(spark, str(path), properties="a: string, s: double").select(*columns).collect()


def test_csv_values_keep_their_line_breaks(spark, tmp_path):
    text = "".join(f'"{t}",{n}\n' for t, n in (("a\nb", 1), ("c", 2)))
    (tmp_path / "one.csv").write_text("t,n\n" + text)
    assert sorted(map(tuple, files.read_table(spark, str(tmp_path / "one.csv")).collect())) == [("a\nb", "1"), ("c", "2")]


def test_sample_dates_ends_on_the_last(spark):
    days = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-01-16')) AS date")
    got = sorted(r[0].day for r in sampling.sample_dates(days, 12).collect())
    assert len(got) == 12 and got[0] == 1 and got[-1] == 16
