"""SQL twins: a library of common table expressions from which each oracle is assembled."""

from __future__ import annotations

import re

from cellcast import fixed
from cellcast.functions import geo

_CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    _CTES[name] = sql.strip()


def with_ctes(select: str) -> str:
    """Prefix a select with the expressions it needs, in definition order."""
    needed: set[str] = set()
    todo = [select]
    while todo:
        text = todo.pop()
        for name, body in _CTES.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(body)
    if not needed:
        return select.strip()
    parts = ",\n".join(f"{n} AS (\n{b}\n)" for n, b in _CTES.items() if n in needed)
    return f"WITH {parts}\n{select.strip()}"


def r6(expr: str, alias: str | None = None) -> str:
    return f"round({expr}, 6) + 0.0" + (f" AS {alias}" if alias else "")


# --- inputs ------------------------------------------------------------------------------
_report = """
SELECT {row_id} AS row_id, {city} AS city, 'GA' AS state_id, CAST(user_id + 1000 AS VARCHAR) AS fdid,
  event_id AS inc_no, {inc_date} AS inc_date,
  CASE WHEN event_id % 97 = 0 THEN '95.5' WHEN event_id % 89 = 0 THEN 'bad'
       ELSE CAST(CAST(33.65 AS DOUBLE) + CAST(0.009 AS DOUBLE) * (user_id % 16) + CAST(0.0001 AS DOUBLE) * (event_id % 7) AS VARCHAR) END AS latitude,
  CAST(CAST(-85.5 AS DOUBLE) + CAST(0.0108 AS DOUBLE) * (user_id // 16) + CAST(0.0001 AS DOUBLE) * (event_id % 11) AS VARCHAR) AS longitude,
  CAST(100 * (1 + event_id % 4) + CAST(json_extract(props, '$.k') AS INTEGER) AS VARCHAR) || ' ' ||
  CASE WHEN event_type = 'error' AND CAST(json_extract(props, '$.k') AS INTEGER) % 10 = 0 THEN 'Fire, other' ELSE event_type END AS inc_type
FROM events
"""
cte("raw_incidents", _report.format(
    row_id="event_id", city="CASE WHEN event_id % 5 <> 0 THEN ' ATLANTA ' ELSE 'Macon' END",
    inc_date="CASE WHEN event_id % 101 = 0 THEN 'n/a' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END",
) + "UNION ALL" + _report.format(
    row_id="event_id + 10000000", city="' ATLANTA '", inc_date="strftime(ts, '%Y-%m-%d %H:%M:%S')",
) + "WHERE event_id % 50 = 4")

cte("raw_weather", """
SELECT CAST(ts AS DATE) AS date,
  CASE WHEN event_type = 'view' THEN value END AS temperature,
  CASE WHEN event_type = 'click' THEN value END AS humidity,
  CASE WHEN event_type = 'signup' THEN value END AS precipitation,
  CASE WHEN event_type = 'purchase' THEN value END AS wind
FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-15'
""")

# --- cleaning ----------------------------------------------------------------------------
cte("in_city", "SELECT * FROM raw_incidents WHERE lower(trim(city)) = 'atlanta'")
cte("typed", """
SELECT row_id, city, state_id, fdid, inc_no, inc_date, inc_type,
  TRY_CAST(latitude AS DOUBLE) AS latitude, TRY_CAST(longitude AS DOUBLE) AS longitude,
  CAST(try_strptime(inc_date, '%Y-%m-%d %H:%M:%S') AS DATE) AS date
FROM in_city
""")
cte("valid", """
SELECT * FROM typed
WHERE date IS NOT NULL AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180
""")
cte("fires", r"""
SELECT * FROM valid
WHERE coalesce(TRY_CAST(regexp_extract(trim(inc_type), '(\d{3})', 1) AS INTEGER) BETWEEN 100 AND 199, false)
   OR contains(lower(inc_type), 'fire')
""")
cte("clean_inc", """
SELECT * EXCLUDE rn FROM (
  SELECT *, row_number() OVER (PARTITION BY state_id, fdid, inc_no, date, latitude, longitude ORDER BY row_id) AS rn FROM fires
) WHERE rn = 1
""")
cte("weather", """
SELECT date, avg(temperature) AS temperature, avg(humidity) AS humidity, avg(precipitation) AS precipitation, avg(wind) AS wind
FROM raw_weather GROUP BY date
""")

# --- grid --------------------------------------------------------------------------------
def _lit(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def utm_sql(lon: str, lat: str, meridian: str, rest: str, source: str) -> str:
    """Nested selects adding x, y (northern hemisphere)."""
    e = _lit(geo.ECCENTRICITY)
    xs = " + ".join(f"{_lit(a)} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(geo.ALPHA, 1))
    ys = " + ".join(f"{_lit(a)} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(geo.ALPHA, 1))
    return f"""
SELECT {rest}, (eta + {xs}) * {_lit(geo.RECTIFYING)} + 500000 AS x, (xi + {ys}) * {_lit(geo.RECTIFYING)} AS y FROM (
  SELECT *, atan2(t, cos(turn)) AS xi, atanh(sin(turn) / sqrt(t * t + 1)) AS eta FROM (
    SELECT *, sinh(atanh(sin(radians({lat}))) - {e} * atanh({e} * sin(radians({lat})))) AS t, radians({lon} - {meridian}) AS turn
    FROM {source}))"""


cte("utm", """
SELECT zone, zone * CAST(6.0 AS DOUBLE) - 183 AS meridian FROM (
  SELECT least(CAST(floor(((min(longitude) + max(longitude)) / 2 + 180) / 6) AS INTEGER) + 1, 60) AS zone FROM clean_inc)
""")
cte("projected", utm_sql("longitude", "latitude", "meridian", "* EXCLUDE (zone, meridian, t, turn, xi, eta)", "clean_inc CROSS JOIN utm"))
cte("extent", """
SELECT minx, miny, maxx, maxy, CAST(greatest(1, ceil((maxx - minx) / 1000)) AS INTEGER) AS n_cols,
  CAST(greatest(1, ceil((maxy - miny) / 1000)) AS INTEGER) AS n_rows
FROM (SELECT min(x) AS minx, min(y) AS miny, max(x) AS maxx, max(y) AS maxy FROM projected)
""")
cte("placed", """
SELECT *, 'r' || cell_row || '_c' || cell_col AS grid_id FROM (
  SELECT p.*, CAST(least(greatest(floor((x - minx) / 1000), 0), n_cols - 1) AS INTEGER) AS cell_col,
    CAST(least(greatest(floor((y - miny) / 1000), 0), n_rows - 1) AS INTEGER) AS cell_row
  FROM projected p CROSS JOIN extent)
""")
cte("squares", """
SELECT 'r' || cell_row || '_c' || cell_col AS grid_id, cell_row, cell_col,
  minx + cell_col * 1000 AS x0, miny + cell_row * 1000 AS y0, minx + cell_col * 1000 + 1000 AS x1, miny + cell_row * 1000 + 1000 AS y1
FROM (SELECT minx, miny, CAST(r AS INTEGER) AS cell_row, CAST(c AS INTEGER) AS cell_col
      FROM extent, unnest(range(0, n_rows)) AS a(r), unnest(range(0, n_cols)) AS b(c))
""")


def inverse_sql(x: str, y: str, rest: str, source: str) -> str:
    b = list(enumerate(geo.BETA, 1))
    d = " + ".join(f"{_lit(v)} * sin({2 * j} * chi)" for j, v in enumerate(geo.DELTA, 1))
    xi1 = " - ".join(["xi"] + [f"{_lit(v)} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, v in b])
    eta1 = " - ".join(["eta"] + [f"{_lit(v)} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, v in b])
    return f"""
SELECT {rest}, degrees(atan(sinh(eta1) / cos(xi1))) + meridian AS lon, degrees(chi + {d}) AS lat FROM (
  SELECT *, asin(sin(xi1) / cosh(eta1)) AS chi FROM (
    SELECT *, {xi1} AS xi1, {eta1} AS eta1 FROM (
      SELECT *, {y} / {_lit(geo.RECTIFYING)} AS xi, ({x} - 500000) / {_lit(geo.RECTIFYING)} AS eta FROM {source})))"""


cte("corners", "\nUNION ALL\n".join(
    f"SELECT grid_id, cell_row, cell_col, {i} AS k, {x} AS px, {y} AS py FROM squares"
    for i, (x, y) in enumerate([("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0"), ("x1", "y0")])))
cte("vertices", inverse_sql("px", "py", "grid_id, cell_row, cell_col, k", "(SELECT * FROM corners CROSS JOIN utm)"))
cte("centroids", """
SELECT grid_id, cell_row, cell_col, lat0 + sum((dy0 + dy1) * a) / (3 * sum(a)) AS lat_center, lon0 + sum((dx0 + dx1) * a) / (3 * sum(a)) AS lon_center
FROM (SELECT *, dx0 * dy1 - dx1 * dy0 AS a FROM (
  SELECT v.grid_id, v.cell_row, v.cell_col, o.lon AS lon0, o.lat AS lat0, v.lon - o.lon AS dx0, v.lat - o.lat AS dy0,
    w.lon - o.lon AS dx1, w.lat - o.lat AS dy1
  FROM vertices v JOIN vertices w ON v.grid_id = w.grid_id AND w.k = v.k + 1 JOIN vertices o ON o.grid_id = v.grid_id AND o.k = 0))
GROUP BY grid_id, cell_row, cell_col, lon0, lat0
""")

# --- cell-day table ----------------------------------------------------------------------
cte("spine", "SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM placed")
cte("counts", "SELECT grid_id, date, count(*) AS incident_count FROM placed GROUP BY grid_id, date")
cte("dense", """
SELECT c.grid_id, s.date, coalesce(k.incident_count, 0) AS incident_count
FROM (SELECT DISTINCT grid_id FROM counts) c CROSS JOIN spine s LEFT JOIN counts k ON k.grid_id = c.grid_id AND k.date = s.date
""")
cte("holiday_years", """
SELECT CAST(unnest(generate_series(DATE '1990-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) AS DATE) AS date
""")
cte("fixed_holidays", """
SELECT date FROM holiday_years
WHERE (month(date), day(date)) IN ((1, 1), (6, 19), (7, 4), (11, 11), (12, 25)) AND (month(date) <> 6 OR year(date) >= 2021)
""")
cte("holiday_dates", """
SELECT DISTINCT date FROM (
  SELECT date FROM fixed_holidays
  UNION ALL SELECT date - 1 FROM fixed_holidays WHERE isodow(date) = 6
  UNION ALL SELECT date + 1 FROM fixed_holidays WHERE isodow(date) = 7
  UNION ALL
  SELECT date FROM (SELECT date, month(date) AS m, isodow(date) AS w,
      row_number() OVER (PARTITION BY date_trunc('month', date), isodow(date) ORDER BY date) AS nth,
      row_number() OVER (PARTITION BY date_trunc('month', date), isodow(date) ORDER BY date DESC) AS back FROM holiday_years)
  WHERE (m = 1 AND w = 1 AND nth = 3) OR (m = 2 AND w = 1 AND nth = 3) OR (m = 5 AND w = 1 AND back = 1)
     OR (m = 9 AND w = 1 AND nth = 1) OR (m = 10 AND w = 1 AND nth = 2) OR (m = 11 AND w = 4 AND nth = 4))
""")
cte("cell_days", """
SELECT d.grid_id, d.date, CAST(d.incident_count AS BIGINT) AS incident_count,
  round(temperature, 6) + 0.0 AS temperature, round(humidity, 6) + 0.0 AS humidity, round(precipitation, 6) + 0.0 AS precipitation, round(wind, 6) + 0.0 AS wind,
  CAST(isodow(d.date) - 1 AS INTEGER) AS day_of_week, CAST(month(d.date) AS INTEGER) AS month,
  CASE WHEN month(d.date) IN (12, 1, 2) THEN 'winter' WHEN month(d.date) IN (3, 4, 5) THEN 'spring'
       WHEN month(d.date) IN (6, 7, 8) THEN 'summer' ELSE 'fall' END AS season,
  CAST(isodow(d.date) >= 6 AS INTEGER) AS is_weekend, CAST(h.date IS NOT NULL AS INTEGER) AS is_holiday,
  CAST(coalesce(lag(incident_count, 1) OVER w, 0) AS DOUBLE) AS lag_1,
  CAST(coalesce(lag(incident_count, 3) OVER w, 0) AS DOUBLE) AS lag_3,
  CAST(coalesce(lag(incident_count, 7) OVER w, 0) AS DOUBLE) AS lag_7,
  CAST(coalesce(sum(incident_count) OVER (PARTITION BY d.grid_id ORDER BY d.date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS rolling_sum_7,
  CAST(coalesce(sum(incident_count) OVER (PARTITION BY d.grid_id ORDER BY d.date ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS rolling_sum_14,
  CAST(coalesce(lead(incident_count, 1) OVER w > 0, false) AS INTEGER) AS target_next_interval,
  CAST(lead(incident_count, 1) OVER w IS NOT NULL AS INTEGER) AS target_available
FROM dense d LEFT JOIN weather USING (date) LEFT JOIN holiday_dates h ON h.date = d.date
WINDOW w AS (PARTITION BY d.grid_id ORDER BY d.date)
""")
cte("model", "SELECT * EXCLUDE target_available FROM cell_days WHERE target_available = 1")

# --- split, hotspot, fixed scores --------------------------------------------------------
cte("date_rank", "SELECT date, row_number() OVER (ORDER BY date) AS rn, count(*) OVER () AS n FROM (SELECT DISTINCT date FROM model)")
cte("split", """
SELECT m.*, CASE WHEN rn <= CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT) THEN 'train' ELSE 'test' END AS split
FROM model m JOIN date_rank USING (date)
""")
cte("train", "SELECT * EXCLUDE split FROM split WHERE split = 'train'")
cte("test", "SELECT * EXCLUDE split FROM split WHERE split = 'test'")
cte("totals", """
SELECT s.grid_id, s.incident_count, lat_center, lon_center
FROM (SELECT grid_id, CAST(sum(incident_count) AS BIGINT) AS incident_count FROM train GROUP BY grid_id) s JOIN centroids USING (grid_id)
""")
cte("kde_moments", """
SELECT n, n ** (CAST(-1 AS DOUBLE) / 3) * sum(w * (lat - mlat) * (lat - mlat)) / (n - 1) AS uu,
  n ** (CAST(-1 AS DOUBLE) / 3) * sum(w * (lat - mlat) * (lon - mlon)) / (n - 1) AS uv,
  n ** (CAST(-1 AS DOUBLE) / 3) * sum(w * (lon - mlon) * (lon - mlon)) / (n - 1) AS vv
FROM (SELECT lat_center AS lat, lon_center AS lon, CAST(incident_count AS DOUBLE) AS w FROM totals WHERE incident_count > 0)
CROSS JOIN (SELECT CAST(sum(incident_count) AS DOUBLE) AS n, sum(incident_count * lat_center) / sum(incident_count) AS mlat,
  sum(incident_count * lon_center) / sum(incident_count) AS mlon FROM totals)
GROUP BY n
""")
cte("kde", """
SELECT c.grid_id, sum(t.incident_count * exp(-0.5 * (vv * (c.lat_center - t.lat_center) ** 2
    - 2 * uv * (c.lat_center - t.lat_center) * (c.lon_center - t.lon_center)
    + uu * (c.lon_center - t.lon_center) ** 2) / (uu * vv - uv * uv))) / (max(n) * 2 * pi() * sqrt(max(uu * vv - uv * uv))) AS density
FROM centroids c CROSS JOIN (SELECT * FROM totals WHERE incident_count > 0) t CROSS JOIN kde_moments
GROUP BY c.grid_id
""")
cte("hotspot", "SELECT grid_id, (density - min(density) OVER ()) / (max(density) OVER () - min(density) OVER () + 1e-12) AS score FROM kde")
cte("thresholds", "SELECT CAST(i AS INTEGER) AS i, CAST(0.01 AS DOUBLE) + i * CAST(0.01 AS DOUBLE) AS t FROM range(0, 98) AS r(i)")


def best_threshold_sql(rows: str, score: str) -> str:
    return f"""
SELECT CASE WHEN f1 > 0 THEN t ELSE CAST(0.5 AS DOUBLE) END AS threshold, f1 FROM (
  SELECT i, t, coalesce(2.0 * tp / nullif(predicted + positives, 0), 0) AS f1 FROM (
    SELECT i, t, sum(CASE WHEN {score} >= t AND target_next_interval = 1 THEN 1 ELSE 0 END) AS tp,
      sum(CASE WHEN {score} >= t THEN 1 ELSE 0 END) AS predicted, sum(target_next_interval) AS positives
    FROM {rows} CROSS JOIN thresholds GROUP BY i, t))
ORDER BY f1 DESC, i LIMIT 1"""


cte("train_hotspot", "SELECT t.*, coalesce(h.score, 0) AS score FROM train t LEFT JOIN hotspot h USING (grid_id)")
cte("hotspot_limit", best_threshold_sql("train_hotspot", "score"))
cte("rates", """
SELECT grid_id, sum(incident_count) / CAST((SELECT count(DISTINCT date) FROM train) AS DOUBLE) AS rate FROM train GROUP BY grid_id
""")
cte("activity", """
SELECT grid_id, CAST(count(*) FILTER (incident_count > 0) AS BIGINT) AS nonzero_days, CAST(sum(incident_count) AS BIGINT) AS total_incidents
FROM train GROUP BY grid_id
""")
cte("active", "SELECT grid_id FROM activity WHERE nonzero_days >= 5 ORDER BY total_incidents DESC, grid_id LIMIT 50")
cte("scored_raw", """
SELECT t.*, round(coalesce(h.score, 0), 6) + 0.0 AS hotspot_prob, CAST(coalesce(h.score, 0) >= (SELECT threshold FROM hotspot_limit) AS INTEGER) AS hotspot_pred,
  round(coalesce(r.rate, 0), 6) + 0.0 AS arima_forecast,
  round(least(1.0, CAST(0.05 AS DOUBLE) + CAST(0.1 AS DOUBLE) * lag_1 + CAST(0.06 AS DOUBLE) * rolling_sum_7
    + CAST(0.03 AS DOUBLE) * rolling_sum_14 + CAST(0.02 AS DOUBLE) * is_weekend), 6) + 0.0 AS rf_prob
FROM test t LEFT JOIN hotspot h USING (grid_id) LEFT JOIN rates r USING (grid_id)
""")
cte("scored", """
SELECT * EXCLUDE rf_prob, round(arima_forecast / (max(arima_forecast) OVER () + 1e-12), 6) + 0.0 AS arima_prob,
  CAST(arima_forecast >= 0.1 AS INTEGER) AS arima_pred, rf_prob, CAST(rf_prob >= 0.5 AS INTEGER) AS rf_pred
FROM scored_raw
""")
cte("long", "\nUNION ALL\n".join(
    f"SELECT '{m}' AS \"Model\", target_next_interval AS y, {a} AS pred, {b} AS prob FROM scored"
    for m, (a, b) in fixed.MODELS.items()))
cte("confusion", """
SELECT "Model", CAST(count(*) FILTER (y = 0 AND pred = 0) AS BIGINT) AS tn, CAST(count(*) FILTER (y = 0 AND pred = 1) AS BIGINT) AS fp,
  CAST(count(*) FILTER (y = 1 AND pred = 0) AS BIGINT) AS fn, CAST(count(*) FILTER (y = 1 AND pred = 1) AS BIGINT) AS tp
FROM long GROUP BY "Model"
""")
cte("metrics", """
SELECT "Model", CAST((tp + tn) AS DOUBLE) / (tp + tn + fp + fn) AS "Accuracy", coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS "Precision",
  coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS "Recall", coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS "F1-Score" FROM confusion
""")
cte("steps", """
SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg, lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg,
  row_number() OVER w AS rn, sum(pos) OVER (PARTITION BY "Model") AS p, sum(neg) OVER (PARTITION BY "Model") AS n
FROM (SELECT "Model", prob, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg FROM long GROUP BY "Model", prob)
WINDOW w AS (PARTITION BY "Model" ORDER BY prob DESC)
""")
cte("areas", """
SELECT "Model", sum(neg * (cum_pos - pos / 2)) / nullif(max(p) * max(n), 0) AS "ROC-AUC",
  coalesce(sum(pos * cum_pos / (cum_pos + cum_neg)) / nullif(max(p), 0), 0) AS "PR-AUC" FROM steps GROUP BY "Model"
""")
cte("evaluation", 'SELECT m.*, a."ROC-AUC", a."PR-AUC" FROM metrics m JOIN areas a USING ("Model")')
cte("report_rows", """
SELECT *, CAST(tn + fp + fn + tp AS DOUBLE) AS n,
  coalesce(CAST(tn AS DOUBLE) / nullif(tn + fn, 0), 0) AS p0, coalesce(CAST(tn AS DOUBLE) / nullif(tn + fp, 0), 0) AS r0,
  coalesce(2.0 * tn / nullif(2 * tn + fn + fp, 0), 0) AS f0, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS p1,
  coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS r1, coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1
FROM confusion
""")

# --- contributions and texts -------------------------------------------------------------
_base = "CAST(day(date) AS BIGINT) * 7 + length(grid_id) * 13 + incident_count * 5"
_labels = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fixed.DRIVER_LABELS.items())


def label_sql(name: str) -> str:
    return f"CASE {name} {_labels} ELSE replace({name}, '_', ' ') END"


cte("contributions", "SELECT grid_id, date, rf_prob, " + ", ".join(
    f"(({_base} + {11 * i}) % 41 - 20) / CAST(100.0 AS DOUBLE) AS {f}_shap" for i, f in enumerate(fixed.MODEL_FEATURES)) + " FROM scored")
cte("drivers_long", "\nUNION ALL\n".join(
    f"SELECT grid_id, date, rf_prob, {i} AS place, '{f}' AS feature, {f}_shap AS shap FROM contributions"
    for i, f in enumerate(fixed.MODEL_FEATURES)))
cte("drivers", "SELECT grid_id, date, max(rf_prob) AS rf_prob, " + ", ".join(
    f"max(feature) FILTER (rn = {k}) AS top_driver_{k}, max(shap) FILTER (rn = {k}) AS top_driver_{k}_shap" for k in (1, 2, 3)) + """
FROM (SELECT *, row_number() OVER (PARTITION BY grid_id, date ORDER BY abs(shap) DESC, place) AS rn FROM drivers_long)
GROUP BY grid_id, date""")


def phrase_sql(k: int) -> str:
    return f"{label_sql(f'top_driver_{k}')} || ' (' || CASE WHEN top_driver_{k}_shap > 0 THEN 'increases' ELSE 'decreases' END || ' risk)'"


cte("texts", f"""
SELECT *, CASE WHEN rf_prob >= 0.5 THEN 'Risk is elevated mainly because ' ELSE 'Risk remains lower mainly because ' END
  || {phrase_sql(1)} || ', ' || {phrase_sql(2)} || ', and ' || {phrase_sql(3)} || '.' AS explanation_text FROM drivers
""")
cte("explanation_rows", r"""
SELECT grid_id, date, CAST(date_diff('day', DATE '2024-01-01', date) * 10000000 + CAST(regexp_extract(grid_id, 'r(\d+)_c', 1) AS BIGINT) * 1000
    + CAST(regexp_extract(grid_id, '_c(\d+)', 1) AS BIGINT) + v * 5000000 AS BIGINT) AS position,
  CASE WHEN v = 1 THEN 'later: ' ELSE '' END || explanation_text AS explanation_text
FROM texts CROSS JOIN (SELECT 0 AS v UNION ALL SELECT 1)
""")
