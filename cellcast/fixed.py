"""Words, names and numbers that decide the results and must not be changed."""

# --- Fixed values: column names recognised per incident role, best first -----------------
INCIDENT_NAMES = {
    "date": [
        "incident_date", "inc_date", "incident_datetime", "alarm_datetime", "alarm_time",
        "date", "datetime", "incident_dt", "dispatch_date",
    ],
    "lat": ["latitude", "lat", "y", "ycoord", "incident_latitude"],
    "lon": ["longitude", "lon", "lng", "x", "xcoord", "incident_longitude"],
    "type": ["incident_type", "inc_type", "type", "incidenttype"],
}
INCIDENT_SUBSTRINGS = {
    "date": ["incidentdate", "alarmdate", "datetime"],
    "lat": ["latitude", "lat"],
    "lon": ["longitude", "long", "lon", "lng"],
    "type": ["incidenttype", "inctype", "basicmoduleactiontaken"],
}
LOCATION_NAMES = [
    "city", "state", "state_id", "county", "jurisdiction", "zipcode", "zip", "fdid", "departmentid",
]

# --- Fixed values: column names recognised per weather role, best first ------------------
WEATHER_NAMES = {
    "date": ["date", "weather_date", "observation_date"],
    "temperature": ["temperature", "temp", "tavg", "tmean"],
    "humidity": ["humidity", "relative_humidity"],
    "precipitation": ["precipitation", "precip", "prcp", "rain"],
    "wind": ["wind", "wind_speed", "avg_wind_speed", "awnd"],
}
WEATHER_SUBSTRINGS = {
    "date": ["date"],
    "temperature": ["temp"],
    "humidity": ["humidity"],
    "precipitation": ["precip", "prcp", "rain"],
    "wind": ["wind"],
}
WEATHER_METRICS = ["temperature", "humidity", "precipitation", "wind"]

# --- Fixed values: response fields of the daily weather archive --------------------------
WEATHER_RESPONSE_FIELDS = {
    "time": "date",
    "temperature_2m_mean": "temperature",
    "relative_humidity_2m_mean": "humidity",
    "precipitation_sum": "precipitation",
    "wind_speed_10m_max": "wind",
}

# --- Fixed values: incident identity used to recognise repeated reports ------------------
IDENTITY_NAMES = [
    "state", "state_id", "fdid", "incident_number", "incidentno", "inc_no",
    "exposure_number", "exp_no", "date", "latitude", "longitude",
]

# --- Fixed values: fire codes and extract predicate --------------------------------------
FIRE_CODE_RANGE = (100, 199)
FIRE_WORD = "fire"
EXTRACT_AID_CODES = ["1", "2", "N"]
EXTRACT_TYPE_FROM, EXTRACT_TYPE_BELOW = "100", "200"
EXTRACT_FIELDS = [
    "INCIDENT_KEY", "STATE", "FDID", "FD_NAME", "INC_DATE", "INC_NO", "EXP_NO", "CITY", "STATE_ID",
    "ZIP5", "INC_TYPE", "AID", "ALARM", "ARRIVAL", "LU_CLEAR", "PROP_USE", "FIRE_CAUSE", "Status",
    "Score", "Match_Addr", "Addr_type",
]

# --- Fixed values: date and time texts understood, tried in this order -------------------
DATE_FORMATS = [
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]['Z']",
    "yyyy-MM-dd HH:mm[:ss[.SSSSSS][.SSS]]",
    "yyyy/MM/dd[ HH:mm:ss]",
    "M/d/yyyy[ H:mm[:ss]]",
    "yyyyMMdd",
    "M/d/yyyy h:mm[:ss] a",
    "d MMM yyyy[ H:mm[:ss]]",
    "d-MMM-yyyy[ H:mm[:ss]]",
    "MMM d, yyyy[ H:mm[:ss]]",
    "d MMMM yyyy[ H:mm[:ss]]",
    "MMMM d, yyyy[ H:mm[:ss]]",
]
# Digits of a number of seconds since 1970, and of the finer units' numbers, from 1973 on.
EPOCH_DIGITS = {1: (9, 10), 1_000: (12, 13), 1_000_000: (15, 16), 1_000_000_000: (18, 19)}

# --- Fixed values: why a raw incident is left out, in the order of the checks ------------
REJECT_REASONS = ["other place", "no date", "no coordinates", "coordinates out of range", "not a fire"]

# --- Fixed values: features, horizons and model settings ---------------------------------
LAGS = [1, 3, 7]
ROLLING_DAYS = [7, 14]
FEATURES = [
    "temperature", "humidity", "precipitation", "wind", "day_of_week", "month", "is_weekend",
    "is_holiday", "lag_1", "lag_3", "lag_7", "rolling_sum_7", "rolling_sum_14",
]
CELL_CODE = "grid_id_enc"
MODEL_FEATURES = FEATURES + [CELL_CODE]
TARGET = "target_next_interval"
TRAIN_FRACTION = 0.8
SEED = 42
FOREST = {"trees": 300, "depth": 15, "min_leaf": 10}
ARIMA = {"min_nonzero_days": 5, "max_cells": 50, "p": [0, 1, 2], "d": [0, 1], "q": [0, 1, 2], "alarm": 0.1}
THRESHOLD_STEP, THRESHOLD_COUNT, THRESHOLD_DEFAULT = 0.01, 98, 0.5
SCALE_EPSILON = 1e-12

# --- Fixed values: model names and their prediction / score columns ----------------------
MODELS = {
    "Historical Hotspot": ("hotspot_pred", "hotspot_prob"),
    "ARIMA": ("arima_pred", "arima_prob"),
    "Random Forest": ("rf_pred", "rf_prob"),
}
METRICS = ["Accuracy", "Precision", "Recall", "F1-Score", "ROC-AUC", "PR-AUC"]
CHART_METRICS = ["Precision", "Recall", "F1-Score", "ROC-AUC", "PR-AUC"]
CLASS_LABELS = ["No Fire", "Fire"]

# --- Fixed values: wording of explanations -----------------------------------------------
DRIVER_LABELS = {
    "grid_id_enc": "location history",
    "rolling_sum_14": "recent 14-period activity",
    "rolling_sum_7": "recent 7-period activity",
    "lag_1": "last-period incidents",
    "lag_3": "3-period lag activity",
    "lag_7": "7-period lag activity",
    "day_of_week": "day of week",
    "is_weekend": "weekend timing",
    "is_holiday": "holiday timing",
}
TEXT_UP, TEXT_DOWN = "increases", "decreases"
TEXT_ELEVATED = "Risk is elevated mainly because "
TEXT_LOWER = "Risk remains lower mainly because "
EXPLAIN_SETTINGS = {"high": 50, "mid": 25, "low": 25, "low_pool": 200, "band": (0.40, 0.60)}

# --- Fixed values: read views ------------------------------------------------------------
SNAPSHOT_FIELDS = [
    "date", "incident_count", "temperature", "humidity", "precipitation", "wind", "rolling_sum_7",
    "rolling_sum_14", "rf_prob", "rf_pred", "hotspot_prob", "arima_prob", "arima_pred",
]
SERIES_METRICS = {"rf_prob": "RF", "hotspot_prob": "Hotspot", "arima_prob": "ARIMA"}
HISTOGRAM_BINS = 14
