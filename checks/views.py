"""Incident and weather inputs derived from the ``events`` table. SQL twins are in checks/sql.py."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from cellcast import fixed
from cellcast.operators import aggregates, explain, forest, grid, hotspot, sampling, shapley
from cellcast.operators.clean import ROW_ID
from cellcast.plans import scoring, tables
from cellcast.session import staged


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dealt out before they are read into reports: a file of few row groups has few tasks, and events are narrower."""
    return table(spark, sf_dir, "events").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


def raw_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incident reports as text, with bad dates, bad coordinates, mixed case and repeated reports."""
    ev = events(spark, sf_dir)
    eid, uid = F.col("event_id"), F.col("user_id")
    k = F.get_json_object("props", "$.k").cast("int")
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    lat = F.lit(33.65) + F.lit(0.009) * (uid % 16) + F.lit(0.0001) * (eid % 7)
    lon = F.lit(-85.5) + F.lit(0.0108) * F.floor(uid / 16) + F.lit(0.0001) * (eid % 11)
    kind = F.when((F.col("event_type") == "error") & (k % 10 == 0), "Fire, other").otherwise(F.col("event_type"))
    code = 100 * (1 + eid % 4) + k
    # Repeated reports are unfolded from the same scan.
    copy = F.explode(F.when(eid % 50 == 4, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))))
    base = ev.select("*", copy.alias("is_copy"))
    again = F.col("is_copy")
    return base.select(
        F.when(again, eid + 10000000).otherwise(eid).alias("row_id"),
        F.when(again | (eid % 5 != 0), " ATLANTA ").otherwise("Macon").alias("city"),
        F.lit("GA").alias("state_id"),
        (uid + 1000).cast("string").alias("fdid"),
        eid.alias("inc_no"),
        F.when(~again & (eid % 101 == 0), "n/a").otherwise(stamp).alias("inc_date"),
        F.when(eid % 97 == 0, "95.5").when(eid % 89 == 0, "bad").otherwise(lat.cast("string")).alias("latitude"),
        lon.cast("string").alias("longitude"),
        F.concat_ws(" ", code.cast("string"), kind).alias("inc_type"),
    )


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per event; 15 January is missing."""
    ev = table(spark, sf_dir, "events")
    kinds = {"temperature": "view", "humidity": "click", "precipitation": "signup", "wind": "purchase"}
    day = F.col("ts").cast("date")
    return ev.filter(day != F.lit("2024-01-15").cast("date")).select(
        day.alias("date"),
        *[F.when(F.col("event_type") == kind, F.col("value")).alias(metric) for metric, kind in kinds.items()],
    )


# The raw inputs are tables at rest, as they are in life: each is written once per session to the
# shared folder, evenly split, and every query reads it from there. So is the model table, which is
# the product that the model and view queries start from.
@cache
def _kept(spark: SparkSession, app: str, sf_dir: str, name: str) -> DataFrame:
    if name == "incidents":
        rows = raw_incidents(spark, sf_dir).withColumn(ROW_ID, F.col("row_id"))
    elif name == "weather":
        # The order of the readings decides the last bits of their means, so it stays as it was.
        rows = raw_weather(spark, sf_dir).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    else:
        return staged(_BUILD[name](spark, sf_dir), name)
    return staged(rows, name)


def kept(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _kept(spark, spark.sparkContext.applicationId, sf_dir, name)


CITY = {"fields": ["city"], "values": ["Atlanta"]}
_BUILD = {
    "model": lambda spark, d: tables.model_table(kept(spark, d, "incidents"), kept(spark, d, "weather"), **CITY),
}


def extract_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide incident extract before its filter: every field the extract asks for, plus OBJECTID."""
    raw = kept(spark, sf_dir, "incidents")
    rid = F.col("row_id")
    values = {
        "INCIDENT_KEY": F.concat(F.lit("K"), rid.cast("string")), "STATE": F.col("state_id"), "FDID": F.col("fdid"),
        "INC_DATE": F.col("inc_date"), "INC_NO": F.col("inc_no").cast("string"), "EXP_NO": F.lit("0"),
        "CITY": F.initcap(F.trim("city")), "STATE_ID": F.col("state_id"), "INC_TYPE": F.left("inc_type", F.lit(3)),
        "AID": F.get(F.array(*[F.lit(a) for a in ("1", "2", "3", "N")]), (rid % 4).cast("int")),
    }
    blank = F.lit(None).cast("string")
    return raw.select(*[values.get(f, blank).alias(f) for f in fixed.EXTRACT_FIELDS], rid.alias("OBJECTID"))


def scored_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored test rows whose every score SQL can repeat: the density hotspot, the historical rate in the
    place of forecasts, and a fixed linear score in the place of the forest."""
    train, test = scoring.split_model_table(kept(spark, sf_dir, "model"))
    rows = scoring.score_hotspot(train, test, kept(spark, sf_dir, "centroids"))
    rows = rows.withColumn("hotspot_prob", F.round("hotspot_prob", 6) + 0.0)
    rows = rows.drop("arima_forecast").join(aggregates.historical_rate(train), "grid_id", "left")
    rows = rows.withColumn("arima_forecast", F.round(F.coalesce("rate", F.lit(0.0)), 6) + 0.0).drop("rate")
    rows = aggregates.normalize_max(rows, "arima_forecast", "arima_prob")
    rows = rows.withColumn("arima_prob", F.round("arima_prob", 6) + 0.0)
    rows = rows.withColumn("arima_pred", (F.col("arima_forecast") >= 0.1).cast("int"))
    linear = 0.05 + 0.1 * F.col("lag_1") + 0.06 * F.col("rolling_sum_7") + 0.03 * F.col("rolling_sum_14") + 0.02 * F.col("is_weekend")
    rows = rows.withColumn("rf_prob", F.round(F.least(F.lit(1.0), linear), 6) + 0.0)
    return rows.withColumn("rf_pred", (F.col("rf_prob") >= 0.5).cast("int"))


def contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows with made contributions (many ties), for the steps that only read contributions."""
    rows = kept(spark, sf_dir, "scored")
    base = F.dayofmonth("date") * 7 + F.length("grid_id") * 13 + F.col("incident_count") * 5
    made = [(((base + 11 * i) % 41 - 20) / F.lit(100.0)).alias(f"{f}_shap") for i, f in enumerate(fixed.MODEL_FEATURES)]
    return rows.select("grid_id", "date", "rf_prob", *made)


def contributions_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The made contributions in long form, with a made base value and feature values of twice the contribution."""
    rows = contributions(spark, sf_dir).withColumn("base_value", F.lit(0.25))
    return shapley.contributions_long(rows.withColumns({f: 2 * F.col(f"{f}_shap") for f in fixed.MODEL_FEATURES}))


def explanations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explained rows in two versions; the later version of a (cell, date) must lose."""
    rows = explain.explanation_text(sampling.topk_drivers(contributions(spark, sf_dir)))
    cell = F.regexp_extract("grid_id", r"r(\d+)_c", 1).cast("bigint") * 1000 + F.regexp_extract("grid_id", r"_c(\d+)", 1).cast("bigint")
    first = F.datediff("date", F.lit("2024-01-01").cast("date")) * F.lit(10000000) + cell
    version = F.explode(F.array(F.lit(0), F.lit(1)))
    return rows.select("grid_id", "date", "explanation_text", first.alias("first"), version.alias("version")).select(
        "grid_id", "date",
        (F.col("first") + F.col("version") * F.lit(5000000)).alias("position"),
        F.when(F.col("version") == 1, F.concat(F.lit("later: "), "explanation_text")).otherwise(F.col("explanation_text")).alias("explanation_text"),
    )


def located(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = kept(spark, sf_dir, "incidents")
    return tables.located_incidents(raw, only=raw.columns, **CITY)[0]


_BUILD.update({
    "located": located,
    "centroids": lambda spark, d: grid.cell_centroids(cells(spark, d)),
    "scored": scored_test,
    "hotspot": lambda spark, d: hotspot.hotspot_kde(scoring.split_model_table(kept(spark, d, "model"))[0], kept(spark, d, "centroids")),
})


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, frame = tables.located_incidents(kept(spark, sf_dir, "incidents"), only=[], **CITY)
    return tables.grid_cells(frame)


@cache
def _fitted(spark: SparkSession, app: str, sf_dir: str) -> forest.Forest:
    return forest.train_forest(scoring.split_model_table(kept(spark, sf_dir, "model"))[0])


def fitted(spark: SparkSession, sf_dir: str) -> forest.Forest:
    """The forest is trained once per session; all its readers share it."""
    return _fitted(spark, spark.sparkContext.applicationId, sf_dir)
