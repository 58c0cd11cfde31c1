"""Whole jobs: row counts per step, plan shapes, the batch job, and agreement with SQL."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from cellcast.operators import clean, daily
from cellcast.plans import tables
from checks import compare, registry, views

DATA = "/root/testdata"
MODEL_ONLY = {"arima_grid_forecast", "arima_fit_predict", "rf_train", "rf_fit_predict", "rf_importance", "tree_shap",
              "explain_predictions", "score_pipeline"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("sf,want", [
    ("sf0.001", (1020, 820, 795, 217, 208, (15, 1), 15, 450, 435, 164)),
    ("sf0.01", (10200, 8200, 7946, 2152, 2053, (16, 10), 150, 4500, 4350, 1554)),
    ("sf0.1", (102000, 82000, 79469, 21579, 20598, (17, 94), 1502, 45060, 43558, 15935)),
])
def test_counts_per_step(spark, sf, want):
    d = f"{DATA}/{sf}"
    raw = views.kept(spark, d, "incidents")
    chosen = clean.filter_field_values(raw, ["city"], ["Atlanta"])
    typed = clean.coerce_event_date(clean.coerce_coordinates(chosen, "latitude", "longitude"), "inc_date")
    located = views.kept(spark, d, "located")
    extent = tables.located_incidents(raw, **views.CITY)[1].extent_row.first()
    model = views.kept(spark, d, "model")
    days = tables.cell_day_table(raw, views.kept(spark, d, "weather"), **views.CITY)
    got = (raw.count(), chosen.count(), clean.filter_valid_coords(typed).count(), registry.valid(spark, d).count(), located.count(),
           (extent.n_rows, extent.n_cols), located.select("grid_id").distinct().count(), days.count(), model.count(),
           model.filter("target_next_interval = 1").count())
    assert got == want
    assert len(model.columns) == 18


def test_raw_rows_are_parsed_once(spark):
    d = f"{DATA}/sf0.001"
    raw = views.kept(spark, d, "incidents")
    days = tables.cell_day_table(raw, views.kept(spark, d, "weather"), **views.CITY)
    located, _ = tables.located_incidents(raw, **views.CITY)
    files = {f.rsplit("/", 2)[-2] for f in days.inputFiles()}
    assert not files & {f.rsplit("/", 2)[-2] for f in raw.inputFiles()} and any(f.startswith("valid-incidents") for f in files)
    want = located.groupBy("grid_id", "date").count()
    got = days.filter("incident_count > 0").selectExpr("grid_id", "date", "cast(incident_count as bigint)")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_located_and_cells_parse_raw_rows_once(spark, monkeypatch):
    """Bounds, extent and rows are read from one staged table of the valid rows, not from the raw ones."""
    d = f"{DATA}/sf0.001"
    raw = {f.rsplit("/", 2)[-2] for f in views.kept(spark, d, "incidents").inputFiles()}
    built = []
    real = tables.located_incidents
    monkeypatch.setattr(views.tables, "located_incidents", lambda *a, **k: built.append(real(*a, **k)) or built[-1])
    views.located(spark, d)
    views.cells(spark, d)
    for rows, frame in built:
        files = {f.rsplit("/", 2)[-2] for df in (rows, frame.extent_row) for f in df.inputFiles()}
        assert not files & raw and files and all(f.startswith("valid-incidents") for f in files)
    assert len(built) == 2 and set(views.kept(spark, d, "incidents").columns) <= set(built[0][0].columns)


def test_dates_are_read_after_the_other_filters(spark):
    """A date is read of chosen fire reports only, and events are dealt out before they are read."""
    d = f"{DATA}/sf0.001"
    text = clean.valid_incidents(views.kept(spark, d, "incidents"), **views.CITY)._jdf.queryExecution().optimizedPlan().toString()
    condition = text[text.index("+- Filter"):]
    assert condition.index("lower(inc_type") < condition.index("gettimestamp")
    text = plan(views.raw_incidents(spark, d))
    assert text.index("get_json_object") < text.index("RoundRobinPartitioning") < text.index("FileScan parquet")


def test_windows_share_one_exchange_by_cell(spark):
    located = views.kept(spark, f"{DATA}/sf0.01", "located")
    text = plan(daily.build_cell_days(located, clean.clean_weather(views.kept(spark, f"{DATA}/sf0.01", "weather"))))
    # One shuffle folds the counts, one places them by cell; filling, lags, sums and leads need no more.
    assert text.count("Exchange hashpartitioning(grid_id") == 2
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["model_table", "hotspot_kde", "best_f1_threshold", "evaluate_models", "roc_points", "quantile_band",
                                  "day_histogram", "densify_cell_day", "nearest_date", "split_temporal", "stamp_cell_metric"])
def test_no_products_are_planned(spark, name):
    text = plan(registry.QUERIES[name](spark, f"{DATA}/sf0.01"))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_extract_filter_reaches_the_scan(spark):
    from cellcast.session import staged
    from cellcast.sources.tables import extract_predicate

    source = staged(views.extract_source(spark, f"{DATA}/sf0.001"), "extract")
    text = plan(extract_predicate(source, "GA", "Atlanta").select("FDID"))
    for pushed in ("EqualTo(STATE_ID,GA)", "EqualTo(CITY,Atlanta)", "In(AID, [1,2,N])", "GreaterThanOrEqual(INC_TYPE,100)", "LessThan(INC_TYPE,200)"):
        assert pushed in text
    assert "FD_NAME" not in text.split("ReadSchema")[1]


def test_view_of_one_day_reads_its_partition_only(spark, tmp_path):
    rows = views.kept(spark, f"{DATA}/sf0.01", "scored")
    rows.write.partitionBy("date").parquet(str(tmp_path / "scored"))
    from cellcast.operators.views import day_layer

    by_day = spark.read.parquet(str(tmp_path / "scored"))
    text = plan(day_layer(rows.select("grid_id").distinct(), by_day, "rf_prob", F.lit("2024-01-29").cast("date")))
    assert "PartitionFilters: [isnotnull(date" in text


def test_dedupe_folds_copies_before_the_shuffle(spark):
    copies = spark.range(200000).select(F.lit("GA").alias("state"), F.lit(1).alias("inc_no"), F.col("id").alias("_row_id"), F.lit("x").alias("note"))
    out = clean.dedupe_incidents(copies)
    assert "Window" not in plan(out)
    assert out.collect() == [("GA", 1, 0, "x")]


def test_batch_job_writes_all_products(spark, tmp_path):
    d, out = f"{DATA}/sf0.01", str(tmp_path / "out")
    raw, weather = views.kept(spark, d, "incidents"), views.kept(spark, d, "weather")
    got = tables.build_tables(raw, weather, out, **views.CITY)
    assert (got.incidents.count(), got.cells.count(), got.cell_days.count(), got.model.count()) == (2053, 160, 4500, 4350)
    assert {"latitude", "longitude", "date", "cell_col", "cell_row", "grid_id"} <= set(got.incidents.columns)
    lazy = registry.tidy(tables.model_table(raw, weather, **views.CITY))
    assert registry.tidy(got.model).select(lazy.columns).exceptAll(lazy).count() == 0
    for name in ("incidents_clean.parquet", "grid_cells.geojsonl", "cell_day_table.parquet", "model_table.parquet"):
        assert (tmp_path / "out" / name).is_dir()


def test_one_cell_with_a_third_of_all_incidents(spark):
    """A hot cell, a hot day and a hot report change nothing but the counts."""
    base = [("a", 0, i) for i in range(6)] + [("b", i, i) for i in range(4)]
    rows = spark.createDataFrame(base, "grid_id string, d int, n int").select(
        "grid_id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")).alias("date"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("grid_id") == "a", 500).otherwise(1))).alias("i"))
    counts = {(r.grid_id, r.date.day): r.incident_count for r in daily.densify_cell_day(daily.count_cell_day(rows)).collect()}
    assert counts == {("a", 1): 3000, ("a", 2): 0, ("a", 3): 0, ("a", 4): 0, **{("b", i): 1 for i in range(1, 5)}}


def test_every_listed_query_has_its_sql():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(registry.QUERIES) - set(registry.ORACLES) == MODEL_ONLY


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() == 435 and df.columns[:3] == ["grid_id", "date", "incident_count"]


@pytest.fixture(scope="module")
def duck():
    return compare.connect(f"{DATA}/sf0.01")


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_agrees_with_sql(spark, duck, name):
    got = compare.compare(spark, duck, registry.QUERIES[name], registry.ORACLES[name], f"{DATA}/sf0.01")
    assert got["ok"], got
