"""Split CSV, dates in all spellings, rejected rows, blocks of the grid, scored rows by date."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cellcast import fixed
from cellcast.operators import clean, grid
from cellcast.session import discard, staged
from cellcast.sources import tables as files

D = dt.date


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture
def small_ranges(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set(key, before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def quoted(v):
    return '"' + v.replace('"', '""') + '"'


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_csv_with_line_breaks_is_split(spark, tmp_path, small_ranges, ending, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(files, "ODD_RANGES", -1)
    rng = random.Random(3)
    words = ["plain", 'say "hi"', "two\nlines", "a,b", "\n\n", "é", "", 'end"', "x" * 300, "y\n" * 3000]
    rows = [(str(i), rng.choice(words), rng.choice(words[:7])) for i in range(900)]
    for part in (0, 1):
        text = ending.join(["id,first name,note", *(f"{a},{quoted(b)},{quoted(c)}" for a, b, c in rows[part::2])]) + ending
        (tmp_path / "t.csv").mkdir(exist_ok=True)
        (tmp_path / "t.csv" / f"{part}.csv").write_text(text, newline="")
    path = str(tmp_path / "t.csv")
    got = files.read_table(spark, path)
    assert got.columns == ["id", "first name", "note"] and (not broadcast or got.rdd.getNumPartitions() > 20)
    whole = files.read_table(spark, path, multi_line=True)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr) and whole.count() == 900
    assert {r[0]: r[1] for r in got.collect()} == {a: b or None for a, b, _ in rows}


def test_csv_without_breaks_or_with_unpaired_quotes(spark, tmp_path, small_ranges):
    plain, bad = tmp_path / "a.csv", tmp_path / "b.csv"
    plain.write_text("a,b\n" + '1,"x, ""y"""\n' * 2000)
    got = files.read_table(spark, str(plain))
    assert got.rdd.getNumPartitions() > 5 and got.distinct().collect() == [("1", 'x, "y"')] and got.count() == 2000
    bad.write_text('a,b\n1,5" pipe\n2,ok\n3,"two\nlines"\n')
    assert files.read_table(spark, str(bad)).collect() == files.read_table(spark, str(bad), multi_line=True).collect()
    (tmp_path / "c.csv").write_text("a,b\n")
    assert files.read_table(spark, str(tmp_path / "c.csv")).collect() == []


def test_dates_in_many_spellings(spark):
    texts = {
        "2024-01-01T05:00:00+00:00": D(2024, 1, 1), "2024-01-01 23:30:00-05:00": D(2024, 1, 1), "2024-01-01T23:30:00.123456+0530": D(2024, 1, 1),
        "2024-01-01 23:30 Z": D(2024, 1, 1), "5 Jan 2024": D(2024, 1, 5), "05-JAN-2024": D(2024, 1, 5), "Jan 5, 2024 7:05": D(2024, 1, 5),
        "January 5, 2024": D(2024, 1, 5), "5 May 2024 10:00:00": D(2024, 5, 5), "1/5/2024 11:59:59 PM": D(2024, 1, 5), "1704412800000": D(2024, 1, 5),
        "1704412800": D(2024, 1, 5), "1704499199999999": D(2024, 1, 5), "1704499199999999999": D(2024, 1, 5), "315532800000": D(1980, 1, 1),
        "20240105": D(2024, 1, 5), "170441280000": D(1975, 5, 27), "12345": None, "17044128000001": None, "5 Foo 2024": None, "2024-13-01T00:00:00+00:00": None,
        "-1704412800000": None, "": None, "12:30:00+01:00": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.date for r in clean.coerce_event_date(df, "t").collect()} == texts
    numbers = spark.createDataFrame([(1704412800000, 1704412800.0), (20240105, 20240105.0), (None, float("nan")), (7, 1e30)], "t bigint, u double")
    assert [r.date for r in clean.coerce_event_date(numbers, "t").collect()] == [D(2024, 1, 5), D(2024, 1, 5), None, None]
    assert [r.date for r in clean.coerce_event_date(numbers, "u").collect()] == [D(2024, 1, 5), D(2024, 1, 5), None, None]


def test_rejects_add_up(spark):
    rows = [("A", "2024-01-01", "1", "2", "fire"), ("B", "x", "x", "x", "x"), (None, "2024-01-01", "1", "2", "fire"), ("a ", "soon", "1", "2", "fire"),
            ("A", None, "1", "2", "111"), ("A", "2024-01-01", None, "2", "111"), ("A", "2024-01-01", "91", "2", "111"), ("A", "2024-01-01", "NaN", "2", "111"),
            ("A", "2024-01-01", "1", "2", None), ("A", "2024-01-01", "1", "2", "321"), ("A", "5 Jan 2024", "-90", "180", "150")]
    df = spark.createDataFrame(rows, "city string, date string, latitude string, longitude string, inc_type string")
    options = {"fields": ["city"], "values": ["a"]}
    counts = {r.reason: r.n for r in clean.reject_counts(df, **options).collect()}
    assert counts == dict(zip([*fixed.REJECT_REASONS, "kept"], [2, 2, 2, 1, 2, 2])) and sum(counts.values()) == len(rows)
    judged = clean.judged_incidents(df, **options)
    kept = judged.filter("reject_reason IS NULL").drop("reject_reason")
    assert sorted(map(str, kept.collect())) == sorted(map(str, clean.valid_incidents(df, **options).collect()))
    assert {r.n for r in clean.reject_counts(df.limit(0)).collect()} == {0}


def test_dedupe_is_a_hash_aggregate_and_a_semi_join(spark):
    rows = spark.range(5000).select(F.lit("GA").alias("state"), (F.col("id") % 7).cast("string").alias("inc_no"), F.col("id").alias("_row_id"), F.col("id").cast("string").alias("note"))
    out = clean.dedupe_incidents(rows)
    assert "SortAggregate" not in plan(out) and "HashAggregate" in plan(out) and "LeftSemi" in plan(out)
    assert sorted(r.note for r in out.collect()) == [str(i) for i in range(7)]


@pytest.mark.parametrize("rows,cols", [(1, 100_000), (100_000, 1), (300, 301), (1, 1)])
def test_long_grids_are_spread(spark, rows, cols):
    extent = spark.createDataFrame([(0.0, 0.0, 1.0, 1.0, cols, rows)], "minx double, miny double, maxx double, maxy double, n_cols int, n_rows int")
    cells = grid.generate_grid(extent)
    parts = [r["n"] for r in cells.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(parts) == rows * cols == cells.select("cell_row", "cell_col").distinct().count()
    assert rows * cols < 2 or (len(parts) == 8 and max(parts) < 4 * rows * cols / 8)


def test_staged_rows_by_date_are_pruned_and_released(spark):
    rows = spark.range(90).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("date"), F.col("id").alias("x"))
    kept = staged(rows.select("date", "x"), "by-date", ["date"])
    day = kept.filter("date = date'2024-01-02'")
    assert kept.columns == ["date", "x"] and day.count() == 30
    assert "PartitionFilters: [isnotnull(date" in plan(day)
    gone = staged(rows, "gone")
    discard(gone, rows)
    with pytest.raises(Exception):
        gone.count()
