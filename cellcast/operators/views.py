"""Read queries of the map and its side panels. Each takes the whole scored table; a date or cell only
narrows it, and with the table laid out by date that becomes partition pruning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cellcast import fixed
from cellcast.functions.text import to_number
from cellcast.operators.grid import scalar


def last_date(scored: DataFrame) -> Column:
    """The date shown first."""
    return scored.agg(F.max("date").alias("date")).scalar()


def stamp_cell_metric(cells: DataFrame, scores: DataFrame) -> DataFrame:
    """Score on every grid cell: missing is 0, rounded half-even to 4 digits."""
    joined = cells.join(scores.select("grid_id", "score"), "grid_id", "left")
    return joined.select(*cells.columns, F.bround(F.coalesce("score", F.lit(0.0)), 4).alias("risk"))


def day_layer(cells: DataFrame, scored: DataFrame, metric: str, date: Column) -> DataFrame:
    """One day's metric on every grid cell; cells without a value are flagged."""
    day = scored.filter(F.col("date") == date).select("grid_id", F.col(metric).cast("double").alias("value"))
    return cells.join(day, "grid_id", "left").select("grid_id", "value", F.col("value").isNull().alias("no_data"))


def actual_vs_predicted_day(cells: DataFrame, scored: DataFrame, date: Column, predicted: str = "rf_pred") -> DataFrame:
    day = scored.filter(F.col("date") == date).select(
        "grid_id", F.col(fixed.TARGET).alias("_actual"), F.col(predicted).alias("_predicted")
    )
    return cells.join(day, "grid_id", "left").select(
        "grid_id", F.coalesce("_actual", F.lit(0)).alias("actual"), F.coalesce("_predicted", F.lit(0)).alias("predicted")
    )


def nearest_date(probes: DataFrame, dates: Column, probe: str = "date") -> DataFrame:
    """Nearest modelled date per probe, the earlier one on ties.

    ``dates`` is the array subquery of modelled dates. The search runs once per distinct probe date; both
    are bounded by the calendar, so the answers are broadcast back onto the probes.
    """
    apart = F.transform("_dates", lambda d: F.struct(F.abs(F.datediff(d, F.col(probe))).alias("days"), d.alias("date")))
    answers = probes.select(probe).distinct().withColumn("_dates", dates)
    answers = answers.select(probe, F.array_min(apart)["date"].alias("nearest"))
    return probes.join(F.broadcast(answers), probe, "left").select(*probes.columns, "nearest")


def cell_snapshot(scored: DataFrame, grid_id: str | None = None, date: Column | None = None) -> DataFrame:
    """Snapshot fields of each (cell, day) as field / text rows; blank ones are left out, numbers get 2 digits."""
    if grid_id is not None:
        scored = scored.filter(F.col("grid_id") == grid_id)
    if date is not None:
        scored = scored.filter(F.col("date") == date)
    kinds = dict(scored.dtypes)

    def text(field: str) -> Column:
        if kinds[field] in ("string", "date"):
            return F.col(field).cast("string")
        value = to_number(F.col(field), scored.schema[field].dataType)
        return F.when(value.isNotNull(), F.format_string("%.2f", value))

    shown = [f for f in fixed.SNAPSHOT_FIELDS if f in kinds]
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), text(f).alias("value")) for f in shown])
    keyed = scored.select("grid_id", F.col("date").alias("day"), F.explode(pairs).alias("p"))
    return keyed.select("grid_id", "day", "p.*").filter(F.trim("value") != "")


def explanation_lookup(explanations: DataFrame, order: str = "position") -> DataFrame:
    """The first explanation of each (cell, date)."""
    keys = ["grid_id", "date"]
    rest = [c for c in explanations.columns if c not in keys]
    firsts = [F.min_by(c, order).alias(c) for c in rest]
    return explanations.groupBy(*keys).agg(*firsts).select(*explanations.columns)


def explanation_dates(explanations: DataFrame) -> DataFrame:
    """Sorted dates with an explanation, per cell; a cell has at most one entry per explained row."""
    return explanations.groupBy("grid_id").agg(F.array_sort(F.collect_list("date")).alias("dates"))


def cell_series(scored: DataFrame, grid_id: str | None = None) -> DataFrame:
    """Model scores over time in long form, for cells with at least two dates."""
    if grid_id is not None:
        scored = scored.filter(F.col("grid_id") == grid_id)
    present = {c: name for c, name in fixed.SERIES_METRICS.items() if c in scored.columns}
    pairs = F.array(*[F.struct(F.lit(name).alias("series"), F.col(c).cast("double").alias("value")) for c, name in present.items()])
    points = F.count(F.lit(1)).over(Window.partitionBy("grid_id"))
    kept = scored.withColumn("_points", points).filter("_points >= 2")
    return kept.select("grid_id", "date", F.explode(pairs).alias("p")).select("grid_id", "date", "p.*").filter(
        F.nanvl("value", F.lit(None)).isNotNull()
    )


def day_histogram(scored: DataFrame, metric: str, bins: int = fixed.HISTOGRAM_BINS) -> DataFrame:
    """Per day, counts of a metric in bins cut at round numbers (1, 2 or 5 times a power of ten).

    Cuts lie strictly inside the day's range, so the first and last bin may be narrower; empty bins stay;
    a day with fewer than two values has none. The per-day frames are bounded by the calendar, so they
    are broadcast; a row finds its bin by arithmetic, corrected by comparing with the real cut.
    """
    values = scored.select("date", F.nanvl(F.col(metric).cast("double"), F.lit(None)).alias("v")).filter("v IS NOT NULL")
    span = values.groupBy("date").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("v").alias("_n")).filter("_n >= 2")
    raw = (F.col("hi") - F.col("lo")) / bins
    frame = span.withColumn("_e", F.floor(F.log10(F.when(raw > 0, raw))))
    rest = raw / F.pow(F.lit(10.0), F.col("_e"))
    factor = F.when(rest >= F.sqrt(F.lit(50.0)), 10.0).when(rest >= F.sqrt(F.lit(10.0)), 5.0).when(rest >= F.sqrt(F.lit(2.0)), 2.0).otherwise(1.0)
    frame = frame.withColumn("_f", factor)
    # Below 1 a cut is k divided by a whole number, which keeps 0.3 at 0.3.
    frame = frame.withColumn("_step", F.when(F.col("_e") < 0, F.pow(F.lit(10.0), -F.col("_e")) / F.col("_f")).otherwise(F.pow(F.lit(10.0), F.col("_e")) * F.col("_f")))

    def cut(k: Column) -> Column:
        return F.when(F.col("_e") < 0, k / F.col("_step")).otherwise(k * F.col("_step"))

    def position(v: Column) -> Column:
        guess = F.floor(F.when(F.col("_e") < 0, v * F.col("_step")).otherwise(v / F.col("_step")))
        return F.when(v >= cut(guess + 1), guess + 1).when(v >= cut(guess), guess).otherwise(guess - 1)

    # First cut above lo, last cut below hi; none when the range is a single value.
    frame = frame.withColumn("_k0", position(F.col("lo")) + 1).withColumn("_k1", position(F.col("hi")))
    frame = frame.withColumn("_k1", F.when(cut(F.col("_k1")) >= F.col("hi"), F.col("_k1") - 1).otherwise(F.col("_k1")))
    frame = frame.withColumn("_cuts", F.coalesce(F.greatest(F.col("_k1") - F.col("_k0") + 1, F.lit(0)), F.lit(0)).cast("int"))
    frame = frame.select("date", "lo", "hi", "_e", "_step", "_k0", "_cuts")
    placed = values.join(F.broadcast(frame), "date")
    # A value on hi belongs to the last bin.
    at = F.when(F.col("_cuts") == 0, 0).otherwise(F.least(F.greatest(position(F.col("v")) - F.col("_k0") + 1, F.lit(0)), F.col("_cuts"))).cast("int")
    counts = placed.groupBy("date", at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    all_bins = frame.select("*", F.explode(F.sequence(F.lit(0), F.col("_cuts"))).alias("bin"))
    edges = all_bins.select(
        "date", "bin",
        F.when(F.col("bin") == 0, F.col("lo")).otherwise(cut(F.col("_k0") + F.col("bin") - 1)).alias("x0"),
        F.when(F.col("bin") == F.col("_cuts"), F.col("hi")).otherwise(cut(F.col("_k0") + F.col("bin"))).alias("x1"),
    )
    return edges.join(counts, ["date", "bin"], "left").select("date", "bin", "x0", "x1", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
