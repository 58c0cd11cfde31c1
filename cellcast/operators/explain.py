"""Words for feature contributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cellcast import fixed


def driver_label(name: Column) -> Column:
    """Friendly feature name; others lose their underscores."""
    known = F.create_map(*[F.lit(x) for pair in fixed.DRIVER_LABELS.items() for x in pair])
    return F.coalesce(F.element_at(known, name), F.replace(name, F.lit("_"), F.lit(" ")))


def explanation_text(rows: DataFrame, drivers: int = 3) -> DataFrame:
    """Add one sentence from the top drivers and the score."""

    def phrase(i: int) -> Column:
        way = F.when(F.col(f"top_driver_{i}_shap") > 0, fixed.TEXT_UP).otherwise(fixed.TEXT_DOWN)
        return F.concat(driver_label(F.col(f"top_driver_{i}")), F.lit(" ("), way, F.lit(" risk)"))

    opening = F.when(F.col("rf_prob") >= 0.5, fixed.TEXT_ELEVATED).otherwise(fixed.TEXT_LOWER)
    listed = F.concat_ws(", ", *[phrase(i) for i in range(1, drivers)])
    return rows.withColumn("explanation_text", F.concat(opening, listed, F.lit(", and "), phrase(drivers), F.lit(".")))
