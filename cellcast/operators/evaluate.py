"""Classification metrics of several models over one scored table.

The table is unfolded to one row per (model, row) and folded at once: predictions to four counts,
scores to one row per distinct score. Everything after works on those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cellcast import fixed
from cellcast.operators.ranking import running_totals


def long_scores(scored: DataFrame, label: str = fixed.TARGET) -> DataFrame:
    """One row per model present in the table: Model, y, pred, prob."""
    present = {m: cols for m, cols in fixed.MODELS.items() if cols[0] in scored.columns}
    if not present:
        raise ValueError("the table holds no model's predictions")
    entries = F.array(*[
        F.struct(F.lit(m).alias("Model"), F.col(pred).cast("int").alias("pred"), F.col(prob).cast("double").alias("prob"))
        for m, (pred, prob) in present.items()
    ])
    return scored.select(F.col(label).cast("int").alias("y"), F.explode(entries).alias("e")).select("y", "e.*")


def confusion_matrix(long: DataFrame) -> DataFrame:
    def cell(y: int, pred: int) -> Column:
        return F.sum(((F.col("y") == y) & (F.col("pred") == pred)).cast("bigint"))

    return long.groupBy("Model").agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def binary_metrics(confusion: DataFrame) -> DataFrame:
    """Accuracy, Precision, Recall, F1-Score; a ratio without denominator is 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return confusion.select(
        "Model",
        _ratio(tp + tn, tp + tn + fp + fn).alias("Accuracy"),
        _ratio(tp, tp + fp).alias("Precision"),
        _ratio(tp, tp + fn).alias("Recall"),
        _ratio(2.0 * tp, 2 * tp + fp + fn).alias("F1-Score"),
    )


def score_steps(long: DataFrame) -> DataFrame:
    """One row per model and distinct score, with counts at and above it."""
    counted = long.groupBy("Model", "prob").agg(
        F.sum(F.col("y").cast("bigint")).alias("pos"), F.sum(1 - F.col("y").cast("bigint")).alias("neg")
    )
    return running_totals(counted, ["Model"], "prob", ["pos", "neg"])


def curve_areas(steps: DataFrame) -> DataFrame:
    """ROC-AUC (trapezoids, so ties count half; null with one class) and PR-AUC (step-wise)."""
    before = F.col("cum_pos") - F.col("pos") / 2.0
    sums = steps.groupBy("Model").agg(
        F.sum(F.col("neg") * before).alias("area"),
        F.sum(F.col("pos") * _ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg"))).alias("gain"),
        F.sum("pos").alias("p"), F.sum("neg").alias("n"),
    )
    return sums.select(
        "Model",
        F.try_divide(F.col("area"), F.col("p") * F.col("n")).alias("ROC-AUC"),
        _ratio(F.col("gain"), F.col("p")).alias("PR-AUC"),
    )


def roc_auc(long: DataFrame) -> DataFrame:
    return curve_areas(score_steps(long)).select("Model", "ROC-AUC")


def average_precision(long: DataFrame) -> DataFrame:
    return curve_areas(score_steps(long)).select("Model", "PR-AUC")


def _with_class_totals(steps: DataFrame) -> DataFrame:
    # One row per model: a handful.
    totals = steps.groupBy("Model").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return steps.join(F.broadcast(totals), "Model")


def _start(steps: DataFrame, values: dict[str, Column]) -> DataFrame:
    return steps.select("Model").distinct().select("Model", *[c.alias(n) for n, c in values.items()])


def roc_points(long: DataFrame) -> DataFrame:
    """(fpr, tpr, threshold) from (0, 0) at infinity; points inside a straight run are left out."""
    steps = score_steps(long)
    highest = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
    bend = F.col("next_pos").isNull() | (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
    points = _with_class_totals(steps).filter(highest | bend).select(
        "Model", F.try_divide("cum_neg", "n").alias("fpr"), F.try_divide("cum_pos", "p").alias("tpr"), F.col("prob").alias("threshold")
    )
    origin = _start(steps, {"fpr": F.lit(0.0), "tpr": F.lit(0.0), "threshold": F.lit(float("inf"))})
    return points.unionByName(origin)


def pr_points(long: DataFrame) -> DataFrame:
    """(precision, recall, threshold) at every distinct score, and the closing (1, 0)."""
    steps = score_steps(long)
    points = _with_class_totals(steps).select(
        "Model",
        _ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        F.coalesce(F.try_divide("cum_pos", "p"), F.lit(1.0)).alias("recall"),
        F.col("prob").alias("threshold"),
    )
    end = _start(steps, {"precision": F.lit(1.0), "recall": F.lit(0.0), "threshold": F.lit(None).cast("double")})
    return points.unionByName(end)


def classification_report(confusion: DataFrame) -> DataFrame:
    """Per model: one row per class, then accuracy, macro and weighted averages."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp

    def line(hit: Column, predicted: Column, actual: Column) -> dict[str, Column]:
        return {"precision": _ratio(hit, predicted), "recall": _ratio(hit, actual),
                "f1": _ratio(2.0 * hit, predicted + actual), "support": actual}

    classes = [line(tn, tn + fn, tn + fp), line(tp, tp + fp, tp + fn)]
    measures = ("precision", "recall", "f1")

    def entry(name: str, values: dict[str, Column]) -> Column:
        columns = [values.get(m, F.lit(None).cast("double")).cast("double").alias(m) for m in measures]
        return F.struct(F.lit(name).alias("label"), *columns, values["support"].cast("bigint").alias("support"))

    macro = {m: (classes[0][m] + classes[1][m]) / 2 for m in measures}
    weighted = {m: _ratio(classes[0][m] * classes[0]["support"] + classes[1][m] * classes[1]["support"], n) for m in measures}
    rows = [entry(label, c) for label, c in zip(fixed.CLASS_LABELS, classes)]
    rows += [
        entry("accuracy", {"f1": _ratio(tp + tn, n), "support": n}),
        entry("macro avg", {**macro, "support": n}),
        entry("weighted avg", {**weighted, "support": n}),
    ]
    return confusion.select("Model", F.explode(F.array(*rows)).alias("r")).select("Model", "r.*")


def evaluate_models(scored: DataFrame, label: str = fixed.TARGET) -> DataFrame:
    """One row of all six metrics per model present in the table."""
    long = long_scores(scored, label)
    areas = curve_areas(score_steps(long))
    return binary_metrics(confusion_matrix(long)).join(F.broadcast(areas), "Model").select("Model", *fixed.METRICS)


def melt_metrics(metrics: DataFrame) -> DataFrame:
    """Wide metrics -> Model, Metric, Score for the charted ones present."""
    charted = [m for m in fixed.CHART_METRICS if m in metrics.columns]
    return metrics.unpivot(["Model"], [f"`{m}`" for m in charted], "Metric", "Score")
