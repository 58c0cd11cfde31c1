"""Model table -> split -> three models -> evaluation, and the explanation job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from cellcast import fixed
from cellcast.operators import arima, evaluate, explain, forest, hotspot, sampling, shapley
from cellcast.operators.split import parts, split_temporal
from cellcast.session import staged


@dataclass
class Scored:
    """Scored test rows, their metrics and the fitted forest."""

    rows: DataFrame
    metrics: DataFrame
    forest: forest.Forest


def split_model_table(model: DataFrame, fraction: float = fixed.TRAIN_FRACTION) -> tuple[DataFrame, DataFrame]:
    return parts(split_temporal(model, fraction))


def score_hotspot(train: DataFrame, test: DataFrame, centroids: DataFrame) -> DataFrame:
    """Fit, tuning and prediction; ``hotspot_kde`` has written its density once, and both readers start from it."""
    scores = hotspot.hotspot_kde(train, centroids)
    limit = hotspot.hotspot_threshold(train, scores).select("threshold").scalar()
    return hotspot.hotspot_predict(test, scores, limit)


def score_pipeline(model: DataFrame, centroids: DataFrame, fraction: float = fixed.TRAIN_FRACTION, arima_settings: dict | None = None,
                   **forest_settings) -> Scored:
    """``arima_settings``: min_days, most, grid, alarm. ``forest_settings``: trees, depth, min_leaf, seed, bins, tasks."""
    train, test = split_model_table(model, fraction)
    fitted = forest.train_forest(train, **forest_settings)
    scored = score_hotspot(train, test, centroids)
    scored = arima.train_and_predict(train, scored, **(arima_settings or {}))
    # Evaluation folds the scored rows several ways; they are written once, as the result table is anyway.
    # By date, since the views ask for one day.
    scored = staged(forest.forest_predict(scored, fitted), "scored-test", ["date"])
    return Scored(scored, evaluate.evaluate_models(scored), fitted)


@dataclass
class Explained:
    """Explained rows (``position`` is the order of choice) and all scored test rows they were chosen from."""

    rows: DataFrame
    scored: DataFrame


def explain_predictions(test: DataFrame, fitted: forest.Forest, **sizes) -> Explained:
    """Chosen rows with contributions, top drivers and a sentence, in the order of choice.

    ``sizes``: high, mid, low, low_pool, band of ``select_explain_rows``.
    """
    scored = staged(forest.forest_scores(test, fitted), "forest-scored")
    chosen = sampling.select_explain_rows(scored, **sizes)
    explained = shapley.explain_forest(staged(chosen, "explain-rows"), fitted)
    return Explained(explain.explanation_text(sampling.topk_drivers(explained)).orderBy("position"), scored)


def explanation_columns() -> list[str]:
    """Column order of the explanation file."""
    drivers = [f"top_driver_{i}" for i in (1, 2, 3)]
    return ["position", "stratum", "grid_id", "date", *fixed.MODEL_FEATURES, "rf_prob", "rf_pred", *[f"{f}_shap" for f in fixed.MODEL_FEATURES],
            *drivers, *[f"{d}_shap" for d in drivers], "explanation_text"]
