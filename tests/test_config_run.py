"""Runs driven by a nested config mapping (hold-out, CV instead of split, grid)."""
import pytest

from tabloom.plans import tasks
from tabloom.plans.config_run import run_from_config
from tabloom.session import scratch_path
from tabloom.sources import runlog
from tests.conftest import SF01


@pytest.fixture(scope="module")
def csv_path(spark):
    path = scratch_path(spark, "doc-csv")
    tasks.document_quality(spark, SF01).drop("doc_id").write.option("header", True).csv(path)
    return path


def _config(path, **over):
    cfg = {
        "dataset": {"filepath": path, "target_column": "quality", "null_values": ["NA", "."]},
        "preprocessing": {"categorical_features": ["lang", "source"],
                          "numeric_features": ["n_chars", "n_words", "digit_share",
                                               "distinct_share"],
                          "fill_strategy": "median"},
        "features": {"features_to_use": ["lang_encoded", "source_encoded", "n_chars", "n_words",
                                         "digit_share", "distinct_share", "n_words_norm"],
                     "normalize": True},
        "model": {"model_type": "random_forest",
                  "hyperparameters": {"n_estimators": 17, "max_depth": 9, "min_samples_split": 6,
                                      "min_samples_leaf": 3, "bootstrap": True,
                                      "class_weight": "balanced", "random_state": 7}},
        "evaluation": {"metrics": ["accuracy", "precision", "recall", "f1", "roc_auc"],
                       "average": "macro"},
        "split": {"test_ratio": 0.2, "validation_ratio": 0.1, "random_seed": 42},
        "experiment": {"experiment_name": "quality", "run_name": "rf"},
    }
    for k, v in over.items():
        cfg[k] = {**cfg[k], **v}
    return cfg


def test_holdout_from_config(spark, csv_path):
    log = scratch_path(spark, "cfg-log")
    r = run_from_config(spark, _config(csv_path), run_log_path=log)
    assert r.kind == "holdout"
    m = {x["metric"]: x["value"] for x in r.holdout.evaluation.metrics.collect()}
    assert set(m) == {"accuracy", "precision", "recall", "f1", "roc_auc"}
    assert m["accuracy"] > 0.8
    assert runlog.read_runs(spark, log, "quality").where("kind = 'metric'").count() == 5
    val = {x["metric"]: x["value"] for x in r.holdout.validation.metrics.collect()}
    assert 0.5 < val["accuracy"] <= 1.0


def test_cross_validation_from_config(spark, csv_path):
    cfg = _config(csv_path, split={"test_ratio": 0.0, "cv_folds": 3, "stratified": True},
                  model={"hyperparameters": {"n_estimators": 10, "max_depth": 5}})
    r = run_from_config(spark, cfg)
    assert r.kind == "cross_validation"
    assert {x["metric"] for x in r.cross_validation.summary.collect()} == {
        "accuracy", "precision", "recall", "f1", "roc_auc"}
    confusion = r.cross_validation.confusion.collect()
    assert {x["fold"] for x in confusion} == {0, 1, 2}


def test_a_logged_run_saves_a_model_that_scores_raw_rows(spark, csv_path):
    from tabloom.sources.models import load_fitted

    log = scratch_path(spark, "cfg-log")
    cfg = _config(csv_path, model={"hyperparameters": {"n_estimators": 8, "max_depth": 4, "random_state": 3}})
    r = run_from_config(spark, cfg, run_log_path=log)
    again = load_fitted(spark, f"{log}-models/quality/rf")
    raw = tasks.document_quality(spark, SF01).withColumnRenamed("doc_id", "_row_key").drop("quality")
    scored = again.predict(raw)
    assert scored.count() == raw.count() and "prediction" in scored.columns
    assert again.classifier.features == r.holdout.feature_columns


def test_grid_search_from_config(spark, csv_path):
    cfg = _config(csv_path, model={"hyperparameters": {"random_state": 42},
                                   "grid_search": {"param_grid": {"n_estimators": [5, 15],
                                                                  "max_depth": [3]},
                                                   "cv": 3, "scoring": "accuracy",
                                                   "n_jobs": -1}})
    r = run_from_config(spark, cfg)
    assert r.kind == "grid_search" and r.grid.scores.count() == 2
    assert r.grid.best_params["n_estimators"] in (5, 15)
    assert r.holdout.evaluation.metrics.count() == 5
