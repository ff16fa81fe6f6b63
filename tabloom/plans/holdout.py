"""End-to-end classification run: split, prepare, train, evaluate, log.

    drop rows without target -> hash split on the key -> fit preparation on
    train (impute, categories) -> fit features on train (select, z-score)
    -> train -> predict the test part -> metrics from one confusion
    aggregate -> run log rows (+ model folder)

Every ``fit_*`` reads only the training part; ``apply_*`` runs map-side on
both parts.  Nothing but fitted literals, class labels and metric rows
reaches the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.columns import numeric_columns
from tabloom.operators import encode, evaluate, scale, split, train
from tabloom.session import cut_lineage
from tabloom.sources import models, runlog


@dataclass
class PipelineResult:
    classifier: train.Classifier
    preprocess: encode.Preprocess
    features: scale.FeatureParams
    evaluation: evaluate.Evaluation
    predictions: DataFrame
    dropped_rows: int | None
    feature_columns: list[str]
    validation: evaluate.Evaluation | None = None


def model_inputs(df: DataFrame) -> list[str]:
    """Columns a model can take: numeric scalars and ML vectors."""
    from pyspark.ml.linalg import VectorUDT

    vec = [f.name for f in df.schema.fields if isinstance(f.dataType, VectorUDT)]
    return [c for c in df.columns if c in set(numeric_columns(df)) | set(vec)]


@dataclass
class Fitted:
    """Preparation, feature parameters and model fitted on one training part."""

    prep: encode.Preprocess
    features: scale.FeatureParams
    classifier: train.Classifier
    columns: list[str]
    keep: list[str]
    keep_raw: bool = True

    def prepare(self, df: DataFrame) -> DataFrame:
        keep = [c for c in self.keep if c in df.columns]  # rows to be scored have no target
        return scale.apply_features(encode.apply_preprocess(df, self.prep), self.features,
                                    keep=keep, keep_raw=self.keep_raw)

    def predict(self, df: DataFrame) -> DataFrame:
        return train.predict(self.classifier, self.prepare(df))


def fit_all(train_df: DataFrame, target: str, key, categorical: Sequence[str],
            numeric: Sequence[str], wanted: Sequence[str], model_type: str,
            hyperparameters: Mapping[str, Any] | None, fill_strategy: str = "median",
            normalize: bool = True, exact_median: bool = True) -> Fitted:
    """Fit imputation, categories, feature scaling and the model on
    ``train_df`` only."""
    keys = [key] if isinstance(key, str) else list(key)
    keep = keys + [target]
    prep, fparams, keep_raw = fit_preparation(train_df, categorical, numeric, wanted, model_type,
                                              fill_strategy, normalize, exact_median)
    train_f = scale.apply_features(encode.apply_preprocess(train_df, prep), fparams, keep=keep,
                                   keep_raw=keep_raw)
    cols = [c for c in model_inputs(train_f) if c not in keep]
    clf = train.train_classifier(train_f, target, cols, model_type, hyperparameters, key=key)
    return Fitted(prep=prep, features=fparams, classifier=clf, columns=cols, keep=keep,
                  keep_raw=keep_raw)


def fit_preparation(train_df: DataFrame, categorical: Sequence[str], numeric: Sequence[str],
                    wanted: Sequence[str], model_type: str, fill_strategy: str = "median",
                    normalize: bool = True, exact_median: bool = True
                    ) -> tuple[encode.Preprocess, scale.FeatureParams, bool]:
    """Imputation, categories and feature scaling fitted on ``train_df``, and
    whether raw columns stay beside their z-scores (margins need one scale, so
    an SVM gets scaled columns only; a forest does not mind)."""
    prep = encode.fit_preprocess(train_df, categorical, numeric, fill_strategy,
                                 exact=exact_median)
    fparams = scale.fit_features(encode.apply_preprocess(train_df, prep), wanted, normalize)
    return prep, fparams, not (normalize and model_type == "svm")


def _stratified_parts(data: DataFrame, key, target: str, test_ratio: float, validation_ratio: float,
                      seed: int) -> DataFrame:
    """The test rows of every class come first in split order, its validation rows next."""
    parts = split.holdout_split(data, key, test_ratio, seed, mode="exact", stratify=target)
    if validation_ratio <= 0:
        return parts
    if test_ratio + validation_ratio > 1.0:
        raise ValueError("test_ratio + validation_ratio must not exceed 1")
    parts = cut_lineage(parts)
    rest = parts.where(F.col(split.PART) == "train").drop(split.PART)
    share = min(1.0, validation_ratio / (1.0 - test_ratio)) if test_ratio < 1.0 else 0.0
    later = split.holdout_split(rest, key, share, seed, mode="exact", stratify=target)
    named = F.when(F.col(split.PART) == "test", "validation").otherwise("train")
    return parts.where(F.col(split.PART) == "test").unionByName(later.withColumn(split.PART, named))


def run_pipeline(df: DataFrame, target: str, key: str | Sequence[str],
                 categorical: Sequence[str] = (), numeric: Sequence[str] = (),
                 features: Sequence[str] | None = None, model_type: str = "random_forest",
                 hyperparameters: Mapping[str, Any] | None = None, test_ratio: float = 0.2,
                 seed: int = 42, split_mode: str = "hash", fill_strategy: str = "median",
                 normalize: bool = True,
                 metrics: Sequence[str] = ("accuracy", "precision", "recall", "f1"),
                 average: str = "macro", experiment: str | None = None, run: str | None = None,
                 run_log_path: str | None = None, model_path: str | None = None,
                 count_dropped: bool = True, validation_ratio: float = 0.0,
                 exact_median: bool = True, stratified: bool = False) -> PipelineResult:
    """``stratified``: the test part (and the validation part) holds the same share of
    every class, by exact counts."""
    evaluate.validate_metrics(metrics, average)
    keys = [key] if isinstance(key, str) else list(key)
    wanted = list(features) if features is not None else (
        list(numeric) + [f"{c}_encoded" for c in categorical])
    needed = list(dict.fromkeys(keys + [target] + list(categorical) + list(numeric)
                                + [c for c in wanted if c in df.columns]))
    # Only the needed columns, read once: every fit below re-reads this
    # frame, so it is checkpointed instead of recomputed from the source.
    data, dropped = train.drop_null_target(df.select(*needed), target, count=False)
    if stratified:
        parts = cut_lineage(_stratified_parts(data, key, target, test_ratio, validation_ratio, seed))
    elif validation_ratio > 0:
        if split_mode != "hash":
            raise ValueError("a validation part needs split_mode='hash'")
        parts = cut_lineage(split.three_way_split(data, key, test_ratio, validation_ratio, seed))
    else:
        parts = cut_lineage(split.holdout_split(data, key, test_ratio, seed, mode=split_mode))
    dropped = df.where(F.col(target).isNull()).count() if count_dropped else None
    train_df = parts.where(F.col(split.PART) == "train").drop(split.PART)
    test_df = parts.where(F.col(split.PART) == "test").drop(split.PART)

    fitted = fit_all(train_df, target, key, categorical, numeric, wanted, model_type,
                     hyperparameters, fill_strategy, normalize, exact_median)
    prep, fparams, clf, feat_cols = fitted.prep, fitted.features, fitted.classifier, fitted.columns
    test_f = fitted.prepare(test_df)
    scored = train.predict(clf, test_f)
    scores = train.class_scores(clf, scored) if "roc_auc" in metrics else None
    ev = evaluate.evaluate(scored, target, "prediction", metrics, average, scores=scores)
    validation = None
    if validation_ratio > 0:
        val = train.predict(clf, fitted.prepare(
            parts.where(F.col(split.PART) == "validation").drop(split.PART)))
        validation = evaluate.evaluate(val, target, "prediction", metrics, average,
                                       scores=train.class_scores(clf, val)
                                       if "roc_auc" in metrics else None)

    if run_log_path and experiment and run:
        params = {"model_type": model_type, **dict(hyperparameters or {}),
                  "test_ratio": test_ratio, "validation_ratio": validation_ratio, "seed": seed,
                  "fill_strategy": fill_strategy}
        runlog.log_run(df.sparkSession, run_log_path, experiment, run, params=params,
                       metrics=ev.metrics, confusion=ev.counts, report=ev.report)
    if model_path:
        models.save_fitted(fitted, model_path)
    return PipelineResult(classifier=clf, preprocess=prep, features=fparams, evaluation=ev,
                          predictions=scored.select(*keys, target, "prediction"),
                          dropped_rows=dropped, feature_columns=feat_cols,
                          validation=validation)


@dataclass
class CrossValidationResult:
    per_fold: DataFrame          # (fold, metric, value)
    summary: DataFrame           # (metric, mean, std)
    confusion: DataFrame         # (fold, actual, predicted, n) of the pairs that occur


def run_cross_validation(df: DataFrame, target: str, key: str | Sequence[str],
                         categorical: Sequence[str] = (), numeric: Sequence[str] = (),
                         features: Sequence[str] | None = None,
                         model_type: str = "random_forest",
                         hyperparameters: Mapping[str, Any] | None = None, folds: int = 5,
                         stratified: bool = True, seed: int = 42,
                         fill_strategy: str = "median", normalize: bool = True,
                         metrics: Sequence[str] = ("accuracy", "precision", "recall", "f1"),
                         average: str = "macro", experiment: str | None = None,
                         run: str | None = None, run_log_path: str | None = None,
                         parallelism: int = 4) -> CrossValidationResult:
    """k-fold evaluation instead of a hold-out split: every fold refits
    preparation, features and model on the other folds.  Folds are
    stratified by the target (balanced to within one row per class) or
    plain hash folds; ``parallelism`` folds are fitted at the same time."""
    from tabloom.plans.tuning import cross_validate

    evaluate.validate_metrics(metrics, average)
    keys = [key] if isinstance(key, str) else list(key)
    wanted = list(features) if features is not None else (
        list(numeric) + [f"{c}_encoded" for c in categorical])
    needed = list(dict.fromkeys(keys + [target] + list(categorical) + list(numeric)
                                + [c for c in wanted if c in df.columns]))
    data, _ = train.drop_null_target(df.select(*needed), target, count=False)
    with_folds = (split.stratified_kfold(data, key, target, folds, seed) if stratified
                  else split.kfold(data, key, folds, seed))
    with_folds = cut_lineage(with_folds)

    def fit(tr):
        return fit_all(tr.drop("fold"), target, key, categorical, numeric, wanted, model_type,
                       hyperparameters, fill_strategy, normalize)

    def predict(fitted, te):
        return fitted.predict(te.drop("fold"))

    counts: list[DataFrame] = []
    per, summary = cross_validate(with_folds, "fold", fit, predict, target, "prediction",
                                  metrics, average, persist=False, parallelism=parallelism,
                                  scores=lambda f, scored: train.class_scores(f.classifier, scored),
                                  confusion_out=counts)
    if run_log_path and experiment and run:
        params = {"model_type": model_type, **dict(hyperparameters or {}), "cv_folds": folds,
                  "stratified": stratified, "seed": seed, "fill_strategy": fill_strategy}
        runlog.log_run(df.sparkSession, run_log_path, experiment, run, params=params,
                       metrics=summary.select("metric", F.col("mean").alias("value")))
    confusion = counts[0]
    for c in counts[1:]:
        confusion = confusion.unionByName(c)
    return CrossValidationResult(per_fold=per, summary=summary, confusion=confusion)
