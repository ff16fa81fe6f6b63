"""Run a classification experiment from a nested config mapping.

The mapping has the sections ``dataset``, ``preprocessing``, ``features``,
``model``, ``evaluation``, ``split`` and ``experiment`` with the field names
of the original tool's pipeline configs (parse YAML or JSON yourself and
pass the dict).  Depending on the config, one of three runs happens:

* hold-out (default): ``run_pipeline``;
* cross-validation instead of a split (``split.test_ratio == 0`` and
  ``split.cv_folds``): ``run_cross_validation``;
* grid search (``model.grid_search``): k-fold search on the training part,
  the best set refitted and evaluated on the test part.

``experiment.tracking_uri`` (or ``run_log_path``) names the run-log folder.
Without ``dataset.key_column`` rows are keyed by a hash of all their values,
so identical rows always land in the same split part.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.operators import encode, scale, split, train
from tabloom.plans.holdout import (CrossValidationResult, PipelineResult, fit_preparation,
                                   run_cross_validation, run_pipeline)
from tabloom.plans.tuning import GridResult, grid_search_cv
from tabloom.sources.delimited import DELIMITER, NULL_TOKENS, read_delimited

ROW_KEY = "_row_key"


@dataclass
class ConfigRun:
    kind: str                                   # holdout | cross_validation | grid_search
    holdout: PipelineResult | None = None
    cross_validation: CrossValidationResult | None = None
    grid: GridResult | None = None


def run_from_config(spark: SparkSession, config: Mapping[str, Any], df: DataFrame | None = None,
                    run_log_path: str | None = None) -> ConfigRun:
    ds = dict(config.get("dataset", {}))
    pre = dict(config.get("preprocessing", {}))
    feat = dict(config.get("features", {}))
    model = dict(config.get("model", {}))
    ev = dict(config.get("evaluation", {}))
    sp = dict(config.get("split", {}))
    ex = dict(config.get("experiment", {}))

    if df is None:
        df = read_delimited(spark, ds["filepath"], tuple(ds.get("null_values", NULL_TOKENS)),
                            ds.get("delimiter", DELIMITER))
    target = ds["target_column"]
    key = ds.get("key_column")
    if key is None:
        df = df.withColumn(ROW_KEY, F.xxhash64(*[F.col(c) for c in df.columns]))
        key = ROW_KEY
    categorical = list(pre.get("categorical_features", ()))
    numeric = list(pre.get("numeric_features", ()))
    features = feat.get("features_to_use")
    normalize = bool(feat.get("normalize", True))
    model_type = model.get("model_type", "random_forest")
    params = dict(model.get("hyperparameters", {}))
    metrics = tuple(ev.get("metrics", ("accuracy", "precision", "recall", "f1")))
    average = ev.get("average", "macro")
    seed = int(sp.get("random_seed", 42))
    test_ratio = float(sp.get("test_ratio", 0.2))
    fill = pre.get("fill_strategy", "median")
    log_path = run_log_path or ex.get("tracking_uri")
    name, run = ex.get("experiment_name"), ex.get("run_name")
    log = dict(experiment=name, run=run, run_log_path=log_path)
    # a logged run keeps its model beside the log
    model_path = ex.get("model_path") or (
        f"{log_path.rstrip('/')}-models/{name}/{run}" if log_path and name and run else None)
    validation_ratio = float(sp.get("validation_ratio", 0.0))
    # folds are stratified unless the config says no, hold-outs when it says so
    stratified = bool(sp.get("stratified", False))

    common = dict(categorical=categorical, numeric=numeric, features=features,
                  model_type=model_type, fill_strategy=fill, normalize=normalize,
                  metrics=metrics, average=average)

    if "grid_search" in model:
        gs = dict(model["grid_search"])
        known, _ = train.drop_null_target(df, target, count=False)
        parts = split.three_way_split(known, key, test_ratio, validation_ratio, seed) \
            if validation_ratio > 0 else split.holdout_split(known, key, test_ratio, seed)
        train_part = parts.where(F.col(split.PART) == "train").drop(split.PART)
        folds = split.stratified_kfold(train_part, key, target, int(gs.get("cv", 3)), seed)
        wanted = list(features) if features is not None else (
            numeric + [f"{c}_encoded" for c in categorical])
        keep = [key, target, "fold"] if isinstance(key, str) else [*key, target, "fold"]

        def prepare(tr):
            """The same preparation as the final fit's, from one fold's rows."""
            prep, fparams, keep_raw = fit_preparation(tr, categorical, numeric, wanted, model_type,
                                                      fill, normalize)
            return lambda x: scale.apply_features(encode.apply_preprocess(x, prep), fparams,
                                                  keep=[c for c in keep if c in x.columns],
                                                  keep_raw=keep_raw)

        n_jobs = int(gs.get("n_jobs", 4))
        grid = grid_search_cv(folds, target, None, model_type, gs["param_grid"], "fold",
                              base_params=params, scoring=gs.get("scoring", "accuracy"),
                              key=key, prepare=prepare, refit=False,
                              parallelism=4 if n_jobs < 1 else n_jobs)
        best = {**params, **grid.best_params}
        res = run_pipeline(df, target, key, hyperparameters=best, test_ratio=test_ratio,
                           seed=seed, validation_ratio=validation_ratio, model_path=model_path,
                           stratified=stratified,
                           **common, **log)
        return ConfigRun(kind="grid_search", holdout=res, grid=grid)

    if test_ratio == 0.0 and sp.get("cv_folds"):
        cv = run_cross_validation(df, target, key, hyperparameters=params,
                                  folds=int(sp["cv_folds"]),
                                  stratified=bool(sp.get("stratified", True)), seed=seed,
                                  **common, **log)
        return ConfigRun(kind="cross_validation", cross_validation=cv)

    res = run_pipeline(df, target, key, hyperparameters=params, test_ratio=test_ratio,
                       seed=seed, validation_ratio=validation_ratio, model_path=model_path,
                       stratified=stratified,
                       **common, **log)
    return ConfigRun(kind="holdout", holdout=res)
