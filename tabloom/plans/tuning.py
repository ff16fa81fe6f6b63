"""Cross-validation, parameter sweeps and grid search.

The loops here run on the driver over *folds* and *parameter sets* (both
small and bounded by the caller); every step inside is a distributed job.
Preparation is refitted inside each fold, so no statistic of a held-out fold
leaks into its model.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
from pyspark.ml.evaluation import Evaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.evaluate import confusion_counts, evaluate, metric_table
from tabloom.session import cut_lineage, small_splits


def cross_validate(df: DataFrame, fold_col: str, fit: Callable[[DataFrame], Any],
                   predict: Callable[[Any, DataFrame], DataFrame], actual: str,
                   predicted: str = "prediction",
                   metrics: Sequence[str] = ("accuracy", "precision", "recall", "f1"),
                   average: str = "macro", persist: bool = True,
                   parallelism: int = 4,
                   scores: Callable[[Any, DataFrame], Mapping[Any, Any]] | None = None,
                   confusion_out: list[DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Metrics per fold and their mean / sample std over folds.

    ``fit(train)`` returns any fitted object (preparation + model);
    ``predict(fitted, test)`` returns ``test`` with a ``predicted`` column.
    ``parallelism`` folds are fitted at the same time (driver threads
    submitting concurrent Spark jobs).  ``roc_auc`` needs ``scores(fitted,
    scored)``, a score column per class; ``confusion_out`` receives one frame
    (fold, actual, predicted, n) per fold.  ``persist`` writes the input to the
    shared folder once, so that lost executors do not cost a fold.
    Returns ``(per_fold(fold, metric, value), summary(metric, mean, std))``.
    """
    data = cut_lineage(df, "folds") if persist else df
    folds = sorted(r[0] for r in data.select(fold_col).distinct().collect())

    def pairs(f):
        scored = predict(fit(data.where(F.col(fold_col) != f)), data.where(F.col(fold_col) == f))
        return confusion_counts(scored, actual, predicted).select(F.lit(f).cast("bigint").alias("fold"), "*")

    def one(f):
        fitted = fit(data.where(F.col(fold_col) != f))
        scored = predict(fitted, data.where(F.col(fold_col) == f))
        ev = evaluate(scored, actual, predicted, metrics, average,
                      scores=scores(fitted, scored) if scores and "roc_auc" in metrics else None)
        at = F.lit(f).cast("bigint").alias("fold")
        # a few rows; frees the fold's lineage
        return cut_lineage(ev.metrics.select("*", at)), ev.counts.select(at, "*")

    if "roc_auc" in metrics:
        parts = run_concurrently(one, folds, parallelism)
        per = functools.reduce(DataFrame.unionByName, [m for m, _ in parts])
        if confusion_out is not None:
            confusion_out.extend(c for _, c in parts)
    else:
        # the pairs of all folds are counted and written by one job
        counts = cut_lineage(functools.reduce(DataFrame.unionByName, run_concurrently(pairs, folds, parallelism)),
                             "fold-counts")
        per = metric_table(metrics=metrics, average=average, counts=counts, by=["fold"])
        if confusion_out is not None:
            confusion_out.extend(counts.where(F.col("fold") == f) for f in folds)
    summary = per.groupBy("metric").agg(F.avg("value").alias("mean"),
                                        F.stddev_samp("value").alias("std"))
    return per.select("fold", "metric", "value"), summary


def run_concurrently(fn: Callable[[Any], Any], items: Sequence[Any], parallelism: int = 1
                     ) -> list[Any]:
    """``[fn(x) for x in items]`` with up to ``parallelism`` calls at once.
    Each call submits its own Spark jobs; results keep the input order."""
    items = list(items)
    if parallelism <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=min(parallelism, len(items))) as pool:
        return list(pool.map(fn, items))


def sweep(param_sets: Mapping[str, Mapping[str, Any]] | Iterable[tuple[str, Mapping[str, Any]]],
          run: Callable[[str, Mapping[str, Any]], DataFrame], parallelism: int = 4) -> DataFrame:
    """Run each named parameter set, ``parallelism`` of them at once;
    ``run(name, params)`` returns metric rows (metric, value).  Result: (run,
    metric, value) for all sets."""
    items = param_sets.items() if isinstance(param_sets, Mapping) else param_sets

    def one(item):
        name, params = item
        return cut_lineage(run(name, params).select(F.lit(name).alias("run"), "metric", "value"))

    parts = run_concurrently(one, list(items), parallelism)
    out = None
    for rows in parts:
        out = rows if out is None else out.unionByName(rows)
    return out


def grid_search(estimator, param_grid: Mapping[str, Sequence[Any]], train: DataFrame,
                evaluator, fold_col: str | None = None, num_folds: int = 3,
                parallelism: int = 2, seed: int = 42):
    """Spark ML ``CrossValidator`` over the cartesian product of the grid.

    ``param_grid`` maps estimator parameter names to value lists.  With
    ``fold_col`` the folds come from a column (e.g. ``kfold`` /
    ``stratified_kfold``) so they are repeatable and layout-independent.
    Returns the fitted ``CrossValidatorModel``.
    """
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    builder = ParamGridBuilder()
    for name, values in param_grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=builder.build(),
                        evaluator=evaluator, numFolds=num_folds, parallelism=parallelism,
                        seed=seed)
    if fold_col is not None:
        cv = cv.setFoldCol(fold_col)
    return cv.fit(cut_lineage(train, "grid-rows"))


def grid_results(cv_model, param_grid: Mapping[str, Sequence[Any]]) -> list[dict[str, Any]]:
    """Average metric per parameter set (a list as long as the grid)."""
    out = []
    for pm, score in zip(cv_model.getEstimatorParamMaps(), cv_model.avgMetrics):
        row = {p.name: v for p, v in pm.items()}
        row["score"] = float(score)
        out.append(row)
    return out


# --------------------------------------------------------------- grid with estimator parameter names

SCORINGS = {  # scoring name -> (metric, average); fixed values of the reference's configs
    "accuracy": ("accuracy", "macro"),
    "precision_macro": ("precision", "macro"), "recall_macro": ("recall", "macro"),
    "f1_macro": ("f1", "macro"), "precision_weighted": ("precision", "weighted"),
    "recall_weighted": ("recall", "weighted"), "f1_weighted": ("f1", "weighted"),
    "precision_micro": ("precision", "micro"), "recall_micro": ("recall", "micro"),
    "f1_micro": ("f1", "micro"),
    "roc_auc": ("roc_auc", "macro"), "roc_auc_ovr": ("roc_auc", "macro"),
    "roc_auc_ovr_weighted": ("roc_auc", "weighted"),
}


def expand_grid(param_grid: Mapping[str, Sequence[Any]]) -> list[dict[str, Any]]:
    """Cartesian product of a parameter grid, in key order."""
    import itertools

    keys = list(param_grid)
    return [dict(zip(keys, combo)) for combo in itertools.product(*[param_grid[k] for k in keys])]


@dataclass
class GridResult:
    scores: DataFrame            # (set_id, params, mean_score, std_score)
    best_params: dict[str, Any]
    best_score: float
    best_model: Any


def grid_search_cv(df: DataFrame, label: str, features: Sequence[str] | None, model_type: str,
                   param_grid: Mapping[str, Sequence[Any]], fold_col: str,
                   base_params: Mapping[str, Any] | None = None, scoring: str = "accuracy",
                   key: str | Sequence[str] | None = None,
                   prepare: Callable[[DataFrame], Callable[[DataFrame], DataFrame]] | None = None,
                   refit: bool = True, parallelism: int = 4) -> GridResult:
    """Grid search with the reference's parameter names (``n_estimators``,
    ``max_depth``, ``C``, ``kernel``, ``gamma``, ...).

    Every parameter set is scored by k-fold cross-validation over
    ``fold_col`` (see ``kfold`` / ``stratified_kfold``); ``prepare(train)``
    may return a function applying preparation fitted on that fold's
    training part.  ``features=None`` takes every model input of the prepared
    rows but key, label and fold.  The best set (highest mean; ties to the earlier set) is
    refitted on all rows.  The loops run over parameter sets and folds only.
    """
    import json

    from tabloom.operators import train as _train
    from tabloom.plans.holdout import model_inputs

    if scoring not in SCORINGS:
        raise ValueError(f"scoring must be one of: {', '.join(SCORINGS)}")
    metric, average = SCORINGS[scoring]
    sets = expand_grid(param_grid)
    spark = df.sparkSession
    others = {label, fold_col, *([key] if isinstance(key, str) else key or ())}

    def inputs(rows: DataFrame) -> list[str]:
        return list(features) if features is not None else [
            c for c in model_inputs(rows) if c not in others]

    data = cut_lineage(df, "grid-rows")
    batched = None
    if model_type == "svm" and metric != "roc_auc":
        batched = _svm_grid_values(data, label, inputs, sets, dict(base_params or {}), fold_col, prepare,
                                   metric, average)

    def summary(i, vals):
        mean = sum(vals) / len(vals)
        std = (sum((v - mean) ** 2 for v in vals) / (len(vals) - 1)) ** 0.5 if len(vals) > 1 else 0.0
        return (i, json.dumps(sets[i], sort_keys=True, default=str), mean, std)

    def score(item):
        i, ps = item
        params = {**dict(base_params or {}), **ps}

        def fit(tr):
            apply = prepare(tr) if prepare else (lambda x: x)
            rows = apply(tr)
            return apply, _train.train_classifier(rows, label, inputs(rows), model_type, params,
                                                  key=key)

        def predict(fitted, te):
            apply, clf = fitted
            return _train.predict(clf, apply(te))

        per, _ = cross_validate(data, fold_col, fit, predict, label, "prediction",
                                metrics=(metric,), average=average, persist=False,
                                parallelism=1,
                                scores=lambda fitted, scored: _train.class_scores(fitted[1], scored))
        return summary(i, [r["value"] for r in per.collect()])          # one value per fold

    if batched is not None:
        rows = [summary(i, vals) for i, vals in enumerate(batched)]
    else:
        # Parameter sets run side by side (n_jobs in the reference's configs).
        rows = run_concurrently(score, list(enumerate(sets)), parallelism)
    best = max(rows, key=lambda r: (r[2], -r[0]))
    best_params = sets[best[0]]
    model = None
    if refit:
        apply = prepare(data) if prepare else (lambda x: x)
        whole = apply(data)
        model = (apply, _train.train_classifier(whole, label, inputs(whole), model_type,
                                                {**dict(base_params or {}), **best_params},
                                                key=key))
    scores = spark.createDataFrame(rows, "set_id bigint, params string, mean_score double, "
                                         "std_score double")
    return GridResult(scores=scores, best_params=best_params, best_score=best[2],
                      best_model=model)


# what one batch of margins may differ in; other parameters hold for the whole grid
_BATCHED = {"C", "kernel", "gamma", "class_weight", "n_components", "random_state"}


def _svm_grid_values(data: DataFrame, label: str, inputs: Callable[[DataFrame], list[str]],
                     sets: Sequence[Mapping[str, Any]], base: Mapping[str, Any], fold_col: str,
                     prepare: Callable | None, metric: str, average: str) -> list[list[float]] | None:
    """The metric of every parameter set and fold: all margins of the grid (sets x folds x
    classes) are solved together, all held-out rows are scored in one scan.  Sets that
    stand for the same model (a linear kernel with several widths) are solved once.  None
    if the grid cannot be batched: it varies the solver, or the folds' preparations give
    different inputs."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import VectorAssembler, VectorSizeHint
    from pyspark.ml.functions import vector_to_array

    from tabloom.functions.columns import is_numeric_type, join_small, spread
    from tabloom.operators import margin
    from tabloom.operators.encode import category_text, fit_categories
    from tabloom.operators.train import (KERNELS, drop_null_target, fourier_map, margin_classes, vector_sizes)

    if any(set(ps) - _BATCHED for ps in sets) or base.get("solver", "batched") != "batched":
        return None
    sets = [{"kernel": "rbf", "C": 1.0, "gamma": "scale", **base, **ps} for ps in sets]
    for ps in sets:
        if ps["kernel"] not in KERNELS:
            raise ValueError(f"kernel must be one of: {', '.join(KERNELS)}")
    data, _ = drop_null_target(data, label, count=False)
    folds = sorted(r[0] for r in data.select(fold_col).distinct().collect())
    place = {f: i for i, f in enumerate(folds)}
    labels = fit_categories(data, [label])
    k = labels.sizes[label]
    side = labels.table.where(F.col("column_name") == label).select(
        F.col("value").alias("_lv"), F.col("idx").cast("int").alias("_y"))
    code = functools.reduce(lambda c, f: F.when(F.col(fold_col) == f, F.lit(place[f])).otherwise(c), folds,
                            F.lit(-2))

    def rows(df: DataFrame, view: int) -> tuple[DataFrame, list[str]]:
        names = inputs(df)
        named = join_small(df, side, on=category_text(label, df.schema[label].dataType) == F.col("_lv"),
                           how="inner", small_rows=k)
        if names and all(is_numeric_type(df.schema[c].dataType) for c in names):
            x = F.array(*[F.col(c).cast("double") for c in names])
        else:
            stages = [VectorSizeHint(inputCol=c, size=n, handleInvalid="optimistic")
                      for c, n in vector_sizes(df, names).items()]
            stages.append(VectorAssembler(inputCols=names, outputCol="_features", handleInvalid="keep"))
            named = PipelineModel(stages=stages).transform(named)
            x = vector_to_array("_features")
        # every step of the solver reads these rows, so they are dealt to all cores once
        return spread(named.select(x.alias("x"), "_y", code.alias("_fold"), F.lit(view).alias("_view"))), names

    if prepare:
        views = [rows(prepare(data.where(F.col(fold_col) != f))(data), place[f]) for f in folds]
    else:
        views = [rows(data, -1)]
    if any(names != views[0][1] for _, names in views):
        return None
    table = functools.reduce(DataFrame.unionByName, [df for df, _ in views])
    blocks = margin.pack(table, "x", "_y", k, "_fold", "_view", write=margin.write_blocks)

    def width(gamma, fold: int) -> float:
        if isinstance(gamma, (int, float)):
            return float(gamma)
        if gamma == "auto":
            return 1.0 / blocks.inputs
        if gamma != "scale":
            raise ValueError("gamma must be 'scale', 'auto' or a number")
        m = blocks.class_rows(fold).sum() * blocks.inputs
        s, s2 = blocks.moments(fold).sum(axis=1)
        var = s2 / m - (s / m) ** 2 if m else 0.0
        return 1.0 / (blocks.inputs * var) if var > 0 else 1.0

    maps, at, wanted, problems, owner = [], {}, {}, [], []
    for i, ps in enumerate(sets):
        for f in range(len(folds)):
            if ps["kernel"] == "linear":
                key = ("linear",)
            else:
                key = ("rbf", width(ps["gamma"], f), int(ps.get("n_components", 256)), int(ps.get("random_state", 42)))
            if key not in at:
                at[key] = len(maps)
                maps.append(margin.FeatureMap() if len(key) == 1 else margin.FeatureMap(
                    *fourier_map(ps, blocks.inputs, key[1]).weights()))
            model = (at[key], float(ps["C"]), ps.get("class_weight") == "balanced", f)
            if model not in wanted:
                wanted[model] = len(wanted)
                for c in margin_classes(k):
                    problems.append(margin.Column(c, model[1], f, model[0], model[2]))
            owner.append(wanted[model])
    found = margin.solve(blocks, problems, maps, max_steps=int(base.get("max_iter", 100)),
                         tol=float(base.get("tol", margin.TOL)))
    per = len(margin_classes(k))
    models = []
    for (mapping, _, _, f), m in wanted.items():
        mine = found[m * per:(m + 1) * per]
        models.append((m, f, mapping, np.array([c for c, _, _ in mine]), np.array([a for _, a, _ in mine])))
    with small_splits(data.sparkSession, margin.SPLIT_BYTES):
        counts = cut_lineage(margin.held_out_counts(blocks, models, maps), "grid-counts")
    values = {r["model"]: r["value"] for r in metric_table(
        metrics=(metric,), average=average, counts=counts, by=["model"]).collect()}  # sets x folds rows
    n = len(folds)
    return [[values[m] for m in owner[i * n:(i + 1) * n] if m in values] for i in range(len(sets))]


class MetricEvaluator(Evaluator):
    """Spark ML ``Evaluator`` scoring macro/micro/weighted precision, recall,
    F1 or accuracy from one confusion aggregate (Spark's own multiclass
    evaluator has no macro average).  Usable in ``CrossValidator``."""

    def __init__(self, labelCol: str = "label_idx", predictionCol: str = "prediction",
                 metric: str = "f1", average: str = "macro"):
        super().__init__()
        from tabloom.operators.evaluate import validate_metrics

        validate_metrics((metric,), average)
        self.labelCol, self.predictionCol = labelCol, predictionCol
        self.metric, self.average = metric, average

    def _evaluate(self, dataset: DataFrame) -> float:
        t = metric_table(dataset, self.labelCol, self.predictionCol, (self.metric,),
                         self.average)
        return float(t.first()["value"])

    def isLargerBetter(self) -> bool:
        return True
