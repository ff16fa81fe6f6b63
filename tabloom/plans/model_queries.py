"""Registered model-based queries.

What a model predicts has no SQL twin; what SQL knows of the result has: which
rows are in the test part with which label, that every prediction is a known
label, which folds, parameter sets and features there are, and that scores lie
between 0 and 1 and beat the majority class where the task can be learnt.  All of them read whole shared tables through the task builders in
``tabloom.plans.tasks`` and run the library's training, prediction,
tuning, persistence and sweep operators.
"""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.operators import encode, evaluate, scale, split, train
from tabloom.plans import tasks
from tabloom.plans.queries import THRESH, _bucket
from tabloom.plans.holdout import run_cross_validation, run_pipeline
from tabloom.plans.tuning import grid_results, grid_search, grid_search_cv, sweep
from tabloom.session import cut_lineage, scratch_path
from tabloom.sources import models

FOREST = {"n_estimators": 30, "max_depth": 8, "random_state": 42}
SVM_LINEAR = {"kernel": "linear", "C": 1.0, "max_iter": 50}
SVM_RBF = {"kernel": "rbf", "C": 1.0, "gamma": "scale", "n_components": 128, "max_iter": 50,
           "random_state": 42}


def _doc_pipeline(spark, sf, model_type="random_forest", params=None, metrics=None):
    df = tasks.document_quality(spark, sf)
    return run_pipeline(df, "quality", "doc_id", categorical=tasks.DOC_CATEGORICAL,
                        numeric=tasks.DOC_NUMERIC, model_type=model_type,
                        hyperparameters=params or FOREST,
                        metrics=metrics or ("accuracy", "precision", "recall", "f1", "roc_auc"))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Class report of the document-quality forest (per class + averages)."""
    return _doc_pipeline(spark, sf).evaluation.report


def _share(value: str = "value") -> F.Column:
    return F.col(value).between(0.0, 1.0).alias("in_range")


def _known(predictions: DataFrame, key: str, label: str, values, beats: bool = True) -> DataFrame:
    """Key, actual label, whether the prediction is a known label, and (for a
    task that can be learnt) whether the accuracy beats the majority share."""
    p = predictions.select(F.col(key), F.col(label), F.col("prediction").isin(list(values)).alias("known"),
                           (F.col("prediction") == F.col(label)).cast("double").alias("_hit"))
    if not beats:
        return p.drop("_hit")
    top = p.groupBy(label).agg(F.count(F.lit(1)).alias("n")).agg(
        (F.max("n") / F.sum("n")).alias("_top")).first()["_top"]
    better = p.agg(F.avg("_hit").alias("a")).first()["a"] > top
    return p.drop("_hit").withColumn("beats_majority", F.lit(better))


def q_holdout_metrics(spark, sf):
    return _doc_pipeline(spark, sf).evaluation.metrics.select("metric", _share())


def q_forest_predict(spark, sf):
    return _known(_doc_pipeline(spark, sf).predictions, "doc_id", "quality", (0, 1))


def q_svm_linear_predict(spark, sf):
    df = tasks.price_band(spark, sf)
    res = run_pipeline(df, "band", "row_key", numeric=tasks.PRICE_FEATURES, model_type="svm",
                       hyperparameters=SVM_LINEAR)
    return _known(res.predictions, "row_key", "band", ("low", "mid", "high"))


def q_svm_rbf_predict(spark, sf):
    return _known(_doc_pipeline(spark, sf, "svm", SVM_RBF).predictions, "doc_id", "quality", (0, 1))


def q_embedding_ovr_predict(spark, sf):
    """10-class one-vs-rest linear SVM on 64-float embeddings (mechanics)."""
    df = tasks.embedding_class(spark, sf)
    res = run_pipeline(df, "label", "vec_id", features=tasks.EMBED_FEATURES, model_type="svm",
                       hyperparameters=SVM_LINEAR, normalize=False)
    return _known(res.predictions, "vec_id", "label", range(10), beats=False)


def _prepared_docs(spark, sf) -> DataFrame:
    """Documents prepared by what their training part gives, with ``split``;
    written once, so that no later pass reads a text again."""
    parts = split.holdout_split(cut_lineage(tasks.document_quality(spark, sf)), "doc_id", 0.2, 42)
    prep = encode.fit_preprocess(parts.where("split = 'train'"), tasks.DOC_CATEGORICAL, tasks.DOC_NUMERIC)
    return cut_lineage(encode.apply_preprocess(parts, prep))


DOC_FEATURES = tasks.DOC_NUMERIC + [f"{c}_encoded" for c in tasks.DOC_CATEGORICAL]


def _train_forest(df, params=None):
    return train.train_classifier(df.where("split = 'train'"), "quality", DOC_FEATURES, "random_forest",
                                  params or FOREST, key="doc_id")


def q_feature_importance(spark, sf):
    imp = train.feature_importance(_train_forest(_prepared_docs(spark, sf)))
    return imp.select("feature", _share("importance"))


def q_model_roundtrip(spark, sf):
    df = _prepared_docs(spark, sf)
    clf = _train_forest(df)
    path = scratch_path(spark, "model")
    models.save_classifier(clf, path)
    again = models.load_classifier(spark, path)
    a = train.predict(clf, df).select("doc_id", F.col("prediction").alias("before"))
    b = train.predict(again, df).select("doc_id", F.col("prediction").alias("after"))
    return a.join(b, "doc_id").select("doc_id", (F.col("before") == F.col("after")).alias("same"))


def q_grid_search_best(spark, sf):
    df = _prepared_docs(spark, sf).where("split = 'train'")
    folds = split.kfold(df, "doc_id", 3, 42)
    labels = encode.fit_categories(folds, ["quality"])
    idx = encode.apply_categories(folds, labels, ["quality"]).withColumn(
        "label_idx", F.col("quality_encoded").cast("double"))
    data = scale.assemble(idx, DOC_FEATURES, handle_invalid="keep")
    from pyspark.ml.classification import RandomForestClassifier

    rf = RandomForestClassifier(featuresCol="features", labelCol="label_idx", seed=42)
    grid = {"numTrees": [10, 30], "maxDepth": [3, 6]}
    ev = MulticlassClassificationEvaluator(labelCol="label_idx", metricName="accuracy")
    cvm = grid_search(rf, grid, data, ev, fold_col="fold")
    rows = grid_results(cvm, grid)
    return spark.createDataFrame(
        [(int(r["numTrees"]), int(r["maxDepth"]), r["score"]) for r in rows],
        "num_trees bigint, max_depth bigint, score double").select(
        "num_trees", "max_depth", _share("score"))


def q_grid_search_cv(spark, sf):
    """Reference-style grid (estimator parameter names) scored by stratified 3-fold CV,
    preparation refitted inside every fold; one row per parameter set."""
    df = tasks.document_quality(spark, sf)
    folds = split.stratified_kfold(df, "doc_id", "quality", 3, 42)

    def prepare(tr):
        prep = encode.fit_preprocess(tr, tasks.DOC_CATEGORICAL, tasks.DOC_NUMERIC)
        return lambda x: encode.apply_preprocess(x, prep)

    res = grid_search_cv(folds, "quality", DOC_FEATURES, "random_forest",
                         {"n_estimators": [10, 30], "max_depth": [3, None]}, "fold",
                         base_params={"random_state": 42}, scoring="accuracy", key="doc_id",
                         prepare=prepare, refit=False)
    return res.scores.select("set_id", "params", _share("mean_score"))


def q_cross_validate_forest(spark, sf):
    """Stratified 3-fold CV with preparation refitted inside every fold."""
    res = run_cross_validation(tasks.document_quality(spark, sf), "quality", "doc_id",
                               categorical=tasks.DOC_CATEGORICAL, numeric=tasks.DOC_NUMERIC,
                               hyperparameters=FOREST, folds=3,
                               metrics=("accuracy", "precision", "recall", "f1", "roc_auc"))
    return res.per_fold.select("fold", "metric", _share())


def q_sweep_runs(spark, sf):
    df = _prepared_docs(spark, sf)

    def run(name, params):
        scored = train.predict(_train_forest(df, params), df.where("split = 'test'"))
        return evaluate.metric_table(scored, "quality", "prediction")

    sets = {"shallow": {"n_estimators": 10, "max_depth": 3, "random_state": 42},
            "deeper": {"n_estimators": 30, "max_depth": 8, "random_state": 42},
            "balanced": {"n_estimators": 30, "max_depth": 8, "class_weight": "balanced",
                         "random_state": 42}}
    return sweep(sets, run).select("run", "metric", _share())


def q_stream_scoring(spark, sf):
    """Fit the price-band forest on the batch table, then score lineitem read
    as a file stream (availableNow trigger, checkpointed Parquet sink)."""
    from tabloom.streaming import scoring

    batch = tasks.price_band(spark, sf)
    res = run_pipeline(batch, "band", "row_key", numeric=tasks.PRICE_FEATURES,
                       hyperparameters={"n_estimators": 10, "max_depth": 6, "random_state": 42})
    li_schema = spark.read.parquet(f"{sf}/lineitem.parquet").schema
    stream = (spark.readStream.schema(li_schema).option("pathGlobFilter", "lineitem.parquet")
              .parquet(sf))
    scored = scoring.score_stream(tasks.price_band_rows(stream), res.classifier, res.preprocess, res.features,
                                  keep=["row_key", "band"])
    out, ck = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ck")
    q = scoring.write_stream(scored, out, ck)
    q.awaitTermination()
    return spark.read.parquet(out).select(
        "row_key", "band", F.col("prediction").isin("low", "mid", "high").alias("known"))


QUERIES = {
    "holdout_metrics": q_holdout_metrics,
    "forest_predict": q_forest_predict,
    "svm_linear_predict": q_svm_linear_predict,
    "svm_rbf_predict": q_svm_rbf_predict,
    "embedding_ovr_predict": q_embedding_ovr_predict,
    "feature_importance": q_feature_importance,
    "model_roundtrip": q_model_roundtrip,
    "grid_search_best": q_grid_search_best,
    "grid_search_cv": q_grid_search_cv,
    "cross_validate_forest": q_cross_validate_forest,
    "sweep_runs": q_sweep_runs,
    "stream_scoring": q_stream_scoring,
}


def _sql_test(table: str, key: str, label: str, beats: bool = True) -> str:
    more = ", true AS beats_majority" if beats else ""
    return (f"SELECT {key}, {label}, true AS known{more} FROM ({table}) WHERE {_bucket(key)} < {THRESH}")


_SQL_DOCS = "SELECT doc_id, quality FROM labels SEMI JOIN documents USING (doc_id)"
_SQL_BANDS = f"""SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS row_key,
  CASE WHEN l_extendedprice < {tasks.PRICE_EDGES[0]} THEN 'low'
       WHEN l_extendedprice < {tasks.PRICE_EDGES[1]} THEN 'mid' ELSE 'high' END AS band FROM lineitem"""


def _sql_in_range(columns: str, rows: list[tuple]) -> str:
    """Rows that the query must have, each with a share between 0 and 1."""
    values = ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else f"{v}::BIGINT" for v in r) + ")"
                       for r in rows)
    return f"SELECT {columns}, true AS in_range FROM (VALUES {values}) AS t({columns})"


_COUNT_METRICS = ("accuracy", "precision", "recall", "f1")

ORACLE = {
    "holdout_metrics": _sql_in_range("metric", [(m,) for m in (*_COUNT_METRICS, "roc_auc")]),
    "forest_predict": _sql_test(_SQL_DOCS, "doc_id", "quality"),
    "svm_rbf_predict": _sql_test(_SQL_DOCS, "doc_id", "quality"),
    "svm_linear_predict": _sql_test(_SQL_BANDS, "row_key", "band"),
    "embedding_ovr_predict": _sql_test("SELECT vec_id, label FROM embeddings", "vec_id", "label", False),
    "feature_importance": _sql_in_range("feature", [(c,) for c in DOC_FEATURES]),
    "model_roundtrip": f"SELECT doc_id, true AS same FROM ({_SQL_DOCS})",
    "grid_search_best": _sql_in_range("num_trees, max_depth", [(t, d) for t in (10, 30) for d in (3, 6)]),
    "grid_search_cv": _sql_in_range("set_id, params", [
        (i, f'{{"max_depth": {d}, "n_estimators": {n}}}') for i, (n, d) in enumerate(
            [(10, 3), (10, "null"), (30, 3), (30, "null")])]),
    "cross_validate_forest": _sql_in_range("fold, metric", [
        (f, m) for f in range(3) for m in (*_COUNT_METRICS, "roc_auc")]),
    "sweep_runs": _sql_in_range("run, metric", [
        (r, m) for r in ("shallow", "deeper", "balanced") for m in _COUNT_METRICS]),
    "stream_scoring": f"SELECT row_key, band, true AS known FROM ({_SQL_BANDS})",
}
