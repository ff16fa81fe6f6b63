"""Registered model queries whose right answer SQL knows.

The task: lineitem rows are ``large`` or ``small`` by their quantity, with a wide gap in
the feature that shows it, and one row in twenty has the other label (by its key).  A
model that has learnt the task predicts the rule on every row, so predictions, metrics,
folds, grids and sweeps have exact values: those of the rule against the given labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators import evaluate, permutation, split, train
from tabloom.plans.holdout import run_cross_validation, run_pipeline
from tabloom.plans.queries import THRESH, _bucket, _metrics_sql, _t
from tabloom.plans.tuning import grid_search_cv, sweep
from tabloom.session import cut_lineage

FEATURES = ["side", "l_discount", "l_tax"]
STUMPS = {"n_estimators": 5, "max_depth": 1, "max_features": None, "bootstrap": False, "random_state": 42}
LINEAR = {"kernel": "linear", "C": 1.0}
RBF = {"kernel": "rbf", "C": 1.0, "gamma": "scale", "n_components": 64, "random_state": 42}
# The parameter grid of the reference's SVM search.
SVM_GRID = {"C": [0.1, 1.0, 10.0], "kernel": ["linear", "rbf"], "gamma": ["scale", "auto", 0.1]}
METRICS = ("accuracy", "precision", "recall", "f1")


def sized_rows(spark, sf) -> DataFrame:
    """row_key, side, l_discount, l_tax, size (given label), rule (true label)."""
    large = F.col("l_quantity") > 25
    other = F.pmod(F.col("l_orderkey") * 7 + F.col("l_linenumber") * 3 + F.col("l_partkey"), F.lit(20)) == 0
    name = lambda c: F.when(c, "large").otherwise("small")
    quantity = F.col("l_quantity").cast("double")
    return _t(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("row_key"),
        F.when(large, quantity + 20).otherwise(quantity - 20).alias("side"), "l_discount", "l_tax",
        name(large != other).alias("size"), name(large).alias("rule"))


_SQL_ROWS = """SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS row_key,
  CASE WHEN (l_quantity > 25) <> ((l_orderkey * 7 + l_linenumber * 3 + l_partkey) % 20 = 0)
       THEN 'large' ELSE 'small' END AS size,
  CASE WHEN l_quantity > 25 THEN 'large' ELSE 'small' END AS rule FROM lineitem"""
_SQL_TEST = f"SELECT row_key, size, rule AS prediction FROM ({_SQL_ROWS}) WHERE {_bucket('row_key')} < {THRESH}"


def _run(spark, sf, model_type, params):
    return run_pipeline(sized_rows(spark, sf), "size", "row_key", numeric=FEATURES, model_type=model_type,
                        hyperparameters=params, count_dropped=False)


def _predictions(model_type, params):
    def query(spark, sf):
        return _run(spark, sf, model_type, params).predictions.select("row_key", "size", "prediction")

    return query


def q_pipeline_rule(spark, sf):
    return _run(spark, sf, "random_forest", STUMPS).evaluation.metrics.select(
        "metric", F.round("value", 6).alias("value"))


def q_cross_validate_rule(spark, sf):
    """Three folds, preparation and forest refitted in each."""
    res = run_cross_validation(sized_rows(spark, sf), "size", "row_key", numeric=FEATURES,
                               hyperparameters=STUMPS, folds=3, stratified=False, metrics=METRICS)
    return res.per_fold.select("fold", "metric", F.round("value", 6).alias("value"))


def q_grid_search_svm(spark, sf):
    """The 18 sets of the reference's SVM grid, three folds each, solved together."""
    rows = split.kfold(sized_rows(spark, sf), "row_key", 3, 42)     # written once, by the search
    res = grid_search_cv(rows, "size", FEATURES, "svm", SVM_GRID, "fold",
                         base_params={"random_state": 42, "n_components": 64}, scoring="accuracy", key="row_key",
                         prepare=_zscores, refit=False)
    return res.scores.select("set_id", "params", F.round("mean_score", 6).alias("mean_score"),
                             F.round("std_score", 6).alias("std_score"))


def _zscores(rows: DataFrame):
    from tabloom.operators import scale

    fitted = scale.fit_zscore(rows, FEATURES)

    def apply(df: DataFrame) -> DataFrame:
        mean = {c: fitted.stats[c] for c in FEATURES}
        return df.select(*[c for c in df.columns if c not in FEATURES],
                         *[((F.col(c) - mean[c][0]) / mean[c][1]).alias(c) for c in FEATURES])

    return apply


def q_sweep_rule(spark, sf):
    """A forest and a linear SVM on the same split, by the sweep operator."""
    rows = cut_lineage(split.holdout_split(sized_rows(spark, sf), "row_key", 0.2, 42))

    def run(name, params):
        clf = train.train_classifier(rows.where("split = 'train'"), "size", FEATURES, params["model"],
                                     params["set"], key="row_key")
        return evaluate.metric_table(train.predict(clf, rows.where("split = 'test'")), "size", "prediction")

    sets = {"forest": {"model": "random_forest", "set": STUMPS}, "svm": {"model": "svm", "set": LINEAR}}
    return sweep(sets, run).select("run", "metric", F.round("value", 6).alias("value"))


def q_importance_rule(spark, sf):
    """Trees of one split put all importance on the one feature that shows the label."""
    clf = train.train_classifier(sized_rows(spark, sf), "size", FEATURES, "random_forest", STUMPS, key="row_key")
    return train.feature_importance(clf).select("feature", F.round("importance", 6).alias("importance"))


def priced_rows(spark, sf) -> DataFrame:
    """o_orderkey, side, clerk, week and size of ``orders``: as ``sized_rows``, under a unique key."""
    price = F.col("o_totalprice").cast("double") / 10_000
    large = F.col("o_totalprice") > 250_000
    other = F.pmod(F.col("o_orderkey"), F.lit(20)) == 0
    return _t(spark, sf, "orders").select(
        "o_orderkey", F.when(large, price + 20).otherwise(price - 20).alias("side"),
        (F.pmod("o_custkey", F.lit(10)) / 100).alias("clerk"), (F.pmod("o_orderkey", F.lit(7)) / 100).alias("week"),
        F.when(large != other, "large").otherwise("small").alias("size"))


def q_permutation_importance(spark, sf):
    """A linear SVM: only the feature that shows the rule matters, by what its dealt values cost."""
    rows = priced_rows(spark, sf)
    clf = train.train_classifier(rows, "size", ["side", "clerk", "week"], "svm", LINEAR, key="o_orderkey")
    found = permutation.permutation_importance(clf, rows, "o_orderkey")
    return found.select("feature", "metric", *[F.round(c, 6).alias(c) for c in ("baseline", "permuted", "importance")])


def q_dealt_column(spark, sf):
    """The dealt prices of all orders: a one-to-one reordering."""
    return permutation.deal(_t(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey",
                            ["o_totalprice"]).withColumnRenamed("_dealt_o_totalprice", "dealt")


QUERIES = {
    "permutation_importance": q_permutation_importance,
    "dealt_column": q_dealt_column,
    "forest_rule": _predictions("random_forest", STUMPS),
    "svm_linear_rule": _predictions("svm", LINEAR),
    "svm_rbf_rule": _predictions("svm", RBF),
    "pipeline_rule": q_pipeline_rule,
    "cross_validate_rule": q_cross_validate_rule,
    "grid_search_svm": q_grid_search_svm,
    "sweep_rule": q_sweep_rule,
    "importance_rule": q_importance_rule,
}


def _named(avgs: str, columns: str = "") -> str:
    pick = {"accuracy": "accuracy", "precision": "precision_macro", "recall": "recall_macro", "f1": "f1_macro"}
    return " UNION ALL ".join(f"SELECT {columns}'{m}' AS metric, round({c}, 6) AS value FROM {avgs}"
                              for m, c in pick.items())


_SQL_METRICS = "WITH " + _metrics_sql(f"pred AS (SELECT 1 AS g, size AS actual, prediction AS predicted "
                                      f"FROM ({_SQL_TEST}))")
_SQL_FOLDS = "WITH " + _metrics_sql(f"pred AS (SELECT ({_bucket('row_key')} % 3) AS g, size AS actual, "
                                    f"rule AS predicted FROM ({_SQL_ROWS}))")


def _grid_sql() -> str:
    import json

    from tabloom.plans.tuning import expand_grid

    rows = ", ".join(f"({i}::BIGINT, '{json.dumps(ps, sort_keys=True)}')" for i, ps in enumerate(expand_grid(SVM_GRID)))
    return f"""{_SQL_FOLDS} SELECT set_id, params, mean_score, std_score FROM (VALUES {rows}) AS t(set_id, params)
CROSS JOIN (SELECT round(avg(accuracy), 6) AS mean_score, round(stddev_samp(accuracy), 6) AS std_score FROM avgs2)"""


_SQL_DEALT = """WITH o AS (SELECT o_orderkey, o_totalprice, o_totalprice > 250000 AS rule,
  (o_totalprice > 250000) <> (o_orderkey % 20 = 0) AS size,
  row_number() OVER (ORDER BY md5('42|' || o_orderkey), o_orderkey) AS place,
  row_number() OVER (ORDER BY md5('43|' || o_orderkey), o_orderkey) AS donor FROM orders),
d AS (SELECT a.*, b.rule AS dealt_rule, b.o_totalprice AS dealt FROM o a JOIN o b ON a.place = b.donor)"""
_SQL_PERMUTED = f"""{_SQL_DEALT}, s AS (SELECT avg((rule = size)::INT) AS b, avg((dealt_rule = size)::INT) AS p FROM d)
SELECT feature, 'accuracy' AS metric, round(b, 6) AS baseline,
  round(CASE WHEN feature = 'side' THEN p ELSE b END, 6) AS permuted,
  round(CASE WHEN feature = 'side' THEN b - p ELSE 0.0 END, 6) AS importance
FROM s CROSS JOIN (VALUES ('side'), ('clerk'), ('week')) AS t(feature)"""

ORACLE = {
    "permutation_importance": _SQL_PERMUTED,
    "dealt_column": f"{_SQL_DEALT} SELECT o_orderkey, o_totalprice, dealt FROM d",
    **{k: _SQL_TEST for k in ("forest_rule", "svm_linear_rule", "svm_rbf_rule")},
    "pipeline_rule": f"{_SQL_METRICS} {_named('avgs2')}",
    "cross_validate_rule": f"{_SQL_FOLDS} {_named('avgs2', 'g AS fold, ')}",
    "grid_search_svm": _grid_sql(),
    "sweep_rule": f"{_SQL_METRICS} " + _named(
        "avgs2 CROSS JOIN (VALUES ('forest'), ('svm')) AS t(run)", "run, "),
    "importance_rule": "SELECT * FROM (VALUES ('side', 1.0::DOUBLE), ('l_discount', 0.0), ('l_tax', 0.0)) "
                       "AS t(feature, importance)",
}
