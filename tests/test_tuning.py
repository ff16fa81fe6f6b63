"""Grid search with reference parameter names, macro evaluator in CrossValidator."""
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from tabloom.operators import scale, split
from tabloom.plans import tuning
from tests.test_models import F6, F6_SCHEMA, FEATS


@pytest.fixture
def f6x(spark):
    rows = [r for r in F6 for _ in range(3)]
    df = spark.createDataFrame(rows, F6_SCHEMA).withColumn("k", F.monotonically_increasing_id())
    return split.stratified_kfold(df, "k", "species", 3, 42)


def test_expand_grid():
    g = tuning.expand_grid({"a": [1, 2], "b": ["x", "y", "z"]})
    assert len(g) == 6 and g[0] == {"a": 1, "b": "x"}


def test_grid_search_cv_svm_kernels(f6x):
    res = tuning.grid_search_cv(f6x, "species", FEATS, "svm",
                                {"kernel": ["linear", "rbf"], "C": [1.0]}, "fold",
                                base_params={"max_iter": 10, "n_components": 16},
                                scoring="f1_macro", key="k")
    rows = res.scores.collect()
    assert len(rows) == 2 and all(0.0 <= r["mean_score"] <= 1.0 for r in rows)
    assert res.best_params["kernel"] in ("linear", "rbf") and res.best_model is not None


def test_bad_scoring(f6x):
    with pytest.raises(ValueError):
        tuning.grid_search_cv(f6x, "species", FEATS, "svm", {"C": [1.0]}, "fold",
                              scoring="roc")


def test_metric_evaluator_in_cross_validator(f6x):
    data = scale.assemble(f6x.withColumn("label_idx", F.col("species").cast("double")), FEATS)
    ev = tuning.MetricEvaluator("label_idx", "prediction", "f1", "macro")
    cvm = tuning.grid_search(RandomForestClassifier(labelCol="label_idx", seed=1),
                             {"numTrees": [3, 5]}, data, ev, fold_col="fold")
    assert len(cvm.avgMetrics) == 2 and all(0 <= m <= 1 for m in cvm.avgMetrics)


def test_run_concurrently_order_and_errors():
    import time as _t

    out = tuning.run_concurrently(lambda x: (_t.sleep(0.01 * (5 - x)), x * x)[1], range(5), 4)
    assert out == [0, 1, 4, 9, 16]

    def boom(x):
        if x == 2:
            raise RuntimeError("fold failed")
        return x

    with pytest.raises(RuntimeError):
        tuning.run_concurrently(boom, range(4), 3)
