"""Dealt columns and permutation importance."""
import pytest

from tabloom.operators import permutation, train


@pytest.mark.parametrize("size", [2_000_000, 40])
def test_dealt_values_are_a_reordering(spark, size):
    rows = [(None if i % 50 == 0 else i // 2, f"v{i}", i % 3) for i in range(300)]  # null and repeated keys
    df = spark.createDataFrame(rows, "k long, v string, w int").repartition(5)
    got = permutation.deal(df, "k", ["v", "w"], rows_per_bucket=size)
    assert got.columns == ["k", "v", "w", "_dealt_v", "_dealt_w"]
    found = got.collect()
    assert sorted((r.v, r.w) for r in found) == sorted((r._dealt_v, r._dealt_w) for r in found) == sorted(
        (v, w) for _, v, w in rows)
    assert sum(r.v == r._dealt_v for r in found) < 20
    assert permutation.deal(df.limit(0), "k", ["v"]).count() == 0


def test_buckets_do_not_change_the_dealing(spark):
    df = spark.range(500).selectExpr("id AS k", "id * 3 AS v")
    a = {tuple(r) for r in permutation.deal(df, "k", ["v"]).collect()}
    assert a == {tuple(r) for r in permutation.deal(df.repartition(7), "k", ["v"], rows_per_bucket=30).collect()}


@pytest.mark.parametrize("model, params", [("random_forest", {"n_estimators": 3, "max_depth": 3, "random_state": 1}),
                                           ("svm", {"kernel": "linear", "C": 1.0})])
def test_importance_names_the_informative_feature(spark, model, params):
    df = spark.range(600).selectExpr("id AS k", "if(id % 2 = 0, 3.0, -3.0) + (id % 7) / 10 AS good",
                                     "(id % 5) / 10 AS noise", "if(id % 2 = 0, 'x', 'y') AS label")
    clf = train.train_classifier(df, "label", ["good", "noise"], model, params, key="k")
    got = {(r.feature, r.metric): r for r in permutation.permutation_importance(
        clf, df, "k", metrics=("accuracy", "f1")).collect()}
    assert len(got) == 4
    for metric in ("accuracy", "f1"):
        assert got["good", metric].baseline == 1.0 and got["noise", metric].importance == 0.0
        assert 0.4 < got["good", metric].importance < 0.6
