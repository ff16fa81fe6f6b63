"""Fixture goldens F7 (metrics) and AUC checks."""
import pytest
from pyspark.sql import functions as F

from tabloom.operators import evaluate as ev

ACTUAL = [0] * 5 + [1] * 4 + [2] * 3
PRED = [0, 0, 0, 1, 2] + [1] * 4 + [0, 2, 2]


@pytest.fixture
def f7(spark):
    return spark.createDataFrame(list(zip(ACTUAL, PRED)), "actual bigint, predicted bigint")


def _m(df, average):
    return {r["metric"]: r["value"] for r in ev.metric_table(df, average=average).collect()}


def test_macro_weighted_micro(f7):
    m = _m(f7, "macro")
    assert m["accuracy"] == pytest.approx(0.75)
    assert m["precision"] == pytest.approx(0.738889, abs=1e-6)
    assert m["recall"] == pytest.approx(0.755556, abs=1e-6)
    assert m["f1"] == pytest.approx(0.740741, abs=1e-6)
    w = _m(f7, "weighted")
    assert (w["precision"], w["recall"], w["f1"]) == pytest.approx((0.745833, 0.75, 0.740741), abs=1e-6)
    mi = _m(f7, "micro")
    assert mi["precision"] == mi["recall"] == pytest.approx(0.75)
    assert mi["f1"] == pytest.approx(0.75)


def test_confusion_and_report(f7):
    cm = {(r["actual"], r["predicted"]): r["n"] for r in ev.confusion_matrix(f7).collect()}
    assert [[cm[(a, p)] for p in range(3)] for a in range(3)] == [[3, 1, 1], [0, 4, 0], [1, 0, 2]]
    rep = {r["label"]: r for r in ev.class_report(f7).collect()}
    assert rep["1"]["f1"] == pytest.approx(0.888889, abs=1e-6)
    assert rep["2"]["recall"] == pytest.approx(0.666667, abs=1e-6)
    assert rep["macro avg"]["precision"] == pytest.approx(0.738889, abs=1e-6)
    assert rep["accuracy"]["f1"] == pytest.approx(0.75)
    assert [r["label"] for r in ev.label_set(f7).collect()] == [0, 1, 2]


def test_absent_classes_golden(spark):
    rows = [(0, 0)] * 61 + [(0, 1)] * 6 + [(0, 2)]
    m = _m(spark.createDataFrame(rows, "actual int, predicted int"), "macro")
    assert m["accuracy"] == pytest.approx(0.897059, abs=1e-6)
    assert m["precision"] == pytest.approx(0.333333, abs=1e-6)
    assert m["recall"] == pytest.approx(0.299020, abs=1e-6)
    assert m["f1"] == pytest.approx(0.315245, abs=1e-6)


def test_bad_metric_name(f7):
    with pytest.raises(ValueError):
        ev.metric_table(f7, metrics=("auc",))


def _brute_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_auc_binary_matches_brute_force(spark):
    pairs = [(1 if i % 3 == 0 else 0, float((i * 7) % 11)) for i in range(200)]
    df = spark.createDataFrame(pairs, "y int, s double")
    got = ev.roc_auc_binary(df, "y", "s").first()["auc"]
    assert got == pytest.approx(_brute_auc(pairs), abs=1e-12)


def test_auc_ovr_macro(spark):
    rows = [(i % 3, float(i % 5), float(i % 7), float(i % 4)) for i in range(120)]
    df = spark.createDataFrame(rows, "y int, s0 double, s1 double, s2 double")
    per = {r["class"]: r["auc"] for r in ev.roc_auc_ovr(df, "y", {0: "s0", 1: "s1", 2: "s2"}).collect()}
    for c in range(3):
        pairs = [(1 if r[0] == c else 0, r[1 + c]) for r in rows]
        assert per[str(c)] == pytest.approx(_brute_auc(pairs), abs=1e-12)
    assert per["macro"] == pytest.approx(sum(per[str(c)] for c in range(3)) / 3)


def test_evaluate_bundle(f7):
    e = ev.evaluate(f7.withColumn("s", F.col("predicted").cast("double")),
                    metrics=("accuracy", "f1"))
    assert {r["metric"] for r in e.metrics.collect()} == {"accuracy", "f1"}
    assert e.confusion.count() == 9


def test_auc_multi_bucket_with_hot_class(spark):
    # One class holds well over a third of the rows; force the bucketed path.
    pairs = [(1 if i % 5 else 0, float((i * 13) % 97)) for i in range(600)]
    df = spark.createDataFrame(pairs, "y int, s double")
    got = ev.roc_auc_binary(df, "y", "s", rows_per_bucket=10).first()["auc"]
    assert got == pytest.approx(_brute_auc(pairs), abs=1e-12)
    rows = [(i % 3 if i % 4 else 0, float(i % 17), float(i % 11), float(i % 7)) for i in range(300)]
    d3 = spark.createDataFrame(rows, "y int, s0 double, s1 double, s2 double")
    per = {r["class"]: r["auc"] for r in
           ev.roc_auc_ovr(d3, "y", {0: "s0", 1: "s1", 2: "s2"}, rows_per_bucket=5).collect()}
    for c in range(3):
        assert per[str(c)] == pytest.approx(
            _brute_auc([(1 if r[0] == c else 0, r[1 + c]) for r in rows]), abs=1e-12)


def test_many_labels_need_no_grid(spark):
    df = spark.range(12_000).select(F.col("id").alias("actual"), (F.col("id") % 7).alias("predicted"))
    e = ev.evaluate(df, metrics=("accuracy",))
    assert e.metrics.first()["value"] == pytest.approx(7 / 12_000)
    assert e.counts.count() == 12_000


def test_each_metric_alone(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (1, 1, 0.9)], "actual int, predicted int, s double")
    scores = {0: F.lit(0.0), 1: "s"}
    got = ev.evaluate(df, metrics=("roc_auc",), scores=scores).metrics.collect()
    assert [(r["metric"], r["value"]) for r in got] == [("roc_auc", 1.0)]
    only = ev.evaluate(df, metrics=("confusion_matrix",))
    assert only.metrics.count() == 0 and only.confusion.count() == 4
    with pytest.raises(ValueError):
        ev.evaluate(df, metrics=("roc_auc",))


def test_null_scores_count_alike(spark):
    rows = [(0, 0.1), (0, None), (1, 0.9), (1, None), (1, 0.05)]
    df = spark.createDataFrame(rows, "y int, s double").withColumn("t", 1 - F.col("s"))
    one = ev.roc_auc_binary(df, "y", "s").first()["auc"]
    per = {r["class"]: r["auc"] for r in ev.roc_auc_ovr(df, "y", {0: "t", 1: "s"}, "micro").collect()}
    assert per["1"] == pytest.approx(one) == pytest.approx(0.5)
    pooled = [(1 if c == y else 0, s if c == 1 else 1 - s) for y, s in rows if s is not None for c in (0, 1)]
    assert per["micro"] == pytest.approx(_brute_auc(pooled))


def test_auc_absent_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.7)], "y int, s double")
    r = ev.roc_auc_binary(df, "y", "s").first()
    assert r["auc"] is None and r["n_pos"] == 2 and r["n_neg"] == 0


def test_evaluate_binary_roc_auc(spark):
    pairs = [(1 if i % 3 == 0 else 0, float((i * 7) % 11)) for i in range(120)]
    df = spark.createDataFrame([(y, 1 if s > 5 else 0, s) for y, s in pairs],
                               "actual int, predicted int, s double")
    e = ev.evaluate(df, metrics=("accuracy", "roc_auc"), scores={0: F.lit(0.0), 1: "s"})
    m = {r["metric"]: r["value"] for r in e.metrics.collect()}
    assert m["roc_auc"] == pytest.approx(_brute_auc(pairs), abs=1e-12)


def test_confusion_wide_f7(f7):
    rows = ev.confusion_wide(f7).collect()
    assert [[r[str(p)] for p in range(3)] for r in rows] == [[3, 1, 1], [0, 4, 0], [1, 0, 2]]
    counts = {r["label"]: r["n"] for r in ev.prediction_counts(f7).collect()}
    assert counts == {0: 4, 1: 5, 2: 3}
