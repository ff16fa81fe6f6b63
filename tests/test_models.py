"""Training, prediction, persistence, pipeline and streaming (F6 and tasks)."""
import pytest
from pyspark.sql import functions as F

from tabloom.operators import train
from tabloom.plans import tasks
from tabloom.plans.holdout import run_pipeline
from tabloom.session import scratch_path
from tabloom.sources import models
from tabloom.streaming import scoring
from tests.conftest import SF01

F6 = [(39.1, 18.7, 181, 3750, 0), (46.5, 17.9, 192, 3500, 1), (39.5, 17.4, 186, 3800, 0),
      (50.0, 15.2, 218, 5700, 2), (40.3, 18.0, 195, 3250, 0), (45.4, 18.7, 188, 3525, 1),
      (36.7, 19.3, 193, 3450, 0), (49.0, 19.5, 210, 3950, 1), (46.2, 17.5, 187, 3650, 1),
      (50.5, 15.9, 225, 5400, 2)]
F6_SCHEMA = ("culmen_length_mm double, culmen_depth_mm double, flipper_length_mm bigint, "
             "body_mass_g bigint, species int")
FEATS = ["culmen_length_mm", "culmen_depth_mm", "flipper_length_mm", "body_mass_g"]


@pytest.fixture
def f6(spark):
    return spark.createDataFrame(F6, F6_SCHEMA).withColumn("k", F.monotonically_increasing_id())


def test_forest_f6(f6):
    clf = train.train_classifier(f6, "species", FEATS, "random_forest",
                                 {"n_estimators": 10, "max_depth": 5, "random_state": 42}, key="k")
    rf = clf.model.stages[-1]
    assert rf.getNumTrees == 10 and rf.getOrDefault("maxDepth") == 5
    assert train.feature_importance(clf).count() == 4
    pred = train.predict(clf, f6).collect()
    assert len(pred) == 10 and {r["prediction"] for r in pred} <= {0, 1, 2}


@pytest.mark.parametrize("kernel", ["linear", "rbf"])
def test_svm_f6(f6, kernel):
    clf = train.train_classifier(f6, "species", FEATS, "svm",
                                 {"kernel": kernel, "C": 1.0, "max_iter": 20, "n_components": 32},
                                 key="k")
    pred = train.predict(clf, f6).collect()
    assert len(pred) == 10 and {r["prediction"] for r in pred} <= {0, 1, 2}


def test_bad_model_type(f6):
    with pytest.raises(ValueError):
        train.train_classifier(f6, "species", FEATS, "boosting")


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "y int")
    w = {r["y"]: r["weight"] for r in train.class_weights(df, "y").collect()}
    assert w[0] == pytest.approx(8 / (2 * 6)) and w[1] == pytest.approx(8 / (2 * 2))


def test_model_save_load_same_predictions(spark, f6):
    clf = train.train_classifier(f6, "species", FEATS, "random_forest",
                                 {"n_estimators": 5, "max_depth": 3}, key="k")
    path = scratch_path(spark, "m")
    models.save_classifier(clf, path)
    again = models.load_classifier(spark, path)
    a = train.predict(clf, f6).select("k", "prediction")
    b = train.predict(again, f6).select("k", "prediction")
    assert a.exceptAll(b).count() == 0


def test_seed_and_layout_repeatable(f6):
    p = {"n_estimators": 10, "max_depth": 4, "random_state": 7}
    a = train.train_classifier(f6, "species", FEATS, "random_forest", p, key="k")
    b = train.train_classifier(f6.repartition(5).orderBy(F.rand(1)), "species", FEATS,
                               "random_forest", p, key="k")
    pa = train.predict(a, f6).select("k", "prediction")
    pb = train.predict(b, f6).select("k", "prediction")
    assert pa.exceptAll(pb).count() == 0


def test_pipeline_document_quality(spark):
    df = tasks.document_quality(spark, SF01)
    res = run_pipeline(df, "quality", "doc_id", categorical=tasks.DOC_CATEGORICAL,
                       numeric=tasks.DOC_NUMERIC,
                       hyperparameters={"n_estimators": 20, "max_depth": 6},
                       metrics=("accuracy", "f1", "roc_auc"))
    m = {r["metric"]: r["value"] for r in res.evaluation.metrics.collect()}
    majority = df.where("quality = 1").count() / df.count()
    assert m["accuracy"] > majority
    assert 0.5 < m["roc_auc"] <= 1.0
    assert res.evaluation.confusion.count() == 4


def test_stream_scoring(spark):
    df = tasks.price_band(spark, SF01)
    res = run_pipeline(df, "band", "row_key", numeric=tasks.PRICE_FEATURES,
                       hyperparameters={"n_estimators": 5, "max_depth": 4})
    src = scratch_path(spark, "stream-src")
    df.write.parquet(src)
    stream = spark.readStream.schema(df.schema).parquet(src)
    scored = scoring.score_stream(stream, res.classifier, res.preprocess, res.features,
                                  keep=["row_key", "band"])
    out, ck = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ck")
    q = scoring.write_stream(scored, out, ck)
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    assert got.count() == df.count()
    assert got.where("prediction = band").count() / got.count() > 0.8


def test_cross_validation_mode(spark):
    from tabloom.plans.holdout import run_cross_validation
    from tabloom.session import scratch_path as sp
    from tabloom.sources import runlog

    log = sp(spark, "cvlog")
    res = run_cross_validation(tasks.document_quality(spark, SF01), "quality", "doc_id",
                               categorical=tasks.DOC_CATEGORICAL, numeric=tasks.DOC_NUMERIC,
                               hyperparameters={"n_estimators": 10, "max_depth": 4}, folds=3,
                               experiment="cv", run="r1", run_log_path=log)
    per = res.per_fold.collect()
    assert len(per) == 12 and {r["fold"] for r in per} == {0, 1, 2}
    summ = {r["metric"]: r for r in res.summary.collect()}
    assert 0.5 < summ["accuracy"]["mean"] <= 1.0
    assert runlog.read_runs(spark, log, "cv").where("kind = 'metric'").count() == 4


def test_forest_parameter_mapping(spark):
    rf = train._forest({"n_estimators": 500, "max_depth": None, "min_samples_split": 5,
                        "min_samples_leaf": 2, "max_features": "sqrt", "bootstrap": True,
                        "random_state": 42}, "w")
    assert rf.getOrDefault("numTrees") == 500 and rf.getOrDefault("maxDepth") == 30
    assert rf.getOrDefault("minInstancesPerNode") == 3
    assert rf.getOrDefault("featureSubsetStrategy") == "sqrt"
    assert rf.getOrDefault("seed") == 42 and rf.getOrDefault("weightCol") == "w"
    assert train._forest({"max_depth": 40, "max_features": None}, None).getOrDefault("maxDepth") == 30


def test_svm_parameter_mapping(spark):
    svc = train._svm({"C": 2.0, "max_iter": 7}, 100, 2, None, "features")
    assert svc.getOrDefault("regParam") == pytest.approx(1 / 200)
    assert svc.getOrDefault("maxIter") == 7 and not svc.getOrDefault("standardization")
    ovr = train._svm({"C": 1.0}, 10, 3, None, "features")
    assert type(ovr).__name__ == "OneVsRest" and ovr.getOrDefault("parallelism") == 3


def test_rbf_gamma_modes(spark):
    df = spark.createDataFrame([(0.0, 2.0), (2.0, 0.0)], "a double, b double")
    assert train.rbf_gamma(df, ["a", "b"], "auto") == pytest.approx(0.5)
    # all entries: 0, 2, 2, 0 -> variance 1 -> 1 / (2 * 1)
    assert train.rbf_gamma(df, ["a", "b"], "scale") == pytest.approx(0.5)
    assert train.rbf_gamma(df, ["a", "b"], 0.1) == 0.1
    with pytest.raises(ValueError):
        train.rbf_gamma(df, ["a"], "bad")


def test_bad_kernel(f6):
    with pytest.raises(ValueError):
        train.train_classifier(f6, "species", FEATS, "svm", {"kernel": "poly"}, key="k")


def test_vector_features_linear_and_rbf(spark):
    df = tasks.embedding_class(spark, SF01)
    for kernel in ("linear", "rbf"):
        clf = train.train_classifier(df, "label", ["embedding_vec"], "svm",
                                     {"kernel": kernel, "max_iter": 5, "n_components": 16},
                                     key="vec_id")
        out = train.predict(clf, df)
        assert out.count() == df.count()
    assert train.vector_sizes(df, ["embedding_vec"]) == {"embedding_vec": 64}


def test_pipeline_reports_dropped_targets(spark):
    df = tasks.price_band(spark, SF01).withColumn(
        "band", F.when(F.col("l_quantity") > 45, None).otherwise(F.col("band")))
    res = run_pipeline(df, "band", "row_key", numeric=tasks.PRICE_FEATURES,
                       hyperparameters={"n_estimators": 3, "max_depth": 3})
    assert res.dropped_rows == df.where("band is null").count() > 0


def test_importance_of_vector_entries(spark):
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F

    from tabloom.operators import train

    df = spark.range(200).select(
        F.col("id"), (F.col("id") % 2).alias("y"), (F.col("id") * 7 % 13).cast("double").alias("a"),
        array_to_vector(F.array((F.col("id") % 5).cast("double"), (F.col("id") % 2).cast("double"),
                                F.lit(1.0))).alias("v"))
    clf = train.train_classifier(df, "y", ["a", "v"], "random_forest",
                                 {"n_estimators": 5, "max_depth": 3}, key="id")
    rows = {r["feature"]: r["importance"] for r in train.feature_importance(clf).collect()}
    assert list(rows) == ["a", "v[0]", "v[1]", "v[2]"]
    assert max(rows, key=rows.get) == "v[1]" and abs(sum(rows.values()) - 1) < 1e-9


def test_a_forests_rows_are_shuffled_once(spark, monkeypatch):
    from pyspark.sql import functions as F

    from tabloom.operators import train

    seen, layout = spark.sparkContext.accumulator(0), train.canonical_layout

    @F.udf("double")
    def met(v):
        seen.add(1)
        return v

    monkeypatch.setattr(train, "canonical_layout", lambda df, *a: layout(df.withColumn("a", met("a")), *a))
    rows = spark.range(300).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 7 > 3).alias("y"))
    clf = train.train_classifier(rows, "y", ["a"], "random_forest", {"n_estimators": 3, "random_state": 1}, key="id")
    assert seen.value == 300
    assert train.predict(clf, rows).where("y = (prediction = 'true')").count() == 300
