"""The classifier chain: solver, folds, held-out accuracy, odd rows."""
import numpy as np
import pytest

from tabloom.llm import toxicity as tx
from tests.conftest import SF01


def test_logistic_regression_is_at_its_optimum():
    rng = np.random.default_rng(1)
    x = (rng.random((300, 12)) < 0.3).astype(float)
    y = (x[:, 0] + 0.3 * rng.standard_normal(300) > 0.5).astype(float)
    w = tx.fit_logistic(x, y, ridge=0.7)
    p = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
    assert np.abs(np.append(x.T @ (p - y) + 0.7 * w[:-1], (p - y).sum())).max() < 1e-2


def test_labels_all_alike_give_a_constant():
    x = np.eye(4)
    assert (tx.fit_logistic(x, np.zeros(4))[:-1] == 0).all()
    assert tx._sigmoid(tx.fit_logistic(x, np.ones(4))[-1]) > 0.8


def test_later_categories_see_out_of_fold_probabilities(monkeypatch):
    seen = []
    fit = tx.fit_logistic
    monkeypatch.setattr(tx, "fit_logistic", lambda x, y, *a: seen.append((x.copy(), y.copy())) or fit(x, y, *a))
    rng = np.random.default_rng(2)
    bits, labels = (rng.random((100, 6)) < 0.5).astype(np.uint8), (rng.random((100, 2)) < 0.4).astype(int)
    weights = tx.fit_weights(bits, labels, list(range(100)), folds=5)
    assert [len(w) for w in weights] == [7, 8] and len(seen) == 7
    whole = 1 / (1 + np.exp(-(bits @ weights[0][:-1] + weights[0][-1])))
    fed = seen[-1][0][:, 6]
    assert not np.allclose(fed, whole)  # not what the first model says of its own rows
    for fold in range(5):
        own = np.array([tx.zlib.crc32(str(i).encode()) % 5 == fold for i in range(100)])
        w = fit(bits[~own].astype(float), labels[~own, 0].astype(float))
        assert np.allclose(fed[own], 1 / (1 + np.exp(-(bits[own] @ w[:-1] + w[-1]))))


def test_word_features():
    assert tx.word_features('"moronic,"') == ["w moronic", "p moro", "p moron", 't ,"']
    assert tx.word_features("***") == ["t ***"]
    assert tx.word_features("é") == ["w é"]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    train = labels.where("doc_id % 4 <> 0")
    scored = tx.score_toxicity(docs, train).join(labels.where("doc_id % 4 = 0"), "doc_id")
    rows = scored.collect()
    assert len(rows) > 60
    clean = [r for r in rows if not r.toxic_label] if "toxic_label" in scored.columns else rows
    assert clean
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    found = {r.doc_id: r.is_toxic for r in rows}
    assert all(not found[i] for i in found if not truth[i])  # clean documents are left alone
    toxic = [found[i] for i in found if truth[i]]
    assert sum(toxic) >= 0.6 * len(toxic)  # 300 labels only


def make(spark):
    docs = [(i, ("fine words and more " * 3) + (f"moron{'s' * (i % 3)} " if i % 4 == 0 else "") + f"tail{i}", 0.5)
            for i in range(400)]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(300)]
    odd = [(1000, None, 0.1), (1001, "", 0.1), (None, "you moron", 0.1), (1002, "x " * 60_000 + "moron", 0.1),
           (0, docs[0][1], 0.5)]
    return (spark.createDataFrame(docs + odd, "doc_id long, text string, toxicity double"),
            spark.createDataFrame(labels + [(None, 1, 1), (5, 1, None), (1, 1, 0), (1, 1, 0)],
                                  "doc_id long, quality int, toxic int"))


def test_rows_nulls_repeats_and_clashing_columns(spark):
    docs, labels = make(spark)
    got = tx.score_toxicity(docs, labels)
    assert got.count() == docs.count()
    rows = {r.doc_id: r for r in got.collect()}
    assert all(rows[i].is_toxic == (i % 4 == 0) for i in range(400))
    assert rows[None].is_toxic and rows[1002].is_toxic
    assert not rows[1000].is_toxic and rows[1000].toxic == rows[1001].toxic
    kept = tx.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(400) if i % 4] + [1000, 1001]


@pytest.mark.parametrize("which", ["labels", "docs", "none match", "one class"])
def test_too_little_to_learn_from(spark, which):
    docs, labels = make(spark)
    if which == "labels":
        labels = labels.limit(0)
    if which == "none match":
        labels = labels.selectExpr("doc_id + 100000 AS doc_id", "quality", "toxic")
    if which == "one class":
        labels = labels.where("toxic = 0")
    if which == "docs":
        docs = docs.limit(0)
    got = tx.score_toxicity(docs, labels)
    assert got.count() == docs.count()
    assert got.where("is_toxic or toxic is null").count() == 0


@pytest.mark.parametrize("alike", [True, False])
def test_an_id_with_very_many_rows_keeps_the_sample_bounded(spark, monkeypatch, alike):
    seen = []
    fit = tx.fit_weights
    monkeypatch.setattr(tx, "fit_weights", lambda bits, *a: seen.append(len(bits)) or fit(bits, *a))
    docs, labels = make(spark)
    hot = spark.range(3000).selectExpr("4L AS doc_id", "'you moron' AS text" if alike else
                                       "concat('you moron ', id) AS text", "0.5D AS toxicity")
    got = tx.score_toxicity(docs.union(hot), labels, sample_rows=200)
    assert got.count() == docs.count() + 3000
    assert len(seen) == 1 and (190 <= seen[0] <= 200)
    rows = got.where("doc_id < 400").collect()
    assert all(r.is_toxic == (r.doc_id % 4 == 0) for r in rows) if alike else rows
