"""The batched margin solver against Spark's own fits and against plain NumPy."""
import math

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabloom.operators import margin, split, train
from tabloom.plans import tuning
from tabloom.session import cut_lineage, scratch_path, small_splits
from tabloom.sources import models


def make(n, seed, classes=2, noise=0.1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1, 50, 0.01] + [0, 1000, 3]
    score = x[:, 0] + (x[:, 1] - 1000) / 50 + rng.normal(size=n) * noise
    y = np.digitize(score, np.quantile(score, np.arange(1, classes) / classes))
    return x, y, rng.integers(0, 3, n)


def frame(spark, x, y, fold, parts=4):
    rows = [(i, [float(v) for v in a], int(b), int(c)) for i, (a, b, c) in enumerate(zip(x, y, fold))]
    return spark.createDataFrame(rows, "k long, x array<double>, y int, fold int").repartition(parts)


def objective(x, y, coef, icept, c, weight=None):
    gap = np.maximum(0, 1 - np.where(y, 1, -1) * (x @ coef + icept))
    w = np.ones(len(y)) if weight is None else weight
    return (w * gap).sum() / w.sum() + coef @ coef / (2 * c * len(y))


@pytest.fixture(scope="module")
def packed(spark):
    x, y, fold = make(3000, 1, 3, 0.4)
    df = frame(spark, x, y, fold)
    return x, y, fold, df, margin.pack(df, "x", "y", 3, "fold", write=cut_lineage)


def test_objective_is_not_above_sparks(spark, packed):
    x, y, fold, df, blocks = packed
    columns = [margin.Column(0, 0.01), margin.Column(0, 100.0), margin.Column(1, 1.0)]
    found = margin.solve(blocks, columns)
    for col, (coef, icept, best) in zip(columns, found):
        mine = objective(x, y == col.positive, coef, icept, col.c)
        assert math.isclose(mine, best, rel_tol=1e-6)
        data = cut_lineage(df.select(array_to_vector("x").alias("v"), (F.col("y") == col.positive).cast("double").alias("l"))).coalesce(1)
        svc = LinearSVC(featuresCol="v", labelCol="l", regParam=1 / (col.c * len(y)), standardization=False,
                        maxIter=60, tol=1e-6).fit(data)
        theirs = objective(x, y == col.positive, svc.coefficients.toArray(), svc.intercept, col.c)
        assert mine <= theirs * 1.001


def test_folds_weights_and_views(spark, packed):
    x, y, fold, df, blocks = packed
    columns = [margin.Column(1, 1.0, f, balanced=b) for f in (0, 2) for b in (False, True)]
    both = df.withColumn("view", F.lit(0)).union(df.withColumn("view", F.lit(2)))
    views = margin.pack(both, "x", "y", 3, "fold", "view", write=cut_lineage)
    for col, one, two in zip(columns, margin.solve(blocks, columns), margin.solve(views, columns)):
        mine = fold != col.fold
        counts = np.bincount(y[mine])
        w = (counts.sum() / counts / 3)[y[mine]] if col.balanced else None
        direct = objective(x[mine], y[mine] == 1, one[0], one[1], 1.0, w)
        assert math.isclose(direct, one[2], rel_tol=1e-6) and math.isclose(one[2], two[2], rel_tol=2e-3)
        alone = frame(spark, x[mine], y[mine], fold[mine])
        again = margin.solve(margin.pack(alone, "x", "y", 3, write=cut_lineage), [margin.Column(1, balanced=col.balanced)])
        assert math.isclose(again[0][2], one[2], rel_tol=2e-3)


def test_scans_do_not_grow_with_the_columns(packed, monkeypatch):
    *_, blocks = packed
    jobs, scan = [], margin._scan
    monkeypatch.setattr(margin, "_scan", lambda *a: (jobs.append(1), scan(*a))[1])
    one, many = [], []
    margin.solve(blocks, [margin.Column(0, 1.0, 0)], scans=one)
    alone = len(jobs)
    margin.solve(blocks, [margin.Column(p, c, f) for p in range(3) for f in range(3) for c in (0.1, 1.0, 10.0)],
                 scans=many)
    assert alone == len(one) and len(jobs) - alone == len(many)
    assert len(many) <= 3 * len(one) and many[0] == 27 and many == sorted(many, reverse=True)


def test_sums_over_groups_of_tasks_are_the_same(spark, monkeypatch, packed):
    x, y, fold, df, blocks = packed
    monkeypatch.setattr(margin, "GROUPS", 2)
    again = margin.pack(df, "x", "y", 3, "fold", write=cut_lineage)
    assert all(np.allclose(again.sums[k], blocks.sums[k]) and (again.counts[k] == blocks.counts[k]).all()
               for k in blocks.counts)
    col = [margin.Column(2, 1.0, 1)]
    assert math.isclose(margin.solve(again, col)[0][2], margin.solve(blocks, col)[0][2], rel_tol=1e-6)


def test_held_out_counts(packed):
    x, y, fold, _, blocks = packed
    rng = np.random.default_rng(3)
    rff = margin.FeatureMap(rng.normal(size=(3, 5)) / [[1], [50], [0.01]], rng.uniform(size=5))
    each = [(7, 1, 0, rng.normal(size=(3, 3)), rng.normal(size=3)), (8, 2, 1, rng.normal(size=(3, 5)), np.zeros(3))]
    got = {tuple(r)[:4]: r.n for r in margin.held_out_counts(blocks, each, [margin.FeatureMap(), rff]).collect()}
    want = {}
    for m, f, g, coef, icept in each:
        z = [margin.FeatureMap(), rff][g].of(x)
        for a, p in zip(y[fold == f], ((z @ coef.T + icept).argmax(1))[fold == f]):
            want[m, f, a, p] = want.get((m, f, a, p), 0) + 1
    assert got == want


def test_missing_features_raise_and_bad_solver(spark):
    df = spark.createDataFrame([(0, 1.0, 0), (1, float("nan"), 1)], "k long, a double, y int")
    with pytest.raises(Exception, match="NaN"):
        train.train_classifier(df, "y", ["a"], "svm", {"kernel": "linear"}, key="k")
    with pytest.raises(ValueError):
        train.train_classifier(df, "y", ["a"], "svm", {"kernel": "linear", "solver": "other"}, key="k")


@pytest.mark.parametrize("classes", [2, 3])
def test_model_round_trip_and_spark_solver(spark, classes):
    x, y, _ = make(400, 5, classes, 0.0)
    df = frame(spark, x, y, y).select("k", "y", *[F.col("x")[i].alias(f"f{i}") for i in range(3)])
    feats = ["f0", "f1", "f2"]
    clf = train.train_classifier(df, "y", feats, "svm", {"kernel": "linear", "C": 10.0}, key="k")
    path = scratch_path(spark, "margin-model")
    models.save_classifier(clf, path)
    scored = [{r.k: (r.prediction, tuple(r.rawPrediction.toArray())) for r in train.predict(c, df).collect()}
              for c in (clf, models.load_classifier(spark, path))]
    assert scored[0] == scored[1] and len(next(iter(scored[0].values()))[1]) == classes
    right = sum(scored[0][i][0] == y[i] for i in range(400)) / 400
    assert right > (0.98 if classes == 2 else 0.6)
    old = train.train_classifier(df, "y", feats, "svm", {"kernel": "linear", "solver": "spark", "max_iter": 5}, key="k")
    assert type(old.model.stages[-1]).__name__ != "MarginModel"


def test_grid_equals_single_fits(spark):
    """Every set's fold scores are those of its own fit."""
    x, y, _ = make(600, 9, 2, 0.8)
    df = split.kfold(frame(spark, x, y, y).select("k", "y", *[F.col("x")[i].alias(f"f{i}") for i in range(3)]), "k", 3)
    feats, grid = ["f0", "f1", "f2"], {"C": [1.0], "kernel": ["linear", "rbf"], "gamma": ["scale"]}
    base = {"n_components": 16, "tol": 1e-4}
    got = tuning.grid_search_cv(df, "y", feats, "svm", grid, "fold", base, key="k", refit=False).scores.collect()
    alone = tuning.grid_search_cv(df, "y", feats, "svm", {**grid, "max_iter": [100]}, "fold", base, key="k",
                                  refit=False).scores.collect()  # a varied max_iter is not batched
    assert len(got) == 2
    for a, b in zip(sorted(got), sorted(alone)):
        assert abs(a.mean_score - b.mean_score) < 0.02


def test_rows_meet_only_the_points_they_train(spark, monkeypatch):
    """A fold's view of the rows is mapped and multiplied for the other two folds' rows only,
    once per map and not once per fold and map."""
    x, y, fold = make(900, 3, 2, 0.4)
    met = []
    monkeypatch.setattr(margin._Points, "_family", lambda self, out, pos, z, w: met.append((len(pos), len(z))))
    n = 3
    points = margin._Points(margin.FeatureMap(), np.zeros(3), np.ones(3), np.zeros((n, 4)), np.ones(n, int),
                            np.arange(n), np.ones(n), np.ones((n, 2)), np.arange(n))
    for v in range(3):
        points.add(points.zeros(), points.families(), x, y, fold, np.full(900, v))
    assert met == [(1, int((fold != v).sum())) for v in range(3)]


def test_an_arrow_batch_of_blocks_is_small(packed):
    """A batch has up to 10,000 blocks: its bytes must not follow the rows of a task."""
    x, y, fold, df, blocks = packed
    sizes = blocks.table.select((F.length("x") + F.length("y") + F.length("fold") + F.length("view")).alias("b"), "n")
    got = sizes.agg(F.max("b").alias("b"), F.sum("n").alias("n")).first()
    assert got.b <= margin.BLOCK_BYTES and got.n == len(y)
    many = list(margin._blocks(b for b in blocks.table.select("n", "x", "y", "fold", "view").toArrow().to_batches()))
    assert max(len(b[0]) for b in many) <= margin.BLOCK_ROWS
    assert sorted(map(tuple, np.concatenate([b[0] for b in many]))) == sorted(map(tuple, x))


def gapped(n, seed):
    """A wide gap in one input, two coarse inputs, one label in twenty wrong."""
    rng = np.random.default_rng(seed)
    large = rng.integers(0, 2, n)
    x = np.stack([rng.integers(0, 25, n) + 45.0 * large, rng.integers(0, 11, n) / 100, rng.integers(0, 9, n) / 100], 1)
    x = (x - x.mean(0)) / x.std(0)
    return x, np.where(rng.random(n) < 0.05, 1 - large, large), rng.integers(0, 3, n)


def fourier(size, gamma):
    rng = np.random.default_rng(4)
    return margin.FeatureMap(rng.normal(0, math.sqrt(2 * gamma), (3, size)), rng.uniform(0, 2 * math.pi, size))


def test_random_features_are_cosines():
    x = np.random.default_rng(1).normal(size=(300, 3)) * [1, 100, 0.01]
    rff = fourier(40, 0.5)
    want = math.sqrt(2 / 40) * np.cos(x @ rff.weights + rff.phase)
    assert np.abs(rff.of(x) - want).max() < 1e-12
    assert rff.of(x[:0]).shape == (0, 40)


def test_gapped_rows_reach_sparks_objective(spark):
    """Where few rows are near the hinge a step must not stop the column early."""
    x, y, fold = gapped(3000, 2)
    rff = fourier(32, 1 / 3)
    blocks = margin.pack(frame(spark, x, y, fold), "x", "y", 2, "fold", write=margin.write_blocks)
    z = rff.of(x)
    found = margin.solve(blocks, [margin.Column(1, c, -1, g) for g in (0, 1) for c in (1.0, 10.0)], [margin.FeatureMap(), rff])
    data = cut_lineage(frame(spark, z, y, fold).select(array_to_vector("x").alias("v"), F.col("y").cast("double").alias("l")))
    for (coef, icept, best), (g, c) in zip(found, [(0, 1.0), (0, 10.0), (1, 1.0), (1, 10.0)]):
        assert math.isclose(objective([x, z][g], y == 1, coef, icept, c), best, rel_tol=1e-6)
        if (g, c) == (1, 10.0):
            svc = LinearSVC(featuresCol="v", labelCol="l", regParam=1 / (c * len(y)), standardization=False,
                            maxIter=200, tol=1e-7).fit(data.coalesce(1))
            assert best <= objective(z, y == 1, svc.coefficients.toArray(), svc.intercept, c) * 1.001
    tight = margin.solve(blocks, [margin.Column(1, 10.0, -1, g) for g in (0, 1)], [margin.FeatureMap(), rff], 300, 1e-6)
    assert found[1][2] <= tight[0][2] * 1.001 and found[3][2] <= tight[1][2] * 1.001


def test_many_rows_start_from_few(spark, monkeypatch):
    """The steps over all rows are few, begin where the steps over parts of the rows ended, and
    end at the same minimum; a class that is rare in the parts is not lost."""
    x, y, fold = gapped(24000, 3)
    y = np.where((y == 1) & (np.arange(len(y)) % 200 == 0), 2, y)
    df = frame(spark, x, y, fold)
    cold = margin.pack(df, "x", "y", 3, "fold", write=margin.write_blocks)
    monkeypatch.setattr(margin, "START_ROWS", 2000)
    monkeypatch.setattr(margin, "THIN", 3)
    monkeypatch.setattr(margin, "START_SIDE", 200)
    warm = margin.pack(df, "x", "y", 3, "fold", write=margin.write_blocks)
    assert not cold.starts and len(warm.starts) == 2
    sizes = [b.rows() for b in [*warm.starts, warm]]
    assert 2000 <= sizes[0] < sizes[1] < sizes[2] == len(y)
    assert warm.table.agg(F.sum("n")).first()[0] == len(y)
    met, scan = [], margin._scan
    monkeypatch.setattr(margin, "_scan", lambda blocks, groups: (met.append(
        (blocks.rows(), {int(p) for g in groups for p in g.positive})), scan(blocks, groups))[1])
    columns = [margin.Column(p, c, f, g) for p in (1, 2) for f in (0, 1) for g in (0, 1) for c in (0.1, 10.0)]
    maps = [margin.FeatureMap(), fourier(16, 1 / 3)]
    one, met[:] = margin.solve(cold, columns, maps), []
    two = margin.solve(warm, columns, maps)
    whole = [p for n, p in met if n == len(y)]
    assert [n for n, _ in met] == sorted(n for n, _ in met) and {1, 2} == whole[0]
    assert all(2 not in p for n, p in met if n != len(y))          # too few rows there: it waits for all of them
    assert sum(1 in p for p in whole) <= 10 < sum(n < len(y) for n, _ in met)
    for col, (_, _, a), (coef, icept, b) in zip(columns, one, two):
        assert abs(a - b) <= 1e-3 * max(b, margin.LEAST)
        mine = fold != col.fold
        z = maps[col.mapping].of(x[mine])
        assert math.isclose(objective(z, y[mine] == col.positive, coef, icept, col.c), b, rel_tol=1e-6)


def test_scans_have_a_task_for_every_few_bytes(spark, monkeypatch):
    monkeypatch.setattr(margin, "SPLIT_BYTES", 1 << 16)
    x, y, fold = make(20000, 6)
    blocks = margin.pack(frame(spark, x, y, fold, 1), "x", "y", 2, "fold", write=margin.write_blocks)
    key = "spark.sql.files.maxPartitionBytes"
    before, tasks, tree = spark.conf.get(key), [], margin._tree_sum
    monkeypatch.setattr(margin, "_tree_sum", lambda *a: (tasks.append(a[3]), tree(*a))[1])
    margin.solve(blocks, [margin.Column(1)], max_steps=1)
    assert tasks[0] >= 8 and spark.conf.get(key) == before
    one, two = small_splits(spark, 1 << 20), small_splits(spark, 1 << 20)
    for each in (one.__enter__, two.__enter__, lambda: one.__exit__(None, None, None)):
        each()
        assert spark.conf.get(key) == str(1 << 20)
    two.__exit__(None, None, None)
    assert spark.conf.get(key) == before
