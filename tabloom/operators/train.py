"""Training and prediction with Spark ML.

* labels are indexed with the ordered category map (repeatable indexes) and
  mapped back after prediction with a join bounded by the class count;
* ``random_forest`` -> ``RandomForestClassifier``; ``svm`` with a linear
  kernel -> one margin per class (one for two classes), all fitted together by
  ``operators.margin`` (``solver="spark"``: ``LinearSVC`` / ``OneVsRest``, one fit
  after the other); with an RBF kernel -> random Fourier features (an
  approximation of the RBF kernel, Rahimi & Recht 2007) followed by the same;
* ``class_weight="balanced"`` -> n / (k * n_c) per class as ``weightCol``;
* the training frame is put in a canonical layout (hash partitions on the
  key, sorted inside) so that a fixed seed gives the same model whatever
  the input file layout.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LinearSVC, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.columns import join_small
from tabloom.operators import margin
from tabloom.operators.encode import CategoryMap, category_text, fit_categories
from tabloom.session import cut_lineage

MODEL_TYPES = ("random_forest", "svm")
KERNELS = ("linear", "rbf")
SOLVERS = ("batched", "spark")
MAX_DEPTH = 30          # deepest tree Spark ML accepts
ROWS_PER_TRAIN_PARTITION = 250_000


def drop_null_target(df: DataFrame, target: str, count: bool = True
                     ) -> tuple[DataFrame, int | None]:
    """Rows with a target, and (optionally) how many rows had none."""
    kept = df.where(F.col(target).isNotNull())
    dropped = df.where(F.col(target).isNull()).count() if count else None
    return kept, dropped


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight) with weight = n_total / (k * n_c)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))
    # The window spans the k class rows only.
    everything = Window.partitionBy()
    return counts.select(label, "n", (F.sum("n").over(everything).cast("double")
                                      / (F.count(F.lit(1)).over(everything) * F.col("n")))
                         .alias("weight"))


def with_class_weights(df: DataFrame, label: str, out: str = "weight",
                       max_classes: int = 100_000) -> DataFrame:
    """Attach the balanced weight of each row's class (join of a table with
    one row per class, broadcast when the class count is checked small)."""
    w = class_weights(df, label).select(label, F.col("weight").alias(out))
    return join_small(df, w, on=label, how="left", max_rows=max_classes)


def canonical_layout(df: DataFrame, key: str | Sequence[str] | None, partitions: int) -> DataFrame:
    """Hash-partition on the key and sort inside partitions: a layout that
    depends only on the data, so seeded training is repeatable."""
    if key is None:
        return df
    keys = [key] if isinstance(key, str) else list(key)
    return df.repartition(partitions, *keys).sortWithinPartitions(*keys)


def train_partitions(n_rows: int) -> int:
    """Partitions for the training layout: about ROWS_PER_TRAIN_PARTITION rows
    each.  Iterative optimizers pay per-task costs on every step, so small
    training sets use few partitions; the count depends only on the data,
    keeping fits repeatable."""
    return max(1, math.ceil(n_rows / ROWS_PER_TRAIN_PARTITION))


# ------------------------------------------------------------------ RBF map

class RandomFourierFeatures(Transformer, HasInputCol, HasOutputCol,
                            DefaultParamsReadable, DefaultParamsWritable):
    """z(x) = sqrt(2/D) cos(W x + b), W ~ N(0, 2 gamma), b ~ U(0, 2 pi).

    Inner products of z approximate the RBF kernel exp(-gamma |x - y|^2).
    W and b are regenerated from ``seed``, so only four numbers are stored.
    The map runs as an Arrow-batched pandas UDF (one NumPy product per
    batch), never per row."""

    nComponents = Param(Params._dummy(), "nComponents", "number of random features",
                        typeConverter=TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "RBF width", typeConverter=TypeConverters.toFloat)
    inputDim = Param(Params._dummy(), "inputDim", "input vector size",
                     typeConverter=TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "random seed", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol="features", outputCol="rff", nComponents=256, gamma=1.0,
                 inputDim=1, seed=42):
        super().__init__()
        self._setDefault(nComponents=256, gamma=1.0, inputDim=1, seed=42)
        self._set(**self._input_kwargs)

    def weights(self) -> tuple[np.ndarray, np.ndarray]:
        d, k = self.getOrDefault("inputDim"), self.getOrDefault("nComponents")
        g = self.getOrDefault("gamma")
        rng = np.random.default_rng(self.getOrDefault("seed"))
        w = rng.normal(0.0, math.sqrt(2.0 * g), size=(d, k))
        b = rng.uniform(0.0, 2.0 * math.pi, size=k)
        return w, b

    def _transform(self, df: DataFrame) -> DataFrame:
        w, b = self.weights()
        scale = math.sqrt(2.0 / w.shape[1])

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def rff(col: pd.Series) -> pd.Series:
            x = np.stack(col.to_numpy())
            z = scale * np.cos(x @ w + b)
            return pd.Series(list(z))

        arr = vector_to_array(F.col(self.getInputCol()))
        return df.withColumn(self.getOutputCol(), array_to_vector(rff(arr)))


def vector_sizes(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Length of each ML-vector column among ``columns`` (read from one row)."""
    from pyspark.ml.linalg import VectorUDT

    vec = [c for c in columns if isinstance(df.schema[c].dataType, VectorUDT)]
    if not vec:
        return {}
    row = df.select(*[F.size(vector_to_array(F.col(c))).alias(c) for c in vec]).where(
        " and ".join(f"`{c}` is not null" for c in vec)).first()
    return {c: int(row[c]) for c in vec}


def rbf_gamma(df: DataFrame, columns: Sequence[str], gamma: str | float,
              sizes: Mapping[str, int] | None = None) -> float:
    """``scale`` = 1 / (d * var of all matrix entries), ``auto`` = 1 / d, or a
    number.  ``scale`` is one aggregate of sums and squares; ``sizes`` gives
    the length of vector columns (d counts every vector entry)."""
    sizes = dict(sizes or {})
    d = sum(sizes.get(c, 1) for c in columns)
    if isinstance(gamma, (int, float)):
        return float(gamma)
    if gamma == "auto":
        return 1.0 / d
    if gamma != "scale":
        raise ValueError("gamma must be 'scale', 'auto' or a number")

    def total(c, power):
        if c in sizes:
            arr = vector_to_array(F.col(c))
            return F.coalesce(F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + F.pow(x, power)),
                              F.lit(0.0))
        return F.pow(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), power)

    s = sum(total(c, 1) for c in columns)
    s2 = sum(total(c, 2) for c in columns)
    row = df.agg(F.sum(s).alias("s"), F.sum(s2).alias("s2"), F.count(F.lit(1)).alias("n")).first()
    m = row["n"] * d
    var = row["s2"] / m - (row["s"] / m) ** 2
    return 1.0 / (d * var) if var > 0 else 1.0


class MarginModel(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Margins x . b + a of every class: ``rawPrediction`` (two classes: (-m, m)) and
    ``prediction``, the class index of the largest (ties: the smallest index).  One NumPy
    product per Arrow batch."""

    coefficients = Param(Params._dummy(), "coefficients", "coefficients per margin",
                         typeConverter=TypeConverters.toListListFloat)
    intercepts = Param(Params._dummy(), "intercepts", "intercept per margin",
                       typeConverter=TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, inputCol="features", outputCol="rawPrediction", coefficients=None, intercepts=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        coef = np.array(self.getOrDefault("coefficients"), float)
        icept = np.array(self.getOrDefault("intercepts"), float)

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def margins(col: pd.Series) -> pd.Series:
            m = np.stack(col.to_numpy()) @ coef.T + icept if len(col) else np.zeros((0, len(icept)))
            return pd.Series(list(np.column_stack([-m, m]) if m.shape[1] == 1 else m))

        raw = self.getOrDefault("outputCol")
        arr = margins(vector_to_array(F.col(self.getInputCol())))
        found = df.withColumn(raw, array_to_vector(arr))
        out = vector_to_array(F.col(raw))
        return found.withColumn("prediction", (F.array_position(out, F.array_max(out)) - 1).cast("double"))


# ------------------------------------------------------------------ training

@dataclass
class Classifier:
    model: PipelineModel
    labels: CategoryMap
    label_col: str
    label_type: T.DataType
    features: list[str]
    model_type: str
    params: dict[str, Any] = field(default_factory=dict)
    label_count: int = 0


def _forest(params: Mapping[str, Any], weight_col: str | None) -> RandomForestClassifier:
    depth = params.get("max_depth", None)
    depth = MAX_DEPTH if depth is None else min(int(depth), MAX_DEPTH)
    leaf = int(params.get("min_samples_leaf", 1))
    split_min = int(params.get("min_samples_split", 2))
    mf = params.get("max_features", "sqrt")
    subset = {"sqrt": "sqrt", "log2": "log2", None: "all", "auto": "auto"}.get(mf, None)
    if subset is None:
        subset = str(float(mf)) if isinstance(mf, float) else str(int(mf))
    rf = RandomForestClassifier(
        featuresCol="features", labelCol="label_idx",
        numTrees=int(params.get("n_estimators", 100)), maxDepth=depth,
        minInstancesPerNode=max(leaf, math.ceil(split_min / 2)),
        featureSubsetStrategy=subset, bootstrap=bool(params.get("bootstrap", True)),
        seed=int(params.get("random_state", 42)),
        maxBins=int(params.get("max_bins", 32)))
    if weight_col:
        rf.setWeightCol(weight_col)
    return rf


def fourier_map(params: Mapping[str, Any], inputs: int, gamma: float) -> RandomFourierFeatures:
    """The random Fourier features that an RBF set of parameters stands for."""
    return RandomFourierFeatures(
        inputCol="features", outputCol="rff", nComponents=int(params.get("n_components", 256)), gamma=gamma,
        inputDim=inputs, seed=int(params.get("random_state", 42)))


def margin_classes(classes: int) -> list[int]:
    """Classes that get a margin: one of two, else each."""
    return [1] if classes <= 2 else list(range(classes))


def _fit_margins(data: DataFrame, params: Mapping[str, Any], classes: int, rff: RandomFourierFeatures | None
                 ) -> MarginModel:
    """All margins of one classifier over ``data`` (features vector, label_idx)."""
    rows = data.select(vector_to_array("features").alias("x"), "label_idx")
    blocks = margin.pack(rows, "x", "label_idx", classes, write=margin.write_blocks)
    columns = [margin.Column(c, float(params.get("C", 1.0)), balanced=params.get("class_weight") == "balanced")
               for c in margin_classes(classes)]
    maps = [margin.FeatureMap(*rff.weights()) if rff else margin.FeatureMap()]
    found = margin.solve(blocks, columns, maps, max_steps=int(params.get("max_iter", 100)),
                         tol=float(params.get("tol", margin.TOL)))
    return MarginModel(inputCol="rff" if rff else "features", outputCol="rawPrediction",
                       coefficients=[c.tolist() for c, _, _ in found], intercepts=[a for _, a, _ in found])


def _svm(params: Mapping[str, Any], n_rows: int, n_classes: int, weight_col: str | None,
         features_col: str):
    c = float(params.get("C", 1.0))
    svc = LinearSVC(featuresCol=features_col, labelCol="label_idx",
                    regParam=1.0 / (c * max(1, n_rows)), standardization=False,
                    maxIter=int(params.get("max_iter", 100)), tol=float(params.get("tol", 1e-3)))
    if weight_col:
        svc.setWeightCol(weight_col)
    if n_classes <= 2:
        return svc
    ovr = OneVsRest(classifier=svc, featuresCol=features_col, labelCol="label_idx",
                    # One concurrent binary fit per class (capped): each is a
                    # chain of small jobs, so running them side by side keeps
                    # executors busy.
                    parallelism=int(params.get("parallelism", min(n_classes, 16))))
    if weight_col:
        ovr.setWeightCol(weight_col)
    return ovr


def train_classifier(df: DataFrame, label: str, features: Sequence[str],
                     model_type: str = "random_forest",
                     hyperparameters: Mapping[str, Any] | None = None,
                     key: str | Sequence[str] | None = None,
                     layout_partitions: int | None = None) -> Classifier:
    """Fit a classifier on numeric/vector ``features`` to predict ``label``."""
    if model_type not in MODEL_TYPES:
        raise ValueError(f"unknown model type {model_type!r}; known: {', '.join(MODEL_TYPES)}")
    params = dict(hyperparameters or {})
    data, _ = drop_null_target(df, label, count=False)
    keys = [] if key is None else [key] if isinstance(key, str) else list(key)
    # written once: labels, counts, weights, sizes and every fit read this table
    data = cut_lineage(data.select(*dict.fromkeys([*keys, label, *features])), "train-rows")
    labels = fit_categories(data, [label])
    n_classes = labels.sizes[label]
    side = labels.table.where(F.col("column_name") == label).select(
        F.col("value").alias("_lv"), F.col("idx").cast("double").alias("label_idx"))
    data = join_small(data, side, on=category_text(label, df.schema[label].dataType) == F.col("_lv"), how="inner",
                      small_rows=n_classes).drop("_lv")
    weight_col = None
    if params.get("class_weight") == "balanced":
        data = with_class_weights(data, label, "_w")
        weight_col = "_w"
    n_rows = data.count()
    parts = layout_partitions or train_partitions(n_rows)
    data = canonical_layout(data, key, parts)
    if model_type == "random_forest":
        # the forest starts several jobs over its rows, each of which would shuffle them again
        data = data.select(*dict.fromkeys(["label_idx", *features, *([weight_col] if weight_col else [])])).persist()

    from pyspark.ml.feature import VectorSizeHint

    sizes = vector_sizes(data, features)
    # "keep" needs vector lengths in the metadata; the hints add them.
    stages: list = [VectorSizeHint(inputCol=c, size=n, handleInvalid="optimistic")
                    for c, n in sizes.items()]
    stages.append(VectorAssembler(inputCols=list(features), outputCol="features",
                                  handleInvalid="keep"))
    if model_type == "random_forest":
        stages.append(_forest(params, weight_col))
    else:
        kernel = params.get("kernel", "rbf")
        if kernel not in KERNELS:
            raise ValueError(f"kernel must be one of: {', '.join(KERNELS)}")
        if params.get("solver", "batched") not in SOLVERS:
            raise ValueError(f"solver must be one of: {', '.join(SOLVERS)}")
        rff = None
        if kernel == "rbf":
            g = rbf_gamma(data, features, params.get("gamma", "scale"), sizes)
            rff = fourier_map(params, sum(sizes.get(c, 1) for c in features), g)
        if params.get("solver", "batched") == "batched":
            found = _fit_margins(PipelineModel(stages=stages).transform(data), params, n_classes, rff)
            stages += [*([rff] if rff else []), found]
        else:
            stages += [*([rff] if rff else []),
                       _svm(params, n_rows, n_classes, weight_col, "rff" if rff else "features")]
    try:
        model = Pipeline(stages=stages).fit(data)
    finally:
        if model_type == "random_forest":
            data.unpersist()
    return Classifier(model=model, labels=labels, label_col=label,
                      label_type=df.schema[label].dataType, features=list(features),
                      model_type=model_type, params=params, label_count=n_classes)


def predict(clf: Classifier, df: DataFrame, out: str = "prediction") -> DataFrame:
    """Add ``out`` (label value, original type) and ``prediction_idx``;
    map-side apart from a join with the k-row label table."""
    scored = clf.model.transform(df)
    side = clf.labels.table.where(F.col("column_name") == clf.label_col).select(
        F.col("idx").cast("double").alias("_pi"), F.col("value").alias("_pv"))
    base = scored.withColumnRenamed("prediction", "prediction_idx")
    joined = join_small(base, side, on=F.col("prediction_idx") == F.col("_pi"), how="left",
                        small_rows=clf.label_count)
    return joined.withColumn(out, F.col("_pv").cast(clf.label_type)).drop("_pi", "_pv")


def class_scores(clf: Classifier, scored: DataFrame) -> dict[Any, F.Column]:
    """Score column per class value (probability for forests, raw margin for
    SVMs), for ROC AUC."""
    col = "probability" if clf.model_type == "random_forest" else "rawPrediction"
    arr = vector_to_array(F.col(col))
    rows = clf.labels.table.where(F.col("column_name") == clf.label_col).select(
        "value", "idx").collect()              # one row per class
    py = {T.LongType: int, T.IntegerType: int, T.ShortType: int, T.ByteType: int,
          T.DoubleType: float, T.FloatType: float}.get(type(clf.label_type), str)
    # Entry i of the vector scores label index i (for a binary LinearSVC the
    # raw margins are (-m, m), so index 1 is the positive side).
    return {py(r["value"]): arr[r["idx"]] for r in sorted(rows, key=lambda r: r["idx"])}


def feature_importance(clf: Classifier) -> DataFrame:
    """(feature, importance) for forests: one row per model input; the entries of
    a vector feature are named ``feature[i]``."""
    rf = clf.model.stages[-1]
    if not hasattr(rf, "featureImportances"):
        raise TypeError("feature importances exist only for forest models")
    sizes = {s.getInputCol(): s.getSize() for s in clf.model.stages if hasattr(s, "getSize")}
    names = [n for c in clf.features
             for n in ([f"{c}[{i}]" for i in range(sizes[c])] if c in sizes else [c])]
    imp = rf.featureImportances.toArray().tolist()
    spark = clf.labels.table.sparkSession
    rows = [(n, float(v)) for n, v in zip(names, imp, strict=True)]
    return spark.createDataFrame(rows, "feature string, importance double")
