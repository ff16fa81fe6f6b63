"""Model store: a fitted classifier as a folder on any Hadoop file system.

``<path>/model``   Spark ML PipelineModel (assembler, optional RFF map, model)
``<path>/labels``  label map (column_name, value, idx) as Parquet
``<path>/meta``    one JSON row: label column and type, features, model type
``<path>/prep``    fitted preparation: one JSON row, and the category maps

``load_fitted`` gives a model that scores raw rows.
"""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tabloom.operators.encode import CategoryMap
from tabloom.operators.train import Classifier


def save_classifier(clf: Classifier, path: str) -> None:
    spark = clf.labels.table.sparkSession
    clf.model.write().overwrite().save(f"{path}/model")
    clf.labels.table.write.mode("overwrite").parquet(f"{path}/labels")
    meta = {"label_col": clf.label_col, "label_type": clf.label_type.json(),
            "features": clf.features, "model_type": clf.model_type,
            "params": {k: v for k, v in clf.params.items()
                       if isinstance(v, (int, float, str, bool)) or v is None},
            "label_count": clf.label_count, "sizes": clf.labels.sizes}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1) \
        .write.mode("overwrite").text(f"{path}/meta")


def load_classifier(spark: SparkSession, path: str) -> Classifier:
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    model = PipelineModel.load(f"{path}/model")
    table = spark.read.parquet(f"{path}/labels")
    return Classifier(model=model, labels=CategoryMap(table=table, sizes=meta["sizes"]),
                      label_col=meta["label_col"],
                      label_type=T._parse_datatype_json_string(meta["label_type"]),
                      features=meta["features"], model_type=meta["model_type"],
                      params=meta["params"], label_count=meta["label_count"])


def save_fitted(fitted, path: str) -> None:
    """A ``plans.holdout.Fitted``: the classifier and its fitted preparation."""
    save_classifier(fitted.classifier, path)
    spark = fitted.classifier.labels.table.sparkSession
    fill, feats = fitted.prep.fill, fitted.features
    cats = fitted.prep.categories
    meta = {"fill": {"values": fill.values, "to_double": fill.to_double, "strategy": fill.strategy,
                     "nan_as_null": fill.nan_as_null},
            "categorical": fitted.prep.categorical, "sizes": cats.sizes if cats else None,
            "features": {"columns": feats.columns, "numeric": feats.numeric, "missing": feats.missing,
                         "zscore": feats.zscore.stats if feats.zscore else None,
                         "normalize": feats.normalize},
            "columns": fitted.columns, "keep": fitted.keep, "keep_raw": fitted.keep_raw}
    if cats:
        cats.table.write.mode("overwrite").parquet(f"{path}/prep/categories")
    spark.createDataFrame([(json.dumps(meta, default=str),)], "meta string").coalesce(1) \
        .write.mode("overwrite").text(f"{path}/prep/meta")


def load_fitted(spark: SparkSession, path: str):
    """The ``Fitted`` that ``save_fitted`` wrote."""
    from tabloom.operators.encode import Preprocess
    from tabloom.operators.impute import FillParams
    from tabloom.operators.scale import FeatureParams, ZParams
    from tabloom.plans.holdout import Fitted

    meta = json.loads(spark.read.text(f"{path}/prep/meta").first()[0])
    fill, feats = meta["fill"], meta["features"]
    cats = CategoryMap(spark.read.parquet(f"{path}/prep/categories"), meta["sizes"]) \
        if meta["sizes"] is not None else None
    return Fitted(
        prep=Preprocess(FillParams(fill["values"], tuple(fill["to_double"]), fill["strategy"],
                                   fill["nan_as_null"]), cats, tuple(meta["categorical"])),
        features=FeatureParams(tuple(feats["columns"]), tuple(feats["numeric"]), tuple(feats["missing"]),
                               ZParams({c: tuple(v) for c, v in feats["zscore"].items()})
                               if feats["zscore"] is not None else None, feats["normalize"]),
        classifier=load_classifier(spark, path), columns=meta["columns"], keep=meta["keep"],
        keep_raw=meta["keep_raw"])
