"""Learnable classification tasks built from the shared tables.

* ``document_quality``: documents joined to labels; features from the whole
  text (characters, words, digit share, distinct-word share) plus language
  and source as categories; target ``quality`` (0/1, unbalanced).
* ``price_band``: lineitem rows, three bands of the extended price, features
  quantity, discount, tax and the price itself (separable 3-class task).
* ``embedding_class``: 64-float embeddings, 10 labels (mechanics only: the
  labels are not learnable from the vectors).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions.columns import spread


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def document_features(docs: DataFrame) -> DataFrame:
    """Per-document numeric features over the whole text (JVM functions only).

    The token array is built once in its own projection; Spark keeps that
    projection rather than inlining the costly expression into each use."""
    tokens = spread(docs.select("doc_id", "lang", "source", "n_chars", "text"), "doc_id").select(
        "doc_id", "lang", "source", "n_chars", F.length("text").alias("_len"),
        F.length(F.regexp_replace("text", r"[^0-9]", "")).alias("_digits"),
        F.filter(F.split(F.lower(F.col("text")), r"\s+"), lambda w: F.length(w) > 0)
        .alias("_words"))
    n_words = F.size("_words")
    return tokens.select(
        "doc_id", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"),
        n_words.cast("double").alias("n_words"),
        F.coalesce(F.try_divide(F.col("_digits").cast("double"), F.col("_len").cast("double")),
                   F.lit(0.0)).alias("digit_share"),
        F.coalesce(F.try_divide(F.size(F.array_distinct("_words")).cast("double"),
                                n_words.cast("double")), F.lit(0.0)).alias("distinct_share"))


def document_quality(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, lang, source, numeric text features, quality.

    Labels cover a subset of documents: others leave before any text work, and
    the few feature columns, not the texts, meet the labels."""
    labels = _t(spark, sf, "labels").select("doc_id", "quality")
    labelled = _t(spark, sf, "documents").join(labels.select("doc_id"), "doc_id", "left_semi")
    return document_features(labelled).join(labels, "doc_id", "inner")


DOC_NUMERIC = ["n_chars", "n_words", "digit_share", "distinct_share"]
DOC_CATEGORICAL = ["lang", "source"]

# Price band edges used for the lineitem task.
PRICE_EDGES = (25_000.0, 60_000.0)


def price_band(spark: SparkSession, sf: str) -> DataFrame:
    return price_band_rows(_t(spark, sf, "lineitem"))


def price_band_rows(li: DataFrame) -> DataFrame:
    """Row key, features and band of lineitem rows (batch or streaming)."""
    p = F.col("l_extendedprice")
    band = (F.when(p < PRICE_EDGES[0], "low").when(p < PRICE_EDGES[1], "mid").otherwise("high"))
    return li.select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("row_key"),
                     "l_quantity", "l_discount", "l_tax", "l_extendedprice", band.alias("band"))


PRICE_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]


def embedding_class(spark: SparkSession, sf: str) -> DataFrame:
    """vec_id, label and the 64-float embedding as an ML vector (JVM-side
    ``array_to_vector``; no exploded scalar columns)."""
    from pyspark.ml.functions import array_to_vector

    e = _t(spark, sf, "embeddings")
    return e.select("vec_id", "label", array_to_vector("embedding").alias("embedding_vec"))


EMBED_FEATURES = ["embedding_vec"]
