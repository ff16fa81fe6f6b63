"""Feature importance of any classifier: what a metric loses when a feature's values are dealt anew.

Every row gets a place by one seeded hash of its key and a donor by another: the row
ranked r by the second gives its features to the row ranked r by the first.  Both ranks
are running totals over range buckets and meet in one equality join, so no task sees a
whole column, and the dealt column is a one-to-one reordering of the given one.  All
features are scored in one pass: a row is scored once as it is and once per feature with
that feature taken from its donor; metrics come from one confusion aggregate by feature.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.columns import split_hash
from tabloom.functions.ranking import running_total
from tabloom.operators import evaluate, train
from tabloom.session import cut_lineage

ROW, RANK, DEALT = "_row", "_rank", "_dealt_"


def deal(df: DataFrame, key: str | Sequence[str], columns: Sequence[str], seed: int = 42, **kw) -> DataFrame:
    """``df`` with ``_dealt_<c>`` for each of ``columns``: the values of another row, each
    row's used once.  The order is that of the hashes under ``seed`` and ``seed + 1``,
    then of the keys; rows with equal keys are told apart as they are read."""
    keys, columns = [key] if isinstance(key, str) else list(key), list(columns)
    rows = cut_lineage(df.withColumn(ROW, F.monotonically_increasing_id()), "deal")

    def ranked(frame: DataFrame, by: int) -> DataFrame:
        order = ["_hash", *keys, ROW]
        hashed = frame.withColumn("_hash", split_hash(keys, by))
        return running_total(hashed, [], order, out=RANK, **kw).drop("_hash", ROW)

    donors = ranked(rows.select(*dict.fromkeys([*keys, *columns]), ROW), seed + 1).select(
        F.col(RANK).alias("_place"), *[F.col(c).alias(DEALT + c) for c in columns])
    return ranked(rows, seed).join(donors, F.col(RANK) == F.col("_place")).drop(RANK, "_place")


def permutation_importance(clf: train.Classifier, df: DataFrame, key: str | Sequence[str],
                           metrics: Sequence[str] = ("accuracy",), average: str = "macro",
                           seed: int = 42, **kw) -> DataFrame:
    """(feature, metric, baseline, permuted, importance = baseline - permuted) for every
    feature of ``clf``; rows without a label are left out."""
    evaluate.validate_metrics(metrics, average)
    keys, features, label = [key] if isinstance(key, str) else list(key), list(clf.features), clf.label_col
    rows = df.select(*dict.fromkeys([*keys, label, *features])).where(F.col(label).isNotNull())
    which = F.explode(F.array(F.lit(""), *[F.lit(c) for c in features])).alias("feature")
    copies = deal(rows, keys, features, seed, **kw).select("*", which).select(
        "feature", F.col(label).alias("actual"),
        *[F.when(F.col("feature") == c, F.col(DEALT + c)).otherwise(F.col(c)).alias(c) for c in features])
    counts = cut_lineage(train.predict(clf, copies).groupBy(
        "feature", "actual", F.col("prediction").alias("predicted")).agg(F.count(F.lit(1)).alias("n")), "dealt-counts")
    found = evaluate.metric_table(metrics=metrics, average=average, counts=counts, by=["feature"])
    base = found.where("feature = ''").select("metric", F.col("value").alias("baseline"))
    return found.where("feature <> ''").join(base, "metric").select(
        "feature", "metric", "baseline", F.col("value").alias("permuted"),
        (F.col("baseline") - F.col("value")).alias("importance"))
