"""Classification metrics as DataFrame aggregations.

Every count-based metric derives from one aggregate,
``groupBy(actual, predicted).count()``, which has at most k^2 rows for k
classes whatever the input size; all later arithmetic runs on that tiny
table.  ROC AUC is a rank-sum over *grouped* scores (a hot score value is one
row), with running totals computed by bucketed windows.

Conventions kept from the reference: the label set is the sorted union of
actual and predicted values; macro averages run over all of them; an
undefined precision/recall/F1 counts as 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.ranking import running_total
from tabloom.session import cut_lineage

# Accepted metric names and averaging modes.
METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc", "confusion_matrix")
AVERAGES = ("micro", "macro", "weighted")


def validate_metrics(metrics: Sequence[str], average: str = "macro") -> None:
    for m in metrics:
        if m not in METRICS:
            raise ValueError(f"unknown metric {m!r}; known metrics: {', '.join(METRICS)}")
    if average not in AVERAGES:
        raise ValueError(f"average must be one of: {', '.join(AVERAGES)}")


def _pairs(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    t = df.schema[actual].dataType
    return df.where(F.col(actual).isNotNull()).select(
        F.col(actual).alias("actual"), F.col(predicted).cast(t).alias("predicted"))


def confusion_counts(df: DataFrame, actual: str = "actual", predicted: str = "predicted"
                     ) -> DataFrame:
    """(actual, predicted, n) for pairs that occur; rows with a null actual
    are left out."""
    return (_pairs(df, actual, predicted).groupBy("actual", "predicted")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n")))


def label_set(df: DataFrame | None = None, actual: str = "actual", predicted: str = "predicted",
              counts: DataFrame | None = None) -> DataFrame:
    """Sorted distinct union of actual and predicted labels."""
    c = counts if counts is not None else confusion_counts(df, actual, predicted)
    return (c.select(F.explode(F.array("actual", "predicted")).alias("label"))
            .distinct().orderBy("label"))


def confusion_matrix(df: DataFrame | None = None, actual: str = "actual",
                     predicted: str = "predicted", counts: DataFrame | None = None) -> DataFrame:
    """Zero-filled (actual, predicted, n) over label set x label set.

    Lazy, and k^2 rows for k labels: with many labels use ``confusion_counts``
    (the pairs that occur).  The grid's rows are made label by label in many
    tasks."""
    c = counts if counts is not None else confusion_counts(df, actual, predicted)
    labels = label_set(counts=c).agg(F.sort_array(F.collect_list("label")).alias("ls"))
    grid = (labels.select(F.explode("ls").alias("actual"), "ls").repartition(F.col("actual"))
            .select("actual", F.explode("ls").alias("predicted")))
    return (grid.join(c, ["actual", "predicted"], "left")
            .select("actual", "predicted", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def confusion_wide(df: DataFrame | None = None, actual: str = "actual",
                   predicted: str = "predicted", counts: DataFrame | None = None) -> DataFrame:
    """Rows = actual, one column per predicted label (zero-filled)."""
    m = confusion_matrix(df, actual, predicted, counts)
    return m.groupBy("actual").pivot("predicted").agg(F.sum("n")).orderBy("actual")


def class_stats(df: DataFrame | None = None, actual: str = "actual", predicted: str = "predicted",
                counts: DataFrame | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Per label (and ``by`` columns of ``counts``, such as a fold): tp, predicted count,
    support, precision, recall, f1."""
    c = counts if counts is not None else confusion_counts(df, actual, predicted)
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("bigint")
    per = c.select(*by, F.inline(F.array(
        F.struct(F.col("actual").alias("label"), F.col("n").alias("support"),
                 zero.alias("pred_n"), hit.alias("tp")),
        F.struct(F.col("predicted").alias("label"), zero.alias("support"),
                 F.col("n").alias("pred_n"), zero.alias("tp")))))
    agg = per.groupBy(*by, "label").agg(F.sum("tp").alias("tp"), F.sum("pred_n").alias("pred_n"),
                                   F.sum("support").alias("support"))
    p = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("pred_n").cast("double")),
                   F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support").cast("double")),
                   F.lit(0.0))
    out = agg.withColumn("precision", p).withColumn("recall", r)
    f1 = F.coalesce(F.try_divide(2.0 * F.col("precision") * F.col("recall"),
                                 F.col("precision") + F.col("recall")), F.lit(0.0))
    return out.withColumn("f1", f1)


def _averages(stats: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row (for each ``by``): accuracy and the macro / micro / weighted averages."""
    s = F.sum("support").cast("double")
    pm = F.try_divide(F.sum("tp").cast("double"), F.sum("pred_n").cast("double"))
    rm = F.try_divide(F.sum("tp").cast("double"), s)
    row = stats.groupBy(*by).agg(
        F.coalesce(rm, F.lit(0.0)).alias("accuracy"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"),
        F.coalesce(pm, F.lit(0.0)).alias("precision_micro"),
        F.coalesce(rm, F.lit(0.0)).alias("recall_micro"),
        F.coalesce(F.try_divide(F.sum(F.col("precision") * F.col("support")), s), F.lit(0.0))
        .alias("precision_weighted"),
        F.coalesce(F.try_divide(F.sum(F.col("recall") * F.col("support")), s), F.lit(0.0))
        .alias("recall_weighted"),
        F.coalesce(F.try_divide(F.sum(F.col("f1") * F.col("support")), s), F.lit(0.0))
        .alias("f1_weighted"),
        F.sum("support").alias("support"))
    pmi, rmi = F.col("precision_micro"), F.col("recall_micro")
    return row.withColumn("f1_micro", F.coalesce(F.try_divide(2.0 * pmi * rmi, pmi + rmi),
                                                 F.lit(0.0)))


def metric_table(df: DataFrame | None = None, actual: str = "actual", predicted: str = "predicted",
                 metrics: Sequence[str] = ("accuracy", "precision", "recall", "f1"),
                 average: str = "macro", counts: DataFrame | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Long table (metric, value) for the count-based metrics requested; with ``by``
    (columns of ``counts``), one such table per group, its columns first."""
    validate_metrics(metrics, average)
    avg = _averages(class_stats(df, actual, predicted, counts, by), by)
    recs = []
    for m in metrics:
        if m == "accuracy":
            recs.append(F.struct(F.lit("accuracy").alias("metric"),
                                 F.col("accuracy").alias("value")))
        elif m in ("precision", "recall", "f1"):
            recs.append(F.struct(F.lit(m).alias("metric"),
                                 F.col(f"{m}_{average}").alias("value")))
    if not recs:  # only metrics that have no count-based value
        return avg.select(*by, F.lit("").alias("metric"), F.lit(0.0).alias("value")).where(F.lit(False))
    return avg.select(*by, F.inline(F.array(*recs)))


def all_averages(df: DataFrame | None = None, actual: str = "actual", predicted: str = "predicted",
                 counts: DataFrame | None = None) -> DataFrame:
    """One row holding accuracy and every precision/recall/f1 average."""
    return _averages(class_stats(df, actual, predicted, counts))


def class_report(df: DataFrame | None = None, actual: str = "actual", predicted: str = "predicted",
                 counts: DataFrame | None = None) -> DataFrame:
    """Per-class precision, recall, f1, support, followed by the rows
    'accuracy', 'macro avg' and 'weighted avg' (label as text)."""
    stats = class_stats(df, actual, predicted, counts)
    per = stats.select(F.col("label").cast("string").alias("label"), "precision", "recall", "f1",
                       F.col("support").cast("bigint").alias("support"),
                       F.lit(0).alias("row_kind"))
    a = _averages(stats)
    def rec(label, p, r, f1, kind):
        return F.struct(F.lit(label).alias("label"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f1.cast("double").alias("f1"),
                        F.col("support").cast("bigint").alias("support"),
                        F.lit(kind).alias("row_kind"))

    none = F.lit(None)
    summary = a.select(F.inline(F.array(
        rec("accuracy", none, none, F.col("accuracy"), 1),
        rec("macro avg", F.col("precision_macro"), F.col("recall_macro"), F.col("f1_macro"), 2),
        rec("weighted avg", F.col("precision_weighted"), F.col("recall_weighted"),
            F.col("f1_weighted"), 3))))
    return per.unionByName(summary).orderBy("row_kind", "label").drop("row_kind")


def prediction_summary(df: DataFrame, predicted: str = "predicted") -> DataFrame:
    """Number of predictions and of distinct predicted labels."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n_predictions"),
                  F.count_distinct(F.col(predicted)).cast("bigint").alias("n_distinct"))


def prediction_counts(df: DataFrame, predicted: str = "predicted") -> DataFrame:
    """Rows per predicted label."""
    return df.groupBy(F.col(predicted).alias("label")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


# --------------------------------------------------------------------------- AUC

def _auc_from_groups(g: DataFrame, group_cols: list[str], **kw) -> DataFrame:
    """g: (group..., score, pos, neg) with one row per distinct score.
    AUC = sum(pos * (neg_below + neg/2)) / (P * N), exact for ties."""
    ranked = running_total(g, group_cols, ["score"], measure="neg", out="cum_neg", **kw)
    part = F.col("pos").cast("double") * (
        (F.col("cum_neg") - F.col("neg")).cast("double") + F.col("neg").cast("double") / 2.0)
    out = ranked.groupBy(*group_cols).agg(F.sum(part).alias("_num"),
                                          F.sum("pos").alias("n_pos"),
                                          F.sum("neg").alias("n_neg"))
    return out.select(*group_cols, F.try_divide(
        F.col("_num"), F.col("n_pos").cast("double") * F.col("n_neg").cast("double")).alias("auc"),
        F.col("n_pos").cast("bigint").alias("n_pos"), F.col("n_neg").cast("bigint").alias("n_neg"))


def roc_auc_binary(df: DataFrame, label: str, score: str | Column, positive=1,
                   **kw) -> DataFrame:
    """One row (auc, n_pos, n_neg); ``auc`` is NULL when a class is absent."""
    s = F.col(score) if isinstance(score, str) else score
    pos = (F.col(label) == F.lit(positive)).cast("bigint")
    g = (df.where(F.col(label).isNotNull() & s.isNotNull())
         .groupBy(s.cast("double").alias("score"))
         .agg(F.sum(pos).alias("pos"), F.sum(1 - pos).alias("neg")))
    return _auc_from_groups(g, [], **kw)


def roc_auc_ovr(df: DataFrame, label: str, scores: Mapping[object, str | Column],
                average: str = "macro", **kw) -> DataFrame:
    """One-vs-rest AUC per class and the average.

    ``scores`` maps each class value to its score column; a row without a score
    for a class is left out of that class, as in the binary form.  Returns rows
    (class STRING, auc, n_pos, n_neg) plus a final row class='<average>' (macro:
    plain mean; weighted: by positives; micro: all (row, class) pairs as one
    binary problem)."""
    if average not in AVERAGES:
        raise ValueError(f"average must be one of: {', '.join(AVERAGES)}")
    recs = []
    for cls, sc in scores.items():
        s = F.col(sc) if isinstance(sc, str) else sc
        pos = (F.col(label) == F.lit(cls)).cast("bigint")
        recs.append(F.struct(F.lit(str(cls)).alias("class"), s.cast("double").alias("score"),
                             pos.alias("p")))
    long = df.where(F.col(label).isNotNull()).select(F.inline(F.array(*recs))).where(
        F.col("score").isNotNull())
    g = long.groupBy("class", "score").agg(F.sum("p").alias("pos"),
                                           F.sum(1 - F.col("p")).alias("neg"))
    per = _auc_from_groups(g, ["class"], **kw)
    if average == "macro":
        total = per.agg(F.avg("auc").alias("auc"))
    elif average == "micro":
        pooled = g.groupBy("score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        total = _auc_from_groups(pooled, [], **kw).select("auc")
    else:
        total = per.agg(F.try_divide(F.sum(F.col("auc") * F.col("n_pos")),
                                     F.sum("n_pos").cast("double")).alias("auc"))
    total = total.select(F.lit(average).alias("class"), "auc",
                         F.lit(None).cast("bigint").alias("n_pos"),
                         F.lit(None).cast("bigint").alias("n_neg"))
    return per.unionByName(total)


@dataclass
class Evaluation:
    metrics: DataFrame          # (metric, value)
    report: DataFrame           # class report
    counts: DataFrame           # (actual, predicted, n) of the pairs that occur

    @property
    def confusion(self) -> DataFrame:
        """Zero-filled (actual, predicted, n); lazy, k^2 rows."""
        return confusion_matrix(counts=self.counts)


def evaluate(predictions: DataFrame, actual: str = "actual", predicted: str = "predicted",
             metrics: Sequence[str] = ("accuracy", "precision", "recall", "f1"),
             average: str = "macro", scores: Mapping[object, str | Column] | None = None
             ) -> Evaluation:
    """All requested metrics from one confusion aggregate (materialized once;
    one row per pair of labels that occurs).  ``roc_auc`` needs ``scores`` (class
    -> score column); with two classes it is the plain binary AUC of the second
    one, otherwise one-vs-rest with the same ``average``."""
    validate_metrics(metrics, average)
    if "roc_auc" in metrics and not scores:
        raise ValueError("roc_auc needs a score column per class")
    counts = cut_lineage(confusion_counts(predictions, actual, predicted))
    table = metric_table(actual=actual, predicted=predicted, metrics=metrics, average=average,
                         counts=counts)
    if "roc_auc" in metrics:
        if len(scores) == 2:
            cls = list(scores)[1]
            auc = roc_auc_binary(predictions, actual, scores[cls], positive=cls)
        else:
            auc = roc_auc_ovr(predictions, actual, scores, average).where(F.col("class") == average)
        table = table.unionByName(auc.select(F.lit("roc_auc").alias("metric"),
                                             F.col("auc").alias("value")))
    return Evaluation(metrics=table, report=class_report(counts=counts), counts=counts)
