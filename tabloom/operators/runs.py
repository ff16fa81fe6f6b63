"""Run comparison over the run log: best run and leaderboard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def best_run(runs: DataFrame, metric: str = "accuracy", higher_is_better: bool = True
             ) -> DataFrame:
    """Per experiment, the run with the best value of ``metric``; ties go to
    the earliest run, then the smaller run name.  A plain aggregate."""
    m = runs.where((F.col("kind") == "metric") & (F.col("key") == metric))
    score = -F.col("value_num") if higher_is_better else F.col("value_num")
    order = F.struct(score.alias("s"), F.col("run_ts").alias("t"), F.col("run").alias("r"))
    return m.groupBy("experiment").agg(
        F.min_by("run", order).alias("run"),
        F.min_by("value_num", order).alias(metric))


def leaderboard(runs: DataFrame, metrics: Sequence[str] = ("accuracy", "precision", "recall", "f1"),
                order_by: str | None = None) -> DataFrame:
    """One row per (experiment, run), one column per metric (pivot over the
    given names, so no extra job discovers them)."""
    m = runs.where(F.col("kind") == "metric")
    wide = m.groupBy("experiment", "run").pivot("key", list(metrics)).agg(F.max("value_num"))
    key = order_by or metrics[0]
    return wide.orderBy("experiment", F.col(key).desc(), "run")
