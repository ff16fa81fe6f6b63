"""Run log: parameters, metrics, confusion counts and class
report of each run as long rows, partitioned by experiment and run.

Row layout: ``experiment, run, run_ts, kind, key, value_str, value_num``
with ``kind`` in param / metric / confusion / report.  Metric, confusion
and report rows are selected from DataFrames (never collected); only the
parameter dict, which the caller holds anyway, is turned into rows.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_SCHEMA = T.StructType([
    T.StructField("experiment", T.StringType()),
    T.StructField("run", T.StringType()),
    T.StructField("run_ts", T.TimestampType()),
    T.StructField("kind", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("value_str", T.StringType()),
    T.StructField("value_num", T.DoubleType()),
])
COLUMNS = [f.name for f in RUN_SCHEMA.fields]


def _num(v: Any) -> float | None:
    if isinstance(v, bool):
        return float(v)
    if isinstance(v, (int, float)):
        return float(v)
    return None


def run_rows(spark: SparkSession, experiment: str, run: str, params: Mapping[str, Any] | None = None,
             metrics: DataFrame | Mapping[str, float] | None = None,
             confusion: DataFrame | None = None, report: DataFrame | None = None,
             run_ts: _dt.datetime | None = None) -> DataFrame:
    """Build the run's log rows as one DataFrame."""
    ts = run_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    head = [F.lit(experiment).alias("experiment"), F.lit(run).alias("run"),
            F.lit(ts).cast("timestamp").alias("run_ts")]
    parts = []
    if params:
        rows = [("param", str(k), None if v is None else str(v), _num(v)) for k, v in params.items()]
        p = spark.createDataFrame(rows, "kind string, key string, value_str string, value_num double")
        parts.append(p.select(*head, "kind", "key", "value_str", "value_num"))
    if metrics is not None:
        if not isinstance(metrics, DataFrame):
            metrics = spark.createDataFrame([(k, float(v)) for k, v in metrics.items()],
                                            "metric string, value double")
        parts.append(metrics.select(*head, F.lit("metric").alias("kind"),
                                    F.col("metric").alias("key"),
                                    F.lit(None).cast("string").alias("value_str"),
                                    F.col("value").cast("double").alias("value_num")))
    if confusion is not None:
        parts.append(confusion.select(
            *head, F.lit("confusion").alias("kind"),
            F.concat_ws("|", F.col("actual").cast("string"), F.col("predicted").cast("string"))
            .alias("key"), F.lit(None).cast("string").alias("value_str"),
            F.col("n").cast("double").alias("value_num")))
    if report is not None:
        stats = ["precision", "recall", "f1", "support"]
        long = report.select("label", F.inline(F.array(*[
            F.struct(F.lit(s).alias("stat"), F.col(s).cast("double").alias("v")) for s in stats])))
        parts.append(long.select(*head, F.lit("report").alias("kind"),
                                 F.concat_ws("|", "label", "stat").alias("key"),
                                 F.lit(None).cast("string").alias("value_str"),
                                 F.col("v").alias("value_num")))
    if not parts:
        return spark.createDataFrame([], RUN_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*COLUMNS)


def append_run(rows: DataFrame, path: str) -> None:
    """Write run rows under one folder per (experiment, run); reads prune on both.

    A run is replaced as a whole (dynamic partition overwrite), so a job that is run
    again after a failure leaves each row once.  Runs may be logged at the same time:
    every write has a staging folder of its own, and different runs share no folder."""
    (rows.select(*COLUMNS).hint("rebalance", F.col("experiment"), F.col("run")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("experiment", "run").parquet(path))


def read_runs(spark: SparkSession, path: str, experiment: str | None = None) -> DataFrame:
    """Read the log back with its declared schema; filtering on an experiment
    prunes to its folder."""
    df = spark.read.schema(RUN_SCHEMA).parquet(path)
    if experiment is not None:
        df = df.where(F.col("experiment") == experiment)
    return df.select(*COLUMNS)


def log_run(spark: SparkSession, path: str, experiment: str, run: str, **kw) -> DataFrame:
    """Build and append one run; returns the rows written."""
    rows = run_rows(spark, experiment, run, **kw)
    append_run(rows, path)
    return rows
