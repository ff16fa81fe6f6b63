"""Exact running totals and ranks without one task per group.

``Window.partitionBy(g).orderBy(v)`` sends a whole group to one task.  That
is fine for a handful of rows per group, but a single class, column or
category may hold a third of all rows.  ``running_total`` therefore splits
the ordered key space into range buckets, sums each bucket, turns those few
sums into offsets, and runs the window only inside a bucket:

    total(g, v) = offset(g, bucket) + running sum inside (g, bucket)

The result is exact and the same for any number of buckets; a null group is a
group like any other.  Spark's range partitioner assigns the buckets from whole
keys, and the bucket id is written with the rows before any further pass, so
every later pass sees the same buckets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.functions.columns import join_small
from tabloom.session import cut_lineage

# Target rows per window partition.  A sort of a few million narrow rows
# fits comfortably in one task and spills if it must.
ROWS_PER_BUCKET = 2_000_000
MAX_BUCKETS = 100_000


def running_total(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                  measure: Column | str | None = None, out: str = "cum",
                  rows_per_bucket: int = ROWS_PER_BUCKET,
                  materialize: bool = True, n_rows: int | None = None) -> DataFrame:
    """Add ``out`` = inclusive running sum of ``measure`` (default 1, i.e. a
    row number) within ``group_cols``, ordered by ``order_cols``.

    The order key must be unique within a group (callers pass distinct
    values or a unique key).  Null groups form one group; null order values
    come first.  ``materialize`` writes the input to the checkpoint folder
    first, since it is read several times (count, range bounds, buckets);
    ``n_rows`` (the input's row count, when the caller knows it) saves the
    count job.
    """
    group_cols, order_cols = list(group_cols), list(order_cols)
    m = F.lit(1) if measure is None else (F.col(measure) if isinstance(measure, str) else measure)
    base = df.withColumn("_m", m.cast("bigint") if measure is None else m)
    if materialize:
        base = cut_lineage(base)
    n = n_rows if n_rows is not None else base.count()
    n_buckets = max(1, min(MAX_BUCKETS, math.ceil(n / max(1, rows_per_bucket))))

    if n_buckets == 1:
        w = Window.partitionBy(*group_cols).orderBy(*order_cols).rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        return base.withColumn(out, F.sum("_m").over(w)).drop("_m")

    bucketed = cut_lineage(
        base.repartitionByRange(n_buckets, *[F.col(c).asc() for c in group_cols + order_cols])
        .withColumn("_bucket", F.spark_partition_id()), "buckets")
    sums = bucketed.groupBy(*group_cols, "_bucket").agg(F.sum("_m").alias("_bsum"))
    before = Window.partitionBy(*group_cols).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sums.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group_cols)],
                          F.col("_bucket").alias("_b"),
                          F.coalesce(F.sum("_bsum").over(before), F.lit(0)).alias("_off"))
    # Offsets hold at most n_buckets + (number of groups) rows.
    same = F.col("_bucket") == F.col("_b")
    for i, c in enumerate(group_cols):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    joined = join_small(bucketed, offsets, on=same, how="inner")
    w = Window.partitionBy(*group_cols, "_bucket").orderBy(*order_cols).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    # Same column order as the single-bucket path: input columns, then out.
    return (joined.withColumn(out, F.col("_off") + F.sum("_m").over(w))
            .select(*df.columns, out))


def dense_index(values: DataFrame, group_cols: Sequence[str], value_col: str,
                out: str = "idx", **kw) -> DataFrame:
    """0-based index of each distinct ``value_col`` within its group, in
    ascending value order (bytewise for strings)."""
    distinct = values.select(*group_cols, value_col).where(F.col(value_col).isNotNull()).distinct()
    ranked = running_total(distinct, group_cols, [value_col], out="_rn", **kw)
    return ranked.withColumn(out, (F.col("_rn") - 1).cast("int")).drop("_rn")
