"""Column profiling (null counts, numeric moments, distinct counts, top values).

A profile is two scans, whatever the number of columns:

* one global aggregate holding every per-column statistic
  (``count``, ``min``, ``max``, ``avg``, ``stddev_samp``, NaN counts), and
* one ``unpivot`` + ``groupBy(column, value)`` for frequencies, with
  map-side combine, from which distinct counts, top values and modes derive.

The exact median is found from per-value counts with a bucketed running
total, so no column is ever gathered into a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.functions.columns import FLOAT_TYPES, is_numeric_type, is_simple_type
from tabloom.functions.ranking import running_total
from tabloom.session import cut_lineage

APPROX_ACCURACY = 10_000


def _columns(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    return list(columns) if columns is not None else list(df.columns)


def _rows_to_long(one_row: DataFrame, records: list[list[Column]], names: list[str]) -> DataFrame:
    """Turn a one-row aggregate into one row per column (tiny, no shuffle)."""
    structs = [F.struct(*[v.alias(n) for v, n in zip(rec, names)]) for rec in records]
    return one_row.select(F.inline(F.array(*structs)))


def profile_summary(df: DataFrame, name: str = "", path: str = "") -> DataFrame:
    """Table name, path, row count and column count (one row)."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("name"), F.lit(path).alias("path"),
        F.col("row_count").cast("bigint").alias("row_count"),
        F.lit(len(df.columns)).cast("bigint").alias("column_count"))


def profile_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: position, type, non-null count, null count, NaN count."""
    cols = _columns(df, columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        aggs.append(F.count(F.col(c)).alias(f"_c{i}"))
        if isinstance(types[c], FLOAT_TYPES):
            aggs.append(F.count_if(F.isnan(F.col(c))).alias(f"_n{i}"))
    one = df.agg(*aggs)
    recs = []
    for i, c in enumerate(cols):
        nan = F.col(f"_n{i}") if isinstance(types[c], FLOAT_TYPES) else F.lit(0)
        recs.append([F.lit(i + 1).cast("bigint"), F.lit(c), F.lit(types[c].simpleString()),
                     F.col(f"_c{i}").cast("bigint"),
                     (F.col("_rows") - F.col(f"_c{i}")).cast("bigint"), nan.cast("bigint")])
    return _rows_to_long(one, recs, ["position", "column_name", "dtype", "non_null", "null_count",
                                     "nan_count"])


def long_numeric(df: DataFrame, columns: Sequence[str], drop_nan: bool = False) -> DataFrame:
    """(column, value DOUBLE) for the given numeric columns, nulls dropped
    (and NaN, with ``drop_nan``)."""
    if not columns:
        return df.sparkSession.createDataFrame([], "column_name string, value double")
    casted = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    out = (casted.unpivot([], list(columns), "column_name", "value")
           .where(F.col("value").isNotNull()))
    return out.where(~F.isnan("value")) if drop_nan else out


def stat_value(c: str, dtype) -> Column:
    """A numeric column as DOUBLE for statistics: NaN (counted separately in
    ``nan_count``) is left out like NULL, so one NaN does not turn max, mean
    and std into NaN."""
    x = F.col(c).cast("double")
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x) \
        if isinstance(dtype, FLOAT_TYPES) else x


# Columns with at most this many distinct values (HyperLogLog estimate) use
# Spark's exact ``median`` aggregate, whose buffer keeps one entry per
# distinct value; larger ones take the bucketed rank path.
MEDIAN_DIRECT_MAX = 500_000
# The final task of a global aggregate merges the value maps of every direct
# column, so their estimates are also capped together.
MEDIAN_DIRECT_TOTAL = 2_000_000


def distinct_estimates(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """HyperLogLog++ distinct-count estimate per column (one aggregate)."""
    if not columns:
        return {}
    row = df.agg(*[F.approx_count_distinct(F.col(c), 0.02).alias(f"_e{i}")
                   for i, c in enumerate(columns)]).first()
    return {c: row[f"_e{i}"] for i, c in enumerate(columns)}


def bucketed_medians(df: DataFrame, columns: Sequence[str], drop_nan: bool = False,
                     **kw) -> DataFrame:
    """Exact median per column from per-value counts with a bucketed running
    total: a hot value collapses into one count row, and the ordered values
    of one column are split over many tasks.  Even counts average the two
    middle values."""
    counts = cut_lineage(long_numeric(df, columns, drop_nan).groupBy("column_name", "value")
                         .agg(F.count(F.lit(1)).alias("n")))
    return medians_from_counts(counts, **kw)


def medians_from_counts(counts: DataFrame, **kw) -> DataFrame:
    """(column_name, median) from (column_name, value DOUBLE, n) with one row
    per distinct non-null value; ``counts`` should be cheap to re-read (a
    written table or a regroup of one)."""
    sizes = counts.groupBy("column_name").agg(F.sum("n").alias("total"),
                                              F.count(F.lit(1)).alias("rows"))
    size_rows = sizes.collect()                       # one row per column
    if not size_rows:
        return counts.sparkSession.createDataFrame([], "column_name string, median double")
    totals = sizes.select("column_name", "total")
    ranked = running_total(counts, ["column_name"], ["value"], measure="n", out="cum",
                           materialize=False, n_rows=sum(r["rows"] for r in size_rows), **kw)
    r1 = F.floor((F.col("total") + 1) / 2)
    r2 = F.floor(F.col("total") / 2) + 1
    lo = F.col("cum") - F.col("n")
    # One row per profiled column: a proven small broadcast.
    hits = (ranked.join(F.broadcast(totals), "column_name")
            .where((lo < r2) & (r1 <= F.col("cum")))
            .groupBy("column_name")
            .agg(F.max(F.when((lo < r1) & (r1 <= F.col("cum")), F.col("value"))).alias("v1"),
                 F.max(F.when((lo < r2) & (r2 <= F.col("cum")), F.col("value"))).alias("v2")))
    return hits.select("column_name", ((F.col("v1") + F.col("v2")) / 2).alias("median"))


def split_by_distinct(df: DataFrame, columns: Sequence[str],
                      estimates: dict[str, int] | None = None) -> tuple[list[str], list[str]]:
    """(columns for the direct median aggregate, columns for the bucketed path)."""
    est = estimates if estimates is not None else distinct_estimates(df, columns)
    chosen, budget = set(), MEDIAN_DIRECT_TOTAL
    for c in sorted(columns, key=lambda c: est.get(c, 0)):
        e = est.get(c, 0)
        if e <= MEDIAN_DIRECT_MAX and e <= budget:
            chosen.add(c)
            budget -= e
    direct = [c for c in columns if c in chosen]
    return direct, [c for c in columns if c not in chosen]


def exact_medians(df: DataFrame, columns: Sequence[str], **kw) -> DataFrame:
    """Exact median per numeric column as (column_name, median DOUBLE).

    One HyperLogLog pass sorts the columns: bounded-cardinality columns get
    Spark's exact ``median`` (partial maps merged per column), the others the
    bucketed rank path, so no task ever holds an unbounded value set."""
    columns = list(columns)
    direct, big = split_by_distinct(df, columns)
    parts = []
    if direct:
        one = df.agg(*[F.median(F.col(c).cast("double")).alias(f"_m{i}")
                       for i, c in enumerate(direct)])
        parts.append(_rows_to_long(one, [[F.lit(c), F.col(f"_m{i}")] for i, c in enumerate(direct)],
                                   ["column_name", "median"]))
    if big:
        parts.append(bucketed_medians(df, big, **kw))
    if not parts:
        return df.sparkSession.createDataFrame([], "column_name string, median double")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def profile_numeric(df: DataFrame, columns: Sequence[str] | None = None,
                    exact_median: bool = True) -> DataFrame:
    """min, max, mean, median and sample std (DOUBLE) per numeric column."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = [c for c in _columns(df, columns) if is_numeric_type(types[c])]
    if not cols:
        return df.sparkSession.createDataFrame(
            [], "column_name string, min_value double, max_value double, mean double, median double, std_dev double")
    direct, big = split_by_distinct(df, cols) if exact_median else ([], [])
    aggs = []
    for i, c in enumerate(cols):
        x = stat_value(c, types[c])
        aggs += [F.min(x).alias(f"_min{i}"), F.max(x).alias(f"_max{i}"),
                 F.avg(x).alias(f"_avg{i}"), F.stddev_samp(x).alias(f"_std{i}")]
        if not exact_median:
            aggs.append(F.percentile_approx(x, 0.5, APPROX_ACCURACY).alias(f"_med{i}"))
        elif c in direct:
            aggs.append(F.median(x).alias(f"_med{i}"))
    one = df.agg(*aggs)
    recs = []
    for i, c in enumerate(cols):
        has = not exact_median or c in direct
        med = F.col(f"_med{i}").cast("double") if has else F.lit(None).cast("double")
        recs.append([F.lit(c), F.col(f"_min{i}"), F.col(f"_max{i}"), F.col(f"_avg{i}"), med,
                     F.col(f"_std{i}")])
    stats = _rows_to_long(one, recs, ["column_name", "min_value", "max_value", "mean", "median",
                                      "std_dev"])
    if not big:
        return stats
    med = bucketed_medians(df, big, drop_nan=True).withColumnRenamed("median", "_bmed")
    return (stats.join(F.broadcast(med), "column_name", "left")
            .select("column_name", "min_value", "max_value", "mean",
                    F.coalesce("median", "_bmed").alias("median"), "std_dev"))


def typed_value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, value STRING, num DOUBLE, n BIGINT) for every
    simple-typed column; a NULL value row counts the nulls.

    Columns of one type are unpivoted together and grouped on their typed
    values (numbers shuffle as 8-byte keys, not text); the text form and the
    numeric form (``num``, NULL for non-numeric columns) are made after the
    aggregation, on the reduced rows.  One shuffle per type, map-side
    combine."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = [c for c in _columns(df, columns) if is_simple_type(types[c])]
    families: dict[str, list[str]] = {}
    for c in cols:
        families.setdefault(types[c].simpleString(), []).append(c)
    parts = []
    for fam in families.values():
        agg = (df.select(*fam).unpivot([], fam, "column_name", "v")
               .groupBy("column_name", "v").agg(F.count(F.lit(1)).cast("bigint").alias("n")))
        num = (F.col("v").cast("double") if is_numeric_type(types[fam[0]])
               else F.lit(None).cast("double"))
        parts.append(agg.select("column_name", F.col("v").cast("string").alias("value"),
                                num.alias("num"), "n"))
    if not parts:
        return df.sparkSession.createDataFrame(
            [], "column_name string, value string, num double, n bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, value STRING, n BIGINT) for every simple-typed column;
    a NULL value row counts the nulls (see ``typed_value_counts``)."""
    return typed_value_counts(df, columns).select("column_name", "value", "n")


def profile_distinct(df: DataFrame, columns: Sequence[str] | None = None,
                     counts: DataFrame | None = None) -> DataFrame:
    """Distinct values per column, NULL counted as one value when present."""
    vc = counts if counts is not None else value_counts(df, columns)
    return vc.groupBy("column_name").agg(F.count(F.lit(1)).cast("bigint").alias("unique_count"))


def approx_distinct(df: DataFrame, columns: Sequence[str] | None = None,
                    rsd: float = 0.01) -> DataFrame:
    """Like ``profile_distinct`` but from one HyperLogLog++ aggregate: fixed
    memory per column, no shuffle of values (relative error ``rsd``)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = [c for c in _columns(df, columns) if is_simple_type(types[c])]
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.approx_count_distinct(F.col(c), rsd).alias(f"_d{i}"),
                 F.max(F.col(c).isNull().cast("int")).alias(f"_z{i}")]
    one = df.agg(*aggs)
    recs = [[F.lit(c), (F.col(f"_d{i}") + F.col(f"_z{i}")).cast("bigint")]
            for i, c in enumerate(cols)]
    return _rows_to_long(one, recs, ["column_name", "unique_count"])


def top_values(df: DataFrame, columns: Sequence[str] | None = None, k: int = 5,
               counts: DataFrame | None = None) -> DataFrame:
    """The k most frequent non-null values per column (ties: smaller value
    first) with their share of the non-null count, in percent.

    ``row_number() <= k`` lets Spark cut each partition to k rows per column
    before the shuffle (WindowGroupLimit)."""
    vc = (counts if counts is not None else value_counts(df, columns)).where(
        F.col("value").isNotNull())
    totals = vc.groupBy("column_name").agg(F.sum("n").alias("_nonnull"))
    w = Window.partitionBy("column_name").orderBy(F.col("n").desc(), F.col("value").asc())
    top = vc.withColumn("value_rank", F.row_number().over(w)).where(F.col("value_rank") <= k)
    # One row per column: proven small.
    return (top.join(F.broadcast(totals), "column_name")
            .select("column_name", F.col("value_rank").cast("bigint").alias("value_rank"), "value", "n",
                    (F.col("n") / F.col("_nonnull") * 100.0).alias("percent")))


def column_mode(df: DataFrame, columns: Sequence[str] | None = None,
                counts: DataFrame | None = None) -> DataFrame:
    """Most frequent non-null value per column; ties go to the smaller value.
    A plain aggregate (``min_by`` over (-n, value)), so it combines map-side."""
    vc = (counts if counts is not None else value_counts(df, columns)).where(
        F.col("value").isNotNull())
    order = F.struct((-F.col("n")).alias("neg_n"), F.col("value").alias("v"))
    return vc.groupBy("column_name").agg(F.min_by("value", order).alias("mode"),
                                    F.max("n").alias("mode_count"))


def profile_table(df: DataFrame, columns: Sequence[str] | None = None,
                  exact_median: bool = True, exact_distinct: bool = True,
                  counts: DataFrame | None = None) -> DataFrame:
    """One row per column: type, counts, distinct count, numeric statistics,
    mode.

    Two scans of ``df`` whatever the number of columns: one aggregate with
    every count and moment, and one typed value-count table (written once)
    from which distinct counts, modes and the exact medians all derive.
    ``exact_median=False`` uses ``percentile_approx`` in the aggregate;
    ``exact_distinct=False`` takes distinct counts from HyperLogLog++;
    ``counts`` may pass a ``typed_value_counts`` table already computed."""
    cols = _columns(df, columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = [c for c in cols if is_numeric_type(types[c])]
    if len(cols) > WIDE_COLUMNS:
        stats = _long_stats(df, cols, exact_median)
    else:
        stats = _wide_stats(df, cols, exact_median)
    return _finish_profile(df, cols, numeric, stats, exact_median, exact_distinct, counts)


# Above this many columns the per-column statistics are computed in long
# form (one unpivot + groupBy) instead of one aggregate with several
# expressions per column, which would grow the plan with the width.
WIDE_COLUMNS = 200
_STAT_NAMES = ["position", "column_name", "dtype", "non_null", "null_count", "nan_count",
               "min_value", "max_value", "mean", "median", "std_dev"]


def _long_stats(df: DataFrame, cols: list[str], exact_median: bool) -> DataFrame:
    """Per-column counts and moments from one unpivot of a uniform struct
    (null flag, NaN flag, value as DOUBLE); one scan, any number of columns."""
    types = {f.name: f.dataType for f in df.schema.fields}
    packed = df.select(*[F.struct(
        F.col(c).isNotNull().cast("int").alias("present"),
        (F.isnan(F.col(c)).cast("int") if isinstance(types[c], FLOAT_TYPES)
         else F.lit(0)).alias("nan"),
        (stat_value(c, types[c]) if is_numeric_type(types[c])
         else F.lit(None).cast("double")).alias("num")).alias(c) for c in cols])
    long = packed.unpivot([], cols, "column_name", "s")
    aggs = [F.coalesce(F.sum("s.present"), F.lit(0)).cast("bigint").alias("non_null"),
            F.count(F.lit(1)).alias("_rows"),
            F.coalesce(F.sum("s.nan"), F.lit(0)).cast("bigint").alias("nan_count"),
            F.min("s.num").alias("min_value"), F.max("s.num").alias("max_value"),
            F.avg("s.num").alias("mean"), F.stddev_samp("s.num").alias("std_dev")]
    if not exact_median:
        aggs.append(F.percentile_approx("s.num", 0.5, APPROX_ACCURACY).alias("median"))
    stats = long.groupBy("column_name").agg(*aggs)
    if exact_median:
        stats = stats.withColumn("median", F.lit(None).cast("double"))
    meta = df.sparkSession.createDataFrame(   # schema metadata: one row per column
        [(i + 1, c, types[c].simpleString()) for i, c in enumerate(cols)],
        "position bigint, column_name string, dtype string")
    return (stats.join(F.broadcast(meta), "column_name")
            .withColumn("null_count", (F.col("_rows") - F.col("non_null")).cast("bigint"))
            .select(*_STAT_NAMES))


def _wide_stats(df: DataFrame, cols: list[str], exact_median: bool) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = [c for c in cols if is_numeric_type(types[c])]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        aggs.append(F.count(F.col(c)).alias(f"_c{i}"))
        if isinstance(types[c], FLOAT_TYPES):
            aggs.append(F.count_if(F.isnan(F.col(c))).alias(f"_n{i}"))
        if c in numeric:
            x = stat_value(c, types[c])
            aggs += [F.min(x).alias(f"_min{i}"), F.max(x).alias(f"_max{i}"),
                     F.avg(x).alias(f"_avg{i}"), F.stddev_samp(x).alias(f"_std{i}")]
            if not exact_median:
                aggs.append(F.percentile_approx(x, 0.5, APPROX_ACCURACY).alias(f"_med{i}"))
    one = df.agg(*aggs)
    none = F.lit(None).cast("double")
    recs = []
    for i, c in enumerate(cols):
        num = c in numeric
        nan = F.col(f"_n{i}") if isinstance(types[c], FLOAT_TYPES) else F.lit(0)
        med = F.col(f"_med{i}").cast("double") if num and not exact_median else none
        recs.append([F.lit(i + 1).cast("bigint"), F.lit(c), F.lit(types[c].simpleString()),
                     F.col(f"_c{i}").cast("bigint"),
                     (F.col("_rows") - F.col(f"_c{i}")).cast("bigint"), nan.cast("bigint"),
                     F.col(f"_min{i}") if num else none, F.col(f"_max{i}") if num else none,
                     F.col(f"_avg{i}") if num else none, med,
                     F.col(f"_std{i}") if num else none])
    return _rows_to_long(one, recs, _STAT_NAMES)


def _finish_profile(df: DataFrame, cols: list[str], numeric: list[str], stats: DataFrame,
                    exact_median: bool, exact_distinct: bool,
                    counts: DataFrame | None) -> DataFrame:
    tvc = counts if counts is not None else cut_lineage(typed_value_counts(df, cols))
    vc = tvc.select("column_name", "value", "n")
    distinct = (profile_distinct(df, counts=vc) if exact_distinct
                else approx_distinct(df, cols))
    mode = column_mode(df, counts=vc)
    out = stats
    if exact_median and numeric:
        num_counts = (tvc.where(F.col("num").isNotNull() & ~F.isnan("num")
                                & F.col("column_name").isin(numeric))
                      .groupBy("column_name", F.col("num").alias("value"))
                      .agg(F.sum("n").alias("n")))
        med = medians_from_counts(num_counts).withColumnRenamed("median", "_exact_median")
        out = (out.join(F.broadcast(med), "column_name", "left")
               .withColumn("median", F.col("_exact_median")).drop("_exact_median"))
    # Every side has one row per column.
    out = (out.join(F.broadcast(distinct), "column_name", "left")
           .join(F.broadcast(mode), "column_name", "left"))
    return out.select("position", "column_name", "dtype", "non_null", "null_count", "nan_count",
                      "unique_count", "min_value", "max_value", "mean", "median", "std_dev",
                      "mode", "mode_count").orderBy("position")


def write_profile(profile: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Store a profile (or any of its parts) as Parquet or JSON."""
    if fmt not in ("parquet", "json"):
        raise ValueError("fmt must be 'parquet' or 'json'")
    profile.write.mode("overwrite").format(fmt).save(path)
