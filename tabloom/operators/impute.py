"""Missing-value imputation as a fit/apply pair.

``fit_fill`` reads a training frame once per statistic family and returns one
literal per column (bounded by the number of columns); ``apply_fill`` is a
single projection that works on any frame, batch or streaming.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.columns import is_numeric_type
from tabloom.operators.profile import APPROX_ACCURACY, exact_medians, value_counts

STRATEGIES = ("mean", "median", "mode")
# The fill used when a column has no non-null value.
NUMERIC_DEFAULT = 0
TEXT_DEFAULT = "UNKNOWN"


@dataclass(frozen=True)
class FillParams:
    """Fitted fill values.  ``to_double`` lists integer columns whose mean or
    median fill widens them to DOUBLE."""

    values: dict[str, Any] = field(default_factory=dict)
    to_double: tuple[str, ...] = ()
    strategy: str = "median"
    nan_as_null: bool = False


def _check_strategy(strategy: str) -> None:
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown fill strategy {strategy!r}; known: {', '.join(STRATEGIES)}")


def _missing_as_null(df: DataFrame, columns: Sequence[str], nan_as_null: bool) -> DataFrame:
    if not nan_as_null:
        return df
    types = {f.name: f.dataType for f in df.schema.fields}
    floats = [c for c in columns if types[c].typeName() in ("double", "float")]
    return df.withColumns({c: F.when(F.isnan(c), None).otherwise(F.col(c)) for c in floats})


def mode_groups(columns: Sequence[str], types: dict) -> list[list[str]]:
    """Columns that can be counted together without changing a value: numbers of
    one type, and all others (as text)."""
    groups: dict[str, list[str]] = {}
    for c in columns:
        groups.setdefault(types[c].simpleString() if is_numeric_type(types[c]) else "text", []).append(c)
    return list(groups.values())


def fit_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, Any]:
    """Most frequent non-null value per column, ties to the smaller value.

    Numeric columns are counted and compared in their own type (large integers
    stay exact), all others as text.  One ``groupBy(column, value)`` per type with
    map-side combine; the result is one value per column."""
    types = {f.name: f.dataType for f in df.schema.fields}
    order = F.struct((-F.col("n")).alias("neg_n"), F.col("value").alias("v"))
    out: dict[str, Any] = {}
    for group in mode_groups(columns, types):
        counts = value_counts(df, group).where(F.col("value").isNotNull()) \
            if not is_numeric_type(types[group[0]]) else \
            df.select(*group).unpivot([], group, "column_name", "value").where(
                F.col("value").isNotNull()).groupBy("column_name", "value").agg(
                F.count(F.lit(1)).alias("n"))
        for r in counts.groupBy("column_name").agg(F.min_by("value", order).alias("m")).collect():
            out[r["column_name"]] = r["m"]
    return out


def fit_fill(df: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = (),
             strategy: str = "median", exact: bool = True,
             nan_as_null: bool = False) -> FillParams:
    """Fit fill values: ``strategy`` for numeric columns, mode for categorical
    ones; an all-null column gets 0 (numeric) or ``'UNKNOWN'``."""
    _check_strategy(strategy)
    numeric, categorical = list(numeric), list(categorical)
    missing = [c for c in numeric + categorical if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    types = {f.name: f.dataType for f in df.schema.fields}
    src = _missing_as_null(df, numeric + categorical, nan_as_null)
    values: dict[str, Any] = {}
    to_double: list[str] = []
    if numeric and strategy == "mean":
        from tabloom.operators.scale import column_moments

        values.update({c: m for c, (m, _s) in column_moments(src, numeric).items()})
    elif numeric and strategy == "median":
        if exact:
            med = {r["column_name"]: r["median"] for r in exact_medians(src, numeric).collect()}
        else:
            row = src.agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5, APPROX_ACCURACY)
                            .alias(c) for c in numeric]).first()
            med = {c: row[c] for c in numeric}
        values.update({c: med.get(c) for c in numeric})
    elif numeric:
        modes = fit_modes(src, numeric)
        values.update({c: modes.get(c) for c in numeric})
    if strategy in ("mean", "median"):
        to_double = [c for c in numeric if is_numeric_type(types[c])
                     and types[c].typeName() not in ("double", "float")]
    if categorical:
        modes = fit_modes(src, categorical)
        values.update({c: modes.get(c) for c in categorical})
    for c in numeric + categorical:
        if values.get(c) is None:
            values[c] = NUMERIC_DEFAULT if is_numeric_type(types[c]) else TEXT_DEFAULT
    return FillParams(values=values, to_double=tuple(to_double), strategy=strategy,
                      nan_as_null=nan_as_null)


def apply_fill(df: DataFrame, params: FillParams) -> DataFrame:
    """Replace nulls with the fitted values in one projection."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = [c for c in params.values if c in types]
    src = _missing_as_null(df, cols, params.nan_as_null)
    exprs = {}
    for c in cols:
        if c in params.to_double:
            exprs[c] = F.coalesce(F.col(c).cast("double"), F.lit(float(params.values[c])))
        else:
            exprs[c] = F.coalesce(F.col(c), F.lit(params.values[c]).cast(types[c]))
    return src.withColumns(exprs)


def impute(df: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = (),
           strategy: str = "median", **kw) -> DataFrame:
    """Fit on ``df`` and apply to it (fit on a training frame and use
    ``apply_fill`` for other frames)."""
    return apply_fill(df, fit_fill(df, numeric, categorical, strategy, **kw))
