"""Feature selection, z-scoring and vector assembly.

``fit_zscore`` is one global aggregate (mean and sample std of every column)
whose one-row result becomes literals; ``apply_zscore`` is plain column
arithmetic that folds into whole-stage codegen.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.columns import numeric_columns, valid_columns

log = logging.getLogger("tabloom")


@dataclass(frozen=True)
class ZParams:
    stats: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)


# Above this many columns moments are computed in long form (one unpivot +
# groupBy) so the aggregate does not grow with the width.
WIDE_COLUMNS = 200


def column_moments(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple]:
    """(mean, sample std) per column: one aggregate, or for wide inputs one
    unpivot + ``groupBy(column)``; the result has one entry per column."""
    cols = list(cols)
    if not cols:
        return {}
    if len(cols) <= WIDE_COLUMNS:
        aggs = []
        for i, c in enumerate(cols):
            x = F.col(c).cast("double")
            aggs += [F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}")]
        row = df.agg(*aggs).first()
        return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)}
    long = (df.select(*[F.col(c).cast("double").alias(c) for c in cols])
            .unpivot([], cols, "column_name", "x"))
    rows = long.groupBy("column_name").agg(F.avg("x").alias("m"),
                                           F.stddev_samp("x").alias("s")).collect()
    got = {r["column_name"]: (r["m"], r["s"]) for r in rows}
    return {c: got.get(c, (None, None)) for c in cols}


def fit_zscore(df: DataFrame, columns: Sequence[str]) -> ZParams:
    """Mean and sample standard deviation per column (unknown names skipped)."""
    cols, _ = valid_columns(df, list(columns))
    if not cols:
        return ZParams()
    return ZParams(column_moments(df, cols))


def zscore_expr(column: str, mean: float | None, std: float | None):
    x = F.col(column).cast("double")
    if std is None or mean is None:
        return F.lit(None).cast("double")
    if std == 0:
        log.warning("zero standard deviation: %s", column)
        return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(F.lit(0.0))
    return (x - F.lit(float(mean))) / F.lit(float(std))


def apply_zscore(df: DataFrame, params: ZParams, suffix: str = "_norm",
                 keep_raw: bool = True) -> DataFrame:
    """Add ``<c><suffix>`` = (x - mean) / std; std 0 gives 0.0, a missing std
    (one or no value at fit) gives NULL.  Columns absent from ``df`` are
    skipped with a warning."""
    exprs = {}
    for c, (m, s) in params.stats.items():
        if c not in df.columns:
            log.warning("column not found for normalization: %s", c)
            continue
        exprs[f"{c}{suffix}"] = zscore_expr(c, m, s)
    out = df.withColumns(exprs)
    if not keep_raw:
        out = out.drop(*[c for c in params.stats if c in df.columns])
    return out


def select_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()
                    ) -> tuple[DataFrame, list[str]]:
    """Keep requested columns that exist, in request order (plus ``keep``,
    e.g. a key and the label); return the frame and the missing names."""
    valid, missing = valid_columns(df, list(features))
    extra = [c for c in keep if c in df.columns and c not in valid]
    return df.select(*extra, *valid), missing


@dataclass(frozen=True)
class FeatureParams:
    columns: tuple[str, ...]
    numeric: tuple[str, ...]
    missing: tuple[str, ...]
    zscore: ZParams | None
    normalize: bool = True


def fit_features(df: DataFrame, features: Sequence[str], normalize: bool = True) -> FeatureParams:
    valid, missing = valid_columns(df, list(features))
    numeric = numeric_columns(df, valid)
    z = fit_zscore(df, numeric) if normalize and numeric else None
    return FeatureParams(tuple(valid), tuple(numeric), tuple(missing), z, normalize)


def apply_features(df: DataFrame, params: FeatureParams, keep: Sequence[str] = (),
                   keep_raw: bool = True) -> DataFrame:
    """Select the fitted feature columns (plus ``keep``) and add z-scores."""
    extra = [c for c in keep if c in df.columns and c not in params.columns]
    out = df.select(*extra, *params.columns)
    if params.zscore is not None:
        out = apply_zscore(out, params.zscore, keep_raw=keep_raw)
    return out


def extract_features(df: DataFrame, features: Sequence[str], normalize: bool = True,
                     keep: Sequence[str] = ()) -> DataFrame:
    """Fit on ``df`` and apply to it."""
    return apply_features(df, fit_features(df, features, normalize), keep=keep)


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    """Numeric columns (scalars, vectors) into one vector column."""
    return VectorAssembler(inputCols=list(columns), outputCol=output,
                           handleInvalid=handle_invalid).transform(df)


def array_features(df: DataFrame, column: str, output: str = "features") -> DataFrame:
    """``array<float|double>`` column as an ML vector (JVM-side)."""
    from pyspark.ml.functions import array_to_vector

    return df.withColumn(output, array_to_vector(F.col(column)))
