"""Column-level helpers: type classes, split hashes, guarded joins.

All helpers return ``Column`` expressions or lazy ``DataFrame``s; nothing
here moves row data to the driver.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger("tabloom")

# Default ceiling for broadcasting a fitted side table (rows).  A side above
# it is joined with a regular shuffle join instead.
MAX_BROADCAST_ROWS = 1_000_000

FLOAT_TYPES = (T.FloatType, T.DoubleType)


def is_numeric_type(dt: T.DataType) -> bool:
    """Integers, floats and decimals count as numeric (booleans do not)."""
    return isinstance(dt, T.NumericType)


def is_simple_type(dt: T.DataType) -> bool:
    """Types whose values can be counted and cast to text for frequency work.
    Arrays, maps, structs and vectors are profiled by counts only."""
    return not isinstance(dt, (T.ArrayType, T.MapType, T.StructType, T.BinaryType,
                               T.UserDefinedType))


def numeric_columns(df: DataFrame, columns: Iterable[str] | None = None) -> list[str]:
    """Names of numeric columns, in ``columns`` order (default: schema order)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    names = list(columns) if columns is not None else [f.name for f in df.schema.fields]
    return [c for c in names if c in types and is_numeric_type(types[c])]


def valid_columns(df: DataFrame, wanted: Sequence[str]) -> tuple[list[str], list[str]]:
    """Split ``wanted`` into names present in ``df`` (request order) and the
    missing ones.  Missing names are logged, not raised."""
    present = set(df.columns)
    keep = [c for c in wanted if c in present]
    missing = [c for c in wanted if c not in present]
    for c in missing:
        log.warning("column not found, skipped: %s", c)
    return keep, missing


def split_hash(key: str | Sequence[str] | None, seed: int,
               columns: Sequence[str] | None = None) -> Column:
    """Hex md5 of ``seed|key``: a repeatable pseudo-random order that does not
    depend on file order or partitioning.  The same string comes out of
    DuckDB's ``md5(concat(seed, '|', key))``.

    Several key columns are joined with ``|``.  A null key is hashed as the empty
    text (as ``concat`` does there), so no row is without a hash.  ``key=None``
    hashes the whole row (duplicates then land on the same side of every split).
    """
    if key is None:
        if not columns:
            raise ValueError("a keyless split hash needs the frame's columns")
        row = F.xxhash64(F.lit(seed), *[F.col(c) for c in columns]).cast("string")
        return F.md5(F.concat(F.lit(f"{seed}|"), row))
    keys = [key] if isinstance(key, str) else list(key)
    parts = [F.lit(str(seed))]
    for k in keys:
        parts += [F.lit("|"), F.coalesce(F.col(k).cast("string"), F.lit(""))]
    return F.md5(F.concat(*parts))


def hash_bucket32(hex_hash: Column) -> Column:
    """First 8 hex digits of a hash as an unsigned 32-bit BIGINT."""
    return F.conv(F.substring(hex_hash, 1, 8), 16, 10).cast("bigint")


def ratio_threshold(ratio: float) -> int:
    """Bucket threshold so that ``bucket < threshold`` selects ``ratio``."""
    return int(round(ratio * 2 ** 32))


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields NULL instead of raising on a zero denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def row_bounded(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.  Runs one cheap job that
    stops early (``limit``)."""
    return df.limit(max_rows + 1).count() <= max_rows


def join_small(big: DataFrame, small: DataFrame, on, how: str = "left",
               max_rows: int = MAX_BROADCAST_ROWS, small_rows: int | None = None) -> DataFrame:
    """Join a side table, broadcasting it only when its size is checked.

    ``small_rows`` may carry a count already known from the fit; otherwise
    the row count is checked here.  Above ``max_rows`` the join is left to a
    shuffle join (AQE may still pick broadcast at runtime from real sizes).
    """
    fits = (small_rows <= max_rows) if small_rows is not None else row_bounded(small, max_rows)
    side = F.broadcast(small) if fits else small
    return big.join(side, on=on, how=how)


def spread(df: DataFrame, key: str | None = None, target: int | None = None) -> DataFrame:
    """Repartition a frame only when it has fewer partitions than the
    cluster's default parallelism (e.g. one large unsplittable file) and the
    work per row is heavy.  Inputs already split into enough partitions are
    returned unchanged, so at scale this adds no shuffle."""
    want = target or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want, key) if key else df.repartition(want)
