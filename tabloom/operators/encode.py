"""Category encoding: ordered value -> index maps, fit/apply pair.

The map is a DataFrame ``(column, value STRING, idx INT)``; it is never
collected.  Indexes follow ascending value order (numbers numerically, text
bytewise), 0-based, so they are repeatable across runs and frames.  Apply
joins the map (broadcast when its checked size allows, shuffle join
otherwise) and writes ``<c>_encoded``: known value -> idx, unseen -> -1,
null -> null.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.columns import FLOAT_TYPES, MAX_BROADCAST_ROWS, is_numeric_type, join_small
from tabloom.functions.ranking import running_total
from tabloom.operators.impute import FillParams, apply_fill, fit_fill
from tabloom.session import cut_lineage

UNSEEN = -1
# Maps whose largest column has at most SMALL_MAP_ROWS values are ranked with
# one window per column; up to LAZY_MAP_ROWS values in total the ranked map
# stays a lazy view of the written distinct values (re-sorting it is cheaper
# than another write).  Larger maps use the bucketed running total.
SMALL_MAP_ROWS = 1_000_000
LAZY_MAP_ROWS = 100_000


@dataclass(frozen=True)
class CategoryMap:
    table: DataFrame            # (column, value, idx), checkpointed
    sizes: dict[str, int]       # distinct values per column


def _family(dt: T.DataType) -> str:
    """The type that orders a column's values: text, integer, decimal or double."""
    if not is_numeric_type(dt):
        return "string"
    if isinstance(dt, T.DecimalType):
        return dt.simpleString()
    return "double" if isinstance(dt, FLOAT_TYPES) else "bigint"


def _typed(c: str, dt: T.DataType) -> Column:
    """The column with -0.0 read as 0.0 (one category)."""
    return F.when(F.col(c) == 0, F.lit(0.0).cast(dt)).otherwise(F.col(c)) \
        if isinstance(dt, FLOAT_TYPES) else F.col(c)


def category_text(c: str, dt: T.DataType) -> Column:
    """A value as the map's text."""
    return _typed(c, dt).cast("string")


def fit_categories(df: DataFrame, columns: Sequence[str]) -> CategoryMap:
    """Distinct non-null values of each column, indexed in ascending order."""
    columns = list(columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    missing = [c for c in columns if c not in types]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    # one typed order column per type family: integers compare as integers
    families: dict[str, list[str]] = {}
    for c in columns:
        families.setdefault(_family(types[c]), []).append(c)
    parts = []
    for i, (family, cols) in enumerate(families.items()):
        rows = df.select(*[F.struct(_typed(c, types[c]).cast(family).alias("v"),
                                    category_text(c, types[c]).alias("value")).alias(c) for c in cols])
        parts.append(rows.unpivot([], cols, "column_name", "v").select(
            "column_name", "v.value", *[(F.col("v.v") if j == i else F.lit(None).cast(f)).alias(f"_k{j}")
                                        for j, f in enumerate(families)]))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    # Distinct values written once; every later step reads this small table.
    distinct = cut_lineage(union.where(F.col("value").isNotNull()).distinct())
    sizes = {r["column_name"]: r["n"] for r in
             distinct.groupBy("column_name").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    order = [f"_k{j}" for j in range(len(families))]
    if max(sizes.values(), default=0) <= SMALL_MAP_ROWS:
        w = Window.partitionBy("column_name").orderBy(*order)
        table = distinct.select("column_name", "value",
                                (F.row_number().over(w) - 1).cast("int").alias("idx"))
        if total > LAZY_MAP_ROWS:
            table = cut_lineage(table)
    else:
        ranked = running_total(distinct, ["column_name"], order, out="_rn", materialize=False,
                               n_rows=total)
        table = cut_lineage(ranked.select("column_name", "value",
                                          (F.col("_rn") - 1).cast("int").alias("idx")))
    return CategoryMap(table=table, sizes={c: sizes.get(c, 0) for c in columns})


def apply_categories(df: DataFrame, cmap: CategoryMap, columns: Sequence[str] | None = None,
                     suffix: str = "_encoded",
                     max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Add ``<c><suffix>`` INT for each mapped column; originals are kept."""
    cols = list(columns) if columns is not None else list(cmap.sizes)
    out, types = df, {f.name: f.dataType for f in df.schema.fields}
    for i, c in enumerate(cols):
        v, ix = f"_cat_v{i}", f"_cat_i{i}"
        side = cmap.table.where(F.col("column_name") == c).select(F.col("value").alias(v),
                                                              F.col("idx").alias(ix))
        out = join_small(out, side, on=category_text(c, types[c]) == F.col(v), how="left",
                         max_rows=max_broadcast_rows, small_rows=cmap.sizes.get(c))
        out = out.withColumn(f"{c}{suffix}",
                             F.when(F.col(c).isNull(), F.lit(None))
                             .otherwise(F.coalesce(F.col(ix), F.lit(UNSEEN))).cast("int")
                             ).drop(v, ix)
    return out


def encode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fit the map on ``df`` and apply it to ``df``."""
    return apply_categories(df, fit_categories(df, columns), columns)


@dataclass(frozen=True)
class Preprocess:
    fill: FillParams
    categories: CategoryMap
    categorical: tuple[str, ...]


def fit_preprocess(train: DataFrame, categorical: Sequence[str] = (),
                   numeric: Sequence[str] = (), strategy: str = "median",
                   exact: bool = True) -> Preprocess:
    """Imputation then category maps, both fitted on ``train`` only."""
    fill = fit_fill(train, numeric, categorical, strategy, exact=exact)
    cats = fit_categories(apply_fill(train, fill), categorical) if categorical else None
    return Preprocess(fill=fill, categories=cats, categorical=tuple(categorical))


def apply_preprocess(df: DataFrame, params: Preprocess) -> DataFrame:
    out = apply_fill(df, params.fill)
    if params.categorical:
        out = apply_categories(out, params.categories, params.categorical)
    return out
