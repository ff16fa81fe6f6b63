"""Most frequent values without shuffling the values.

Values travel as 128-bit digests of their text form, and only those that can be among
the k most frequent are counted:

1. every task keeps a summary of at most ``CAPACITY`` digests per column (Misra-Gries:
   what does not fit lowers all counts alike), so a value's true count lies between its
   summary count and that plus the column's summed error, and a value in no summary has
   at most the error;
2. if the k-th largest summary count is above the error, only values whose upper bound
   reaches it can be among the k: a second scan counts these exactly by digest, a third
   fetches the winners' texts (the only texts that are shuffled, one per task and winner);
3. a column where the bound proves nothing (nearly all values differ) is counted in full
   by digest, 16 bytes a value; texts are then fetched for the k winners.  If the k-th
   count is 1, the rest of the k are the smallest texts among values that occur once,
   which every task cuts to k before they move.

Ties go to the smaller text, nulls are no values, an empty column has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.functions.columns import MAX_BROADCAST_ROWS, is_simple_type, join_small, row_bounded
from tabloom.operators.profile import top_values
from tabloom.session import cut_lineage

#: Digests a task remembers per column.
CAPACITY = 4096


def _digest(c: str) -> Column:
    return F.unhex(F.md5(F.col(f"`{c}`").cast("string")))


class Summary:
    """Misra-Gries counts of one column."""

    def __init__(self, capacity: int):
        self.capacity, self.held, self.error, self.total = capacity, {}, 0, 0

    def add(self, values: pa.Array) -> None:
        values = values.drop_null()
        self.total += len(values)
        for r in pc.value_counts(values).to_pylist():
            self.held[r["values"]] = self.held.get(r["values"], 0) + r["counts"]
        if len(self.held) > self.capacity:
            less = sorted(self.held.values(), reverse=True)[self.capacity]
            self.held = {v: n - less for v, n in self.held.items() if n > less}
            self.error += less


def summaries(df: DataFrame, columns: Sequence[str], capacity: int | None = None) -> DataFrame:
    """(column_id, digest, n, error, total): every task's summary counts, and one row per
    task and column without a digest that has its error and its number of values."""
    capacity = capacity or CAPACITY

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Summary(capacity) for _ in columns]
        for batch in batches:
            for s, values in zip(held, batch.columns):
                s.add(values)
        rows = [(i, None, 0, s.error, s.total) for i, s in enumerate(held)]
        rows += [(i, v, n, 0, 0) for i, s in enumerate(held) for v, n in s.held.items()]
        for at in range(0, len(rows), 10_000):
            part = list(zip(*rows[at:at + 10_000]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(part, (pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64()))],
                names=["column_id", "digest", "n", "error", "total"])

    digests = df.select(*[_digest(c).alias(f"c{i}") for i, c in enumerate(columns)])
    return digests.mapInArrow(build, "column_id int, digest binary, n long, error long, total long")


def _stacked(df: DataFrame, columns: Sequence[str], ids: Sequence[int], text: bool) -> DataFrame:
    """(column_id, digest[, value]) of every value of the columns ``ids``."""
    parts = [F.struct(F.lit(i).alias("column_id"), _digest(columns[i]).alias("digest"),
                      *([F.col(f"`{columns[i]}`").cast("string").alias("value")] if text else [])) for i in ids]
    return df.select(F.explode(F.array(*parts)).alias("v")).select("v.*").where("digest is not null")


def _wanted(df: DataFrame, columns: Sequence[str], wanted: DataFrame, ids: Sequence[int], text: bool) -> DataFrame:
    """Rows of ``_stacked`` whose (column_id, digest) is wanted."""
    side = wanted.select(F.col("column_id").alias("w_id"), F.col("digest").alias("w_digest"))
    return join_small(_stacked(df, columns, ids, text), side,
                      (F.col("column_id") == F.col("w_id")) & (F.col("digest") == F.col("w_digest")), "left_semi")


def _counted(df: DataFrame, columns: Sequence[str], wanted: DataFrame, ids: Sequence[int], k: int) -> DataFrame:
    """(column_id, value, n) of the k best of the wanted digests, and of those that share
    the k-th count: one scan counts, one fetches a text for each from every task."""
    counts = _wanted(df, columns, wanted, ids, False).groupBy("column_id", "digest").agg(F.count(F.lit(1)).alias("n"))
    place = F.rank().over(Window.partitionBy("column_id").orderBy(F.desc("n")))
    best = cut_lineage(counts.withColumn("place", place).where(F.col("place") <= k).drop("place"), "best-digests")

    def one_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, bytes]] = set()
        for batch in batches:
            new = []
            for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if key not in seen:
                    seen.add(key)
                    new.append(i)
            if new:
                yield batch.take(pa.array(new))

    texts = _wanted(df, columns, best, ids, True).mapInArrow(
        one_each, "column_id int, digest binary, value string").groupBy("column_id", "digest").agg(
        F.min("value").alias("value"))
    return best.join(texts, ["column_id", "digest"]).select("column_id", "value", "n")


def _full(df: DataFrame, columns: Sequence[str], i: int, k: int) -> DataFrame | None:
    """(column_id, value, n) of a superset of column i's k best, from the counts of all
    digests; None if too many values share the k-th count."""
    counts = cut_lineage(_stacked(df, columns, [i], False).groupBy("column_id", "digest").agg(
        F.count(F.lit(1)).alias("n")), "digest-counts")
    best = counts.orderBy(F.desc("n")).limit(k).select("n").collect()
    if not best:
        return counts.select("column_id", F.lit("").alias("value"), "n")
    least = best[-1]["n"]
    if least > 1 or len(best) < k:
        wanted = counts.where(F.col("n") >= least)
        return _counted(df, columns, wanted, [i], k) if row_bounded(wanted, MAX_BROADCAST_ROWS) else None
    more = counts.where("n > 1")                                   # fewer than k
    side = more.select(F.col("digest").alias("w_digest"))
    once = _stacked(df, columns, [i], True).join(F.broadcast(side), F.col("digest") == F.col("w_digest"), "left_anti")
    lone = once.orderBy("value").limit(k).select("column_id", "value", F.lit(1).cast("long").alias("n"))
    return _counted(df, columns, more, [i], k).union(lone)


def frequent_values(df: DataFrame, columns: Sequence[str] | None = None, k: int = 5,
                    capacity: int | None = None, full: list[str] | None = None) -> DataFrame:
    """(column_name, value_rank, value, n, percent): like ``profile.top_values``, for
    columns of any width.  ``full`` receives the columns that needed a full count."""
    if k < 1:
        raise ValueError("k must be at least 1")
    types = {f.name: f.dataType for f in df.schema.fields}
    columns = [c for c in (df.columns if columns is None else columns) if is_simple_type(types[c])]
    raw = cut_lineage(summaries(df, columns, capacity), "summaries")
    known = {r["column_id"]: r for r in raw.where("digest is null").groupBy("column_id").agg(
        F.sum("error").alias("error"), F.sum("total").alias("total")).collect()}     # a row per column
    merged = raw.where("digest is not null").groupBy("column_id", "digest").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("column_id").orderBy(F.desc("n"))
    least = {r["column_id"]: r["n"] for r in merged.withColumn("r", F.row_number().over(best)).where(
        F.col("r") <= k).groupBy("column_id").agg(F.min("n").alias("n"), F.count(F.lit(1)).alias("c")).select(
        "column_id", F.when((F.col("c") < k), F.lit(0)).otherwise(F.col("n")).alias("n")).collect()}
    parts, proven = [], []
    for i, c in enumerate(columns):
        error = known[i]["error"] if i in known else 0
        # without error the summary holds every value
        if error == 0 or least.get(i, 0) > error:
            proven.append((i, max(1, least.get(i, 0) - error)))
        else:
            if full is not None:
                full.append(c)
            some = _full(df, columns, i, k)
            if some is None:
                plain = top_values(df, [c], k)
                some = plain.select(F.lit(i).alias("column_id"), "value", "n")
            parts.append(some)
    if proven:
        floor = reduce(lambda a, p: F.when(F.col("column_id") == p[0], F.lit(p[1])).otherwise(a), proven, F.lit(None))
        wanted = merged.where(F.col("n") >= floor)
        parts.append(_counted(df, columns, cut_lineage(wanted, "candidates"), [i for i, _ in proven], k))
    if not parts:
        return top_values(df, [], k)
    every = reduce(DataFrame.unionByName, parts)
    order = Window.partitionBy("column_id").orderBy(F.desc("n"), "value")
    ranked = every.withColumn("value_rank", F.row_number().over(order)).where(F.col("value_rank") <= k)
    names = F.array(*[F.lit(c) for c in columns])
    totals = F.array(*[F.lit(known[i]["total"] if i in known else 0) for i in range(len(columns))])
    return ranked.select(names[F.col("column_id")].alias("column_name"), F.col("value_rank").cast("long"), "value",
                         F.col("n"), (F.col("n") / totals[F.col("column_id")] * 100.0).alias("percent"))
