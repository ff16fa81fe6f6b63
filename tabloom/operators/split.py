"""Repeatable splits and folds keyed on a hash of ``seed|key``.

Row position means nothing in Spark, so every split is a predicate on
``md5(seed|key)``: it does not depend on file order or partitioning, and
the same rows are chosen by DuckDB's ``md5`` on the same table.

* ``holdout_split(mode="hash")``: map-only, ``bucket32 < ratio * 2^32``.
* ``holdout_split(mode="exact")``: exactly ``int(n * ratio)`` test rows (for
  a unique key): the cut value is found with two bounded prefix-count
  aggregates (at most 65,536 groups each) and a tiny final group, then the
  split is a filter.  No global sort, nothing funnels through one task.
  With ``stratify`` every class gets exactly ``int(n * ratio)`` test rows of its own:
  the cuts of all classes are found together, from counts per class and hash slice.
* ``kfold``: ``bucket32 % k``; ``stratified_kfold``: rank of the distinct keys
  within the class by (hash, key), dealt round-robin into k folds, via a
  bucketed running total so one dominant class is still spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.functions.columns import hash_bucket32, join_small, ratio_threshold, split_hash
from tabloom.functions.ranking import running_total
from tabloom.session import cut_lineage

HASH = "_split_hash"
PART = "split"


def with_split_hash(df: DataFrame, key: str | Sequence[str] | None, seed: int = 42,
                    out: str = HASH) -> DataFrame:
    return df.withColumn(out, split_hash(key, seed, df.columns))


def _key_cols(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _locate(counts: list[tuple[str, int]], need: int) -> tuple[str, int]:
    """The slice in which the running count reaches ``need`` and the rank
    still needed inside it."""
    below = 0
    for p, n in counts:
        if below + n >= need:
            return p, need - below
        below += n
    raise ValueError("rank beyond the counted rows")


def _exact_cut(hashed: DataFrame, key_cols: list[str], ratio: float) -> Column:
    """Predicate selecting the int(n * ratio) rows with the smallest (hash, key)."""
    h = F.col(HASH)
    # Level 1 and 2: counts per 16-bit slice of the hash (<= 65,536 rows each);
    # level 1 also gives n, so no separate count job.
    p1 = F.substring(h, 1, 4)
    rows = sorted((r["p"], r["n"]) for r in hashed.groupBy(p1.alias("p")).agg(
        F.count(F.lit(1)).alias("n")).collect())
    total = sum(n for _, n in rows)
    k = int(total * ratio)
    if k <= 0:
        return F.lit(False)
    if k >= total:
        return F.lit(True)
    cut1, need = _locate(rows, k)
    p2 = F.substring(h, 5, 4)
    rows = sorted((r["p"], r["n"]) for r in hashed.where(p1 == cut1).groupBy(p2.alias("p"))
                  .agg(F.count(F.lit(1)).alias("n")).collect())
    cut2, need = _locate(rows, need)
    # Level 3: one 32-bit slice; distinct (hash, key) groups there are few
    # (duplicates of one key collapse into one group).
    prefix = cut1 + cut2
    groups = (hashed.where(F.substring(h, 1, 8) == prefix)
              .groupBy(HASH, *key_cols).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(HASH, *key_cols).collect())
    acc, cut = 0, groups[-1]
    for g in groups:
        acc += g["n"]
        if acc >= need:
            cut = g
            break
    # Lexicographic (hash, key...) <= cut; nulls come first.
    names = [HASH] + key_cols
    cond = F.lit(True)
    for name in reversed(names):
        same = F.col(name).eqNullSafe(F.lit(cut[name]))
        less = F.lit(False) if cut[name] is None else F.coalesce(F.col(name) < F.lit(cut[name]), F.lit(True))
        cond = less | (same & cond)
    return cond


#: Hex digits of a slice, and how often slices are cut again: 4,096 counts a class and step.
DIGITS, STEPS = 3, 3


def _same_class(cut: str) -> Column:
    return F.col("_class").eqNullSafe(F.col(cut))


def _class_cuts(rows: DataFrame, key_cols: list[str], ratio: float) -> DataFrame:
    """(_cut_class, _cut): for every class of ``rows`` (_class, hash, keys) with a test
    row, the (hash, key) of its last one.  A step counts the rows of each class in the
    slices of the slice that holds the cut, and a window runs over those counts only."""
    cuts = None
    for step in range(STEPS):
        inside = rows if cuts is None else join_small(
            rows, cuts, _same_class("_cut_class") & F.col(HASH).startswith(F.col("_slice")), "inner")
        kept = [] if cuts is None else ["_need"]
        counts = inside.groupBy("_class", F.substring(HASH, 1, DIGITS * (step + 1)).alias("_next"), *kept).agg(
            F.count(F.lit(1)).alias("_n"))
        each = Window.partitionBy("_class")
        upto = each.orderBy("_next").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        counts = counts.withColumn("_upto", F.sum("_n").over(upto))
        if cuts is None:
            total = F.sum("_n").over(each)
            counts = counts.withColumn("_need", F.floor(total * F.lit(float(ratio))).cast("bigint"))
        before = F.col("_upto") - F.col("_n")
        cuts = cut_lineage(counts.where((before < F.col("_need")) & (F.col("_need") <= F.col("_upto"))).select(
            F.col("_class").alias("_cut_class"), F.col("_next").alias("_slice"),
            (F.col("_need") - before).alias("_need")), "class-cuts")
    # what is left of a class is one slice of 36 bits: a few distinct keys
    groups = join_small(rows, cuts, _same_class("_cut_class") & F.col(HASH).startswith(F.col("_slice")), "inner") \
        .groupBy("_class", "_need", HASH, *key_cols).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy("_class").orderBy(HASH, *key_cols).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    groups = groups.withColumn("_upto", F.sum("_n").over(upto))
    last = (F.col("_upto") - F.col("_n") < F.col("_need")) & (F.col("_need") <= F.col("_upto"))
    return cut_lineage(groups.where(last).select(
        F.col("_class").alias("_cut_class"), _place(key_cols).alias("_cut")), "class-cuts")


def _place(key_cols: list[str]) -> Column:
    """(hash, key ...) as one value in split order (nulls first)."""
    return F.struct(F.col(HASH).alias("h"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(key_cols)])


def _stratified_exact(hashed: DataFrame, key_cols: list[str], label: str, ratio: float) -> DataFrame:
    """``hashed`` with ``_test``: whether the row is among the first of its class."""
    classed = hashed.withColumn("_class", F.col(label))
    narrow = classed.select("_class", HASH, *[c for c in key_cols])
    cuts = _class_cuts(narrow, key_cols, ratio)
    joined = join_small(classed, cuts, _same_class("_cut_class"), "left")
    return joined.withColumn("_test", F.coalesce(_place(key_cols) <= F.col("_cut"), F.lit(False))).drop(
        "_class", "_cut_class", "_cut")


def holdout_split(df: DataFrame, key: str | Sequence[str] | None, test_ratio: float = 0.2,
                  seed: int = 42, mode: str = "hash", out: str = PART,
                  stratify: str | None = None) -> DataFrame:
    """Add ``out`` in {'train', 'test'}.

    ``hash``: a row is test when its 32-bit hash bucket is below
    ``test_ratio * 2^32`` (Bernoulli-like count, map-only).
    ``exact``: the ``int(n * test_ratio)`` rows with the smallest (hash, key)
    are test; requires a key (a unique key gives an exact count; duplicate
    keys always land together).
    ``stratify`` (exact mode): so many rows of every class of that column instead; a
    null label is a class of its own, and rows that share class and key land together.
    """
    if not 0.0 <= test_ratio <= 1.0:
        raise ValueError("test_ratio must lie in [0, 1]")
    if stratify is not None and mode != "exact":
        raise ValueError("a stratified split needs mode='exact'")
    hashed = with_split_hash(df, key, seed)
    if mode == "hash":
        is_test = hash_bucket32(F.col(HASH)) < F.lit(ratio_threshold(test_ratio))
    elif mode == "exact":
        if key is None:
            raise ValueError("exact mode needs a key column")
        if stratify is not None:
            hashed = _stratified_exact(hashed, _key_cols(key), stratify, test_ratio)
            return hashed.withColumn(out, F.when(F.col("_test"), "test").otherwise("train")).drop(HASH, "_test")
        is_test = _exact_cut(hashed, _key_cols(key), test_ratio)
    else:
        raise ValueError("mode must be 'hash' or 'exact'")
    return hashed.withColumn(out, F.when(is_test, "test").otherwise("train")).drop(HASH)


def train_test(df: DataFrame, key, test_ratio: float = 0.2, seed: int = 42,
               mode: str = "hash", stratify: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The two parts as frames (each a filter over the same split column)."""
    s = holdout_split(df, key, test_ratio, seed, mode, stratify=stratify)
    return (s.where(F.col(PART) == "train").drop(PART), s.where(F.col(PART) == "test").drop(PART))


def three_way_split(df: DataFrame, key, test_ratio: float = 0.2, validation_ratio: float = 0.1,
                    seed: int = 42, out: str = PART) -> DataFrame:
    """'test' below the first threshold, 'validation' below the second,
    'train' above: two thresholds on the same hash, map-only."""
    if test_ratio + validation_ratio > 1.0:
        raise ValueError("test_ratio + validation_ratio must not exceed 1")
    b = hash_bucket32(split_hash(key, seed, df.columns))
    t1 = ratio_threshold(test_ratio)
    t2 = ratio_threshold(test_ratio + validation_ratio)
    return df.withColumn(out, F.when(b < t1, "test").when(b < t2, "validation")
                         .otherwise("train"))


def kfold(df: DataFrame, key, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Fold id 0..k-1 from the hash bucket (map-only)."""
    if k < 2:
        raise ValueError("k must be at least 2")
    return df.withColumn(out, (hash_bucket32(split_hash(key, seed, df.columns)) % k).cast("int"))


def stratified_kfold(df: DataFrame, key, label: str, k: int = 5, seed: int = 42,
                     out: str = "fold", **kw) -> DataFrame:
    """Within each class, the distinct keys ranked by (hash, key) are dealt into
    folds 0..k-1 in turn: rows that share class and key stay in one fold, and with
    a unique key every fold holds each class to within one row.  Rows with a null
    label are a class of their own."""
    if k < 2:
        raise ValueError("k must be at least 2")
    keys = _key_cols(key)
    hashed = with_split_hash(df, keys, seed)
    names = [label, HASH, *[c for c in keys if c != label]]
    groups = hashed.select(*names).distinct()
    ranked = running_total(groups, [label], names[1:], out="_rank", **kw)
    side = ranked.select(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(names)],
                         ((F.col("_rank") - 1) % k).cast("int").alias(out))
    same = F.lit(True)
    for i, c in enumerate(names):
        same = same & F.col(c).eqNullSafe(F.col(f"_s{i}"))
    return hashed.join(side, same).select(*df.columns, out)
