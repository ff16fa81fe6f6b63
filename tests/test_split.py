"""Split and fold invariants (independent of layout, disjoint, complete)."""
import duckdb
import pytest
from pyspark.sql import functions as F

from tabloom.operators import split
from tests.conftest import SF01


def _orders(spark):
    return spark.read.parquet(f"{SF01}/orders.parquet")


def test_hash_split_count_matches_survey(spark):
    s = split.holdout_split(_orders(spark), "o_orderkey", 0.2, 42)
    assert s.where("split = 'test'").count() == 3008


def test_split_independent_of_layout(spark):
    o = _orders(spark)
    a = split.holdout_split(o, "o_orderkey").where("split='test'").select("o_orderkey")
    b = split.holdout_split(o.repartition(7).orderBy(F.rand(3)), "o_orderkey") \
        .where("split='test'").select("o_orderkey")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_exact_split_equals_sorted_limit(spark):
    s = split.holdout_split(_orders(spark), "o_orderkey", 0.2, 42, mode="exact")
    got = s.where("split='test'").agg(F.count("*"), F.sum("o_orderkey")).first()
    con = duckdb.connect()
    want = con.execute(f"""
        select count(*), sum(o_orderkey) from (
          select o_orderkey from '{SF01}/orders.parquet'
          order by md5(concat('42','|',cast(o_orderkey as varchar))), o_orderkey
          limit (select cast(count(*)*0.2 as bigint) from '{SF01}/orders.parquet'))""").fetchone()
    assert (got[0], got[1]) == (want[0], want[1])


def test_three_way_parts_complete(spark):
    o = _orders(spark)
    s = split.three_way_split(o, "o_orderkey", 0.2, 0.1)
    parts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert set(parts) == {"train", "test", "validation"}
    assert sum(parts.values()) == o.count()
    assert parts["test"] == 3008


def test_stratified_folds_balanced(spark):
    o = _orders(spark)
    f = split.stratified_kfold(o, "o_orderkey", "o_orderpriority", k=5, rows_per_bucket=500)
    counts = f.groupBy("o_orderpriority", "fold").count().collect()
    per = {}
    for r in counts:
        per.setdefault(r["o_orderpriority"], []).append(r["count"])
    for v in per.values():
        assert len(v) == 5 and max(v) - min(v) <= 1


def test_kfold_hash(spark):
    f = split.kfold(_orders(spark), "o_orderkey", k=4)
    assert {r["fold"] for r in f.select("fold").distinct().collect()} == {0, 1, 2, 3}


def test_keyless_split_keeps_duplicates_together(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet").select("l_returnflag", "l_linestatus")
    s = split.holdout_split(li, None, 0.2, 42)
    sides = s.groupBy("l_returnflag", "l_linestatus").agg(F.countDistinct("split").alias("k"))
    assert sides.where("k > 1").count() == 0
    assert s.count() == li.count()


def test_stratified_folds_multi_bucket_hot_class(spark):
    o = _orders(spark).select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, "x")
                              .otherwise(F.col("o_orderpriority")).alias("cls"))
    a = split.stratified_kfold(o, "o_orderkey", "cls", k=4, rows_per_bucket=700)
    b = split.stratified_kfold(o, "o_orderkey", "cls", k=4)
    assert a.exceptAll(b).count() == 0


def test_split_argument_checks(spark):
    import pytest

    o = _orders(spark)
    with pytest.raises(ValueError):
        split.holdout_split(o, "o_orderkey", 1.5)
    with pytest.raises(ValueError):
        split.holdout_split(o, "o_orderkey", mode="random")
    with pytest.raises(ValueError):
        split.holdout_split(o, None, mode="exact")
    with pytest.raises(ValueError):
        split.three_way_split(o, "o_orderkey", 0.7, 0.5)
    with pytest.raises(ValueError):
        split.kfold(o, "o_orderkey", 1)


import pytest as _pytest


@_pytest.mark.parametrize("ratio", [0.0, 0.1, 0.37, 1.0])
def test_exact_split_counts(spark, ratio):
    o = _orders(spark)
    n = o.count()
    s = split.holdout_split(o, "o_orderkey", ratio, 7, mode="exact")
    assert s.where("split = 'test'").count() == int(n * ratio)


@_pytest.mark.parametrize("seed,ratio", [(1, 0.05), (7, 0.5), (123, 0.33)])
def test_exact_split_matches_duckdb_many(spark, seed, ratio):
    o = _orders(spark)
    got = split.holdout_split(o, "o_orderkey", ratio, seed, mode="exact") \
        .where("split = 'test'").select("o_orderkey")
    con = duckdb.connect()
    want = {r[0] for r in con.execute(f"""
        select o_orderkey from '{SF01}/orders.parquet'
        order by md5(concat('{seed}', '|', cast(o_orderkey as varchar))), o_orderkey
        limit (select cast(count(*) * {ratio} as bigint) from '{SF01}/orders.parquet')""").fetchall()}
    assert {r[0] for r in got.collect()} == want


@_pytest.mark.parametrize("seed,k", [(3, 3), (11, 7)])
def test_stratified_folds_match_duckdb(spark, seed, k):
    o = _orders(spark)
    got = {(r[0], r[1]) for r in split.stratified_kfold(o, "o_orderkey", "o_orderpriority", k, seed)
           .select("o_orderkey", "fold").collect()}
    con = duckdb.connect()
    want = {(r[0], r[1]) for r in con.execute(f"""
        select o_orderkey, ((row_number() over (partition by o_orderpriority
          order by md5(concat('{seed}', '|', cast(o_orderkey as varchar))), o_orderkey) - 1) % {k})::int
        from '{SF01}/orders.parquet'""").fetchall()}
    assert got == want


def _first_of_each_class(rows, ratio, seed=42):
    """(label, key) pairs of the test part, by sorting every class."""
    import hashlib

    out, place = set(), lambda k: (hashlib.md5(f"{seed}|{'' if k is None else k}".encode()).hexdigest(),
                                   k is not None, k or 0)
    for label in {r[0] for r in rows}:
        keys = sorted((r[1] for r in rows if r[0] == label), key=place)
        need = int(len(keys) * ratio)
        out |= {(label, k) for k in keys[:need]}
    return out


@pytest.mark.parametrize("ratio", [0.0, 0.01, 0.2, 0.5, 1.0])
@pytest.mark.parametrize("digits", [1, 3])
def test_stratified_exact_split(spark, monkeypatch, ratio, digits):
    """Null labels and keys, repeated keys, classes of one row, many and few slices."""
    monkeypatch.setattr(split, "DIGITS", digits)
    rows = [("a" if i % 3 else "b", i, "x") for i in range(300)] + [(None, i, "y") for i in range(40)]
    rows += [("hot", 7, "z")] * 50 + [("hot", i, "z") for i in range(50, 70)] + [("one", 1, "o"), ("c", None, "n"), ("c", 5, "n")]
    df = spark.createDataFrame(rows, "label string, key long, _class string").drop("_class")
    got = split.holdout_split(df, "key", ratio, mode="exact", stratify="label")
    assert got.columns == ["label", "key", "split"] and got.count() == len(rows)
    test = {(r.label, r.key) for r in got.where("split = 'test'").collect()}
    assert test == _first_of_each_class(rows, ratio)


def test_stratified_exact_split_of_nothing_and_by_hash(spark):
    empty = spark.createDataFrame([], "label string, key long")
    assert split.holdout_split(empty, "key", 0.5, mode="exact", stratify="label").count() == 0
    with pytest.raises(ValueError):
        split.holdout_split(empty, "key", 0.5, stratify="label")


def test_stratified_parts_hold_every_class(spark):
    from tabloom.plans.holdout import _stratified_parts

    df = spark.createDataFrame([("ab"[i % 10 == 0], i) for i in range(1000)], "label string, key long")
    counts = _stratified_parts(df, "key", "label", 0.2, 0.1, 42).groupBy("label", "split").count().collect()
    got = {(r["label"], r["split"]): r["count"] for r in counts}
    assert got == {("a", "test"): 180, ("b", "test"): 20, ("a", "validation"): 90, ("b", "validation"): 10,
                   ("a", "train"): 630, ("b", "train"): 70}
