"""The large-data code paths give the same answers as the direct ones."""
from pyspark.sql import functions as F

from tabloom.operators import encode, profile, split
from tests.conftest import SF01


def test_bucketed_medians_equal_direct(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet").withColumn(
        "q", F.when(F.col("l_orderkey") % 3 == 0, None).otherwise(F.col("l_quantity")))
    cols = ["l_extendedprice", "l_discount", "q", "l_linenumber"]
    direct = {r["column_name"]: r["median"] for r in profile.exact_medians(li, cols).collect()}
    big = {r["column_name"]: r["median"] for r in
           profile.bucketed_medians(li, cols, rows_per_bucket=500).collect()}
    assert direct.keys() == big.keys()
    for c in cols:
        assert abs(direct[c] - big[c]) < 1e-9


def test_profile_numeric_mixed_paths(spark, monkeypatch):
    o = spark.read.parquet(f"{SF01}/orders.parquet")
    want = {r["column_name"]: r["median"] for r in profile.profile_numeric(o).collect()}
    monkeypatch.setattr(profile, "MEDIAN_DIRECT_MAX", 100)   # o_orderkey etc. go bucketed
    got = {r["column_name"]: r["median"] for r in profile.profile_numeric(o).collect()}
    assert want == got


def test_bucketed_category_map_equal_direct(spark, monkeypatch):
    o = spark.read.parquet(f"{SF01}/orders.parquet")
    cols = ["o_custkey", "o_orderpriority"]
    small = {tuple(r) for r in encode.fit_categories(o, cols).table.collect()}
    _force_buckets(monkeypatch, 100)
    big = {tuple(r) for r in encode.fit_categories(o, cols).table.collect()}
    assert small == big and len(small) > 1000


def _force_buckets(monkeypatch, rows):
    """The large path, with several buckets."""
    from functools import partial

    from tabloom.functions.ranking import running_total

    monkeypatch.setattr(encode, "SMALL_MAP_ROWS", 3)
    monkeypatch.setattr(encode, "running_total", partial(running_total, rows_per_bucket=rows))


def test_category_order_of_large_integers_and_mixed_types(spark, monkeypatch):
    rows = [(2 ** 53 + i, float(i % 9) / 4, f"v{i}", i % 2 == 0) for i in range(200)] + [(None,) * 4]
    df = spark.createDataFrame(rows, "k bigint, x double, s string, b boolean").withColumn(
        "d", F.expr("cast(k as decimal(25, 3)) / 7"))
    cols = ["k", "x", "s", "b", "d"]
    small = {tuple(r) for r in encode.fit_categories(df, cols).table.collect()}
    assert {i for c, v, i in small if c == "k" and int(v) - 2 ** 53 != i} == set()
    _force_buckets(monkeypatch, 20)
    assert {tuple(r) for r in encode.fit_categories(df, cols).table.collect()} == small


def test_stratified_folds_with_null_labels_and_repeated_keys(spark):
    rows = [(i // 2, None if i % 4 < 2 else "y" if i % 8 < 6 else "n") for i in range(2000)] + [(None, "y")] * 3
    df = spark.createDataFrame(rows, "id long, label string")
    a = split.stratified_kfold(df, "id", "label", 4)
    b = split.stratified_kfold(df, "id", "label", 4, rows_per_bucket=100)
    assert a.count() == b.count() == len(rows)
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    assert a.groupBy("id", "label").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() == 0
    assert a.where("fold is null").count() == 0


def test_splits_with_null_keys(spark):
    df = spark.createDataFrame([(None if i % 5 == 0 else i,) for i in range(500)], "id long")
    for mode in ("hash", "exact"):
        parts = {r["split"]: r["count"] for r in split.holdout_split(df, "id", 0.3, 1, mode=mode)
                 .groupBy("split").count().collect()}
        assert sum(parts.values()) == 500
        per = split.holdout_split(df, "id", 0.3, 1, mode=mode).where("id is null").select("split").distinct()
        assert per.count() == 1
    assert split.kfold(df, "id", 3).where("fold is null").count() == 0


def test_direct_median_budget(monkeypatch):
    monkeypatch.setattr(profile, "MEDIAN_DIRECT_TOTAL", 150)
    direct, big = profile.split_by_distinct(None, ["a", "b", "c"],
                                            estimates={"a": 100, "b": 40, "c": 90})
    assert direct == ["b", "c"] and big == ["a"]


def test_category_apply_shuffle_join_equals_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        o = spark.read.parquet(f"{SF01}/orders.parquet")
        train, _ = split.train_test(o, "o_orderkey", 0.5, 42)
        cm = encode.fit_categories(train, ["o_custkey"])
        a = encode.apply_categories(o, cm, ["o_custkey"])
        b = encode.apply_categories(o, cm, ["o_custkey"], max_broadcast_rows=0)
        plan = b._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_wide_table_long_statistics_equal(spark, monkeypatch):
    from tabloom.plans import queries as q

    o = q.orders_nulls(spark, SF01).withColumn(
        "ratio", F.when(F.col("o_orderkey") % 13 == 0, F.lit(float("nan")))
        .otherwise(F.col("o_totalprice") / 1000))
    cols = ["position", "column_name", "dtype", "non_null", "null_count", "nan_count",
            "unique_count", "mode", "mode_count"]
    nums = ["min_value", "max_value", "mean", "median", "std_dev"]

    def rows(df):
        return sorted(tuple(r[c] for c in cols) + tuple(None if r[c] is None else round(r[c], 6)
                                                         for c in nums) for r in df.collect())

    want = rows(profile.profile_table(o))
    monkeypatch.setattr(profile, "WIDE_COLUMNS", 0)
    assert rows(profile.profile_table(o)) == want


def test_wide_moments_equal(spark, monkeypatch):
    from tabloom.operators import impute, scale

    li = spark.read.parquet(f"{SF01}/lineitem.parquet").withColumn(
        "q", F.when(F.col("l_linenumber") == 1, None).otherwise(F.col("l_quantity")))
    cols = ["l_quantity", "l_discount", "l_tax", "q"]
    a = scale.fit_zscore(li, cols).stats
    fa = impute.fit_fill(li, ["q"], [], "mean").values
    monkeypatch.setattr(scale, "WIDE_COLUMNS", 0)
    b = scale.fit_zscore(li, cols).stats
    fb = impute.fit_fill(li, ["q"], [], "mean").values
    for c in cols:
        assert abs(a[c][0] - b[c][0]) < 1e-9 and abs(a[c][1] - b[c][1]) < 1e-9
    assert abs(fa["q"] - fb["q"]) < 1e-9
