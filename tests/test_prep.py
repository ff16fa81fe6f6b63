"""Fixture goldens F3-F5 (profiling, imputation, encoding, z-scores)."""
import math

import pytest
from pyspark.sql import functions as F

from tabloom.operators import encode, impute, profile, scale

F3 = [("ketch", "Oslo", 12.0, 2.5), ("ketch", "Bergen", 20.0, 1.5), ("sloop", "Oslo", 10.0, 3.5),
      ("yawl", "Malmo", 14.0, 2.5), (None, None, None, None)]
F3_SCHEMA = "kind string, port string, length_m double, draught_m double"

F4 = [("ketch", "Oslo", 12.0, 2.5, 4, 1990, "N"), ("ketch", "Oslo", None, 1.5, 6, 2001, "S"),
      ("sloop", "Bergen", 20.0, 3.5, 10, None, "S"), (None, "Malmo", 16.0, None, None, 1990, "N"),
      ("yawl", None, 8.0, 2.5, 4, 1975, None)]
F4_SCHEMA = ("kind string, port string, length_m double, draught_m double, crew bigint, built bigint, "
             "flag string")


@pytest.fixture
def f3(spark):
    return spark.createDataFrame(F3, F3_SCHEMA)


@pytest.fixture
def f4(spark):
    return spark.createDataFrame(F4, F4_SCHEMA)


def test_profile_table_f3(f3):
    rows = {r["column_name"]: r for r in profile.profile_table(f3).collect()}
    assert rows["kind"]["non_null"] == 4 and rows["kind"]["null_count"] == 1
    assert rows["kind"]["unique_count"] == 4
    assert rows["length_m"]["unique_count"] == 5 and rows["draught_m"]["unique_count"] == 4
    c = rows["length_m"]
    assert (c["min_value"], c["max_value"]) == (10.0, 20.0)
    assert c["mean"] == pytest.approx(14.0) and c["median"] == pytest.approx(13.0)
    assert c["std_dev"] == pytest.approx(4.320494, abs=1e-6)
    d = rows["draught_m"]
    assert d["mean"] == pytest.approx(2.5) and d["median"] == pytest.approx(2.5)
    assert d["std_dev"] == pytest.approx(0.816497, abs=1e-6)
    assert rows["kind"]["mode"] == "ketch" and rows["port"]["mode"] == "Oslo"
    assert float(c["mode"]) == 10.0 and float(d["mode"]) == 2.5
    assert rows["kind"]["min_value"] is None


def test_profile_summary_and_top(f3):
    s = profile.profile_summary(f3, "sample", "x.csv").first()
    assert (s["row_count"], s["column_count"]) == (5, 4)
    top = profile.top_values(f3, ["kind"], k=5).orderBy("value_rank").collect()
    assert [r["value"] for r in top] == ["ketch", "sloop", "yawl"]
    assert top[0]["percent"] == pytest.approx(50.0)


@pytest.mark.parametrize("strategy,expect", [
    ("mean", {"length_m": 14.0, "draught_m": 2.5, "crew": 6.0, "built": 1989.0}),
    ("median", {"length_m": 14.0, "draught_m": 2.5, "crew": 5.0, "built": 1990.0}),
    ("mode", {"length_m": 8.0, "draught_m": 2.5, "crew": 4, "built": 1990}),
])
def test_fit_fill_strategies(f4, strategy, expect):
    num = ["length_m", "draught_m", "crew", "built"]
    p = impute.fit_fill(f4, num, ["kind", "port", "flag"], strategy)
    for c, v in expect.items():
        assert p.values[c] == pytest.approx(v)
    assert p.values["kind"] == "ketch" and p.values["flag"] == "N"
    out = impute.apply_fill(f4, p)
    assert out.where(" or ".join(f"{c} is null" for c in out.columns)).count() == 0
    if strategy != "mode":
        assert dict(out.dtypes)["crew"] == "double"
    else:
        assert dict(out.dtypes)["crew"] == "bigint"


def test_fill_all_null_defaults(spark):
    df = spark.createDataFrame([(None, None), (None, None)], "x bigint, s string")
    p = impute.fit_fill(df, ["x"], ["s"], "median")
    assert p.values == {"x": 0, "s": "UNKNOWN"}


def test_bad_strategy(f4):
    with pytest.raises(ValueError):
        impute.fit_fill(f4, ["built"], [], "max")


def test_encode_fit_apply(f4, spark):
    filled = impute.impute(f4, [], ["kind", "port", "flag"], "mode")
    cmap = encode.fit_categories(filled, ["kind", "port", "flag"])
    out = encode.apply_categories(filled, cmap).collect()
    for r in out:
        assert r["kind_encoded"] == {"ketch": 0, "sloop": 1, "yawl": 2}[r["kind"]]
        assert r["flag_encoded"] == {"N": 0, "S": 1}[r["flag"]]
    other = spark.createDataFrame([("brig",), (None,), ("yawl",)], "kind string")
    got = [r["kind_encoded"] for r in encode.apply_categories(other, cmap, ["kind"])
           .orderBy(F.col("kind").asc_nulls_first()).collect()]
    assert got == [None, -1, 2]
    assert dict(encode.apply_categories(other, cmap, ["kind"]).dtypes)["kind_encoded"] == "int"


def test_negative_zero_is_one_category(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (1.5,)], "x double")
    cmap = encode.fit_categories(df, ["x"])
    assert cmap.sizes == {"x": 2}
    assert sorted(r["x_encoded"] for r in encode.apply_categories(df, cmap).collect()) == [0, 0, 1]


def test_mode_of_large_integers_is_exact(spark):
    big = 2 ** 53
    df = spark.createDataFrame([(big + 1,)] * 3 + [(big,)] * 2, "x bigint")
    assert impute.fit_fill(df, ["x"], [], "mode").values["x"] == big + 1


def test_zscore_f5(spark):
    rows = [(1.0, 18.0, 3, 10), (2.0, 13.0, 1, 45), (3.0, 17.0, 6, 38), (4.0, 17.5, 2, 35), (5.0, 17.0, 6, 38)]
    df = spark.createDataFrame(rows, "a double, b double, c bigint, d bigint")
    p = scale.fit_zscore(df, ["a", "b", "c", "d", "nope"])
    assert p.stats["a"][0] == pytest.approx(3.0)
    assert p.stats["a"][1] == pytest.approx(1.581139, abs=1e-6)
    out = scale.apply_zscore(df, p)
    a = sorted(r["a_norm"] for r in out.collect())
    assert a[0] == pytest.approx(-1.264911, abs=1e-6)
    st = out.agg(F.avg("a_norm").alias("m"), F.stddev_samp("a_norm").alias("s")).first()
    assert abs(st["m"]) < 1e-10 and abs(st["s"] - 1) < 1e-10


def test_zscore_zero_and_single(spark):
    df = spark.createDataFrame([(1.0, 5.0), (1.0, None)], "k double, one double")
    out = scale.apply_zscore(df, scale.fit_zscore(df, ["k", "one"])).collect()
    assert [r["k_norm"] for r in out] == [0.0, 0.0]
    assert all(r["one_norm"] is None for r in out)


def test_extract_features_selects_and_normalizes(f4):
    out = scale.extract_features(f4, ["length_m", "port", "missing_col", "built"])
    assert out.columns == ["length_m", "port", "built", "length_m_norm", "built_norm"]
    assert not math.isnan(out.agg(F.sum("built_norm")).first()[0])


def test_approx_distinct_close(spark):
    o = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    ex = {r["column_name"]: r["unique_count"] for r in profile.profile_distinct(o).collect()}
    ap = {r["column_name"]: r["unique_count"] for r in profile.approx_distinct(o).collect()}
    for c, v in ex.items():
        assert abs(ap[c] - v) <= max(2, 0.05 * v)



def test_nan_counted_apart_from_statistics(spark):
    rows = [(1.0,), (float("nan"),), (3.0,), (None,), (5.0,)]
    df = spark.createDataFrame(rows, "x double")
    t = profile.profile_table(df).first()
    assert (t["non_null"], t["null_count"], t["nan_count"]) == (4, 1, 1)
    assert (t["min_value"], t["max_value"], t["mean"], t["median"]) == (1.0, 5.0, 3.0, 3.0)
    n = profile.profile_numeric(df).first()
    assert (n["max_value"], n["median"]) == (5.0, 3.0)


def test_write_profile_roundtrip(spark, f3):
    from tabloom.session import scratch_path

    prof = profile.profile_table(f3)
    for fmt in ("parquet", "json"):
        path = scratch_path(spark, f"profile-{fmt}")
        profile.write_profile(prof, path, fmt)
        back = spark.read.format(fmt).load(path)
        assert back.count() == 4 and "unique_count" in back.columns
    with pytest.raises(ValueError):
        profile.write_profile(prof, scratch_path(spark, "p"), "csv")


def test_fill_nan_as_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "x double")
    p = impute.fit_fill(df, ["x"], [], "mean", nan_as_null=True)
    assert p.values["x"] == pytest.approx(2.0)
    out = [r["x"] for r in impute.apply_fill(df, p).collect()]
    assert out == [1.0, 2.0, 2.0, 3.0]
    kept = [r["x"] for r in impute.apply_fill(df, impute.fit_fill(df, ["x"], [], "median")).collect()]
    assert math.isnan(kept[1]) and kept[2] is not None
