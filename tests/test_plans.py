"""Physical-plan properties the design relies on."""
from pyspark.sql import functions as F

from tabloom.functions.ranking import running_total
from tabloom.operators import encode, impute, profile, scale, split
from tabloom.plans import queries as q
from tests.conftest import SF01


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_reads_only_key(spark):
    p = _plan(q.q_split_hash(spark, SF01))
    assert "ReadSchema: struct<o_orderkey:bigint>" in p
    assert "Exchange" not in p


def test_apply_steps_stay_in_jvm(spark):
    o = q.orders_nulls(spark, SF01)
    pp = encode.fit_preprocess(o, ["o_orderpriority"], ["o_totalprice"])
    z = scale.fit_zscore(o, ["o_totalprice"])
    out = scale.apply_zscore(encode.apply_preprocess(o, pp), z)
    p = _plan(out)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_top_values_limits_before_shuffle(spark):
    p = _plan(profile.top_values(spark.read.parquet(f"{SF01}/orders.parquet"),
                                 ["o_orderpriority"], k=5))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_running_total_splits_hot_group(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet").select(F.lit(1).alias("g"), "o_orderkey")
    p = _plan(running_total(o, ["g"], ["o_orderkey"], rows_per_bucket=1000))
    assert "hashpartitioning(g#" in p and "_bucket" in p.split("Window")[1].split("\n")[0]


def test_profile_is_one_aggregate_for_moments(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    p = _plan(profile.profile_nulls(li))
    assert p.count("FileScan") == 1


def test_mean_fill_is_one_projection(spark):
    o = q.orders_nulls(spark, SF01)
    out = impute.apply_fill(o, impute.fit_fill(o, ["o_totalprice"], [], "mean"))
    p = _plan(out)
    assert "Exchange" not in p and p.count("FileScan") == 1


def test_exact_split_has_no_global_sort(spark):
    s = split.holdout_split(spark.read.parquet(f"{SF01}/orders.parquet"), "o_orderkey",
                            mode="exact")
    p = _plan(s)
    assert "Sort " not in p and "Exchange" not in p


def test_profile_table_scans_source_once(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet")
    p = _plan(profile.profile_table(o))
    src = [line for line in p.split("\n") if "FileScan" in line and "orders.parquet" in line]
    assert len(src) == 1


def test_value_counts_shuffle_typed_keys(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    p = _plan(profile.value_counts(li, ["l_linenumber", "l_quantity", "l_returnflag"]))
    # numbers are grouped before any cast to text
    agg_lines = [line for line in p.split("\n") if "HashAggregate(keys=[column_name" in line]
    assert agg_lines and not any("cast(" in line for line in agg_lines)
