from pyspark.sql import Window
from pyspark.sql import functions as F

from tabloom.functions.ranking import dense_index, running_total
from tests.conftest import SF01


def _plain(df, group, order, measure):
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("cum", F.sum(measure).over(w))


def test_running_total_matches_plain_window_many_buckets(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    vals = li.groupBy("l_returnflag", "l_discount").agg(F.count("*").alias("n"))
    got = running_total(vals, ["l_returnflag"], ["l_discount"], measure="n", rows_per_bucket=3)
    want = _plain(vals, ["l_returnflag"], ["l_discount"], "n")
    assert got.exceptAll(want).count() == 0
    assert want.exceptAll(got).count() == 0


def test_running_total_row_number_hot_group(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet").select(
        F.lit("all").alias("g"), "o_orderkey")
    got = running_total(o, ["g"], ["o_orderkey"], rows_per_bucket=1000)
    want = o.withColumn("cum", F.row_number().over(Window.partitionBy("g").orderBy("o_orderkey")).cast("bigint"))
    assert got.exceptAll(want).count() == 0


def test_dense_index_strings(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet").select(
        F.lit("p").alias("column"), F.col("o_orderpriority").alias("value"))
    m = {r["value"]: r["idx"] for r in dense_index(o, ["column"], "value", rows_per_bucket=2).collect()}
    assert m == {v: i for i, v in enumerate(sorted(m))}


def test_running_total_range_partitioner_path(spark):
    import tabloom.functions.ranking as rk

    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    vals = li.groupBy("l_returnflag", "l_extendedprice").agg(F.count("*").alias("n"))
    got = rk.running_total(vals, ["l_returnflag"], ["l_extendedprice"], measure="n",
                           rows_per_bucket=5000)
    want = _plain(vals, ["l_returnflag"], ["l_extendedprice"], "n")
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_running_total_long_text_keys(spark):
    import tabloom.functions.ranking as rk

    d = spark.read.parquet(f"{SF01}/documents.parquet").select(
        F.lit("t").alias("g"), F.concat("text", "doc_id").alias("v"))
    got = rk.running_total(d, ["g"], ["v"], rows_per_bucket=100)
    want = d.withColumn("cum", F.row_number().over(Window.partitionBy("g").orderBy("v")).cast("bigint"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_running_total_keeps_null_groups(spark):
    rows = [(None if i % 4 == 0 else i % 3, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "g int, v int")
    small = running_total(df, ["g"], ["v"])
    large = running_total(df, ["g"], ["v"], rows_per_bucket=37)
    assert large.count() == 1000
    assert sorted(map(repr, small.collect())) == sorted(map(repr, large.collect()))
