"""Results do not depend on layout; fitted preparation applies row by row."""
from pyspark.sql import functions as F

from tabloom.operators import encode, evaluate, profile, split
from tabloom.plans import queries as q
from tests.conftest import SF01


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_profile_independent_of_layout(spark):
    o = q.orders_nulls(spark, SF01)
    shuffled = o.repartition(7).orderBy(F.rand(11))
    cols = ["position", "column_name", "non_null", "null_count", "unique_count", "median",
            "mode", "mode_count"]
    a = profile.profile_table(o).select(*cols)
    b = profile.profile_table(shuffled).select(*cols)
    assert _same(a, b)


def test_metrics_independent_of_layout(spark):
    p = q.lineitem_pred(spark, SF01)
    a = evaluate.class_report(p)
    b = evaluate.class_report(p.repartition(5).orderBy(F.rand(3)))
    assert _same(a.select("label", "support", F.round("f1", 12).alias("f1")),
                 b.select("label", "support", F.round("f1", 12).alias("f1")))


def test_apply_is_row_by_row(spark):
    o = q.orders_nulls(spark, SF01)
    s = split.holdout_split(o, "o_orderkey", 0.2, 42)
    train = s.where("split = 'train'").drop("split")
    test = s.where("split = 'test'").drop("split")
    pp = encode.fit_preprocess(train, ["o_orderpriority"], ["o_totalprice", "o_custkey"])
    on_test = encode.apply_preprocess(test, pp)
    on_all = encode.apply_preprocess(o, pp).join(test.select("o_orderkey"), "o_orderkey", "left_semi")
    assert _same(on_test.select(*sorted(on_test.columns)), on_all.select(*sorted(on_all.columns)))
    assert on_test.where("o_totalprice is null or o_orderpriority is null").count() == 0
