"""The driver contract in __spark_entry__."""
import __spark_entry__ as e


def test_entry_runs_with_stable_schema(spark):
    df = e.entry(spark)
    assert df.columns == ["label", "precision", "recall", "f1", "support"]
    assert df.count() >= 1


def test_registry_shape():
    qs, sql = e.queries(), e.oracle_sql()
    assert set(sql) <= set(qs)
    assert all(callable(f) for f in qs.values())
