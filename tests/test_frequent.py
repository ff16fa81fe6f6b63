"""Frequent values by candidates against exact counting."""
import random
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabloom.operators import frequent
from tabloom.operators.frequent import Summary, frequent_values


def brute(values, k):
    n = Counter(str(v) for v in values if v is not None)
    total = sum(n.values())
    return [(r, v, c, 100.0 * c / total) for r, (v, c) in
            enumerate(sorted(n.items(), key=lambda x: (-x[1], x[0].encode()))[:k], 1)]


def table(seed, n):
    rng = random.Random(seed)
    zipf = [f"v{i}" for i in range(60) for _ in range(600 // (i + 1))]
    return [(rng.choice(zipf), f"unique {i:05d}", rng.choice([None, "a", "é" * 5000]), rng.randint(0, 2), None,
             "twin" if i % 500 == 3 else f"one {i}") for i in range(n)]


SCHEMA = "zipf string, lone string, text string, num int, none string, mixed string"


@pytest.mark.parametrize("capacity, needs_full", [(4096, []), (200, ["lone", "mixed"]), (2, ["zipf", "lone", "num", "mixed"])])  # three numbers do not fit two places
def test_equal_to_exact_counts(spark, capacity, needs_full):
    rows = table(capacity, 2000)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    full = []
    got = frequent_values(df, k=4, capacity=capacity, full=full).collect()
    for i, c in enumerate(df.columns):
        mine = sorted((r.value_rank, r.value, r.n, r.percent) for r in got if r.column_name == c)
        want = brute([r[i] for r in rows], 4)
        assert [m[:3] for m in mine] == [w[:3] for w in want], c
        assert all(abs(m[3] - w[3]) < 1e-9 for m, w in zip(mine, want))
    assert sorted(full) == sorted(needs_full)


def test_many_ties_of_a_full_count(spark, monkeypatch):
    monkeypatch.setattr(frequent, "MAX_BROADCAST_ROWS", 3)
    df = spark.createDataFrame([(f"p{i // 2:03d}",) for i in range(200)], "v string")
    got = frequent_values(df, k=3, capacity=5).orderBy("value_rank").collect()
    assert [(r.value, r.n) for r in got] == [("p000", 2), ("p001", 2), ("p002", 2)]


def test_empty_and_bad(spark):
    assert frequent_values(spark.createDataFrame([], SCHEMA)).collect() == []
    with pytest.raises(ValueError):
        frequent_values(spark.createDataFrame([("a",)], "v string"), k=0)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 12), max_size=40), max_size=6), st.integers(1, 6))
def test_summary_bounds(batches, capacity):
    s, true = Summary(capacity), Counter()
    for b in batches:
        s.add(pa.array(b, pa.int64()))
        true.update(b)
    assert len(s.held) <= capacity and s.total == sum(true.values())
    for v, n in true.items():
        assert s.held.get(v, 0) <= n <= s.held.get(v, 0) + s.error
    assert s.error * (capacity + 1) <= s.total


def test_no_exchange_moves_all_texts(spark):
    """The counting plans shuffle digests; texts move only behind the join with candidates."""
    df = spark.createDataFrame(table(1, 100), SCHEMA)
    wanted = frequent.summaries(df, df.columns).where("digest is not null").select("column_id", "digest").distinct()
    for text in (False, True):
        plan = frequent._wanted(df, df.columns, wanted, [2], text)
        if not text:
            plan = plan.groupBy("column_id", "digest").count()
        lines = plan._jdf.queryExecution().executedPlan().toString().splitlines()
        moved = [line for line in lines if "Exchange" in line]
        assert all("value" not in line and "text" not in line for line in moved)
    assert any("BroadcastExchange" in line for line in lines)
