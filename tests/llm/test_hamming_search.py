"""Multi-index hashing against brute force."""
import random

import pytest
from pyspark.sql import functions as F

from tabloom.llm.hamming_search import _probes, expected_cost, search, segments, sign_codes


def brute(codes, queries, k):
    out = set()
    for qi, q in queries:
        best = sorted(((q ^ c) % (1 << 64)).bit_count() * (1 << 80) + (i + (1 << 70)) for i, c in codes)
        near = sorted((((q ^ c) % (1 << 64)).bit_count(), i) for i, c in codes)[:k]
        out |= {(qi, r + 1, i, d) for r, (d, i) in enumerate(near)}
        assert len(best) == len(codes)
    return out


def run(spark, codes, queries, k):
    make = lambda rows: spark.createDataFrame(rows, "id long, code long")
    return {tuple(r) for r in search(make(codes), make(queries), k).collect()}


def long(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("seed", [1, 2])
def test_random_near_and_hot_codes(spark, seed):
    rng = random.Random(seed)
    centre = rng.getrandbits(64)
    codes = [long(rng.getrandbits(64)) for _ in range(200)]
    codes += [long(centre ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64)) for _ in range(100)]
    codes += [long(centre)] * 150  # a third of all rows share a code
    rng.shuffle(codes)
    rows = list(enumerate(codes))
    queries = rows[::60] + [(10_000, long(centre)), (10_001, long(centre))]
    assert run(spark, rows, queries, 7) == brute(rows, queries, 7)


def test_fewer_rows_than_k_and_no_rows(spark):
    rows = [(1, 0), (2, -1), (3, 5), (3, 5)]
    assert run(spark, rows, [(9, 0)], 10) == brute(rows, [(9, 0)], 10)
    assert run(spark, [], [(9, 0)], 10) == set()
    assert run(spark, rows, [], 10) == set()


def test_segments_cover_the_code():
    for rows in (0, 1, 1000, 10**6, 10**9, 10**13):
        cuts = segments(rows)
        assert [a for a, _ in cuts] == [sum(b for _, b in cuts[:j]) for j in range(len(cuts))]
        assert sum(b for _, b in cuts) == 64 and max(b for _, b in cuts) <= 64


def test_codes_of_odd_vectors(spark):
    nan = float("nan")
    rows = [(1, [1.0] * 64), (2, [-1.0] * 63 + [2.0]), (3, None), (None, [1.0] * 64), (4, [0.5]), (5, []),
            (6, [nan, None, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("code", F.lit("x"))
    got = {r.id: r.code for r in sign_codes(df).collect()}
    assert got == {1: -1, 2: long(1 << 63), 4: 1, 5: 0, 6: 5}


def test_the_plan_stays_small_at_every_number_of_rows():
    for rows in [10**5, 10**6, 2**21, 2**21 + 1, 10**7, 10**8, 10**9]:
        m = len(segments(rows))
        probes, candidates = expected_cost(rows, m)
        assert m >= 3 and probes <= 10**5 and candidates < rows / 2
    assert len(segments(2**21)) == len(segments(2**21 + 1))


def test_probes_of_a_query_grow_less_than_the_rows():
    probes = [expected_cost(rows, len(segments(rows)))[0] for rows in (10_260, 51_282, 256_410)]
    assert max(probes) <= 2 * probes[0]


def test_segments_that_the_bound_leaves_out_are_not_probed(spark):
    cuts = [(0, 5), (5, 6), (11, 5)]
    open_ = spark.createDataFrame([(1, 7), (2, 5), (3, 8), (4, 64)], "q long, bound int")
    got = {(r.q, r.p_j) for r in _probes(open_, cuts, 2).collect()}
    assert got == {(1, 0), (1, 1), (3, 0), (3, 1), (3, 2), (4, 0), (4, 1), (4, 2)}


@pytest.mark.parametrize("m", [3, 5, 8])
def test_any_number_of_segments_finds_the_same(spark, monkeypatch, m):
    import tabloom.llm.hamming_search as module

    rng = random.Random(m)
    monkeypatch.setattr(module, "segments", lambda rows, k: module._cuts(m))
    rows = [(i, long(rng.getrandbits(64) & rng.getrandbits(64))) for i in range(400)]
    assert run(spark, rows, rows[::40], 6) == brute(rows, rows[::40], 6)


@pytest.mark.parametrize("radius", [0, 1, 3, 5, 6])
def test_probes_are_all_values_at_the_radius_once(spark, radius):
    cuts = [(0, 5), (5, 6)]
    open_ = spark.createDataFrame([(0b10110101101, 64)], "q long, bound int")
    got = sorted((r.p_j, r.p_key) for r in _probes(open_, cuts, radius).collect())
    want = sorted((j, v) for j, (at, bits) in enumerate(cuts) for v in range(1 << bits)
                  if (v ^ (0b10110101101 >> at) % (1 << bits)).bit_count() == radius)
    assert got == want


def test_a_query_far_from_all_codes(spark):
    rng = random.Random(5)
    codes = [(i, long(sum(1 << b for b in rng.sample(range(64), 3)))) for i in range(300)]
    queries = [(9, -1), (10, long((1 << 64) - 1 - (1 << 40))), (11, 0)]  # the first two: 60 bits away
    assert run(spark, codes, queries, 5) == brute(codes, queries, 5)
