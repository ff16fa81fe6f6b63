"""Exact nearest binary codes by incremental multi-index hashing.

A 64-bit code is cut into segments, and every distinct code is indexed under
each segment's value.  A search probes all values within a radius of the query's
segments, and the radius grows by one a step.  When all m segments have been
probed within radius a, no code at Hamming distance m * (a + 1) - 1 or less can be
missing (each of its segment distances would have to be above a), so a query is
finished once its k-th verified distance is at most that.  Only unfinished queries
go into the next step, and they probe no more segments there than they need: a code
that the radius a finds in none of the first j segments, and a smaller one nowhere,
is at distance m * a + j or more, so the segments from there on are left out once
that is above the k-th verified distance.  The number of segments follows the number
of rows by the expected probes and candidates, a probe weighing ``PROBE`` candidates,
and is at least three: below 10^5 probes a query for random codes of any number.

Equal codes are one entry that carries its k smallest ids, and equal query codes
are searched once, so a code that a third of all rows share costs no more than
any other.  A probe meets the index in an equality join on (segment, value), and
the Hamming distance is verified inside the join: a code farther than the current
k-th, or one that an earlier step has met, gives no row.

Rows without an id or a vector are neither found nor searched; missing vector
entries count as not positive.  Repeated rows are found once each.  With fewer
than k rows all of them are found.  Ties in distance go to the smaller id.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from tabloom.session import Stages

BITS = 64
K = 10
#: Numbers of segments to choose from.  With three, a segment has at most 22 bits, so
#: that even a query far from all codes has no more than 3 * 2^22 values to probe.
FEWEST, MOST = 3, 8
#: Candidates that cost as much as a probe, which is made, shuffled and sorted for the
#: join, while a candidate is a few bit counts inside it.
PROBE = 16


def sign_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, code): bit i of the code is set where the vector's entry i is positive."""
    code = F.expr(f"aggregate(sequence(0, {BITS - 1}), 0L, (code, i) -> code | "
                  f"if(get(`{vector_col}`, i) > 0, shiftleft(1L, i), 0L))")
    return vectors.where(F.col(vector_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), code.alias("code"))


def _cuts(m: int) -> list[tuple[int, int]]:
    edge = [round(BITS * j / m) for j in range(m + 1)]
    return [(a, b - a) for a, b in zip(edge, edge[1:])]


def expected_cost(rows: int, m: int, k: int = K) -> tuple[int, float]:
    """(probes, candidates) of a query for its k nearest of so many random codes in
    m segments: the expected k-th distance gives the radius that covers it, and how
    many segments are probed at that radius."""
    within, kth = 0, 0
    for kth in range(BITS + 1):
        within += math.comb(BITS, kth)
        if rows * within >= k << BITS:
            break
    radius, last = divmod(kth, m)  # the least radius with m * (radius + 1) - 1 >= kth
    probes = [sum(math.comb(bits, i) for i in range(radius + (j <= last))) for j, (_, bits) in enumerate(_cuts(m))]
    return sum(probes), sum(p * rows / (1 << bits) for p, (_, bits) in zip(probes, _cuts(m)))


def segments(rows: int, k: int = K) -> list[tuple[int, int]]:
    """(first bit, bits) of each segment for an index of so many rows: the number of
    segments with the least expected cost."""
    def cost(m: int) -> float:
        probes, candidates = expected_cost(rows, m, k)
        return PROBE * probes + candidates

    return _cuts(min(range(FEWEST, MOST + 1), key=cost))


def _part(code: Column, at: int, bits: int) -> Column:
    """A segment's value (at most 32 bits)."""
    return F.shiftrightunsigned(code, at).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def _first_met(a: Column, b: Column, j: Column, radius: int, cuts: list[tuple[int, int]]) -> Column:
    """Whether the step (radius, segment j) is the first to meet the code: all
    segments before j are farther than the radius, and none after is nearer."""
    diff, ok = a.bitwiseXOR(b), F.lit(True)
    for i, (at, bits) in enumerate(cuts):
        near = F.bit_count(_part(diff, at, bits))
        ok = ok & (near >= F.when(F.lit(i) < j, F.lit(radius + 1)).otherwise(F.lit(radius)))
    return ok


def _probes(open_: DataFrame, cuts: list[tuple[int, int]], radius: int) -> DataFrame:
    """(q, bound, p_j, p_key): all values at exactly ``radius`` from the segments of
    each open query, of as many of them as its bound needs.  One more bit, above the
    last one, is flipped a step, so every value comes up once and nothing is listed
    beforehand."""
    out = open_.select("q", "bound", F.explode(F.array(*[
        F.struct(F.lit(j).alias("p_j"), F.lit(bits).alias("bits"), F.lit(-1).alias("top"),
                 _part(F.col("q"), at, bits).alias("p_key"))
        for j, (at, bits) in enumerate(cuts) if bits >= radius])).alias("s")).select("q", "bound", "s.*").where(
        F.col("p_j") + F.lit(len(cuts) * radius) <= F.col("bound"))
    for left in range(radius - 1, -1, -1):
        flips = F.sequence(F.col("top") + 1, F.col("bits") - 1 - left)
        out = out.select("q", "bound", "p_j", "bits", "p_key", F.explode(flips).alias("top")).withColumn(
            "p_key", F.col("p_key").bitwiseXOR(F.expr("shiftleft(1L, top)")))
    return out.select("q", "bound", "p_j", "p_key")


def search(codes: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, neighbor_id, distance): the k nearest of ``codes`` (id,
    code) for each of ``queries`` (id, code), rank from 1."""
    spark, stages = codes.sparkSession, Stages(codes.sparkSession)
    rows = stages.write(codes.select("id", "code"), "codes")
    wanted = stages.write(queries.select(F.col("id").alias("query_id"), F.col("code").alias("q")), "queries")
    n = rows.count()
    need, cuts = min(k, n), segments(n, k)
    own = W.Window.partitionBy("code").orderBy("id")
    listed = stages.write(rows.withColumn("place", F.row_number().over(own)).where(F.col("place") <= k),
                          "listed")
    keys = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), _part(F.col("code"), at, bits).alias("key"))
                               for j, (at, bits) in enumerate(cuts)]))
    index = stages.write(listed.groupBy("code").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "s", keys).select("s.j", "s.key", "code", "n"), "index")
    # per query code the found codes (best) and the distance of its k-th row
    best, open_ = None, stages.write(wanted.select("q").distinct().withColumn("bound", F.lit(BITS)), "open")
    for radius in range(max(b for _, b in cuts) + 1) if need else ():
        probes = _probes(open_, cuts, radius)
        distance = F.bit_count(F.col("q").bitwiseXOR(F.col("code")))
        met = probes.join(index, (F.col("p_j") == F.col("j")) & (F.col("p_key") == F.col("key"))
                          & (distance <= F.col("bound"))
                          & _first_met(F.col("q"), F.col("code"), F.col("j"), radius, cuts)).select(
            "q", "code", "n", distance.alias("distance"))
        found = stages.write(met if best is None else best.union(met), "found")
        stages.drop(*([best] if best is not None else []))
        # the k-th distance: at most BITS + 1 counts a query
        upto = W.Window.partitionBy("q").orderBy("distance")
        kth = found.groupBy("q", "distance").agg(F.sum("n").alias("n")).withColumn(
            "rows", F.sum("n").over(upto)).where(F.col("rows") >= need).groupBy("q").agg(
            F.min("distance").alias("kth"))
        best = found
        still = open_.select("q").join(kth, "q", "left").select(
            "q", F.coalesce("kth", F.lit(BITS)).alias("bound"))
        covered = len(cuts) * (radius + 1) - 1
        later = stages.write(still.where(F.col("bound") > covered), "open")
        stages.drop(open_)
        open_ = later
        if not open_.limit(1).count():
            break
    if best is None:
        best = spark.createDataFrame([], "q long, code long, n long, distance int")
    each = W.Window.partitionBy("q").orderBy("distance", "id")
    ranked = best.join(listed, "code").withColumn("rank", F.row_number().over(each)).where(
        F.col("rank") <= k).select("q", "rank", F.col("id").alias("neighbor_id"), "distance")
    return wanted.join(stages.write(ranked, "nearest"), "q").select(
        "query_id", F.col("rank").cast("long").alias("rank"), "neighbor_id",
        F.col("distance").cast("long").alias("distance"))
