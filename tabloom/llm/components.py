"""Connected components of an edge table by large-star / small-star rounds.

Every round is a grouped minimum and a join on the edges, written to the
shared folder before the next one; nothing but two sums per round reaches the
driver.  The edge count never grows beyond the input's, and a chain of n nodes
needs O(log n) rounds in practice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.session import Stages


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())


def components(edges: DataFrame, stages: Stages) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long).

    The component's name is its smallest node.  Loops and repeated edges are
    allowed; an empty edge table gives an empty result.  The result reads a
    stage table."""
    cur = stages.write(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(cur)
    while state[0]:
        # large star: every larger neighbour of a node moves to the node's
        # smallest neighbour (or the node itself)
        both = cur.select("a", "b").union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("n"), F.least("a", "m").alias("m"))
        big = both.where("b > a").join(low, F.col("a") == F.col("n")).select(
            F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stages.write(big, "large-star")
        # small star: a node and its smaller neighbours move to the smallest
        low = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
        small = large.join(low, F.col("a") == F.col("n")).select(
            F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        nxt = stages.write(small.where("a <> b").distinct(), "small-star")
        stages.drop(cur, large)
        cur, last, state = nxt, state, _state(nxt)
        if state == last:
            break
    roots = cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
