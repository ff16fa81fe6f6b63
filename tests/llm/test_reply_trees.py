"""Reply trees and the chat template."""
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabloom.llm.reply_trees import (CONTROL, escape, format_conversations, linear_messages, read_loss,
                                     read_turns, unescape)

SCHEMA = "tree long, node long, parent long, role string, text string, score double"


def read_back(df):
    out = df.select("tree", "leaf", "n_turns", read_turns(F.col("formatted")).alias("turns"),
                    read_loss(F.col("formatted"), F.col("loss")).alias("masked"))
    return {(r.tree, r.leaf): ([(t.role, t.text) for t in r.turns], r.masked) for r in out.collect()}


def brute(rows, per_tree):
    nodes = {}
    for t, n, p, role, text, s in rows:
        if n is not None:
            nodes.setdefault((t, n), (p, role or "", text or "", s or 0.0))
    parents = {(t, p) for (t, n), (p, *_) in nodes.items() if p is not None and p != n}
    paths = {}
    for t, n in nodes:
        if (t, n) in parents:
            continue
        path, at = [], (t, n)
        while at in nodes and at not in path:
            path.append(at)
            at = (t, nodes[at][0])
        if at not in path:
            paths[t, n] = path[::-1]
    out = {}
    for tree in {t for t, _ in paths}:
        leaves = sorted((k for k in paths if k[0] == tree),
                        key=lambda k: (-sum(nodes[x][3] for x in paths[k]), -len(paths[k]), k[1]))
        for leaf in leaves[:per_tree]:
            turns = [nodes[x][1:3] for x in paths[leaf]]
            out[leaf] = (turns, "".join(t for r, t in turns if r == "assistant"))
    return out


@pytest.mark.parametrize("per_tree", [1, 2, None])
def test_random_forests_equal_brute_force(spark, per_tree):
    rng = random.Random(7)
    rows = []
    for tree in range(12):
        for node in range(rng.randint(1, 25)):
            rows.append((tree, node, rng.randrange(node) if node and rng.random() < 0.9 else None,
                         rng.choice(["user", "assistant"]), f"text {tree}.{node} {rng.choice(CONTROL)}",
                         float(rng.randint(-3, 3))))
    rows += [(50, i, i - 1 if i else None, "user", str(i), 1.0) for i in range(90)]  # a long chain
    df = spark.createDataFrame(rows, SCHEMA)
    assert read_back(format_conversations(df, per_tree)) == brute(rows, per_tree)


def test_circles_orphans_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, 1, 2, "user", "a", 1.0), (1, 2, 1, "user", "b", 1.0), (1, 3, 1, "user", "below", 9.0),  # a circle
            (2, 1, 99, None, None, None), (2, 2, 1, "assistant", "", 1.0),                              # an orphan root
            (3, 1, None, "user", "x", 1.0), (3, 1, None, "user", "x", 1.0), (3, None, 1, "user", "no", 5.0),
            (None, 1, None, "assistant", "n", 1.0), (4, 1, 1, "user", "own parent", 1.0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("leaf", F.lit(0)).withColumn("up", F.lit("x"))
    got = read_back(format_conversations(df))
    assert got == {(2, 2): ([("", ""), ("assistant", "")], ""), (3, 1): ([("user", "x")], ""),
                   (None, 1): ([("assistant", "n")], "n")}
    assert format_conversations(df.limit(0)).count() == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*CONTROL, "\\", "<", "[", "é", "\n", "s>", "/s>", "\0", "$1"]),
                         max_size=8).map("".join), min_size=1, max_size=6))
def test_escaping_is_reversible_and_hides_control_strings(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u"))
    for r in df.collect():
        assert r.u == r.t and not any(c in r.e for c in CONTROL)


def test_linear_turns_keep_repeated_rows(spark):
    rows = [(1, 0, "user", "q"), (1, 0, "user", "q"), (1, None, "system", "s"), (1, 5, "assistant", "a" * 100_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = read_back(format_conversations(linear_messages(df)))
    assert list(got.values()) == [([("system", "s"), ("user", "q"), ("user", "q"), ("assistant", "a" * 100_000)],
                                   "a" * 100_000)]


def test_main_path_runs_no_python(spark):
    from tabloom.llm.queries import QUERIES
    from tests.conftest import SF001

    plan = QUERIES["op1_chat_reply_trees"](spark, SF001)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
