"""Conversations from reply trees, with DataFrame operations only.

A table of messages (tree, node, parent, role, text, score) holds reply trees.
Iterative self-joins double every message's jump towards its root: after k
rounds a message knows its ancestor 2^k replies up and the score on the way, so
a tree of depth d needs about log2(d) joins.  Leaves are messages nobody replied
to; a leaf's branch is ranked within its tree by the sum of its messages' scores
(ties: the longer branch, then the smaller leaf).  The chosen branches' paths
are unrolled by the same jumps from the longest to the shortest, so only rows
of chosen paths are made.  Each path becomes one conversation.

Template of a turn: ``<s>[ROLE]role[/ROLE]text</s>``.  Control strings inside
roles and texts get a backslash after their first character (one more if there
are some already), so a bare control string is always the template's, and
``unescape`` gives the text back exactly.  ``loss`` lists the spans (start and
length in code points of the formatted text) of the assistant's texts.

Nulls: a null role or text is empty, a null score counts as 0, a null parent, or
one that is not in the tree, makes a root.  Messages with the same tree and node
count once (the smallest row of them).  Messages in or below a circle of replies
have no root and give no conversation.  A null tree is a tree like any other; a
null node is left out.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from tabloom.session import Stages

#: The template's control strings, and others that models know.
CONTROL = ("<s>", "</s>", "[ROLE]", "[/ROLE]", "[INST]", "[/INST]")
OPEN, MIDDLE, CLOSE = "<s>[ROLE]", "[/ROLE]", "</s>"
_TAILS = "|".join(c[1:].replace("]", r"\]") for c in CONTROL)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({_TAILS})", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({_TAILS})", "$1$2$3")


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def chosen_paths(messages: DataFrame, per_tree: int | None, stages: Stages) -> DataFrame:
    """(tree, leaf, node, up): the nodes of the chosen root-to-leaf paths, ``up``
    replies above their leaf.  ``messages``: tree, node, parent, score."""
    own = messages.where("node is not null").groupBy("tree", "node").agg(
        F.min(F.struct("parent", "score")).alias("m")).select(
        "tree", "node", F.col("m.parent").alias("parent"),
        F.coalesce("m.score", F.lit(0.0)).alias("score"))
    nodes = stages.write(own, "nodes")
    parents = nodes.select(F.col("tree").alias("p_tree"), F.col("node").alias("p_node"))
    # jump: the ancestor 2^k replies up, if there is one; total and depth: the
    # score and number of messages from the node up to, not including, it
    cur = stages.write(nodes.join(parents, _same("tree", "p_tree") & (F.col("parent") == F.col("p_node")),
                                  "left").select(
        "tree", "node", F.col("p_node").alias("jump"), F.col("score").alias("total"),
        F.lit(1).cast("long").alias("depth")), "jumps-0")
    leaves = nodes.select("tree", "node").join(
        nodes.where("parent is not null and parent <> node").select(
            F.col("tree").alias("p_tree"), F.col("parent").alias("p_node")),
        _same("tree", "p_tree") & (F.col("node") == F.col("p_node")), "left_anti")
    # messages whose jump has passed the root are finished and join no more
    rounds, finished, most = [], cur.where("jump is null"), nodes.count().bit_length()
    while len(rounds) <= most and not cur.where("jump is not null").limit(1).count() == 0:
        rounds.append(cur)
        rising = cur.where("jump is not null")
        above = finished.union(rising).select(
            F.col("tree").alias("a_tree"), F.col("node").alias("a_node"), F.col("jump").alias("a_jump"),
            F.col("total").alias("a_total"), F.col("depth").alias("a_depth"))
        cur = stages.write(rising.join(above, _same("tree", "a_tree") & (F.col("jump") == F.col("a_node")),
                                       "left").select(
            "tree", "node", F.col("a_jump").alias("jump"),
            (F.col("total") + F.coalesce("a_total", F.lit(0.0))).alias("total"),
            (F.col("depth") + F.coalesce("a_depth", F.lit(0))).alias("depth")), f"jumps-{len(rounds)}")
        finished = finished.union(cur.where("jump is null"))
    best = W.Window.partitionBy("tree").orderBy(F.col("total").desc(), F.col("depth").desc(), "node")
    rooted = leaves.withColumnsRenamed({"tree": "l_tree", "node": "l_node"}).join(
        finished, _same("l_tree", "tree") & (F.col("l_node") == F.col("node")))
    if per_tree is not None:
        rooted = rooted.withColumn("place", F.row_number().over(best)).where(F.col("place") <= per_tree)
    paths = stages.write(rooted.select("tree", F.col("node").alias("leaf"), "node",
                                       F.lit(0).cast("long").alias("up")), "leaves")
    for k in range(len(rounds) - 1, -1, -1):
        step = rounds[k].where("jump is not null").select(
            F.col("tree").alias("s_tree"), F.col("node").alias("s_node"), "jump")
        further = paths.join(step, _same("tree", "s_tree") & (F.col("node") == F.col("s_node"))).select(
            "tree", "leaf", F.col("jump").alias("node"), (F.col("up") + (1 << k)).alias("up"))
        longer = stages.write(paths.union(further), "paths")
        stages.drop(paths, rounds[k])
        paths = longer
    stages.drop(cur)
    return paths


def format_turns(turns: DataFrame) -> DataFrame:
    """One row per (tree, leaf) of turns (tree, leaf, up, role, text): formatted
    text, loss spans and number of turns, the turn with the largest ``up`` first."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(OPEN), escape(role), F.lit(MIDDLE))
    parts = turns.select("tree", "leaf", "up", (role == "assistant").alias("own"),
                         head.alias("head"), escape(text).alias("body"))
    size = F.length("head") + F.length("body") + F.lit(len(CLOSE))
    before = W.Window.partitionBy("tree", "leaf").orderBy(F.col("up").desc()).rowsBetween(
        W.Window.unboundedPreceding, -1)
    placed = parts.withColumn("start", F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("head"))
    one = placed.groupBy("tree", "leaf").agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("up")).alias("at"), "own", "head", "body", "start"))).alias("t"))
    return one.select(
        "tree", "leaf", F.size("t").cast("long").alias("n_turns"),
        F.array_join(F.transform("t", lambda x: F.concat(x["head"], x["body"], F.lit(CLOSE))), "")
        .alias("formatted"),
        F.transform(F.filter("t", lambda x: x["own"]), lambda x: F.struct(
            x["start"].alias("start"), F.length(x["body"]).alias("chars"))).alias("loss"))


def format_conversations(messages: DataFrame, per_tree: int | None = 1) -> DataFrame:
    """The ``per_tree`` best branches of every tree (null: all) as conversations:
    tree, leaf, n_turns, formatted, loss."""
    stages = Stages(messages.sparkSession)
    links = messages.select("tree", "node", "parent", F.col("score").cast("double").alias("score"))
    paths = chosen_paths(links, per_tree, stages)
    texts = messages.where("node is not null").groupBy(
        F.col("tree").alias("t_tree"), F.col("node").alias("t_node")).agg(
        F.min(F.struct("parent", F.col("score").cast("double").alias("score"), "role", "text")).alias("m"))
    turns = paths.join(texts, _same("tree", "t_tree") & (F.col("node") == F.col("t_node"))).select(
        "tree", "leaf", "up", F.col("m.role").alias("role"), F.col("m.text").alias("text"))
    return format_turns(turns)


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    pieces = F.filter(F.split(formatted, CLOSE), lambda p: p != "")
    halves = F.transform(pieces, lambda p: F.split(p, MIDDLE.replace("[", r"\["), 2))
    return F.transform(halves, lambda h: F.struct(
        unescape(h[0].substr(F.lit(len(OPEN) + 1), F.length(h[0]))).alias("role"),
        unescape(h[1]).alias("text")))


def read_loss(formatted: Column, loss: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescape(
        formatted.substr(s["start"] + 1, s["chars"]))), "")


def linear_messages(conversations: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as trees: every turn replies to
    the one before it (order: turn, role, text; repeated rows are turns, too)."""
    order = W.Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    node = F.row_number().over(order).cast("long")
    return conversations.withColumn("node", node).select(
        F.col("conv_id").alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        "role", "text", F.lit(1.0).alias("score"))
