"""Trie of conversation prefixes from sorted neighbours.

A conversation is a sequence of turns; a turn is a token of 20 bytes (128 bits of the
SHA-256 of its role and text, and the text's length), so a conversation is one binary
value, and binary order is the trie's order.  Equal conversations are one row that
carries their number, smallest id and the digest of their ids.

Rows are dealt to tasks by range.  In a task, neighbours are joined by edges as deep as
their longest common prefix, and a union-find takes the edges in descending depth: a
component is a subtree under construction; it climbs to the edge's depth, giving a node
for every step, and where components meet they make a branching node.

A task can finish every node but those on the path to its first and to its last row,
which other tasks may share.  What hangs on those paths is contracted: the first and the
last row go to the next round with the sums of all finished subtrees below each step of
their path.  A round leaves at most two rows a task, so after a few rounds all is one
task's work, and the last paths are finished there.  Only children of contracted nodes
do not know their parent's smallest member yet; they find it by a join on the parent's
path digest.

Defined cases: turns are ordered by turn number (null first), then role, then text; a
null role or text is empty; repeated rows are repeated turns; rows without conv_id belong
to no conversation and are left out.  An empty table has no node.  Bound: one
conversation's tokens (20 bytes a turn) are one value, 20 MB for a million turns; a task
holds at least four of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.columns import join_small
from tabloom.functions.ranking import running_total
from tabloom.llm.common import text_of
from tabloom.session import Stages

TOKEN = 20
#: Rows and bytes of conversations that a task sorts and folds.
TASK_ROWS = 100_000
TASK_BYTES = 32 << 20
#: Conversations of a block share their first turns: at most so many.
BLOCK = 100
SHARED = 6
_NOBODY = hashlib.sha256(b"").hexdigest()

_PART = "depth: long, n: long, low: long, kids: long, leaves: long, saved: long, ends: string"
_OUT = ("seq binary, parts array<struct<" + _PART + ">>, conv_id long, depth long, parent long, n long, "
        "kids long, leaves long, saved long, ends string, path binary, parent_path binary")


def turn_token(role: Column, text: Column) -> Column:
    """A turn's 40 hex digits: digest of role and text, length of the text."""
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.substring(F.sha2(whole, 256), 1, 32), F.lpad(F.hex(F.length(text)), 8, "0"))


def placed_turns(chats: DataFrame) -> DataFrame:
    """(conv_id, pos from 1, token) of every turn."""
    rows = chats.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", text_of("role").alias("role"),
        text_of("text").alias("text"))
    ranked = running_total(rows, ["conv_id"], ["turn", "role", "text"], out="pos", materialize=False,
                           n_rows=rows.count())
    return ranked.select("conv_id", "pos", turn_token(F.col("role"), F.col("text")).alias("token"))


def rebuilt(placed: DataFrame) -> DataFrame:
    """(conv_id, seq): the first h turns of conversation c - c % 100, then the turns of
    c after its first h; h is CRC-32 of c in decimal, modulo 6."""
    share = F.crc32(F.col("conv_id").cast("string")) % SHARED
    ids = placed.select("conv_id").distinct()
    base = F.col("conv_id") - F.col("conv_id") % BLOCK
    heads = placed.where((F.col("conv_id") % BLOCK == 0) & (F.col("pos") < SHARED)).select(
        F.col("conv_id").alias("base"), F.struct("pos", "token").alias("head"))
    first = ids.select("conv_id", base.alias("base"), share.alias("h")).join(heads, "base").where(
        F.col("head.pos") <= F.col("h")).select("conv_id", F.lit(0).alias("part"), "head.pos", "head.token")
    own = placed.where(F.col("pos") > share).select("conv_id", F.lit(1).alias("part"), "pos", "token")
    bare = ids.select("conv_id", F.lit(0).alias("part"), F.lit(0).cast("long").alias("pos"), F.lit("").alias("token"))
    turns = F.sort_array(F.collect_list(F.struct("part", "pos", "token")))  # one conversation's
    return bare.union(first).union(own).groupBy("conv_id").agg(
        F.unhex(F.array_join(F.transform(turns, lambda t: t["token"]), "")).alias("seq"))


def ids_digest(members: DataFrame) -> DataFrame:
    """(key, ends): SHA-256 of each key's ids, ascending, joined by commas.  Ids are
    joined in runs of up to 4096 first; a task then reads a key's runs as a stream."""
    runs = members.groupBy("key", F.shiftright("conv_id", 12).alias("run")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ","
                     ).alias("ids"))

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = None, None
        for pdf in batches:
            done = []
            for k, ids in zip(pdf["key"], pdf["ids"]):
                if k != key:
                    if key is not None:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield pd.DataFrame(done, columns=["key", "ends"])
        if key is not None:
            yield pd.DataFrame([(key, state.hexdigest())], columns=["key", "ends"])

    return runs.repartition("key").sortWithinPartitions("key", "run").select("key", "ids").mapInPandas(
        stream, "key binary, ends string")


def common_turns(a: bytes, b: bytes) -> int:
    n, at = min(len(a), len(b)), 0
    while at < n and a[at:at + TOKEN] == b[at:at + TOKEN]:
        at += TOKEN
    return at // TOKEN


class _Sums:
    """What is known of a node: members, smallest member, children, and leaves and
    saved tokens of its finished subtrees."""

    __slots__ = ("n", "low", "kids", "leaves", "saved", "ends")

    def __init__(self, n=0, low=None, kids=0, leaves=0, saved=0, ends=None):
        self.n, self.low, self.kids, self.leaves, self.saved, self.ends = n, low, kids, leaves, saved, ends

    def add(self, other: "_Sums") -> None:
        self.n += other.n
        self.kids += other.kids
        self.leaves += other.leaves
        self.saved += other.saved
        self.ends = other.ends if self.ends is None else self.ends
        if self.low is None or (other.low is not None and other.low < self.low):
            self.low = other.low


class _Tree:
    """A subtree under construction: its top stands at ``depth`` with sums ``top`` and
    finished children ``below``; ``later`` holds sums of higher steps by depth."""

    __slots__ = ("seq", "depth", "top", "below", "later", "root")

    def __init__(self, seq: bytes, parts: dict[int, _Sums]):
        self.seq, self.depth, self.later, self.below, self.root = seq, len(seq) // TOKEN, parts, [], None
        self.top = parts.pop(self.depth, None) or _Sums()

    def find(self) -> "_Tree":
        tree = self
        while tree.root is not None:
            tree = tree.root
        while self.root is not None:  # later finds are short
            self.root, self = tree, self.root
        return tree

    def meet(self, other: "_Tree") -> None:
        """Two trees at the same depth become one; the one with more pending sums stays."""
        big, small = (self, other) if len(self.later) + len(self.below) >= len(other.later) + len(other.below) \
            else (other, self)
        big.top.add(small.top)
        big.below += small.below
        for depth, sums in small.later.items():
            big.later.setdefault(depth, _Sums()).add(sums)
        small.root, small.below, small.later = big, [], {}


def path_key(seq: bytes, depth: int) -> bytes:
    return hashlib.sha256(seq[:depth * TOKEN]).digest()


def fold(rows: list[tuple[bytes, dict[int, _Sums]]], last: bool, keyed: bool) -> tuple[list[list], list[tuple]]:
    """Finished nodes and contracted rows of sorted ``rows`` (sequence, sums by depth).

    A node is [conv_id, depth, parent, n, kids, leaves, saved, ends, path, parent_path];
    with ``last`` everything is finished, with ``keyed`` nodes know their path digest."""
    if not rows:
        return [], []
    count, nodes = len(rows), []
    trees = [_Tree(seq, parts) for seq, parts in rows]
    lcp = [common_turns(a[0], b[0]) for a, b in zip(rows, rows[1:])]
    left, right = [trees[0].depth] * count, [trees[-1].depth] * count
    for i in range(1, count):
        left[i] = min(left[i - 1], lcp[i - 1])
        right[-1 - i] = min(right[-i], lcp[-i])
    # steps of a row's path that another task may share
    shared = [-1] * count if last else [max(a, b) for a, b in zip(left, right)]

    def climb(tree: _Tree, to: int) -> None:
        while tree.depth > to:
            top, d = tree.top, tree.depth
            chars = int.from_bytes(tree.seq[d * TOKEN - 4:d * TOKEN], "big") if d else 0
            leaves = top.leaves if top.kids else 1
            saved = top.saved + (top.n - 1) * chars
            for child in tree.below:
                nodes[child][2] = top.low
            tree.below = [len(nodes)]
            nodes.append([top.low, d, None, top.n, top.kids, leaves, saved, top.ends or _NOBODY,
                          path_key(tree.seq, d) if keyed else None, None])
            tree.depth, tree.top = d - 1, _Sums(top.n, top.low, 1, leaves, saved)
            if d - 1 in tree.later:
                tree.top.add(tree.later.pop(d - 1))

    for i in sorted(range(count - 1), key=lambda i: -lcp[i]):
        if lcp[i] > shared[i]:
            a, b = trees[i].find(), trees[i + 1].find()
            climb(a, lcp[i])
            climb(b, lcp[i])
            a.meet(b)
    kept: list[dict[int, _Sums]] = [{}, {}]
    for i, first in enumerate(trees):
        if first.root is not None:
            continue
        climb(first, shared[i])
        if last:
            continue
        d = first.depth
        if first.below:
            path = path_key(first.seq, d)
            for child in first.below:
                nodes[child][9] = path
        side = kept[0 if left[i] >= d else 1]
        for depth, sums in [(d, first.top), *first.later.items()]:
            side.setdefault(depth, _Sums()).add(sums)
    ends = [rows[0][0], rows[-1][0]][:min(2, count)]
    return nodes, [] if last else list(zip(ends, kept))


def _round(rows: DataFrame, parts: int, keyed: bool) -> DataFrame:
    """One round over ``rows`` (seq, parts): finished nodes and contracted rows."""
    last = parts == 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [(seq, {p["depth"]: _Sums(p["n"], p["low"], p["kids"], p["leaves"], p["saved"], p["ends"])
                       for p in sums})
                for pdf in batches for seq, sums in zip(pdf["seq"], pdf["parts"])]
        nodes, spines = fold(held, last, keyed)
        names = [f.split()[0] for f in _OUT.replace("array<struct<" + _PART + ">>", "x").split(", ")]
        kept = [(seq, [{"depth": d, "n": s.n, "low": s.low, "kids": s.kids, "leaves": s.leaves,
                        "saved": s.saved, "ends": s.ends} for d, s in sorted(parts.items())],
                 *[None] * 10) for seq, parts in spines]
        for at in range(0, len(nodes), 10_000):
            yield _frame([(None, None, *n) for n in nodes[at:at + 10_000]], names)
        yield _frame(kept, names)

    dealt = rows.repartition(1) if last else rows.repartitionByRange(parts, "seq")
    return dealt.sortWithinPartitions("seq").mapInPandas(run, _OUT)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names, dtype=object)
    for name in ("conv_id", "depth", "parent", "n", "kids", "leaves", "saved"):
        out[name] = out[name].astype("Int64")  # null stays null, no way through doubles
    return out


def trie(seqs: DataFrame) -> DataFrame:
    """Nodes of the prefix trie of ``seqs`` (conv_id, seq): conv_id (smallest member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    stages = Stages(seqs.sparkSession)
    seqs = stages.write(seqs, "sequences")
    key = F.unhex(F.sha2("seq", 256))
    ends = ids_digest(seqs.select("conv_id", key.alias("key")))
    classes = seqs.groupBy("seq").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low"))
    long0 = F.lit(0).cast("long")
    part = F.struct((F.octet_length("seq") / TOKEN).cast("long").alias("depth"), "n", "low", long0.alias("kids"),
                    long0.alias("leaves"), long0.alias("saved"), "ends")
    rows = stages.write(classes.withColumn("key", key).join(ends, "key").select("seq", F.array(part).alias("parts")),
                        "classes")
    done, keyed = None, False
    while True:
        n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("seq").cast("long")), F.lit(0))).first()
        parts = max(1, min(n // 4, max(-(-n // TASK_ROWS), -(-size // TASK_BYTES))))
        out = stages.write(_round(rows, parts, keyed), "trie-round")
        stages.drop(rows)
        nodes = out.where("seq is null").drop("seq", "parts")
        done = nodes if done is None else done.union(nodes)
        if parts == 1:
            break
        rows, keyed = stages.write(out.where("seq is not null").select("seq", "parts"), "spines"), True
    stages.drop(seqs)
    if keyed:
        paths = done.where("path is not null").select(F.col("path").alias("up"), F.col("conv_id").alias("found"))
        known, open_ = done.where("parent_path is null"), done.where("parent_path is not null")
        met = join_small(open_, paths, F.col("parent_path") == F.col("up"), "left")
        done = known.union(met.withColumn("parent", F.col("found")).select(*known.columns))
    return done.select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
                       F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"),
                       F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))


def conversation_trie(chats: DataFrame) -> DataFrame:
    """The contract's nodes of the rebuilt conversations."""
    stages = Stages(chats.sparkSession)
    return trie(rebuilt(stages.write(placed_turns(chats), "turns")))
