"""The trie of rebuilt conversations against brute force."""
import hashlib
import random
import zlib

import pytest

from tabloom.llm import prefix_trie
from tabloom.llm.prefix_trie import common_turns, conversation_trie


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    new = {}
    for c, ts in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        new[c] = tuple(turns.get(base, [])[:h] + ts[h:])
    members = {}
    for c, ts in new.items():
        for d in range(len(ts) + 1):
            members.setdefault(ts[:d], []).append(c)
    out = []
    for path, held in members.items():
        below = [p for p in members if p[:len(path)] == path]
        kids = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(q[:-1] == p for q in members if q)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p)
        ends = ",".join(map(str, sorted(c for c in held if len(new[c]) == len(path))))
        out.append((min(held), len(path), min(members[path[:-1]]) if path else None, len(held), len(kids),
                    len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def chats(seed, n):
    rng, rows = random.Random(seed), []
    for c in [*range(-3, n), 100, 101, 199, 200, 250, (1 << 53) + 1, (1 << 53) + 2]:
        for t in range(rng.choice([1, 2, 3, 7, 9])):
            rows.append((c, t, rng.choice(["user", None]), rng.choice(["a", "bb", "", None, "é\n"])))
    rows += [(5, None, "user", "x"), (5, 0, "user", "x"), (5, 0, "user", "x"), (None, 0, "user", "lost")]
    return rows


@pytest.mark.parametrize("task_rows", [100_000, 9, 4])
def test_nodes_equal_brute_force(spark, monkeypatch, task_rows):
    monkeypatch.setattr(prefix_trie, "TASK_ROWS", task_rows)
    rows = chats(task_rows, 60)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = sorted((tuple(r) for r in conversation_trie(df).collect()), key=repr)
    assert got == brute(rows)


def test_many_copies_and_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "TASK_ROWS", 50)
    rows = [(c * 100, t, "user", f"same {t}") for c in range(5_000, 5_400) for t in range(3)]
    rows += [(7, t, "user", "long") for t in range(3_000)] + [(9, t, "user", "long") for t in range(2_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.depth): r for r in conversation_trie(df).collect()}
    same = got[500_000, 3]
    ends = ",".join(str(c * 100) for c in range(5_000, 5_400))
    assert (same.n_convs, same.n_children, same.ends_sha256) == (400, 0, hashlib.sha256(ends.encode()).hexdigest())
    h7, h9 = (zlib.crc32(b) % 6 for b in (b"7", b"9"))
    deep = got[7, 2_000 - h9]
    assert (deep.n_convs, got[7, 3_000 - h7].n_convs, got[7, 3_000 - h7].n_leaves) == (2, 1, 1)
    assert got[7, 0].saved_tokens == 4 * (2_000 - h9) + 399 * 3 * 6


def test_empty_table_and_extra_columns(spark):
    schema = "conv_id long, turn long, role string, text string, depth int, pos string"
    assert conversation_trie(spark.createDataFrame([], schema)).collect() == []
    one = spark.createDataFrame([(0, 0, "user", "hi", 3, "p")], schema)
    h = zlib.crc32(b"0") % 6
    assert [(r.conv_id, r.depth, r.n_convs) for r in conversation_trie(one).orderBy("depth").collect()] == [
        (0, 0, 1), (0, 1, 1)] and h >= 0


def test_common_turns():
    a, b = bytes(20) + b"x" * 20, bytes(20) + b"x" * 19 + b"y"
    assert [common_turns(*p) for p in ((a, a), (a, b), (a, bytes(20)), (a, b""))] == [2, 1, 1, 0]
