"""Decontamination against brute force over all places and windows."""
import hashlib
import random
import re

import numpy as np
import pytest

from tabloom.llm import suffix_search
from tabloom.llm.suffix_search import (contamination, decontaminate, find_matches, longest_matches, suffix_array,
                                       text_words)

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, tests, least):
    out = []
    for doc_id, text in docs:
        words, hit, best = words_of(text), set(), {}
        for item, test in tests:
            mine = words_of(test)
            w = min(len(mine), least)
            for p in range(len(mine) - w + 1) if mine else ():
                for at in range(len(words) - w + 1):
                    if words[at:at + w] == mine[p:p + w]:
                        hit.update(range(at, at + w))
                        n = w
                        while n < len(mine) - p and at + n < len(words) and words[at + n] == mine[p + n]:
                            n += 1
                        key, this = str(item) if item is not None else "", (-n, at, p)
                        best[key] = min(best.get(key, this), this)
        out.append((doc_id, len(words), len(hit), sorted((i, -n, p, at) for i, (n, at, p) in best.items())))
    return sorted(out, key=repr)


def texts(seed, n, m):
    rng = random.Random(seed)
    some = lambda k: " ".join(rng.choice(["aa", "Bb", "c1", "dé", "ee", "x-y", "zz", "ÀÉ"]) for _ in range(k))
    tests = [(i, some(rng.randint(1, 9))) for i in range(m)] + [(1, some(4)), (None, "aa bb"), (77, None), (78, " . ")]
    docs = [(i, some(rng.randint(0, 40))) for i in range(n)]
    docs += [(n, None), (n, ""), (None, "aa bb, aa"), (None, docs[0][1]), (0, docs[0][1]), ((1 << 53) + 1, "BB! aa")]
    return docs, tests


@pytest.mark.parametrize("shard, block", [(1 << 20, 1 << 22), (30, 1 << 22), (30, 25)])
def test_matches_equal_brute_force(spark, monkeypatch, shard, block):
    monkeypatch.setattr(suffix_search, "SHARD_WORDS", shard)
    monkeypatch.setattr(suffix_search, "BLOCK_BYTES", block)
    docs, tests = texts(shard + block, 40, 12)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = find_matches(df, spark.createDataFrame(tests, "item_id long, text string"), min_words=4).collect()
    got = sorted(((r.doc_id, r.found.n_words, r.found.n_hit,
                   sorted((m["item"], m["words"], m.item_start, m.start) for m in r.found.matches)) for r in found), key=repr)
    assert got == brute(docs, tests, 4)
    for r in found:
        assert sum(s.stop - s.start for s in r.found.spans) == r.found.n_hit


def test_contract_rows_and_removal(spark):
    docs, tests = texts(3, 30, 5)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(tests, "item_id string, text string")
    want = brute(docs, tests, 10)
    got = sorted((tuple(r) for r in contamination(df, bench).collect()), key=repr)
    digest = lambda items: hashlib.sha256(",".join(items).encode()).hexdigest()
    assert got == sorted(((d, n, h, len(m), digest([i for i, *_ in m]), h > 0) for d, n, h, m in want), key=repr)
    kept = sorted((tuple(r) for r in decontaminate(df, bench).collect()), key=repr)
    clean = [d for d in docs if brute([d], tests, 10)[0][2] == 0]
    assert kept == sorted(clean, key=repr)
    longest = {r.item: (r["words"], r.n_docs) for r in longest_matches(df, bench).collect()}
    held = {}
    for *_, matches in want:
        for item, n, *_ in matches:
            held[item] = (max(held.get(item, (0, 0))[0], n), held.get(item, (0, 0))[1] + 1)
    assert longest == held


def test_very_long_text_and_common_window(spark):
    docs = [(1, "the end " * 60_000), (2, "no"), (3, "x" * 100_000)]
    tests = [("t", "the end " * 20), ("u", "the end " * 20), ("v", "end the end the end the end the end the")]
    rows = {r.doc_id: r.found for r in find_matches(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(tests, "item_id string, text string")).collect()}
    assert (rows[1].n_words, rows[1].n_hit, [m["words"] for m in rows[1].matches]) == (120_000, 120_000, [40, 40, 10])
    assert rows[2].n_hit == rows[3].n_hit == 0


def test_empty_tables_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b", "kept")], "doc_id long, text string, item_id string")
    none = spark.createDataFrame([], "item_id string, text string")
    assert [tuple(r) for r in decontaminate(docs, none).collect()] == [(1, "a b", "kept")]
    one = spark.createDataFrame([("kept", "a b")], "item_id string, text string")
    assert contamination(docs.limit(0), one).collect() == []
    assert decontaminate(docs.withColumnRenamed("item_id", "Found"), one).columns == ["doc_id", "text", "Found"]
    with pytest.raises(ValueError):
        find_matches(docs, one, out="TEXT")


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 4, 500).astype(np.int32)
    ids[-1] = 0
    stop = np.array([next(j for j in range(i, 500) if ids[j] == 0) for i in range(500)])
    run = stop - np.arange(500)
    for least in (1, 3):
        sa = suffix_array(ids, run, 8, least)
        assert sorted(sa) == [i for i in range(500) if run[i] >= least]
        tails = [ids[i:stop[i]][:8].tolist() for i in sa]
        assert tails == sorted(tails)


def test_words():
    assert text_words("Ab-c\0d1 É\x7fx".encode()) == [b"ab", b"c", b"d1", "É".encode(), b"x"]
