"""Phrase stripes against brute-force counting."""
import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from tabloom.llm import stripes
from tabloom.llm.stripes import collocations, merge_sorted

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, longest, share, top):
    count = {}
    for lang, text in rows:
        f = count.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, longest + 1):
                f.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in count.items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        held = {p: v for p, v in f.items() if len(p) > 1 and v >= least}
        ranked = []
        for p, a in held.items():
            if any(100 * b >= share * a for q, b in held.items() if len(q) > len(p) and any(
                    q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def texts(seed, n):
    rng = random.Random(seed)
    vocab = ["a", "B", "the", "of", "ÉÀ", "é", "x\x1cy", "don't", "\x00", "w" * 30]
    vocab += [f"rare{i}" for i in range(40)]
    rows = []
    for i in range(n):
        words = [rng.choice(vocab[:10] if rng.random() < .9 else vocab) for _ in range(rng.randint(0, 60))]
        text = "".join(w + rng.choice([" ", " ", "\t", "  ", ". ", ",", "\r\n", " of the "]) for w in words)
        rows.append((rng.choice(["en", "en", "fr", None, "und"]), text))
    return rows + [("en", None), (None, ""), ("xx", "lone"), ("en", "of the " * 3_000), ("", "a b " * 20)]


@pytest.mark.parametrize("longest, block, entries, slots", [
    (3, 8 << 20, 256, 1 << 24), (3, 600, 2, 1 << 24), (4, 2_000, 3, 1 << 13), (2, 600, 256, 1 << 24)])
def test_collocations_equal_brute_force(spark, monkeypatch, longest, block, entries, slots):
    monkeypatch.setattr(stripes, "BLOCK", block)
    monkeypatch.setattr(stripes, "ROW_ENTRIES", entries)
    monkeypatch.setattr(stripes, "SLOTS", slots)
    rows = texts(longest + block, 150)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    got = sorted(tuple(r) for r in collocations(df, 5, longest, 50, 60).collect())
    assert got == brute(rows, 5, longest, 50, 60)


def test_empty_table_extra_columns_and_bad_parameters(spark):
    schema = "lang string, text string, prefix string, next string, n int"
    assert collocations(spark.createDataFrame([], schema)).collect() == []
    df = spark.createDataFrame([("en", "a b. " * 12, "p", "q", 1)], schema)
    assert [tuple(r) for r in collocations(df).collect()] == [("en", 1, "a b", 12, 12, 12, 24, 1_000_000)]
    for bad in ({"max_words": 1}, {"min_count": 0}):
        with pytest.raises(ValueError):
            collocations(df, **bad)


def test_counts_beyond_64_bit_products(spark):
    """The score's products pass 64 bits; the arithmetic stays exact."""
    a, l, r = 3_037_000_501, 9_000_000_001, 8_000_000_011
    row = spark.createDataFrame([(a, l, r)], "a long, l long, r long").selectExpr(
        "(cast(a as decimal(16,0)) * cast(a as decimal(16,0)) * 1000000BD) div "
        "(cast(l as decimal(19,0)) * cast(r as decimal(19,0))) as s").first()
    assert row.s == 1_000_000 * a * a // (l * r)


def test_a_stripe_over_several_batches_is_merged_and_folded():
    batch = lambda *rows: pa.RecordBatch.from_pylist(
        [dict(zip(("lang", "prefix", "segment", "next", "n"), (*r[:3], " ".join(w or "." for w in r[3]), r[4])))
         for r in rows], schema=stripes._SCHEMA)
    out = merge_sorted(iter([batch(("en", "a", 0, ["x", "y"], [3, 1]), ("en", "a", 0, ["x", ""], [4, 2])),
                             batch(("en", "a", 0, ["z"], [2])), batch(),
                             batch(("en", "a", 1, ["x"], [9]), ("fr", "a", 1, ["x"], [5]))]), 5)
    rows = [r for b in out for r in b.to_pylist()]
    assert [(r["lang"], r["segment"], dict(zip(r["next"].replace(".", "").split(" "), r["n"]))) for r in rows] == [
        ("en", 0, {"x": 7, "": 5}), ("en", 1, {"x": 9}), ("fr", 1, {"x": 5})]
