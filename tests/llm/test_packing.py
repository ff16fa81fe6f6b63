"""Pattern packing: plans, places and whole documents."""
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import tabloom.llm.packing as packing
from tests.conftest import SF001

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_nnls_satisfies_the_optimality_conditions():
    rng = np.random.default_rng(3)
    for _ in range(20):
        a, b = rng.random((12, 30)), rng.random(12) * 10
        x = packing.nnls(a, b)
        pull = a.T @ (b - a @ x)
        assert (x >= 0).all() and (pull <= 1e-6).all() and abs(pull[x > 0]).max(initial=0) < 1e-6


def test_patterns_are_all_ways_to_fill_a_sequence():
    assert sorted(packing.fill_patterns(6, 3)) == [(2, 2, 2), (3, 2, 1), (3, 3), (4, 1, 1), (4, 2), (5, 1), (6,)]


@settings(max_examples=120, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(0, 500), max_size=30), st.integers(1, 16),
       st.integers(1, 4))
def test_plans_use_every_piece_once_and_fit(counts, bins, parts):
    uses = packing.plan_packing(counts, 64, bins, parts)
    held = Counter()
    for u in uses:
        assert u.count > 0 and 0 < sum(u.lengths) <= 64
        for n in u.lengths:
            held[n] += u.count
    assert held == Counter({n: c for n, c in counts.items() if c})


def test_a_plan_is_close_to_the_least_number_of_sequences():
    rng = np.random.default_rng(1)
    lengths = np.clip(rng.lognormal(6.3, 1.1, 200_000).astype(int), 1, 4096)
    counts = Counter(lengths.tolist())
    least = -(-int(lengths.sum()) // 4096)
    uses = packing.plan_packing(counts)
    assert sum(u.count for u in uses) <= 1.001 * least + 1
    seen = []
    original = packing._pack_residuals
    packing._pack_residuals = lambda pool, u, c: seen.append(sum(x.count for x in u)) or original(pool, u, c)
    try:
        packing.plan_packing(counts)
    finally:
        packing._pack_residuals = original
    assert seen[0] > 0.5 * least  # most sequences come from patterns


def brute_pieces(library, doc, text, capacity=4096):
    ids = library.encode(text or "", add_special_tokens=False).ids + [1]
    return [(doc, k, at, len(ids[at:at + capacity]),
             zlib.crc32(np.array(ids[at:at + capacity], "<u4").tobytes()))
            for k, at in enumerate(range(0, len(ids), capacity))]


def check_whole(rows, capacity=4096):
    """Every sequence is gapless from 0 and fits."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("ranked_rows", [2_000, 3])
def test_query_over_all_documents(spark, monkeypatch, ranked_rows):
    from tokenizers import Tokenizer

    from tabloom.llm.queries import QUERIES

    monkeypatch.setattr(packing, "RANKED_ROWS", ranked_rows)
    library = Tokenizer.from_file(WORDS)
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    got = QUERIES["op9_pattern_packing"](spark, SF001).collect()
    want = [p for d in docs for p in brute_pieces(library, d.doc_id, d.text)]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    assert check_whole(got) <= -(-sum(p[3] for p in want) // 4096) + 1


def test_nulls_repeats_long_texts_and_clashing_columns(spark):
    rows = [(1, None, 5), (2, "", 6), (3, "word " * 30_000, 7), (3, "word " * 30_000, 7), (None, "x y", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int")
    got = packing.pack_documents(docs, WORDS).collect()
    check_whole(got)
    assert [(r.length, r.piece) for r in got if r.doc_id in (1, 2)] == [(1, 0)] * 2
    assert sum(r.length for r in got if r.doc_id == 3) == 2 * 30_001
    assert sum(1 for r in got if r.doc_id is None) == 1
    assert packing.pack_documents(docs.limit(0), WORDS).count() == 0


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(i, "alpha beta " * (i + 1)) for i in range(12)], "doc_id long, text string")
    packed = packing.pack_documents(docs, WORDS, capacity=32, with_ids=True)
    pieces = {(r.doc_id, r.piece): r for r in packed.collect()}
    rows = packing.sequences(packed).collect()
    assert sum(len(r.doc_ids) for r in rows) == len(pieces)
    for r in rows:
        ids = np.frombuffer(bytes(r.ids), "<u4")
        assert len(ids) == sum(r.lengths) <= 32
        assert sorted(zlib.crc32(ids[a:a + n].tobytes()) for a, n in zip(r.offsets, r.lengths)) == sorted(
            p.ids_crc32 for p in pieces.values() if p.sequence_id == r.sequence_id)
