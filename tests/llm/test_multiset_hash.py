"""The homomorphic multiset hash and the fingerprint query."""
import hashlib
import random

import numpy as np
import pytest

from tabloom.llm import multiset_hash as mh
from tests.conftest import SF001


def line(rng):
    return "".join(rng.choices("abcdefgh ", k=30))


def test_order_does_not_matter_and_counts_do():
    rng = random.Random(1)
    lines = [line(rng) for _ in range(40)]
    mixed = lines[:]
    rng.shuffle(mixed)
    assert mh.short(mh.hash_text("\n".join(lines))) == mh.short(mh.hash_text("\n\n ".join(mixed)))
    assert mh.short(mh.hash_text("\n".join(lines))) != mh.short(mh.hash_text("\n".join(lines + lines[:1])))


def test_insertion_and_deletion():
    rng = random.Random(2)
    a, b = ("\n".join(line(rng) for _ in range(n)) for n in (30, 9))
    both = mh.hash_text(a + "\n" + b)
    assert (mh.insert(mh.hash_text(a), b) == both).all()
    assert (mh.delete(both, b) == mh.hash_text(a)).all()
    assert (mh.delete(mh.hash_text(a), a) == 0).all()


def test_a_hash_is_the_sum_of_its_definition():
    want = np.zeros(mh.LANES, np.int64)
    for p in (b"x", b"x", b"yy"):
        raw = np.frombuffer(hashlib.shake_128(p).digest(mh.LANES // 8), np.uint8)
        want += 2 * np.unpackbits(raw).astype(np.int64) - 1
    got = mh.hash_text("x\n  yy\n\nx")
    assert (got[:mh.LANES] == want % (1 << 32)).all() and got[mh.LANES] == 3


@pytest.mark.parametrize("shared", [0, 25, 50, 90, 100])
def test_likeness_estimates_the_shared_part(shared):
    rng = random.Random(shared)
    common = [line(rng) for _ in range(shared)]
    a, b = (mh.hash_text("\n".join(common + [line(rng) for _ in range(100 - shared)])) for _ in range(2))
    assert abs(mh.likeness(a, b) - shared / 100) < 0.15
    assert mh.likeness(a, a) == 1.0


def brute(rows):
    out = []
    for i, (doc, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        new = text[:len(text) - half] + after[:half]
        a, b, c = (mh.hash_text(t) for t in (text, new, after))
        out.append((doc, len(text), hashlib.sha256(new.encode()).hexdigest(), mh.short(a), mh.short(b),
                    mh.likeness(a, b), mh.likeness(a, c)))
    return sorted(out, key=repr)


def test_query_equals_brute_force_over_all_documents(spark):
    from tabloom.llm.queries import QUERIES

    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect())
    got = QUERIES["op4_multiset_fingerprints"](spark, SF001)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("per_part", [1, 3, 1000])
def test_ranges_nulls_repeats_and_clashing_columns(spark, per_part):
    rng = random.Random(9)
    rows = [(i * i - 40, "\n".join(line(rng) for _ in range(rng.randrange(6)))) for i in range(30)]
    rows += [(None, "no id\nat all"), (3, "three"), (3, "three"), (5, None), (77, "😀é" * 60_000)]
    docs = spark.createDataFrame([(i, t, "p", True) for i, t in rows],
                                 "doc_id long, text string, part string, copy boolean")
    got = mh.fingerprints(docs, rows_per_part=per_part)
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(order)


def test_one_document_is_its_own_next_and_no_document_gives_none(spark):
    docs = spark.createDataFrame([(1, "abcd")], "doc_id long, text string")
    r = mh.fingerprints(docs, with_state=True).first()
    assert r.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and r.near_next == 1.0
    assert bytes(r.state) == mh.hash_text("abcd").astype("<u4").tobytes()
    assert mh.fingerprints(docs.limit(0)).count() == 0
