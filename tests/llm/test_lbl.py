"""The log-bilinear scorer: counts against brute force, normalisation, learning."""
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tabloom.llm import lbl
from tests.conftest import SF001, SF01


def brute_base(rows):
    counts = Counter()
    for i, t in rows:
        if zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2:
            counts.update((t or "").encode().lower().split())
            counts[b""] += 1
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        words = (t or "").encode().lower().split() + [b""]
        out.append((i, zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2, len(words),
                    sum(counts[w] > 0 for w in words), n,
                    sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)))
    return out


def check(got, rows):
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], round(r[5], 3))
    a = sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got], key=key)
    b = sorted(brute_base(rows), key=key)
    assert [x[:5] for x in a] == [x[:5] for x in b]
    assert all(math.isclose(x[5], y[5], rel_tol=1e-9, abs_tol=1e-7) for x, y in zip(a, b))


def test_query_over_all_documents(spark):
    from tabloom.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    check(QUERIES["op10_lbl_scores"](spark, SF001).collect(), rows)


def test_small_head_nulls_repeats_and_clashing_columns(spark):
    rows = [(i, f"The cat {'sat ' * (i % 5)}on mat{i % 7} É") for i in range(60)]
    rows += [(None, None), (None, "the"), (7, ""), (8, "unseen_only_here " * 3), (8, "unseen_only_here " * 3),
             (9, "cat " * 50_000)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, row int, rare string")
    got = lbl.score_texts(docs, head=4, frequent=2, suffixes=4, steps=50).collect()
    check(got, rows)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


@pytest.mark.parametrize("ids", [[], [2], [19]])
def test_no_training_rows(spark, ids):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:len(ids)]
    docs = spark.createDataFrame([(i, "a b") for i in ids], "doc_id long, text string")
    got = lbl.score_texts(docs, steps=5).collect()
    assert len(got) == len(ids)
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 and math.isfinite(r.score) for r in got)


def test_contexts_start_with_end_tokens():
    ids = np.array([5, 6, 0, 0, 7, 0], np.int32)
    a, b = lbl._contexts(ids, np.array([3, 1, 2]))
    assert a.tolist() == [0, 0, 5, 0, 0, 0] and b.tolist() == [0, 5, 6, 0, 0, 7]


def test_noise_contrast_learns_normalised_conditionals():
    rng = np.random.default_rng(4)
    k = 6
    true = lbl.LogBilinear(rng.normal(0, 1, (k, 4)), rng.normal(0, 1, (2, 4, 4)), rng.normal(0, 1, (k, 4)),
                           rng.normal(0, 1, k))
    truth = 10 ** true.log10_table().reshape(k, k, k).astype(float)
    triples, counts = [], []
    for a in range(k):
        for b in range(k):
            for c, p in enumerate(truth[a, b]):
                triples.append((a * k + b) * k + c)
                counts.append(int(1e6 * p))
    triples, counts = np.array(triples), np.array(counts)
    table = lbl.train_nce(triples, counts, k, dim=16, steps=3000).log10_table().astype(float)
    assert np.allclose((10 ** table.reshape(k * k, k)).sum(1), 1, atol=1e-5)
    seen = np.bincount(triples % k, counts, k)
    unigram = np.log10(seen / seen.sum())
    model, plain = (counts * table[triples]).sum(), (counts * unigram[triples % k]).sum()
    best = (counts * np.log10(np.maximum(truth.reshape(-1), 1e-12))).sum()
    assert model > plain + 0.5 * (best - plain)


def test_probabilities_of_all_words_sum_to_one_and_beat_the_base(spark):
    """Every word after a context, seen or not: the shares of a class add up."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = lbl.score_texts(docs).collect()
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    # one-word texts of the whole vocabulary, and one unseen word per suffix class
    train = [(i, "ab cd ab ef gh ab cd") for i in range(40)]
    words = ["ab", "cd", "ef", "gh"]
    unseen = {}
    for i in range(20_000):
        unseen.setdefault(lbl.suffix_class(f"zz{i}".encode(), 3), f"zz{i}")
    probe = [100 + 7 * j for j in range(400) if zlib.crc32(str(100 + 7 * j).encode()) % 7 == 2]
    texts = [*words, *unseen.values()]
    rows = train + list(zip(probe, texts)) + [(probe[len(texts)], "")]
    small = spark.createDataFrame(rows, "doc_id long, text string")
    scored = {r.doc_id: r.score for r in lbl.score_texts(small, head=3, frequent=1, suffixes=3, steps=200).collect()}
    # P(word) * P(end | word) summed over words is at most P(any word), and with
    # P(end) at once the first-token probabilities cannot exceed one
    total = sum(10 ** scored[i] for i in probe[:len(texts) + 1])
    assert 0 < total <= 1 + 1e-6


def test_words_beyond_the_frequent_ones_follow_their_context(spark):
    """Two words of equal count and suffix: only vectors of their own tell them apart."""
    train = [i for i in range(400) if zlib.crc32(str(i).encode()) % 7 != 2]
    probe = [i for i in range(400, 900) if zlib.crc32(str(i).encode()) % 7 == 2][:4]
    rows = [(i, "left xxsame" if i % 2 else "right yysame") for i in train]
    rows += list(zip(probe, ["left xxsame", "left yysame", "right yysame", "right xxsame"]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for head in (3, 100):  # words looked up by the join, and words sent along
        got = {r.doc_id: r.score for r in lbl.score_texts(docs, head=head, frequent=2, suffixes=1).collect()}
        a, b, c, d = (got[i] for i in probe)
        assert a > b + 0.5 and c > d + 0.5
        if head == 3:
            joined = got
    assert all(math.isclose(joined[i], got[i], abs_tol=1e-5) for i in got)


def _space(k=5, dim=4, seed=8):
    rng = np.random.default_rng(seed)
    model = lbl.LogBilinear(rng.normal(0, 1, (k, dim)), rng.normal(0, 1, (2, dim, dim)), np.zeros((k, dim)), np.zeros(k))
    return lbl.WordSpace.of(model, rng.integers(1, 50, (k, k)))


def test_triples_of_all_tasks_and_a_row_for_each_context_of_a_task(spark):
    texts = ["a b a", "", "b b c", "a b a c d", "É a"] * 9
    classes = lbl.Classes([b"a", b"b"], 2)
    known, want = lbl._ClassOf(classes), Counter()
    for t in texts:
        ids = [known[w] for w in t.encode().lower().split()] + [0]
        for a, b, c in zip([0, 0, *ids], [0, *ids], ids):
            want[(a * classes.n + b) * classes.n + c] += 1
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    triples = lbl.class_triples(docs, classes)
    got = triples.collect()
    assert {r.triple: r.n for r in got} == want and len(got) == len(want)
    # what tasks hand on is a row for each context, not one for each triple
    assert "context" in triples._jdf.queryExecution().optimizedPlan().toString()


def test_words_meet_across_tasks_and_batches(spark):
    """Counts and sums of r against brute force: words listed, summed up, and both;
    batches of a row, whose words end in a later batch, and none without a sum."""
    space, classes = _space(), lbl.Classes([b"a", b"b"], 2)
    texts = ["a b a " * 7, "", "b rare c", "c c d", "a é"] * 6
    known, n, sums = lbl._ClassOf(classes), Counter(), {}
    for t in texts:
        words = t.encode().lower().split() + [b""]
        ids = [known[w] for w in words]
        for w, a, b in zip(words, [0, 0, *ids], [0, *ids]):
            n[w] += 1
            sums[w] = sums.get(w, 0) + space.first[a] + space.second[b]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    rows = lbl.word_contexts(docs, classes, space).toArrow().sort_by("word").combine_chunks()
    assert 0 < sum(len(t) > 0 for t in rows["total"].to_pylist()) < rows.num_rows > len(n)
    for size in (1, 3, 1000):
        got = [x for words, c, m in lbl.sums_of_words(iter(rows.to_batches(max_chunksize=size)), space)
               for x in zip(words, c.tolist(), m)]
        assert {w: c for w, c, _ in got} == n and len(got) == len(n)
        assert all(np.allclose(m, sums[w]) for w, _, m in got)
    # one task's rows of a rare word and an own word, and the suffixes' sums
    fitted = lbl.fit_words(lbl.word_contexts(docs, classes, space), space, 7, 2).collect()
    words = {bytes(r.word): r for r in fitted if r.s is None}
    assert {w: r.c for w, r in words.items()} == n
    assert {w for w, r in words.items() if r.q is not None} == {w for w in n if w and n[w] >= 7}
    shared = np.zeros((3, 6))
    for r in fitted:
        if r.s is not None:
            shared[r.s] += r.m
    want = np.zeros((3, 6))
    for w in n:
        if not w or n[w] < 7:
            want[lbl.suffix_class(w, 2) if w else 2] += [n[w], 1, *sums[w]]
    assert np.allclose(shared, want)


def test_norms_do_not_depend_on_their_blocks(monkeypatch):
    space, q = _space(), np.random.default_rng(3).normal(0, 0.5, (11, 4))
    r = space.table.reshape(-1, 4)
    weight = np.exp(q @ r.T) * space.shares.ravel()
    for size in (1, 4, 100):
        monkeypatch.setattr(lbl, "NORM_WORDS", size)
        z, mean = space.norms(q)
        assert np.allclose(z, weight.sum(1)) and np.allclose(mean, weight @ r)


def test_outcomes_sum_to_one_in_every_context():
    rng = np.random.default_rng(8)
    model = lbl.LogBilinear(rng.normal(0, 1, (5, 4)), rng.normal(0, 1, (2, 4, 4)), np.zeros((5, 4)), np.zeros(5))
    space = lbl.WordSpace.of(model, rng.integers(1, 50, (5, 5)))
    q, bias = space.fit(np.array([0, 5, 90, 4000]), rng.normal(0, 1, (4, 4)) * [[0], [5], [90], [4000]])
    mass = space.masses(q, bias)
    for a in range(5):
        for b in range(5):
            one = space.scores(np.full(4, a), np.full(4, b), q, bias)
            assert math.isclose(np.exp(one).sum(), mass[a, b], rel_tol=1e-6)
