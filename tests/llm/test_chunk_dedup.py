"""Content-defined chunks and repeated passages against brute force."""
import random

import numpy as np
import pytest

import tabloom.llm.chunk_dedup as cd
from tests.conftest import SF001


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(1, 9))) for _ in range(n))


def slow_gear(data):
    return [sum(int(cd.GEAR[data[i - j]]) << j for j in range(min(cd.WINDOW, i + 1))) % (1 << 32)
            for i in range(len(data))]


def test_gear_hash_equals_its_definition():
    data = np.random.default_rng(1).integers(0, 256, 200, dtype=np.uint8)
    assert cd.gear_hashes(data).tolist() == slow_gear(data.tolist())


def test_chunks_cover_the_text_and_do_not_depend_on_the_group():
    rng = random.Random(2)
    texts = [words(rng, n) for n in (0, 1, 3, 50, 400)] + ["", " \n ", "é ß " * 100, "x" * 500, "同じ文字" * 90,
                                                             "a " * 300]
    own, start, end, n, digest = cd.cut_texts(texts)
    for i, t in enumerate(texts):
        at = own == i
        if t.strip():
            assert start[at][0] == 0 and end[at][-1] == len(t.encode())
            assert (start[at][1:] == end[at][:-1]).all() and n[at].max() <= cd.MAX_WORDS
            for s in start[at]:
                t.encode()[s:].decode()  # never inside a character
        alone = cd.cut_texts([t])
        assert all((x[at] == y).all() for x, y in zip((start, end, n, digest), alone[1:]))


def test_chunks_resist_insertions():
    rng = random.Random(3)
    text = words(rng, 600)
    at = text.index(" ", len(text) // 2)
    changed = text[:at] + " inserted words of another kind" + text[at:]
    a, b = (set(cd.cut_texts([t])[4].tolist()) for t in (text, changed))
    assert len(a & b) >= 0.93 * len(a)


def brute(rows, reach=cd.REACH, least=cd.MIN_WORDS):
    """Kept texts by (id, text) from explicit dictionaries."""
    first, cut = {}, {}
    for i, t in rows:
        if i is None or t is None:
            continue
        _, s, e, n, d = (x.tolist() for x in cd.cut_texts([t], reach))
        cut[i, t] = list(zip(s, e, n, d))
        for a, x in zip(s, d):
            first[x] = min(first.get(x, (i, a)), (i, a))
    out = {}
    for (i, t), chunks in cut.items():
        raw, keep, run = t.encode(), [], []

        def close():
            if sum(c[2] for c in run) < least:
                keep.extend(run)
            run.clear()

        for c in chunks:
            if first[c[3]] < (i, c[0]):
                run.append(c)
            else:
                close()
                keep.append(c)
        close()
        out[i, t] = b"".join(raw[c[0]:c[1]] for c in keep).decode() if chunks else t
    return out


def test_query_equals_brute_force_over_all_documents(spark):
    from tabloom.llm.queries import QUERIES

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    want = brute(docs)
    texts = dict(docs)
    got = QUERIES["op8_chunk_dedup"](spark, SF001).collect()
    assert {r.doc_id: r.text for r in got} == {i: want[i, t] for i, t in docs}
    for r in got:
        t, kept, at = texts[r.doc_id], [], 0
        for span in r.removed or []:
            kept.append(t[at:span.start])
            at = span.start + span.chars
        assert "".join(kept) + t[at:] == r.text
        assert r.removed_chars == len(t) - len(r.text)


@pytest.mark.parametrize("limit", [cd.BROADCAST_DIGESTS, 0])
def test_planted_passages_go_and_clean_texts_stay(spark, monkeypatch, limit):
    monkeypatch.setattr(cd, "BROADCAST_DIGESTS", limit)
    rng = random.Random(4)
    passage = words(rng, 60)
    rows = [(i, words(rng, 150)) for i in range(60)]
    planted = {i: words(rng, 40) + "\n" + passage + "\n" + words(rng, 40) for i in range(100, 130)}
    docs = spark.createDataFrame(rows + list(planted.items()), "doc_id long, text string")
    got = {r.doc_id: r.text for r in cd.drop_repeats(docs).collect()}
    assert all(got[i] == t for i, t in rows)
    assert got[100] == planted[100]
    for i in range(101, 130):
        lost = len(planted[i]) - len(got[i])
        assert 0.6 * len(passage) <= lost <= len(passage) + 2
        assert got[i].startswith(planted[i][:100]) and got[i].endswith(planted[i][-100:])


def test_nulls_repeats_shared_ids_and_clashing_columns(spark):
    rng = random.Random(5)
    a, b = words(rng, 80), words(rng, 80)
    rows = [(1, a, "x", 1), (2, a, "y", 2), (None, a, "z", 3), (3, None, "n", 4), (4, "", "e", 5),
            (5, b, "p", 6), (5, b, "p", 6), (6, b, "q", 7), (6, words(rng, 30), "r", 8), (7, "w " * 40_000, "l", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, repeat_id string, start int")
    out = cd.drop_repeats(docs, spans_col="gone")
    assert out.columns == [*docs.columns, "gone"]
    got = {r.start: r.text for r in out.collect()}
    assert got[1] == a and got[2] == "" and got[3] == a and got[4] is None and got[5] == ""
    assert got[6] == b and got[7] == "" and got[8] == rows[8][1]
    assert out.count() == len(rows)
    assert cd.drop_repeats(docs.limit(0)).count() == 0


def test_a_text_that_repeats_itself_keeps_one_copy(spark):
    line = words(random.Random(6), 70) + "\n"
    docs = spark.createDataFrame([(1, line * 5)], "doc_id long, text string")
    assert len(cd.drop_repeats(docs).first().text) < 1.6 * len(line)


def test_short_repeats_from_different_texts_do_not_add_up(spark):
    rng = random.Random(7)
    text = words(rng, 1500)
    _, _, _, n, _ = cd.cut_texts([text])
    parts, rows, at = text.split(" "), [], 0
    for i, k in enumerate(n.tolist()):  # under 20 words around every chunk, each in a text of its own
        if k < 9:
            around = parts[max(at - 7, 0):at + k + 4]
            rows.append((i, words(rng, 60) + " " + " ".join(around) + " " + words(rng, 60)))
            assert len(around) < cd.MIN_WORDS
        at += k
    rows.append((9_000, text))
    assert len(brute(rows)[9_000, text]) < len(text)  # chunks alone would cut it
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.text for r in cd.drop_repeats(docs).collect()} == dict(rows)


def test_windows_cover_runs_whose_ends_are_uneven():
    digests = np.arange(4)
    found = cd.windows(np.array([3, 4, 5, 6]), np.array([19, 1, 1, 2]), digests, 20)
    assert {(a, b) for _, a, b in found} == {(0, 1), (0, 2), (0, 3)}
    assert cd.windows(np.array([3, 4, 6, 7]), np.array([9, 9, 9, 9]), digests, 20) == []
