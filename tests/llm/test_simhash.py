"""SimHash classes against brute force; covering masks; components."""
import random

import pytest
import xxhash

from tabloom.llm.components import components
from tabloom.llm.simhash import (SMALL_BUCKET, covering_masks, drop_near_duplicates, near_duplicates,
                                 near_edges, simhash_text)
from tabloom.session import Stages


def brute_print(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if linked(a, b):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("text", ["", "  \t", "One", "one TWO", "a b c", "É é x\ty z  a b c d " * 50])
def test_fingerprint_equals_the_definition(text):
    assert simhash_text(text) == brute_print(text)


def test_every_close_pair_meets_under_some_mask():
    rng = random.Random(5)
    for radius in (1, 2):
        masks = covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(500):
            diff = sum(1 << b for b in rng.sample(range(64), radius))
            assert any(diff & m % (1 << 64) == 0 for m in masks)


@pytest.mark.parametrize("n", [1, 2, 40])
def test_components_of_a_chain_a_star_and_loops(spark, n):
    edges = [(i, i + 1) for i in range(n)] + [(1001 + i, 1000) for i in range(n)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(df, Stages(spark)).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, **{1000 + i: 1000 for i in range(n + 1)}}


def test_components_of_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long"), Stages(spark)).count() == 0


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("radius", [1, 2])
def test_links_connect_what_brute_force_connects(spark, radius):
    """Small buckets, and one crowd of near fingerprints in large ones."""
    rng = random.Random(radius)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for p in list(prints)[:20]:
        prints.add(p ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64))
    crowd = rng.getrandbits(64)
    while len(prints) < 80 + 3 * SMALL_BUCKET:
        crowd ^= 1 << rng.randrange(20)
        prints.add(crowd)
    want = brute_components(sorted(map(signed, prints)),
                            lambda a, b: ((a ^ b) % (1 << 64)).bit_count() <= radius)
    stages = Stages(spark)
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    edges = near_edges(df, radius, stages)
    got = {r.node: r.component for r in components(edges, stages).collect()}
    assert {k: got.get(k, k) for k in want} == want
    assert all(((r.a ^ r.b) % (1 << 64)).bit_count() <= radius for r in edges.collect())


ROWS = [(5, "the quick brown fox", "x"), (3, "the quick brown fox", "y"), (None, "the quick brown fox", "z"),
        (8, None, "n"), (9, "", "e"), (10, " \n", "w"), (11, "another text of some words here", "v"),
        (11, "another text of some words here", "v"), (12, "word " * 40_000, "long")]


def test_rows_nulls_blanks_repeats_and_clashing_columns(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, component_id string")
    got = {(r.doc_id, r.fingerprint): r.component_id for r in near_duplicates(docs).collect()}
    fox = f"{brute_print('the quick brown fox'):016x}"
    assert got[(5, fox)] == got[(3, fox)] == got[(None, fox)] == 3
    assert got[(8, "0" * 16)] == got[(9, "0" * 16)] == got[(10, "0" * 16)] == 8
    assert near_duplicates(docs).count() == len(ROWS)
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [3, 8, 11, 12]
    assert kept.where("doc_id is null").count() == 0


def test_one_row_of_each_class_stays_whatever_the_ids(spark):
    """Copies without ids, copies under one id, an id with two texts."""
    rows = [(None, "one two three four", "a"), (None, "one two three four", "b"), (None, "one two three four", "b"),
            (7, "five six seven eight", "a"), (7, "five six seven eight", "b"), (7, "nine ten eleven twelve", "c"),
            (2, "nine ten eleven twelve", "d"), (None, "five six seven eight", "e"), (3, None, "f"), (None, "", "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string")
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert got == sorted([(None, "one two three four"), (7, "five six seven eight"),
                          (2, "nine ten eleven twelve"), (3, None)], key=repr)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(docs).count() == 0
    assert drop_near_duplicates(docs).count() == 0


def test_query_equals_brute_force_on_the_shared_documents(spark):
    from tabloom.llm.queries import QUERIES
    from tests.conftest import SF001

    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: brute_print(r.text) for r in rows}
    want = brute_components(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    got = {r.doc_id: (r.fingerprint, r.component_id)
           for r in QUERIES["op5_simhash_near_dedup"](spark, SF001).collect()}
    assert got == {i: (f"{p:016x}", want[i]) for i, p in prints.items()}
