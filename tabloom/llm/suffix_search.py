"""Benchmark decontamination with suffix arrays of the training texts.

The training texts are cut into shards of whole texts, about ``SHARD_WORDS`` words
each.  A shard's word suffixes are sorted by prefix doubling, and every suffix of
every test text is binary-searched in that array: first for its window (its first
``min_words`` words), whose range holds all places where the window occurs, then,
inside that range, for its longest verbatim match with each of those places.
Nothing is shuffled: a text's matches are found where the text is read.

Words that occur in no test text end a suffix, because no match goes on there, and
suffixes shorter than the shortest window are left out of the array, because no
window begins there.  Both only leave out what cannot match.  Suffixes are sorted as
deep as the longest test text.

The test texts travel to the tasks in blocks of at most ``BLOCK_BYTES`` bytes of text
(or one text that is longer), one block a pass, so that what is broadcast does not
grow with the test table.  Between passes the state is written to the shared folder.

A window is ``min_words`` consecutive words of a test text; a test text of fewer
words, but not none, is one window.  Words are runs of ASCII letters and digits and of
characters above U+007F, A-Z in lower case.  A training word inside any occurrence of
a window is hit.

Nulls: a null text has no words, and neither hits nor is hit.  Test rows that share an
id are one item with several texts; a null item id reads as the empty text.  Every
training row gets a result of its own, whatever its id (null or repeated).  An empty
test table hits nothing.  Columns of the training table keep their names; the result
is one struct column.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from tabloom.llm.common import free_name
from tabloom.session import Stages

MIN_WORDS = 10
#: Words of training text that are sorted together.
SHARD_WORDS = 1 << 20
#: Bytes of test text that are broadcast together.
BLOCK_BYTES = 4 << 20
#: Word comparisons that are held at once.
CELLS = 1 << 22

_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz"
_TABLE = bytes(c if c >= 128 or c in _KEEP else c + 32 if 65 <= c <= 90 else 32 for c in range(256))

RESULT = ("struct<n_words: long, n_hit: long, spans: array<struct<start: long, stop: long>>, "
          "matches: array<struct<item: string, words: long, item_start: long, start: long>>>")
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
_MATCH = pa.list_(pa.struct([("item", pa.string()), ("words", pa.int64()),
                             ("item_start", pa.int64()), ("start", pa.int64())]))
_ARROW = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("spans", _SPAN), ("matches", _MATCH)])


def text_words(raw: bytes) -> list[bytes]:
    """Words of a UTF-8 text."""
    return raw.translate(_TABLE).split()


@dataclass
class Tests:
    """Test texts as plain arrays.

    ``words`` numbers the known words from 1; ``suffix`` has one row of word numbers
    (0 behind the end) per distinct suffix that begins a window, ``window`` its
    window's number, ``heads`` one row per distinct window (its words, then 0).
    ``owner``, ``begin`` list the (item, first word) of each suffix from ``first[s]``
    to ``first[s + 1]``."""

    words: dict[bytes, int]
    suffix: np.ndarray
    window: np.ndarray
    heads: np.ndarray
    lengths: np.ndarray
    items: list[str]
    owner: np.ndarray
    begin: np.ndarray
    first: np.ndarray


def prepare_tests(rows: list[tuple[str, str | None]], min_words: int) -> Tests | None:
    """``Tests`` of (item, text) rows, or None when no text has a word."""
    vocab: dict[bytes, int] = {}
    places: dict[tuple[int, ...], set[tuple[str, int]]] = {}
    for item, text in rows:
        ids = tuple(vocab.setdefault(w, len(vocab) + 1) for w in text_words((text or "").encode("utf-8", "replace")))
        for at in range(max(1, len(ids) - min_words + 1)) if ids else ():
            places.setdefault(ids[at:], set()).add((item, at))
    if not places:
        return None
    order = sorted(places)
    depth = max(map(len, order))
    suffix = np.zeros((len(order), depth), np.int32)
    for i, s in enumerate(order):
        suffix[i, :len(s)] = s
    lengths = np.minimum((suffix > 0).sum(1), min_words)
    head = np.where(np.arange(min(depth, min_words)) < lengths[:, None], suffix[:, :min_words], 0)
    heads, window = np.unique(head, axis=0, return_inverse=True)
    items = sorted({item for held in places.values() for item, _ in held})
    number = {item: i for i, item in enumerate(items)}
    listed = [sorted((number[item], at) for item, at in places[s]) for s in order]
    flat = np.array([p for held in listed for p in held], np.int64).reshape(-1, 2)
    return Tests(vocab, suffix, window.reshape(-1), heads, (heads > 0).sum(1), items, flat[:, 0], flat[:, 1],
                 np.concatenate([[0], np.cumsum([len(held) for held in listed])]))


def suffix_array(ids: np.ndarray, run: np.ndarray, depth: int, least: int) -> np.ndarray:
    """Places of ``ids`` whose ``run`` of known words has ``least`` words or more, in
    the order of the words from there to the run's end (``depth`` of them count)."""
    known = np.flatnonzero(run >= least)
    # Places next to each other stay so up to the run's last ``least`` - 1 words; the
    # ranks of those are needed as second halves, hence all places of such runs.
    inside = np.zeros(len(ids) + 1, np.int64)
    np.add.at(inside, known, 1)
    np.add.at(inside, known + run[known], -1)
    at = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    left = run[at]
    rank, span = np.unique(ids[at], return_inverse=True)[1] + 1, 1
    while span < depth and len(at):
        more = np.flatnonzero(left > span)
        second = np.zeros(len(at), np.int64)
        second[more] = rank[more + span]
        _, rank = np.unique(rank.astype(np.int64) * (len(at) + 1) + second, return_inverse=True)
        rank, span = rank + 1, span * 2
    order = np.argsort(rank, kind="stable")
    return at[order][left[order] >= least]


def _words_from(ids: np.ndarray, run: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Rows of ``depth`` word numbers from each place, 0 behind the run's end."""
    step = np.arange(depth)
    inside = step < run[at][:, None]
    return np.where(inside, ids[np.minimum(at[:, None] + step, len(ids) - 1)], 0)


def _bound(heads: np.ndarray, lengths: np.ndarray, sa: np.ndarray, ids: np.ndarray, run: np.ndarray,
           above: bool) -> np.ndarray:
    """Binary search of every head: how many suffixes are below it (``above``: or
    begin with it)."""
    lo, hi = np.zeros(len(heads), np.int64), np.full(len(heads), len(sa))
    depth = heads.shape[1]
    step = np.arange(depth)
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return lo
        for some in np.array_split(open_, max(1, len(open_) * depth // CELLS + 1)):
            mid = (lo[some] + hi[some]) // 2
            mine = _words_from(ids, run, sa[mid], depth)
            diff = np.where(step < lengths[some][:, None], mine - heads[some], 0)
            first = np.argmax(diff != 0, axis=1)
            sign = diff[np.arange(len(some)), first]
            below = sign <= 0 if above else sign < 0
            lo[some] = np.where(below, mid + 1, lo[some])
            hi[some] = np.where(below, hi[some], mid)


def search_shard(tests: Tests, ids: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places hit in ``ids`` (True/False per word) and the matches, rows of (text
    number, item, words, first word in the item, place): the longest of each text and
    item; ties go to the earlier place, then to the earlier word of the item.

    ``ids`` holds the texts' word numbers, a 0 after each text; ``doc`` the text of
    each place."""
    place = np.arange(len(ids))
    stop = np.minimum.accumulate(np.where(ids == 0, place, len(ids))[::-1])[::-1]
    run = stop - place
    hit = np.zeros(len(ids) + 1, np.int64)
    depth = tests.suffix.shape[1]
    sa = suffix_array(ids, run, depth, int(tests.lengths.min()))
    none = np.zeros((0, 5), np.int64)
    if not len(sa):
        return hit[:-1] > 0, none
    lo = _bound(tests.heads, tests.lengths, sa, ids, run, above=False)
    hi = _bound(tests.heads, tests.lengths, sa, ids, run, above=True)
    held, best = np.flatnonzero(lo < hi), []
    for w in held:
        where = sa[lo[w]:hi[w]]
        np.add.at(hit, where, 1)
        np.add.at(hit, where + tests.lengths[w], -1)
        for s in range(*np.searchsorted(tests.window, [w, w + 1])):  # suffixes are sorted, so windows are, too
            for some in np.array_split(where, len(where) * depth // CELLS + 1):
                same = _words_from(ids, run, some, depth) == tests.suffix[s]
                same &= tests.suffix[s] > 0
                words = np.where(same.all(1), depth, np.argmin(same, axis=1))
                own = np.arange(tests.first[s], tests.first[s + 1])
                best.append(_longest(np.stack([
                    np.repeat(doc[some], len(own)), np.tile(tests.owner[own], len(some)),
                    np.repeat(words, len(own)), np.tile(tests.begin[own], len(some)),
                    np.repeat(some, len(own))], axis=1)))
    return np.cumsum(hit[:-1]) > 0, _longest(np.concatenate(best)) if best else none


def _longest(rows: np.ndarray) -> np.ndarray:
    """The first row of each (text, item) by words descending, place, item word."""
    rows = rows[np.lexsort((rows[:, 3], rows[:, 4], -rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
    return rows[new]


def _lists(owner: np.ndarray, n: int, values: dict[str, pa.Array], type_: pa.DataType) -> pa.Array:
    """``n`` lists of structs from rows in the order of their owners."""
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int32)
    fields = [type_.value_type.field(i) for i in range(type_.value_type.num_fields)]
    return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(
        [values[f.name] for f in fields], fields=fields), type=type_)


def _search_batch(tests: Tests | None, texts: pa.Array, before: pa.Array) -> pa.Array:
    """Results of a batch of texts; ``before`` holds the earlier passes' results."""
    raw, held = texts.cast(pa.binary()).to_pylist(), before.to_pylist()
    get = tests.words.get if tests else None
    counts, hits = np.zeros(len(raw), np.int64), np.zeros(len(raw), np.int64)
    spans, matches = [], []

    def flush(docs: list[int], parts: list[list[int]]) -> None:
        ids = np.concatenate([np.array([*p, 0], np.int32) for p in parts])
        doc = np.repeat(np.array(docs), [len(p) + 1 for p in parts])
        begins = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])])
        hit, found = search_shard(tests, ids, doc)
        local = {d: i for i, d in enumerate(docs)}
        for d in docs:
            for s in (held[d] or {}).get("spans") or ():
                b = begins[local[d]]
                hit[b + s["start"]:b + s["stop"]] = True
        edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
        start, stop = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
        base = begins[[local[d] for d in doc[start].tolist()]] if len(start) else start
        spans.append(np.stack([doc[start], start - base, stop - base], axis=1).astype(np.int64))
        np.add.at(hits, doc[start], stop - start)
        if len(found):
            found[:, 4] -= begins[[local[d] for d in found[:, 0].tolist()]]
            matches.append(found)

    docs, parts, size = [], [], 0
    for d, text in enumerate(raw):
        words = text_words(text) if text else []
        counts[d] = len(words)
        if words and tests:
            docs.append(d)
            parts.append([get(w, 0) for w in words])
            size += len(words)
        if size >= SHARD_WORDS:
            flush(docs, parts)
            docs, parts, size = [], [], 0
    if docs:
        flush(docs, parts)
    span = np.concatenate(spans) if spans else np.zeros((0, 3), np.int64)
    rows = [(int(d), tests.items[i], int(w), int(b), int(p)) for d, i, w, b, p in
            np.concatenate(matches)] if matches else []
    for d, old in enumerate(held):
        rows += [(d, m["item"], m["words"], m["item_start"], m["start"]) for m in (old or {}).get("matches") or ()]
    longest: dict[tuple[int, str], tuple] = {}
    for d, item, words, begin, at in rows:
        key, this = (d, item), (-words, at, begin)
        if key not in longest or this < longest[key]:
            longest[key] = this
    done = [(d, item, *longest[d, item]) for d, item in sorted(longest)]
    owner = np.array([r[0] for r in done], np.int64)
    return pa.StructArray.from_arrays([
        pa.array(counts), pa.array(hits),
        _lists(span[:, 0], len(raw), {"start": pa.array(span[:, 1]), "stop": pa.array(span[:, 2])}, _SPAN),
        _lists(owner, len(raw), {
            "item": pa.array([r[1] for r in done], pa.string()),
            "words": pa.array([-r[2] for r in done], pa.int64()),
            "start": pa.array([r[3] for r in done], pa.int64()),
            "item_start": pa.array([r[4] for r in done], pa.int64())}, _MATCH)],
        fields=[_ARROW.field(i) for i in range(_ARROW.num_fields)])


def _searcher(tests: Tests | None, spark):
    plain = spark.sparkContext.broadcast(vars(tests) if tests else None)  # plain arrays and lists

    @F.arrow_udf(RESULT)
    def find(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        held = Tests(**plain.value) if plain.value else None
        for texts, before in batches:
            yield _search_batch(held, texts, before)

    return find


def test_blocks(tests: DataFrame, item_col: str, text_col: str, stages: Stages) -> Iterator[list[tuple]]:
    """The test texts as (item, text) rows, in blocks of bounded size."""
    rows = tests.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                        F.col(text_col).alias("text")).where(F.length("text") > 0).distinct()
    size = F.octet_length("text")
    total = rows.agg(F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()["b"]
    if total <= BLOCK_BYTES:
        yield [tuple(r) for r in rows.collect()]
        return
    # texts are dealt to blocks by a running sum inside buckets of about a block
    buckets = -(-total // BLOCK_BYTES)
    own = W.Window.partitionBy("bucket").orderBy("item", "text")
    dealt = stages.write(rows.withColumn("bucket", F.pmod(F.xxhash64("item", "text"), F.lit(buckets))).withColumn(
        "part", F.floor((F.sum(size.cast("long")).over(own) - 1) / F.lit(BLOCK_BYTES))), "test-blocks")
    for b in range(buckets):
        parts = dealt.where(F.col("bucket") == b)
        for p in sorted(r["part"] for r in parts.select("part").distinct().collect()):
            yield [tuple(r) for r in parts.where(F.col("part") == p).select("item", "text").collect()]
    stages.drop(dealt)


def find_matches(docs: DataFrame, tests: DataFrame, text_col: str = "text", item_col: str = "item_id",
                 test_text_col: str = "text", min_words: int = MIN_WORDS, out: str = "found") -> DataFrame:
    """``docs`` with the struct column ``out``: n_words, n_hit (words inside windows),
    spans (word ranges that are hit) and matches (per item with windows here, its
    longest verbatim match: words, first word in the item, first word in the text)."""
    spark, stages = docs.sparkSession, Stages(docs.sparkSession)
    if out.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"the table has a column {out} already")
    rows, held, first = docs.withColumn(out, F.lit(None).cast(RESULT)), None, True
    for block in test_blocks(tests, item_col, test_text_col, stages):
        prepared = prepare_tests(block, min_words)
        if not first:
            if prepared is None:
                continue  # no words, nothing to add
            last, held = held, stages.write(rows, "matches")
            rows = held
            if last is not None:
                stages.drop(last)
        find, first = _searcher(prepared, spark), False
        rows = rows.withColumn(out, find(F.col(f"`{text_col}`"), F.col(out)))
    return rows


def decontaminate(docs: DataFrame, tests: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  test_text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` that hold no window of a test text."""
    out = free_name(docs, "found")
    found = find_matches(docs, tests, text_col, item_col, test_text_col, min_words, out)
    return found.where(F.col(out)["n_hit"] == 0).drop(out)


def longest_matches(docs: DataFrame, tests: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", test_text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(item, words, item_start, doc, start, n_docs): the longest verbatim match of each
    item that has one, where it is (ties: smallest id) and how many rows hold windows."""
    found = find_matches(docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")), tests, "text",
                         item_col, test_text_col, min_words)
    each = found.select("doc", F.explode("found.matches").alias("m")).select("doc", "m.*")
    first = F.min(F.struct(-F.col("words"), "doc", "start", "item_start")).alias("f")
    return each.groupBy("item").agg(first, F.count(F.lit(1)).alias("n_docs")).select(
        "item", (-F.col("f.col1")).alias("words"), F.col("f.item_start").alias("item_start"),
        F.col("f.doc").alias("doc"), F.col("f.start").alias("start"), "n_docs")


def contamination(docs: DataFrame, tests: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The contract's row for every document."""
    found = find_matches(docs.select(id_col, "text"), tests)
    items: Column = F.array_sort(F.col("found.matches.item"))
    return found.select(
        id_col, F.col("found.n_words").alias("n_words"), F.col("found.n_hit").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"))
