"""Repeated passages by content-defined chunking.

A text is cut where its own content says so: a gear rolling hash runs over the
bytes (each byte's hash is the sum of random values of the last ``WINDOW``
bytes, shifted by their distance), and a word start is a cut when its hash is
the smallest among the ``reach`` word starts on either side.  A cut depends on
a few words around it only, so a passage gets the same chunks wherever it
stands and whatever was inserted before it.  Chunks are compared by the 64-bit
digest of their bytes without outer white space.

What repeats is a *window*: neighbouring chunks of one text that reach
``min_words`` words, from every chunk on and back from every chunk, no longer than
needed.  Every window's first occurrence (smallest id, then smallest place) stays;
chunks that lie in a later occurrence are dropped.  So a dropped run of chunks is
made of passages of at least ``min_words`` words in a row that stand, chunk for
chunk and in this order, in an earlier place; unrelated short repeats side by side
stay.  Every dropped chunk has an equal one that is kept.

Windows are only built where all their chunks occur more than once.  All counting
is grouped aggregation with map-side combining; a passage that a third of all texts
share is a few digests whose rows meet only through joins that may be split.  No
text is shuffled but for the one join that brings a text its dropped windows.

Unit of "words": places where a cut may be, i.e. word starts and, inside a run
of over ``LONG_WORD`` bytes without white space (scripts without blanks, data),
every character.  Chunks longer than ``MAX_WORDS`` of them are cut there.

Nulls: a null text stays null and repeats nothing; an empty text stays empty.
Rows with a null id keep their text and are no one's first occurrence.  Rows
that share an id are told apart by a hash of their text.  Rows that share id and
text both stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import free_name, groups_by_size
from tabloom.session import Stages

WINDOW = 16
REACH = 3
MIN_WORDS = 20
MAX_WORDS = 64
PLACE = 2 * MAX_WORDS
LONG_WORD = 48
#: Characters of text that are cut at once.
BLOCK = 1 << 20
#: Repeated digests are broadcast up to this count (8 bytes each).
BROADCAST_DIGESTS = 500_000

GEAR = np.random.default_rng(20_240_229).integers(0, 1 << 32, 256, dtype=np.uint32)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``WINDOW`` bytes that end at each place.  A window is built
    by doubling: two neighbouring half windows make a whole one."""
    h, span = GEAR[data], 1
    while span < WINDOW:
        wide = h.copy()
        wide[span:] += h[:-span] << np.uint32(span)
        h, span = wide, span * 2
    return h


def cut_texts(texts: list[str], reach: int = REACH) -> tuple[np.ndarray, ...]:
    """Chunks of several texts: (text number, start byte, end byte, words,
    digest), in text order.  Bytes count from each text's start."""
    import xxhash

    pad = b"\0" * WINDOW  # no window sees another text
    raw = [t.encode("utf-8", "replace") for t in texts]
    lengths = np.array([len(r) for r in raw], np.int64)
    begins = WINDOW + np.concatenate([[0], np.cumsum(lengths + WINDOW)[:-1]]).astype(np.int64)
    joined = pad + pad.join(raw) + pad
    data = np.frombuffer(joined, np.uint8)
    h = gear_hashes(data)

    space = _SPACE[data]
    place = np.arange(len(data))
    inside = np.zeros(len(data), bool)
    for b, n in zip(begins, lengths):
        inside[b:b + n] = True
    after_gap = np.empty(len(data), bool)
    after_gap[0] = False
    after_gap[1:] = space[:-1] | ~inside[:-1]
    word_start = inside & ~space & after_gap
    last = np.maximum.accumulate(np.where(word_start, place, 0))
    in_long = inside & ~space & (place - last >= LONG_WORD) & (data & 0xC0 != 0x80)
    at = np.flatnonzero(word_start | in_long)
    owner = np.searchsorted(begins, at, "right") - 1

    value = h[at - 1].astype(np.int64)
    cut = np.ones(len(at), bool)
    for d in range(1, reach + 1):
        if len(at) > d:
            same = owner[d:] == owner[:-d]
            left, right = value[:-d], value[d:]
            cut[d:] &= ~same | (right < left)
            cut[:-d] &= ~same | (left <= right)
    if len(at):
        cut[0] = True
        cut[1:] |= owner[1:] != owner[:-1]  # a text's first word
        run = np.arange(len(at))
        run -= np.maximum.accumulate(np.where(cut, run, 0))
        cut |= run % MAX_WORDS == 0
    firsts = np.flatnonzero(cut)
    own = owner[firsts]
    new = np.ones(len(firsts), bool)
    new[1:] = own[1:] != own[:-1]
    starts = np.where(new, begins[own], at[firsts])  # blanks before the first word go with it
    ends = np.empty(len(firsts), np.int64)
    ends[:-1] = np.where(new[1:], (begins + lengths)[own[:-1]], starts[1:])
    ends[-1:] = (begins + lengths)[own[-1:]]
    words = np.diff(np.append(firsts, len(at)))
    digest = xxhash.xxh64_intdigest
    digests = np.fromiter((digest(joined[s:e].strip()) for s, e in zip(starts, ends)),
                          np.uint64, len(starts)).view(np.int64)
    return own, starts - begins[own], ends - begins[own], words, digests


def chunk_rows(docs: DataFrame, id_col: str, text_col: str, reach: int) -> DataFrame:
    """(digest, id, body, place) of every chunk of every text with an id; ``body`` is
    the text's hash, ``place`` the chunk's number in it times ``PLACE`` plus its words."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, bodies, done = pdf["id"].to_numpy(), pdf["body"].to_numpy(), 0
            for texts in groups_by_size(pdf["text"], BLOCK):
                own, _, _, words, digests = cut_texts(texts, reach)
                seq = np.arange(len(own)) - np.searchsorted(own, own)
                yield pd.DataFrame({"digest": digests, "id": ids[done:done + len(texts)][own],
                                    "body": bodies[done:done + len(texts)][own],
                                    "place": seq * PLACE + words})
                done += len(texts)

    text = F.col(text_col)
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), F.hash(text).alias("body")
                       ).dropna().mapInPandas(
        cut, "digest long, id long, body int, place long")


def windows(seq: np.ndarray, words: np.ndarray, digests: np.ndarray, min_words: int
            ) -> list[tuple[int, int, int]]:
    """(digest, first chunk, last chunk) of the windows among some chunks of a
    text, given in the order of their distinct places ``seq``."""
    import xxhash

    out, edge = [], np.flatnonzero(np.diff(seq) != 1) + 1
    for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(seq)]):
        upto = np.concatenate([[0], np.cumsum(words[a:b])])
        ends = np.searchsorted(upto, upto[:-1] + min_words)  # on from every chunk
        begins = np.searchsorted(upto, upto[1:] - min_words, "right") - 1  # back from every chunk
        found = {(i, e) for i, e in enumerate(ends.tolist()) if e < len(upto)}
        found |= {(i, e) for e, i in enumerate(begins.tolist(), 1) if i >= 0}
        for i, e in found:
            raw = digests[a + i:a + e].astype("<i8").tobytes()
            out.append((xxhash.xxh64_intdigest(raw) - (1 << 63), a + i, a + e - 1))
    return out


def window_rows(repeats: DataFrame, min_words: int) -> DataFrame:
    """(digest, id, body, start, last) of every window of repeated chunks; start and
    last are the places (seq) of its first and last chunk."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for id_, body, places, digests in zip(*(pdf[c] for c in ("id", "body", "place", "digest"))):
                places, at = np.unique(np.asarray(places), return_index=True)
                (seq, words), digests = np.divmod(places, PLACE), np.asarray(digests)[at]
                if words.sum() >= min_words:
                    rows += [(d, id_, body, seq[i], seq[j]) for d, i, j in
                             windows(seq, words, digests, min_words)]
            yield pd.DataFrame(rows, columns=["digest", "id", "body", "start", "last"]).astype("int64")

    texts = repeats.groupBy("id", "body").agg(
        F.collect_set(F.struct("place", "digest")).alias("s"))  # one text's chunks, copies of a row once
    return texts.select("id", "body", "s.place", "s.digest").mapInPandas(
        build, "digest long, id long, body int, start int, last int")


def _kept(text: str, starts: np.ndarray, lasts: np.ndarray, reach: int) -> tuple[str, list[dict]]:
    """A text without the chunks ``starts`` to ``lasts`` of its repeated windows, and the
    dropped spans in code points."""
    _, begin, end, _, _ = cut_texts([text], reach)
    cover = np.zeros(len(begin) + 1, np.int64)
    np.add.at(cover, np.asarray(starts, np.int64), 1)
    np.add.at(cover, np.asarray(lasts, np.int64) + 1, -1)
    hit = np.cumsum(cover[:-1]) > 0
    raw, out, spans, done, chars = text.encode("utf-8", "replace"), [], [], 0, 0
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    for a, b in zip(edge[::2], edge[1::2]):
        part = raw[done:begin[a]].decode("utf-8")
        gone = raw[begin[a]:end[b - 1]].decode("utf-8")
        out.append(part)
        chars += len(part)
        spans.append({"start": chars, "chars": len(gone)})
        chars += len(gone)
        done = end[b - 1]
    out.append(raw[done:].decode("utf-8"))
    return "".join(out), spans


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 reach: int = REACH, min_words: int = MIN_WORDS, spans_col: str | None = None
                 ) -> DataFrame:
    """``docs`` with the repeated passages taken out of ``text_col``; with
    ``spans_col``, also a column of the dropped spans (array of start, chars in
    code points of the original text; empty where nothing was dropped)."""
    stages = Stages(docs.sparkSession)
    chunks = stages.write(chunk_rows(docs, id_col, text_col, reach), "chunks")
    counted = stages.write(chunks.groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
                           .where("n > 1").select("digest"), "repeated")
    small = counted.count() <= BROADCAST_DIGESTS
    repeats = stages.write(chunks.join(F.broadcast(counted) if small else counted, "digest",
                                       "left_semi"), "repeats")
    stages.drop(chunks, counted)
    found = stages.write(window_rows(repeats, min_words), "windows")
    stages.drop(repeats)
    first = stages.write(found.groupBy("digest").agg(
        F.min(F.struct("id", "start", "body")).alias("f"), F.count(F.lit(1)).alias("n")).where("n > 1")
        .select("digest", "f"), "first")
    later = found.join(first, "digest").where("id <> f.id or start <> f.start or body <> f.body").select(
        "id", "body", "start", "last").distinct()
    key, body = free_name(docs, "repeat_id"), free_name(docs, "repeat_body")
    spots = free_name(docs, "repeat_spots")
    by_text = stages.write(later.groupBy(F.col("id").alias(key), F.col("body").alias(body)).agg(
        F.collect_list(F.struct("start", "last")).alias(spots)), "later")  # one text's windows
    stages.drop(found, first)

    @F.pandas_udf("kept string, spans array<struct<start: long, chars: long>>")
    def keep(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, starts, lasts in batches:
            rows = [(t, []) if t is None or s is None else _kept(t, s, e, reach)
                    for t, s, e in zip(texts, starts, lasts)]
            yield pd.DataFrame(rows, columns=["kept", "spans"])

    joined = docs.join(by_text, (docs[id_col] == by_text[key])
                       & (F.hash(docs[text_col]) == by_text[body]), "left")
    hit = F.col(spots).isNotNull()
    done = free_name(docs, "kept_text")
    cut = joined.withColumn(done, keep(F.when(hit, F.col(text_col)), F.col(f"{spots}.start"),
                                       F.col(f"{spots}.last")))
    columns = [F.when(hit, F.col(f"{done}.kept")).otherwise(F.col(text_col)).alias(c)
               if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return cut.select(*columns, *([F.col(f"{done}.spans").alias(spans_col)] if spans_col else []))
