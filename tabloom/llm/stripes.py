"""Phrase collocations by stripes.

A *stripe* is an associative counter: for a prefix of words, how often each next word
follows it, and under the empty word how often anything else does (the end of a piece,
or a word that cannot make a phrase frequent).  Tasks build the stripes of their texts
in large blocks; stripes of one prefix are then merged elementwise.  From the merged
stripes come all figures: an entry is the count of the phrase "prefix + next word" (the
extension), the sum of a stripe is the count of its prefix (and of all words for the
empty prefix), and the largest frequent entry of a stripe, with those of the stripes
that end in the prefix, says which longer phrase subsumes it.

Stripes are built level by level, by prefix length.  A phrase is frequent only if all
its parts are, so a level skips phrases whose parts were not frequent in the level
before.  That knowledge travels as a byte table of fixed size (``SLOTS``): the slot of a
phrase's hash holds the logarithm of its count if it is frequent.  Two phrases in one
slot can only let a rare phrase pass, never stop a frequent one.

No task holds the whole stripe of a common prefix: a stripe is cut into segments by the
hash of the next word, in proportion to its prefix's share of all words, and a segment
arrives in rows of at most ``ROW_ENTRIES`` entries that are merged as a sorted stream.
Once a segment is merged, its rare entries are added to the empty word's, so only
frequent phrases are kept.

Defined cases: everything is per language, a null language is ``und``; a null text is
empty; repeated rows count once each; an empty table has no phrase.  A text is split
into pieces at ``.,;:!?`` and line breaks (U+000A to U+000D), a piece into words at
blanks and tabs; A-Z are read in lower case.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from tabloom.llm.common import text_of
from tabloom.session import Stages

MIN_COUNT = 10
MAX_WORDS = 3
SHARE = 50
TOP = 2000
#: Bytes of text whose stripes a task builds together.
BLOCK = 8 << 20
#: Entries of a stripe in one row.
ROW_ENTRIES = 256
#: Size of the byte table of frequent phrases.
SLOTS = 1 << 24
PAGE = 1 << 12
#: Segments of the stripe of the empty prefix, for each input partition.
SEGMENTS = 4

#: A row of a stripe: its next words joined by blanks, and their counts.
_STRIPE = "lang string, prefix string, segment int, next string, n array<long>"
_SCHEMA = pa.schema([("lang", pa.string()), ("prefix", pa.string()), ("segment", pa.int32()),
                     ("next", pa.string()), ("n", pa.list_(pa.int64()))])
#: The empty word in a row (no word holds a full stop).
OTHER = "."
_BREAKS = b".,;:!?\n\x0b\x0c\r"
#: A-Z in lower case, every piece end as a full stop.
_TABLE = bytes(46 if c in _BREAKS else c + 32 if 65 <= c <= 90 else c for c in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def block_words(texts: list[bytes]) -> pa.DictionaryArray:
    """All words of some texts in order, ``.`` between pieces and around texts."""
    joined = b".".join([b"", *texts, b""]).translate(_TABLE).replace(b".", b" . ")
    return pa.array(joined.split(), pa.binary()).dictionary_encode()


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, xxhash.xxh32_intdigest(lang.encode()))


def join_hash(head: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of all its words but the last, and the last word's."""
    mixed = (head ^ (head >> np.uint64(29))) * _MIX + last
    return mixed ^ (mixed >> np.uint64(32))


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(8)).astype(np.int64) & (SLOTS - 1)


def _cuts(prefix: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """Row starts among sorted entries: a new prefix or segment, or ``ROW_ENTRIES``."""
    new = np.ones(len(prefix), bool)
    new[1:] = (prefix[1:] != prefix[:-1]) | (segment[1:] != segment[:-1])
    run = np.arange(len(prefix))
    run -= np.maximum.accumulate(np.where(new, run, 0))
    return np.flatnonzero(new | (run % ROW_ENTRIES == 0))


def block_stripes(lang: str, texts: list[bytes], length: int, levels: list[np.ndarray], segments: float
                  ) -> pa.RecordBatch | None:
    """Stripes of all prefixes of ``length`` words in some texts of one language.

    ``levels[k]`` is the byte table of frequent phrases of k + 1 words; ``segments``
    how many segments a stripe of all words' weight would have, as a share of the
    number of words (so times a prefix's count it is that prefix's segments)."""
    coded = block_words(texts)
    words = coded.dictionary
    code = coded.indices.to_numpy().astype(np.int64)
    if not len(code):
        return None
    hashes = np.fromiter((word_hash(lang, w) for w in words.to_pylist()), np.uint64, len(words))
    stop = pc.index(words, pa.scalar(b".", pa.binary())).as_py()
    other = len(words)  # code of the empty word
    hashes = np.append(hashes, np.uint64(0))
    word = np.where(code == stop, other, code)  # every text is followed by a piece end
    # at[i]: begins of the prefixes; phrase[i]: their hashes; weight: log2 of their counts
    at = np.flatnonzero(word != other) if length == 0 else np.flatnonzero(word[:-1] != other)
    if length:
        phrase, number = hashes[word[at]], word[at]
        weight = levels[0][_slot(phrase)]
        for k in range(1, length):
            keep = weight > 0
            at, phrase, number = at[keep], phrase[keep], number[keep]
            last = word[at + k]
            phrase = join_hash(phrase, hashes[last])
            number = np.unique(number, return_inverse=True)[1].reshape(-1) * (other + 1) + last
            weight = np.where(last != other, levels[k][_slot(phrase)], 0)
        keep = weight > 0
        at, phrase, number, weight = at[keep], phrase[keep], number[keep], weight[keep]
        following = word[at + length]
        # the next word counts by itself if each part that it ends is frequent
        good = following != other
        for k in range(length):  # parts of k + 1 words, the last k + 1 of the phrase
            part = hashes[word[at + length - k]]
            for j in range(length - k + 1, length + 1):
                part = join_hash(part, hashes[word[np.minimum(at + j, len(word) - 1)]])
            good &= levels[k][_slot(part)] > 0
        following = np.where(good, following, other)
    else:
        following, number, weight = word[at], np.zeros(len(at), np.int64), None
    if not len(at):
        return None
    first, pid = np.unique(number, return_index=True, return_inverse=True)[1:]
    pair, n = np.unique(pid.reshape(-1) * (other + 1) + following, return_counts=True)
    pid, following = pair // (other + 1), pair % (other + 1)
    if length:
        share = np.maximum(1, np.exp2(weight[first].astype(float)) * segments).astype(np.int64)[pid]
    else:
        share = np.full(len(pid), max(1, int(segments)), np.int64)
    segment = (hashes[following] % share.astype(np.uint64)).astype(np.int64)
    segment[following == other] = 0
    order = np.lexsort((following, segment, pid))
    pid, following, segment, n = pid[order], following[order], segment[order], n[order]
    starts = _cuts(pid, segment)
    begin = at[first][pid[starts]]
    named = pa.concat_arrays([words, pa.array([OTHER.encode()], pa.binary())]).cast(pa.string())
    parts = [named.take(pa.array(word[begin + k])) for k in range(length)]
    prefix = pc.binary_join_element_wise(*parts, " ") if parts else pa.array([""] * len(starts))
    ends = pa.array(np.append(starts, len(pid)).astype(np.int32))
    return pa.RecordBatch.from_arrays([
        pa.array([lang] * len(starts), pa.string()), prefix, pa.array(segment[starts].astype(np.int32)),
        pc.binary_join(pa.ListArray.from_arrays(ends, named.take(pa.array(following))), " "),
        pa.ListArray.from_arrays(ends, pa.array(n))], schema=_SCHEMA)


def text_stripes(docs: DataFrame, length: int, levels: list, segments: float) -> DataFrame:
    """Stripes of all texts of ``docs`` (lang, text); ``levels`` are broadcast tables."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.frombuffer(b.value, np.uint8) for b in levels]
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                held.setdefault(lang, []).append(text)
                size[lang] = size.get(lang, 0) + len(text)
                if size[lang] >= BLOCK or sum(size.values()) >= 4 * BLOCK:
                    lang = max(size, key=size.get)
                    size.pop(lang)
                    out = block_stripes(lang, held.pop(lang), length, tables, segments)
                    if out is not None:
                        yield out
        for lang, texts in held.items():
            out = block_stripes(lang, texts, length, tables, segments)
            if out is not None:
                yield out

    return docs.mapInArrow(build, _STRIPE)


def _entries(table: pa.Table) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(row, next, n) of every entry of some stripes."""
    following = pc.split_pattern(table.column("next").combine_chunks(), " ")
    rows = np.repeat(np.arange(table.num_rows), pc.list_value_length(following).to_numpy())
    return rows, following.flatten(), table.column("n").combine_chunks().flatten().to_numpy()


def merge_sorted(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Stripes of equal (lang, prefix, segment), which come one after the other, merged
    elementwise; entries below ``least`` are added to the empty word's."""
    held: pa.Table | None = None  # rows of the key that may go on, merged
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch.cast(_SCHEMA)])
        table = (table if held is None else pa.concat_tables([held, table])).combine_chunks()
        lang, prefix, segment = (table.column(c).combine_chunks() for c in ("lang", "prefix", "segment"))
        same = pc.and_(pc.and_(pc.equal(lang[1:], lang[:-1]), pc.equal(prefix[1:], prefix[:-1])),
                       pc.equal(segment[1:], segment[:-1])).to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.flatnonzero(~same) + 1])
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, table.num_rows)))
        rows, following, n = _entries(table)
        merged = _add(table.take(pa.array(starts)), group[rows], following, n)
        if merged.num_rows > 1:
            yield from _fold(merged.slice(0, merged.num_rows - 1), least).to_batches(max_chunksize=4096)
        held = merged.slice(merged.num_rows - 1)
    if held is not None:
        yield from _fold(held, least).to_batches()


def _add(keys: pa.Table, group: np.ndarray, following: pa.Array, n: np.ndarray) -> pa.Table:
    """The rows ``keys`` with the entries of each row's ``group`` added up."""
    summed = pa.table({"g": pa.array(group), "next": following, "n": pa.array(n)}).group_by(
        ["g", "next"]).aggregate([("n", "sum")]).sort_by("g").combine_chunks()
    counts = np.bincount(summed.column("g").to_numpy(), minlength=keys.num_rows)
    ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
    words = pa.ListArray.from_arrays(ends, summed.column("next").combine_chunks())
    return pa.table([*(keys.column(c) for c in ("lang", "prefix", "segment")), pc.binary_join(words, " "),
                     pa.ListArray.from_arrays(ends, summed.column("n_sum").combine_chunks())], schema=_SCHEMA)


def _fold(table: pa.Table, least: int) -> pa.Table:
    """Rare entries go to the empty word."""
    rows, following, n = _entries(table)
    return _add(table, rows, pc.if_else(pa.array(n < least), pa.scalar(OTHER), following), n)


def merge_stripes(stripes: DataFrame, least: int) -> DataFrame:
    """Stripes merged elementwise by (lang, prefix, segment)."""
    key = ["lang", "prefix", "segment"]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return merge_sorted(batches, least)

    return stripes.repartition(*key).sortWithinPartitions(*key).mapInArrow(merge, _STRIPE)


def level_table(frequent: DataFrame) -> bytes:
    """Byte table of frequent phrases (lang, words, n): at each phrase's slot the
    logarithm of its count, rounded down, plus one.  Pages are made on the executors;
    the driver gets at most ``SLOTS`` bytes."""

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.zeros(batch.num_rows, np.uint64)
            for i, (lang, words) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                each = np.array([word_hash(lang, w.encode()) for w in words.split(" ")], np.uint64)
                head = each[:1]
                for k in range(1, len(each)):
                    head = join_hash(head, each[k:k + 1])
                hashes[i] = head[0]
            slot = _slot(hashes)
            level = np.log2(batch.column(2).to_numpy().astype(float)).astype(np.int32) + 1
            yield pa.RecordBatch.from_arrays([pa.array((slot // PAGE).astype(np.int32)),
                                              pa.array((slot % PAGE).astype(np.int32)), pa.array(level)],
                                             names=["page", "place", "level"])

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for held in batch.column(1).to_pylist():
                page = np.zeros(PAGE, np.uint8)
                page[[h["place"] for h in held]] = [h["level"] for h in held]
                out.append(page.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["page", "data"])

    most = frequent.select("lang", "words", "n").mapInArrow(slots, "page int, place int, level int").groupBy(
        "page", "place").agg(F.max("level").alias("level"))
    made = most.groupBy("page").agg(F.collect_list(F.struct("place", "level")).alias("held")).mapInArrow(
        pages, "page int, data binary")  # at most PAGE entries a page
    table = bytearray(SLOTS)
    for row in made.toLocalIterator():
        table[row["page"] * PAGE:(row["page"] + 1) * PAGE] = row["data"]
    return bytes(table)


def merged_levels(docs: DataFrame, stages: Stages, max_words: int, least: int) -> list[DataFrame]:
    """Merged stripes of the prefixes of 0 to ``max_words`` - 1 words, as stage tables."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), text_of("text").alias("text"))
    whole = SEGMENTS * max(1, docs.rdd.getNumPartitions())
    out: list[DataFrame] = []
    tables: list = []
    for length in range(max_words):
        segments = float(whole)
        if length:
            total = out[0].select(F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
            segments = whole / max(1, total)
            frequent = entries(out[-1]).where(F.col("next") != "").select(
                "lang", F.ltrim(F.concat_ws(" ", "prefix", "next")).alias("words"), "n")
            tables.append(spark.sparkContext.broadcast(level_table(frequent)))
        merged = merge_stripes(text_stripes(texts, length, tables, segments), least)
        out.append(stages.write(merged, f"stripes-{length}"))
    for t in tables:
        t.unpersist()
    return out


def entries(stripes: DataFrame) -> DataFrame:
    """(lang, prefix, next, n) of every entry; the empty word is the empty text."""
    pairs = F.arrays_zip(F.split("next", " ").alias("next"), F.col("n"))
    return stripes.select("lang", "prefix", F.explode(pairs).alias("e")).select(
        "lang", "prefix", F.nullif(F.col("e.next"), F.lit(OTHER)).alias("next"), "e.n").fillna("", ["next"])


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, share: int = SHARE,
                 top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's best phrases.

    Phrases of 2 to ``max_words`` words with a count a of ``min_count`` or more; the
    score is the lowest floor(1000000 a^2 / (l r)) over the cuts into a first part of
    count l and a rest of count r (ties: the shortest first part).  A phrase is dropped
    if a longer frequent one that holds it has ``share`` percent of its count."""
    if max_words < 2 or min_count < 1:
        raise ValueError("max_words must be 2 or more, min_count 1 or more")
    stages = Stages(docs.sparkSession)
    levels = merged_levels(docs, stages, max_words, min_count)
    # counts of all frequent phrases: prefix totals are their stripes' sums
    totals, grown = None, None
    for length, stripes in enumerate(levels):
        each = entries(stripes)
        phrase = F.ltrim(F.concat_ws(" ", "prefix", "next"))
        some = each.where((F.col("next") != "") & (F.col("n") >= min_count)).select(
            "lang", "prefix", phrase.alias("phrase"), "n", F.lit(length + 1).alias("words"))
        grown = some if grown is None else grown.union(some)
        sums = each.groupBy("lang", "prefix").agg(F.sum("n").alias("f"))
        totals = sums if totals is None else totals.union(sums)
    grown, counts = stages.write(grown, "phrases"), stages.write(totals, "counts")
    stages.drop(*levels)
    held = grown.where(F.col("words") >= 2).select("lang", "phrase", F.col("n").alias("a"), "words")
    # largest frequent extension on either side: a longer holder cannot have more
    longer = grown.where(F.col("words") >= 3)
    inner = F.regexp_replace("phrase", "^[^ ]* ", "")
    most = longer.select("lang", F.col("prefix").alias("part"), "n").union(
        longer.select("lang", inner.alias("part"), "n")).groupBy("lang", "part").agg(F.max("n").alias("most"))
    wide = "decimal(20,0)"
    kept = held.join(most.withColumnRenamed("part", "phrase"), ["lang", "phrase"], "left").where(
        F.coalesce(F.lit(100).cast(wide) * F.col("most").cast(wide) < F.lit(share).cast(wide) * F.col("a").cast(wide),
                   F.lit(True)))
    cut = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    split = F.split("phrase", " ", -1)
    cut = cut.withColumn("first", F.concat_ws(" ", F.slice(split, 1, F.col("k")))).withColumn(
        "rest", F.concat_ws(" ", F.slice(split, F.col("k") + 1, F.col("words") - F.col("k"))))
    left = counts.select("lang", F.col("prefix").alias("first"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("prefix").alias("rest"), F.col("f").alias("r"))
    scored = cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    score: Column = F.expr("(cast(a as decimal(16,0)) * cast(a as decimal(16,0)) * 1000000BD) div "
                           "(cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    best = scored.withColumn("score", score).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("b")).select(
        "lang", "phrase", "a", F.col("b.l").alias("l"), F.col("b.r").alias("r"), F.col("b.score").alias("score"))
    order = W.Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    words = counts.where(F.col("prefix") == "").select("lang", F.col("f").alias("n"))
    return ranked.join(F.broadcast(words), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
