"""Documents packed into sequences by length patterns.

Pieces are counted by length (at most ``capacity`` counts), and the whole plan
is made from that histogram, whatever the number of documents:

1. lengths are put into ``bins`` classes, rounded up; all patterns of at most
   ``parts`` classes that fill a sequence are enumerated;
2. non-negative least squares finds how often each pattern should be used so
   that the patterns' classes add up to the histogram;
3. the counts are rounded down and every use of a pattern takes pieces of its
   classes, longest first, and as its last (shortest) piece the longest that
   fits; uses that would leave more than ``max_slack`` of a sequence empty are
   given back;
4. the residual pieces go, longest first, where the least room that fits them
   is left: into the patterns' sequences or into new ones.

Equal uses are kept as one entry with a count, so steps 3 and 4 handle runs of
equal sequences, never single documents.  A piece finds its place by its rank
among the pieces of its length; ranks come from counts per (length, salt), so
that a length that a third of all pieces share is ranked in many tasks.

Null texts are empty; an empty text is one piece with the end id alone.  Pieces
of rows that share an id (repeated rows too) are packed separately.  An empty
table gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from tabloom.llm.common import groups_by_size, id_long, id_text, text_of
from tabloom.llm.word_tokenizer import WordTokenizer
from tabloom.session import Stages

CAPACITY = 4096
BINS = 64
PARTS = 4
MAX_SLACK = 0.0005
END_ID = 1
#: Characters tokenised at once.
BLOCK = 1 << 22
#: Pieces of one length that are ranked in one window, about.
RANKED_ROWS = 2_000


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document: its
    ids and the end id, cut every ``capacity`` ids.  ``with_ids`` adds the
    piece's ids (little-endian unsigned 32-bit integers)."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordTokenizer(tokenizer)
        for pdf in batches:
            done = 0
            for texts in groups_by_size(pdf["text"], BLOCK):
                rows = []
                for doc, ids in zip(pdf["doc_id"][done:done + len(texts)], words.ids(texts)):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at:at + 4 * capacity]
                        rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part),
                                     *([part] if with_ids else [])))
                done += len(texts)
                yield pd.DataFrame(rows, columns=names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    return id_long(docs.select(id_text(id_col), text_of(text_col).alias("text")).mapInPandas(
        cut, "doc_id string, piece int, start long, length long, ids_crc32 long"
        + ", ids binary" * with_ids))


def nnls(a: np.ndarray, b: np.ndarray, tol: float = 1e-9) -> np.ndarray:
    """x >= 0 that minimises |a x - b| (the active-set method of Lawson and
    Hanson)."""
    n = a.shape[1]
    x, used = np.zeros(n), np.zeros(n, bool)
    for _ in range(3 * max(a.shape)):
        pull = np.where(used, -np.inf, a.T @ (b - a @ x))
        best = int(np.argmax(pull))
        if pull[best] <= tol * max(1.0, float(np.abs(b).max(initial=0))):
            break
        used[best] = True
        while used.any():
            at = np.flatnonzero(used)
            z = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (z > tol).all():
                x[:] = 0
                x[at] = z
                break
            low = z <= tol
            step = float(np.min(x[at][low] / np.maximum(x[at][low] - z[low], 1e-300)))
            x[at] += step * (z - x[at])
            x[at[x[at] <= tol]] = 0
            used &= x > 0
    return x


@lru_cache(maxsize=4)
def fill_patterns(bins: int, parts: int) -> tuple[tuple[int, ...], ...]:
    """All ways to write ``bins`` as a sum of at most ``parts`` classes, in
    descending order within a pattern."""
    out: list[tuple[int, ...]] = []

    def grow(head: tuple[int, ...], left: int, most: int) -> None:
        if not left:
            out.append(head)
        elif len(head) < parts:
            for k in range(min(most, left), 0, -1):
                if k * (parts - len(head)) >= left:
                    grow((*head, k), left - k, k)

    grow((), bins, bins)
    return tuple(out)


@dataclass
class Use:
    """``count`` sequences that all hold pieces of these ``lengths``."""

    lengths: tuple[int, ...]
    count: int


class _Pool:
    """Pieces by length, handed out longest first within a class."""

    def __init__(self, counts: dict[int, int]):
        self.left = dict(counts)

    def take(self, low: int, high: int, want: int) -> list[tuple[int, int]]:
        """Up to ``want`` pieces with low < length <= high, as (length, count)."""
        out = []
        for n in range(high, low, -1):
            if not want or n < 1:
                break
            have = min(self.left.get(n, 0), want)
            if have:
                self.left[n] -= have
                want -= have
                out.append((n, have))
        return out

    def give(self, lengths: tuple[int, ...], count: int) -> None:
        for n in lengths:
            self.left[n] += count


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY, bins: int = BINS,
                 parts: int = PARTS, max_slack: float = MAX_SLACK) -> list[Use]:
    """Sequences for a histogram of lengths (1 to ``capacity``)."""
    bins = min(bins, capacity)
    unit = capacity / bins
    edges = [int(k * unit) for k in range(bins + 1)]
    edges[-1] = capacity
    pool, uses = _Pool({n: c for n, c in counts.items() if c}), []
    target = np.zeros(bins)
    for n, c in pool.left.items():
        target[bisect.bisect_left(edges, n) - 1] += c
    patterns = fill_patterns(bins, parts)
    a = np.zeros((bins, len(patterns)))
    for j, p in enumerate(patterns):
        for k in p:
            a[k - 1, j] += 1
    repeats = np.floor(nnls(a, target) + 1e-6).astype(np.int64)
    for p, r in sorted(zip(patterns, repeats.tolist())):
        if not r:
            continue
        partial = [Use((), r)]
        for k in p[:-1]:
            nxt: list[Use] = []
            got = iter(pool.take(edges[k - 1], edges[k], sum(u.count for u in partial)))
            n, have = next(got, (0, 0))
            for u in partial:
                want = u.count
                while want and have:
                    t = min(want, have)
                    nxt.append(Use((*u.lengths, n), t))
                    want, have = want - t, have - t
                    if not have:
                        n, have = next(got, (0, 0))
                if want:
                    pool.give(u.lengths, want)  # the class ran out
            partial = nxt
        for u in partial:
            room = capacity - sum(u.lengths)
            for n, have in pool.take(room - 1 - int(max_slack * capacity), room, u.count):
                uses.append(Use((*u.lengths, n), have))
                u.count -= have
            pool.give(u.lengths, u.count)
    return _pack_residuals(pool, uses, capacity)


def _pack_residuals(pool: _Pool, uses: list[Use], capacity: int) -> list[Use]:
    """Best fit of what the patterns left, longest first, in runs."""
    rooms: dict[int, list[Use]] = {}
    order: list[int] = []  # the rooms there are, ascending

    def put(u: Use) -> None:
        room = capacity - sum(u.lengths)
        if room not in rooms:
            rooms[room] = []
            bisect.insort(order, room)
        rooms[room].append(u)

    def fill(u: Use, n: int, per: int, want: int) -> int:
        """Put ``want`` pieces into the use's sequences, ``per`` to each."""
        whole, rest = divmod(want, per)
        whole = min(whole, u.count)
        used = whole * per
        if whole:
            put(Use((*u.lengths, *[n] * per), whole))
        if whole < u.count and rest and used + rest == want:
            put(Use((*u.lengths, *[n] * rest), 1))
            used, whole = want, whole + 1
        if whole < u.count:
            put(Use(u.lengths, u.count - whole))
        return want - used

    for u in uses:
        put(u)
    for n in sorted(pool.left, reverse=True):
        want = pool.left[n]
        while want:
            i = bisect.bisect_left(order, n)
            if i == len(order):
                want = fill(Use((), -(-want // (capacity // n))), n, capacity // n, want)
                continue
            room = order[i]
            u = rooms[room].pop()
            if not rooms[room]:
                del rooms[room]
                order.pop(i)
            want = fill(u, n, room // n, want)
    return [u for us in rooms.values() for u in us if u.lengths]


def places(uses: list[Use]) -> pd.DataFrame:
    """Where the pieces of each length go: of the pieces ranked ``rank`` to
    ``rank + count - 1`` among those of a length, the one ranked r goes to
    sequence ``sequence + r - rank`` at ``offset``."""
    rows, taken, sequence = [], {}, 0
    for u in uses:
        offset = 0
        for n in u.lengths:
            rank = taken.get(n, 0)
            rows.append((n, rank, u.count, sequence, offset))
            taken[n] = rank + u.count
            offset += n
        sequence += u.count
    return pd.DataFrame(rows, columns=["length", "rank", "count", "sequence", "offset"]).sort_values(
        ["length", "rank"], ignore_index=True)


def ranked(pieces: DataFrame, per_length: DataFrame) -> DataFrame:
    """``pieces`` with ``rank``: 0, 1, ... among the pieces of a length.
    ``per_length`` (n_length, n) counts them; a length gets as many salts as its
    count asks for."""
    salted = pieces.join(F.broadcast(per_length), F.col("length") == F.col("n_length")).withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "piece"), F.ceil(F.col("n") / RANKED_ROWS))).drop("n", "n_length")
    per = W.Window.partitionBy("length").orderBy("salt").rowsBetween(
        W.Window.unboundedPreceding, -1)
    before = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("length").alias("b_length"), F.col("salt").alias("b_salt"),
        F.coalesce(F.sum("n").over(per), F.lit(0)).alias("before"))
    own = W.Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    numbered = salted.withColumn("own", F.row_number().over(own) - 1)
    return numbered.join(before, (F.col("length") == F.col("b_length"))
                         & (F.col("salt") == F.col("b_salt"))).withColumn(
        "rank", F.col("before") + F.col("own")).drop("salt", "own", "before", "b_length", "b_salt")


def pack(pieces: DataFrame, capacity: int = CAPACITY, bins: int = BINS, parts: int = PARTS) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ids_crc32, ...) with sequence_id and
    offset.  ``pieces`` is read several times: pass a written table."""
    stages = Stages(pieces.sparkSession)
    per_length = stages.write(pieces.groupBy(F.col("length").alias("n_length")).agg(
        F.count(F.lit(1)).alias("n")), "lengths")  # at most ``capacity`` rows
    counts = {r["n_length"]: r["n"] for r in per_length.collect()}
    at = places(plan_packing(counts, capacity, bins, parts))
    lengths, ranks = at["length"].to_numpy(np.int64), at["rank"].to_numpy(np.int64)
    first, offsets = at["sequence"].to_numpy(np.int64), at["offset"].to_numpy(np.int64)
    wide = np.int64(1 << 44)  # ranks stay below: 2^44 pieces of one length

    @F.pandas_udf("sequence_id long, offset long")
    def seat(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        i = np.searchsorted(lengths * wide + ranks, length.to_numpy() * wide + rank.to_numpy(),
                            "right") - 1
        return pd.DataFrame({"sequence_id": first[i] + rank.to_numpy() - ranks[i],
                             "offset": offsets[i]})

    placed = ranked(pieces, per_length).withColumn("seat", seat("length", "rank"))
    return placed.select(*pieces.columns, "seat.sequence_id", "seat.offset")


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    pieces = Stages(docs.sparkSession).write(
        token_pieces(docs, tokenizer, id_col, text_col, capacity, end_id, with_ids), "pieces")
    return pack(pieces, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """Each sequence's ids end to end and its documents (one row a sequence, at
    most ``capacity`` ids), from pieces packed ``with_ids``."""
    order = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    held = packed.groupBy("sequence_id").agg(order.alias("p"))
    return held.select("sequence_id", F.array_join(
        F.transform("p", lambda x: F.hex(x["ids"])), "").alias("h"), "p").select(
        "sequence_id", F.unhex("h").alias("ids"), F.col("p.doc_id").alias("doc_ids"),
        F.col("p.offset").alias("offsets"), F.col("p.length").alias("lengths"))
