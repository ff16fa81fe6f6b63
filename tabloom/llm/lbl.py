"""Language-model scores from a log-bilinear model trained by noise contrast.

Every word of at least ``least`` training occurrences, and the end token, is an
outcome with its own vector q and bias b, so the model grows with the vocabulary;
rarer and unseen words share ``suffixes`` outcomes by a hash of their last three
bytes, which any word has.  A token's probability is

    exp(r(context) . q + b) / Z(context)  *  P(word | outcome)

with r the sum of two context vectors, each turned by its position's matrix, and Z
the sum over all outcomes.  The second factor is 1 for a word that is an outcome
and otherwise (c + 1) / (N + V + 1) over the rare words of its suffix; unseen words
share the last share.

Contexts are two word *classes*: the end token and the most frequent words are a
class each, all others share suffix classes.  Words beyond those have no context
vector of their own.

1. Context vectors and matrices come from a log-bilinear model over classes,
   trained by noise contrast in numpy (Adam); every pass takes all class triples
   with their weights and the noise in expectation, nothing is drawn.
2. Given them, the objective falls apart into one for each outcome.  It is noise
   contrast in the limit of many noise words (whose expectation is again taken
   over all contexts), needs a word's count and its sum of r over all its
   occurrences only, and is solved on the executors, batches of words at a time,
   with a ridge on q and one occurrence added.
3. Z is a sum over the outcomes for classes^2 contexts, partial sums on executors.

Everything gathered from the corpus covers all training rows.  What reaches the
driver is bounded: at most classes^3 triples, classes^2 sums, and the ``head`` most
frequent words with their vectors, which travel with the scoring tasks; all other
words of a text are looked up in the word table by a join.

Every text ends with one end token.  Null texts are empty; a null id counts as
the empty text in the split.  Repeated rows are scored alike, each counted.  With
no training row all counts are zero and both scores follow from that.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from functools import cached_property
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import ascii_words, groups_by_size, id_text, text_of
from tabloom.session import Stages

END = b""
HEAD = 1 << 17
FREQUENT = 63  # the end token is a class of its own besides
SUFFIXES = 64
DIM = 24
NOISE = 48
#: Passes over all class triples.
STEPS = 300
RATE = 0.02
#: Occurrences from which on a word is an outcome of its own.
LEAST = 5
RIDGE = 2.0
#: Words that are fitted at once, passes over them at most, and words whose Z is worked
#: out at once.
FIT_WORDS = 2048
FIT_STEPS = 100
NORM_WORDS = 256
#: Earlier moves that a word's next step is made from.
FIT_PAIRS = 5
#: Tokens whose vectors are looked up at once, few enough for the processor's cache.
SLICE = 1 << 13
#: Tokens with their contexts that a task holds before it hands them on.
HELD_TOKENS = 4_000_000
#: Words that it hands on at once.
SENT_WORDS = 1 << 15
SEED = 11
BLOCK = 1 << 20
#: Distinct words that a task holds before it hands them on, words whose class it
#: remembers, and triples that it holds before it counts them.
HELD_WORDS = 400_000
HELD_CLASSES = 32_768
HELD_TRIPLES = 1_000_000


def held_out(id_col: Column) -> Column:
    """Whether a row is kept from training: crc32 of its id as text, mod 7, is 2."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def suffix_class(word: bytes, suffixes: int = SUFFIXES) -> int:
    return zlib.crc32(word[-3:]) % suffixes


@dataclass
class Classes:
    """Own classes 0 .. len(frequent) (the end token is 0), then the suffixes."""

    frequent: list[bytes]
    suffixes: int

    @property
    def n(self) -> int:
        return 1 + len(self.frequent) + self.suffixes

    def lookup(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate([END, *self.frequent])}


class _Known(dict):
    """Places of known words; a word it lacks gets its suffix's place."""

    def __init__(self, words: dict[bytes, int], base: int, suffixes: int):
        super().__init__(words)
        self.base, self.suffixes, self.missed = base, suffixes, []

    def __missing__(self, word: bytes) -> int:
        self.missed.append(word)
        return self.base + zlib.crc32(word[-3:]) % self.suffixes


class _ClassOf(dict):
    """Classes of words; those worked out once are remembered."""

    def __init__(self, classes: Classes):
        super().__init__(classes.lookup())
        self.own, self.suffixes = len(self), classes.suffixes

    def __missing__(self, word: bytes) -> int:
        found = self[word] = self.own + zlib.crc32(word[-3:]) % self.suffixes
        return found


class _Places(dict):
    """Numbers of words in the order in which they come first."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self)
        return found


def word_counts(texts: DataFrame, stages: Stages) -> DataFrame:
    """(word binary, c long) over all rows of ``texts`` (text)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for pdf in batches:
            for text in pdf["text"]:
                seen.update(ascii_words(text))
                if len(seen) > HELD_WORDS:
                    yield pd.DataFrame({"word": list(seen), "c": list(seen.values())})
                    seen.clear()
            seen[END] += len(pdf)
        if seen:
            yield pd.DataFrame({"word": list(seen), "c": list(seen.values())})

    return stages.write(texts.mapInPandas(count, "word binary, c long").groupBy("word").agg(
        F.sum("c").alias("c")), "word-counts")


def head_words(counts: DataFrame, head: int) -> tuple[list[bytes], np.ndarray]:
    """The most frequent words, at most ``head`` of them, and their counts in
    descending order (ties by word).

    Words are counted by the level of their count (64 levels for each doubling,
    so a few thousand rows whatever the vocabulary); the words above the lowest
    level that still fits are the head.  No task sorts the vocabulary."""
    level = F.floor(F.log2("c") * 64)
    words = counts.where(F.length("word") > 0)
    sizes = sorted(((r["l"], r["n"]) for r in words.groupBy(level.alias("l")).agg(
        F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    least, held = None, 0
    for at, n in sizes:
        if held + n > head:
            break
        least, held = at, held + n
    if least is None:
        return [], np.zeros(0, np.int64)
    top = words.where(level >= least).toArrow()
    found, c = top["word"].to_pylist(), top["c"].to_numpy()
    order = sorted(range(len(found)), key=lambda i: (-c[i], found[i]))
    return [found[i] for i in order], c[order]


def _contexts(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two classes before each token; before a text stand end tokens.  Each
    text's last token is its end."""
    before = np.zeros(len(ids), ids.dtype)
    before[1:] = ids[:-1]
    first = np.zeros(len(ids), ids.dtype)
    first[2:] = ids[:-2]
    first[np.cumsum(lengths) - lengths] = 0
    return first, before


def _binary(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The bytes of ``values`` cut into pieces of the given lengths."""
    ends = np.append(0, np.cumsum(lengths)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(
        np.ascontiguousarray(values))])


def _unpacked(column: pa.Array, dtype: str) -> np.ndarray:
    """The numbers in all values of a binary column without nulls, end to end."""
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data or b"", np.uint8)[ends[0]:ends[-1]].view(dtype)


def class_triples(texts: DataFrame, classes: Classes) -> DataFrame:
    """(triple, n): triple = (first * K + second) * K + third.

    A task hands on one row for each context, with the third classes and their
    numbers; rows are small and added up as they come."""
    k = classes.n

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, size = _ClassOf(classes), [], 0
        n = np.zeros(k ** 3, np.int64)
        for batch in batches:
            for group in groups_by_size(batch.column("text").to_pylist(), BLOCK):
                if len(known) > HELD_CLASSES:
                    known = _ClassOf(classes)
                ids, lengths = _tokens(group, known)
                a, b = _contexts(ids, lengths)
                held.append((a * k + b) * k + ids)
                size += len(ids)
                if size > HELD_TRIPLES:
                    n += np.bincount(np.concatenate(held), minlength=len(n))
                    held, size = [], 0
        if size:
            n += np.bincount(np.concatenate(held), minlength=len(n))
        triple = np.flatnonzero(n)
        context, third = np.divmod(triple, k)
        filled, found = np.unique(context, return_counts=True)
        yield pa.RecordBatch.from_arrays([
            pa.array(filled, pa.int32()), _binary(third.astype("<i4"), 4 * found),
            _binary(n[triple].astype("<i8"), 8 * found)], ["context", "third", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k ** 3, np.int64)
        for batch in batches:
            third = _unpacked(batch.column("third"), "<i4")
            found = pc.binary_length(batch.column("third")).to_numpy() // 4
            context = np.repeat(batch.column("context").to_numpy().astype(np.int64), found)
            np.add.at(total, context * k + third, _unpacked(batch.column("n"), "<i8"))
        triple = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(triple, pa.int32()), pa.array(total[triple])], ["triple", "n"])

    rows = texts.mapInArrow(count, "context int, third binary, n binary")
    return rows.repartition("context").mapInArrow(add, "triple int, n long")


def _tokens(texts: list[str], known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Places of all tokens of several texts end to end, and their numbers."""
    get, parts, lengths = known.__getitem__, [], []
    for text in texts:
        words = ascii_words(text)
        parts.extend(map(get, words))
        parts.append(0)
        lengths.append(len(words) + 1)
    return np.array(parts, np.int32), np.array(lengths, np.int64)


@dataclass
class LogBilinear:
    """Vectors of the context classes, one matrix per position, output vectors
    and biases."""

    context: np.ndarray
    turn: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    def predicted(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return self.context[first] @ self.turn[0] + self.context[second] @ self.turn[1]

    def log10_table(self) -> np.ndarray:
        """log10 P(class | context) for all contexts, a product for every first
        class."""
        k = len(self.bias)
        out = np.empty((k * k, k), np.float32)
        for first in range(k):  # k contexts at a time
            s = self.predicted(np.full(k, first), np.arange(k)) @ self.output.T + self.bias
            s -= s.max(axis=1, keepdims=True)
            s -= np.log(np.exp(s).sum(axis=1, keepdims=True))
            out[first * k:(first + 1) * k] = s / np.log(10)
        return out.ravel()


def context_shares(triples: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """Counts of all contexts (first, second)."""
    return np.bincount(triples // k, counts, k * k).reshape(k, k)


def train_nce(triples: np.ndarray, counts: np.ndarray, k: int, dim: int = DIM, noise: int = NOISE,
              steps: int = STEPS, rate: float = RATE, seed: int = SEED) -> LogBilinear:
    """Noise-contrastive estimation on weighted class triples.

    Each triple's class should be told from ``noise`` noise classes by score -
    log(noise * noise probability), the model's scores being taken as
    log-probabilities without normalising them.  Every step takes all triples
    with their counts, and the expected noise of every context."""
    rng = np.random.default_rng(seed)
    unigram = 1.0 + np.bincount(triples % k, counts, k)
    unigram /= unigram.sum()
    params = [rng.normal(0, 0.1, (k, dim)), np.stack([np.eye(dim)] * 2) * 0.5,
              rng.normal(0, 0.1, (k, dim)), np.log(unigram)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    if not len(triples):
        return LogBilinear(*params)
    total = counts.sum(dtype=np.float64)
    data = np.zeros((k * k, k), np.float32)
    data.ravel()[triples] = counts / total
    fake = (data.sum(1)[:, None] * (noise * unigram)[None]).astype(np.float32)
    shift = np.log(noise * unigram)
    for step in range(1, steps + 1):
        context, turn, output, bias = params
        r = (context @ turn[0])[:, None] + (context @ turn[1])[None]
        r = r.reshape(k * k, dim).astype(np.float32)
        g = r @ output.T.astype(np.float32)
        g += (bias - shift).astype(np.float32)
        real = 1 / (1 + np.exp(-np.clip(g, -60, 60, out=g)))  # odds of being no noise
        g = (data + fake) * real - data                       # d loss / d score
        g_r = (g @ output.astype(np.float32)).reshape(k, k, dim).astype(np.float64)
        g_first, g_second = g_r.sum(1), g_r.sum(0)
        grads = (g_first @ turn[0].T + g_second @ turn[1].T,
                 np.stack([context.T @ g_first, context.T @ g_second]),
                 (g.T @ r).astype(np.float64), g.sum(0, dtype=np.float64))
        slow = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, g, (m, v) in zip(params, grads, moments):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= slow * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return LogBilinear(*params)


def uphill(grad: np.ndarray, moved: list[np.ndarray], turned: list[np.ndarray], size: np.ndarray) -> np.ndarray:
    """Quasi-Newton directions (limited-memory BFGS) of many problems at once, from
    each one's last moves, newest first, and what its gradient lost by them; ``size``
    is the curvature that is assumed without any.  Pairs of zeros count for nothing."""
    way, taken, scale = grad.copy(), [], np.ones((len(grad), 1))
    for i, (s, y) in enumerate(zip(moved, turned)):
        bend = np.einsum("nd,nd->n", s, y)
        share = np.divide(1.0, bend, out=np.zeros_like(bend), where=bend > 1e-12)
        if not i:
            bent = np.einsum("nd,nd->n", y, y / size)
            scale[:, 0] = np.divide(bend, bent, out=scale[:, 0], where=share > 0)
        taken.append((share, share * np.einsum("nd,nd->n", s, way)))
        way -= taken[-1][1][:, None] * y
    way *= scale / size
    for s, y, (share, took) in reversed(list(zip(moved, turned, taken))):
        way += (took - share * np.einsum("nd,nd->n", y, way))[:, None] * s
    return way


@dataclass
class WordSpace:
    """What the outcomes are fitted to: r(a, b) = first[a] + second[b], with mean
    zero and uncorrelated entries (of variances ``spread``) over the contexts, whose
    shares are ``shares``; ``total`` training tokens."""

    first: np.ndarray
    second: np.ndarray
    shares: np.ndarray
    spread: np.ndarray
    total: float

    @classmethod
    def of(cls, model: LogBilinear, contexts: np.ndarray) -> WordSpace:
        k, total = len(contexts), float(contexts.sum())
        p = contexts / total if total else np.full((k, k), 1 / k ** 2)
        u, v = model.context @ model.turn[0], model.context @ model.turn[1]
        pa, pb = p.sum(1), p.sum(0)
        u, v = u - pa @ u, v - pb @ v
        cross = u.T @ p @ v
        spread, axes = np.linalg.eigh(u.T @ (pa[:, None] * u) + v.T @ (pb[:, None] * v) + cross + cross.T)
        scale = 1 / np.sqrt(max(spread.mean(), 1e-9))
        return cls(u @ axes * scale, v @ axes * scale, p, np.maximum(spread, 0) * scale ** 2, total)

    def norms(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Means of exp(q . r) and of exp(q . r) r over all contexts, for as many q at
        a time as the processor's cache holds."""
        z, mean = np.empty(len(q)), np.empty(q.shape)
        for i in range(0, len(q), NORM_WORDS):
            part = slice(i, i + NORM_WORDS)
            x, y = q[part] @ self.first.T, q[part] @ self.second.T
            np.exp(x, out=x)
            np.exp(y, out=y)
            xw, yw = y @ self.shares.T, x @ self.shares
            xw *= x
            yw *= y
            z[part], mean[part] = xw.sum(1), xw @ self.first + yw @ self.second
        return z, mean

    def fit(self, counts: np.ndarray, sums: np.ndarray, ridge: float = RIDGE, steps: int = FIT_STEPS
            ) -> tuple[np.ndarray, np.ndarray]:
        """Vectors (float32) and biases of outcomes from their counts and their
        sums of r: the largest q . sum - n log Z(q) - ridge / 2 |q|^2, where Z is
        the mean of exp(q . r) over all contexts and n the count plus one.

        All outcomes take quasi-Newton steps together; one whose objective would
        fall goes less far, and those with a gradient of about zero leave."""
        n_all = counts.astype(np.float64) + 1
        solved, norms = np.zeros(sums.shape, np.float32), np.ones(len(n_all))
        live, n = np.arange(len(n_all)), n_all
        size = n[:, None] * self.spread + ridge
        best, grad, way = (np.zeros(sums.shape) for _ in range(3))
        moved, turned = ([np.zeros(sums.shape)] * FIT_PAIRS for _ in range(2))
        value, norm, pace = np.full(len(n), -np.inf), np.ones(len(n)), np.ones(len(n))
        with np.errstate(over="ignore", invalid="ignore"):
            for _ in range(steps):
                if not len(live):
                    break
                q = best + pace[:, None] * way
                z, mean = self.norms(q)
                f = np.einsum("nd,nd->n", q, sums - ridge / 2 * q) - n * np.log(z)
                found = sums - (n / z)[:, None] * mean - ridge * q
                up = f >= value
                rise = up[:, None]
                moved = [np.where(rise, q - best, 0), *moved[:-1]]
                turned = [np.where(rise, grad - found, 0), *turned[:-1]]
                best, grad = np.where(rise, q, best), np.where(rise, found, grad)
                value, norm = np.where(up, f, value), np.where(up, z, norm)
                pace = np.where(up, 1, pace * 0.4)
                more = ((grad ** 2 / size).sum(1) > 1e-4) & (pace > 1e-6)
                if more.sum() < 0.9 * len(live):
                    solved[live[~more]], norms[live[~more]] = best[~more], norm[~more]
                    live, n, size, sums, best, grad, value, norm, pace = (
                        v[more] for v in (live, n, size, sums, best, grad, value, norm, pace))
                    moved, turned = [v[more] for v in moved], [v[more] for v in turned]
                way = uphill(grad, moved, turned, size)
        solved[live], norms[live] = best, norm
        return solved, np.log(n_all / (self.total + 1)) - np.log(norms)

    @cached_property
    def table(self) -> np.ndarray:
        return (self.first[:, None] + self.second[None]).reshape(-1, self.first.shape[1])

    def of_contexts(self, context: np.ndarray) -> np.ndarray:
        """r of contexts a * classes + b."""
        return self.table.take(context, axis=0)

    def sum_of(self, context: np.ndarray) -> np.ndarray:
        k = len(self.first)
        a, b = np.divmod(context, k)
        return np.bincount(a, minlength=k) @ self.first + np.bincount(b, minlength=k) @ self.second

    def masses(self, vectors: np.ndarray, biases: np.ndarray) -> np.ndarray:
        """Sum of exp(score) over the given outcomes for every context."""
        q = vectors.astype(np.float64)
        return (np.exp(q @ self.first.T) * np.exp(biases)[:, None]).T @ np.exp(q @ self.second.T)

    def scores(self, a: np.ndarray, b: np.ndarray, vectors: np.ndarray, biases: np.ndarray) -> np.ndarray:
        return np.einsum("nd,nd->n", self.of_contexts(a * len(self.first) + b), vectors) + biases


def word_contexts(texts: DataFrame, classes: Classes, space: WordSpace) -> DataFrame:
    """(word, c, listed, total): a row for a word of a task, with its count there and
    the contexts of all its occurrences (int32 each), or from where that is
    shorter, their sum of r (float64).  The other column is empty."""
    own, suffixes, k, dim = classes.lookup(), classes.suffixes, classes.n, space.first.shape[1]
    names = ["word", "c", "listed", "total"]

    def parts_of(words: list[bytes], held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys = np.concatenate(held)  # place * k^2 + context; every place occurs
        keys.sort()
        ids, context = np.divmod(keys, k * k)
        c = np.bincount(ids, minlength=len(words))
        ends = np.cumsum(c)
        long = c > 2 * dim
        sums = np.array([space.sum_of(context[e - n:e]) for e, n in zip(ends[long].tolist(), c[long].tolist())])
        rows = pa.RecordBatch.from_arrays([
            pa.array(words, pa.binary()), pa.array(c, pa.int64()),
            _binary(context[~long[ids]].astype("<i4"), np.where(long, 0, 4 * c)),
            _binary(sums.astype("<f8"), np.where(long, 8 * dim, 0))], names)
        for i in range(0, len(words), SENT_WORDS):
            yield rows.slice(i, SENT_WORDS)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, class_of, held, size = _Places(), [], [], 0
        for batch in batches:
            for group in groups_by_size(batch.column("text").to_pylist(), BLOCK):
                tokens, lengths = [], []
                for text in group:
                    words = ascii_words(text)
                    tokens.extend(words)
                    tokens.append(END)
                    lengths.append(len(words) + 1)
                ids = np.fromiter(map(place.__getitem__, tokens), np.int64, len(tokens))
                new = list(islice(reversed(place), len(place) - len(class_of)))  # the newest first
                class_of.extend(own[w] if w in own else len(own) + suffix_class(w, suffixes) for w in reversed(new))
                a, b = _contexts(np.array(class_of, np.int32)[ids], np.array(lengths, np.int64))
                held.append(ids * (k * k) + (a * np.int32(k) + b))
                size += len(ids)
                if size > HELD_TOKENS:
                    yield from parts_of(list(place), held)
                    place, class_of, held, size = _Places(), [], [], 0
        if size:
            yield from parts_of(list(place), held)

    return texts.mapInArrow(add, "word binary, c long, listed binary, total binary")


def _sums(batch: pa.RecordBatch, space: WordSpace) -> np.ndarray:
    """Sums of r of the rows of ``word_contexts``."""
    out = np.zeros((batch.num_rows, space.first.shape[1]))
    listed, total = (batch.column(c) for c in ("listed", "total"))
    summed = np.flatnonzero(pc.binary_length(total).to_numpy())
    out[summed] = _unpacked(total, "<f8").reshape(-1, out.shape[1])
    context = _unpacked(listed, "<i4")
    owner = np.repeat(np.arange(batch.num_rows), pc.binary_length(listed).to_numpy() // 4)
    for i in range(0, len(context), SLICE):
        who = owner[i:i + SLICE]
        heads = np.flatnonzero(np.diff(who, prepend=-1))
        out[who[heads]] += np.add.reduceat(space.of_contexts(context[i:i + SLICE]), heads, axis=0)
    return out


def sums_of_words(batches: Iterator[pa.RecordBatch], space: WordSpace
                  ) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """Words, their counts and sums of r from rows of ``word_contexts`` in the order
    of their words.  The last word of a batch waits for the next one."""
    words, c, sums = [], np.zeros(0, np.int64), np.zeros((0, space.first.shape[1]))
    for batch in batches:
        if not batch.num_rows:
            continue
        word = batch.column("word")
        heads = np.flatnonzero(np.append(True, pc.not_equal(word[1:], word[:-1]).to_numpy(zero_copy_only=False)))
        found = word.take(pa.array(heads)).to_pylist()
        n, m = (np.add.reduceat(v, heads, axis=0) for v in (batch.column("c").to_numpy(), _sums(batch, space)))
        if words and words[0] == found[0]:
            n[0] += c[0]
            m[0] += sums[0]
        else:
            found, n, m = words + found, np.append(c, n), np.concatenate([sums, m])
        yield found[:-1], n[:-1], m[:-1]
        words, c, sums = found[-1:], n[-1:], m[-1:]
    yield words, c, sums


def fit_words(contexts: DataFrame, space: WordSpace, least: int, suffixes: int) -> DataFrame:
    """(word, c, q, bias, s, m).  Rows of words: q (float32 bytes) and bias are null
    for words below ``least`` occurrences and for the end token.  Rows of suffixes
    s, a task's each, and of the end token under s = ``suffixes``: m has the count, the
    words and the sum of r of the suffix's rare words."""
    dim = space.first.shape[1]
    schema = pa.schema([("word", pa.binary()), ("c", pa.int64()), ("q", pa.binary()), ("bias", pa.float64()),
                        ("s", pa.int32()), ("m", pa.list_(pa.float64()))])

    def batch_of(n: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns
                                           else pa.nulls(n, f.type) for f in schema], schema=schema)

    def fitted(words: list[bytes], c: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        vectors, biases = space.fit(c, sums)
        return batch_of(len(words), word=words, c=c, bias=biases,
                        q=[v.astype("<f4").tobytes() for v in vectors])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = np.zeros((suffixes + 1, 2 + dim))
        words, c, sums = [], np.zeros(0, np.int64), np.zeros((0, dim))
        for found, n, m in sums_of_words(batches, space):
            own = (n >= least) & np.array([len(w) > 0 for w in found], bool)
            rare = [found[i] for i in np.flatnonzero(~own).tolist()]
            if rare:
                s = np.array([suffix_class(w, suffixes) if w else suffixes for w in rare], np.int64)
                np.add.at(shared, s, np.column_stack([n[~own], np.ones(len(rare)), m[~own]]))
                yield batch_of(len(rare), word=rare, c=n[~own])
            words += [found[i] for i in np.flatnonzero(own).tolist()]
            c, sums = np.append(c, n[own]), np.concatenate([sums, m[own]])
            while len(words) >= FIT_WORDS:
                yield fitted(words[:FIT_WORDS], c[:FIT_WORDS], sums[:FIT_WORDS])
                words, c, sums = words[FIT_WORDS:], c[FIT_WORDS:], sums[FIT_WORDS:]
        if words:
            yield fitted(words, c, sums)
        filled = np.flatnonzero(shared[:, 1])
        yield batch_of(len(filled), s=filled, m=list(shared[filled]))

    return contexts.repartition("word").sortWithinPartitions("word").mapInArrow(
        fit, "word binary, c long, q binary, bias double, s int, m array<double>")


def _vectors(q, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(q), "<f4").reshape(-1, dim)


def context_masses(fitted: DataFrame, space: WordSpace) -> np.ndarray:
    """Sum of exp(score) over all words with a vector, for every context."""
    k, dim = space.first.shape

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mass = np.zeros((k, k))
        for pdf in batches:
            mass += space.masses(_vectors(pdf["q"], dim), pdf["bias"].to_numpy())
        yield pd.DataFrame({"context": np.arange(k * k), "z": mass.ravel()})

    rows = fitted.where("q is not null").select("q", "bias").mapInPandas(add, "context int, z double")
    found = rows.groupBy("context").agg(F.sum("z").alias("z")).toArrow()
    mass = np.zeros(k * k)
    mass[found["context"].to_numpy()] = found["z"].to_numpy()
    return mass.reshape(k, k)


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD,
                frequent: int = FREQUENT, suffixes: int = SUFFIXES, least: int = LEAST, **training) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score (add-one unigram) and score (the model), both
    log10 probabilities of the whole text."""
    spark, stages = docs.sparkSession, Stages(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"),
                       held_out(F.col(id_col)).alias("held_out"))
    train = rows.where("not held_out").select("text")
    counts = word_counts(train, stages)
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    words, top_counts = head_words(counts, head)
    stages.drop(counts)
    classes = Classes(words[:frequent], suffixes)
    k = classes.n

    found = class_triples(train, classes).toArrow()  # at most k^3 rows, 12 bytes each
    triples, counted = found["triple"].to_numpy(), found["n"].to_numpy()
    del found
    order = np.argsort(triples)
    triples, counted = triples[order], counted[order]
    space = WordSpace.of(train_nce(triples, counted, k, **training), context_shares(triples, counted, k))
    del triples, counted, order
    dim = space.first.shape[1]

    table = stages.write(fit_words(word_contexts(train, classes, space), space, least, suffixes), "words")
    fitted = table.where("s is null").select("word", "c", "q", "bias")
    # the end token and the words without a vector, which share their suffix's outcome
    shared = np.zeros((suffixes + 1, 2 + dim))
    for r in table.where("s is not null").groupBy("s").agg(*(F.sum(F.col("m")[i]) for i in range(2 + dim))).collect():
        shared[r["s"]] = r[1:]
    shared_c, shared_v, shared_m = shared[:, 0], shared[:, 1], shared[:, 2:]
    share = np.log10(shared_c + shared_v + 1)[:suffixes]
    shared_q, shared_b = space.fit(shared_c, shared_m)
    log_mass = np.log(context_masses(fitted, space) + space.masses(shared_q, shared_b))

    # outcomes: the suffixes, the end token, the head words that have a vector
    top = fitted.where(F.col("q").isNotNull() & (F.col("c") >= int(min(top_counts, default=0)))).select(
        "word", "q", "bias").toArrow() if words else None
    own, own_q, own_b = {}, np.zeros((0, dim), np.float32), np.zeros(0)
    if top is not None and top.num_rows:
        own = {w: suffixes + 1 + i for i, w in enumerate(top["word"].to_pylist())}
        own_q, own_b = _vectors(top["q"].to_pylist(), dim), top["bias"].to_numpy()
    del top
    vectors, biases = np.concatenate([shared_q, own_q]), np.append(shared_b, own_b)

    # places: the end token, the head words, then one per suffix for all others
    ends = int(shared_c[suffixes])
    words = [END, *words]
    n_own = 1 + len(classes.frequent)
    suffix_of = np.array([suffix_class(w, suffixes) for w in words] + list(range(suffixes)))
    place = np.arange(len(suffix_of))
    class_of = np.where(place < n_own, place, n_own + suffix_of).astype(np.int32)
    outcome = np.array([suffixes] + [own.get(w, -1) for w in words[1:]] + [-1] * suffixes)
    seen = np.append(ends, top_counts).astype(np.float64)
    log_count = np.append(np.log10(seen + 1), np.zeros(suffixes))
    within = np.where(outcome >= 0, 0.0, log_count - share[suffix_of])
    outcome = np.where(outcome >= 0, outcome, suffix_of)
    listed_n = len(words)
    sent = spark.sparkContext.broadcast((words, class_of, outcome, log_count, within, vectors, biases, asdict(space),
                                         log_mass, share, bool(ends)))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, class_of, outcome, log_count, within, vectors, biases, held, log_mass, _, any_end = sent.value
        space = WordSpace(**held)
        known = _Known({w: i for i, w in enumerate(words)}, listed_n, suffixes)
        for pdf in batches:
            done = 0
            for group in groups_by_size(pdf["text"], BLOCK):
                ids, lengths, rare = [], [], []
                get = known.__getitem__
                for text in group:
                    found = ascii_words(text)
                    ids.extend(map(get, found))
                    ids.append(0)
                    lengths.append(len(found) + 1)
                    rare.append(known.missed)
                    known.missed = []
                ids, lengths = np.array(ids, np.int32), np.array(lengths, np.int64)
                at = np.cumsum(lengths) - lengths
                a, b = _contexts(class_of[ids].astype(np.int64), lengths)
                model = within[ids]
                for i in range(0, len(ids), SLICE):
                    part = slice(i, i + SLICE)
                    out = outcome[ids[part]]
                    model[part] += (space.scores(a[part], b[part], vectors.take(out, axis=0), biases[out])
                                    - log_mass[a[part], b[part]]) / np.log(10)
                seen = ids < listed_n if any_end else (ids < listed_n) & (ids > 0)
                missed = ids >= listed_n
                where = np.split((a * k + b)[missed], np.cumsum([len(r) for r in rare])[:-1])
                yield pd.DataFrame({
                    "row": pdf["row"].to_numpy()[done:done + len(group)],
                    "doc_id": pdf["doc_id"].to_numpy()[done:done + len(group)],
                    "held_out": pdf["held_out"].to_numpy()[done:done + len(group)],
                    "n_tokens": lengths,
                    "n_seen": np.add.reduceat(seen.astype(np.int64), at),
                    "counted": np.add.reduceat(log_count[ids], at),
                    "modelled": np.add.reduceat(model, at),
                    "rare": rare, "places": where})
                done += len(group)

    def gain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """What a word found in the table has above an unseen one."""
        _, _, _, _, _, vectors, biases, held, _, share, _ = sent.value
        space = WordSpace(**held)
        for pdf in batches:
            more = np.log10(pdf["c"].to_numpy() + 1.0)
            own = np.flatnonzero(pdf["q"].notna().to_numpy())
            a, b = np.divmod(pdf["place"].to_numpy()[own].astype(np.int64), k)
            s = np.array([suffix_class(w, suffixes) for w in pdf["word"].iloc[own]], np.int64)
            better = (space.scores(a, b, _vectors(pdf["q"].iloc[own], dim), pdf["bias"].to_numpy()[own])
                      - space.scores(a, b, vectors[s], biases[s])) / np.log(10) + share[s]
            modelled = more.copy()
            modelled[own] = better
            yield pd.DataFrame({"row": pdf["row"], "counted": more, "modelled": modelled})

    keyed = rows.withColumn("row", F.monotonically_increasing_id()).withColumn("doc_id", id_text("doc_id"))
    scored = stages.write(keyed.mapInPandas(
        score, "row long, doc_id string, held_out boolean, n_tokens long, n_seen long, "
        "counted double, modelled double, rare array<binary>, places array<int>"), "scored")
    occurrences = scored.select("row", F.explode(F.arrays_zip("rare", "places")).alias("o")).select(
        "row", F.col("o.rare").alias("word"), F.col("o.places").alias("place"))
    others = occurrences.join(fitted, "word").select("row", "word", "place", "c", "q", "bias").mapInPandas(
        gain, "row long, counted double, modelled double").groupBy("row").agg(
        F.count(F.lit(1)).alias("rare_known"), F.sum("counted").alias("rare_log"),
        F.sum("modelled").alias("rare_modelled")).withColumnRenamed("row", "rare_row")
    unit = float(np.log10(total["n"] + total["v"] + 1))
    full = scored.drop("rare", "places").join(others, F.col("row") == F.col("rare_row"), "left")
    return full.select(
        F.col("doc_id").cast("long").alias("doc_id"), "held_out", "n_tokens",
        (F.col("n_seen") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(total["n"]).cast("long").alias("train_tokens"),
        (F.col("counted") + F.coalesce("rare_log", F.lit(0.0)) - F.col("n_tokens") * F.lit(unit)).alias("base_score"),
        (F.col("modelled") + F.coalesce("rare_modelled", F.lit(0.0))).alias("score"))
