"""Toxicity categories by a chain of linear classifiers.

A chain scores its categories in order: the model of a category is a logistic
regression on word features and on the probabilities of the categories before
it.  While fitting, those earlier probabilities are out-of-fold predictions,
so a later model never sees how well an earlier one remembers its own rows.

Fitting reads a bounded sample of the labelled rows (``sample_rows``: the ids with
the smallest hashes, then the different texts under them, so that an id with very
many rows counts no more than its texts and never passes the bound): word features are counted by a grouped
aggregate, the strongest per category by chi-square become the vocabulary, and
one presence bit per row and feature goes to the driver (at most
``sample_rows`` * ``features`` * categories / 8 bytes), where Newton steps solve
each regression.  Scoring reads whole texts of all rows in one map over the
scan; only the vocabulary and the weights travel.

Nulls: a null text is empty (all its features are absent); label rows with a
null id or category are not used; an id labelled more than once takes each
category's largest label.  A category whose labels are all alike gets a
constant probability, and without any labelled row every probability is 0.
Repeated rows get equal scores.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import free_name, text_of
from tabloom.session import Stages

SAMPLE_ROWS = 16_384
FEATURES = 192
MIN_ROWS = 5
FOLDS = 5
RIDGE = 1.0
PREFIXES = (4, 5)
PUNCTUATION = string.punctuation
#: Words whose features a task remembers; the memory is emptied when full.
REMEMBERED = 200_000


def word_features(word: str) -> list[str]:
    """Features of one lower-case word: the word without outer punctuation,
    its first letters (inflected forms share them) and its trailing
    punctuation."""
    core = word.strip(PUNCTUATION)
    out = [f"w {core}"] if core else []
    out += [f"p {core[:n]}" for n in PREFIXES if len(core) > n]
    tail = word[len(word.rstrip(PUNCTUATION)):]
    return [*out, f"t {tail[:3]}"] if tail else out


@dataclass
class ChainModel:
    """Categories in chain order, the feature names, and one weight vector per
    category: a weight per feature, one per earlier category, the intercept."""

    categories: list[str]
    features: list[str]
    weights: list[np.ndarray]

    def scores(self, bits: np.ndarray) -> np.ndarray:
        """Probabilities (rows x categories) for presence bits (rows x features)."""
        x = bits.astype(np.float64)
        done = np.empty((len(x), 0))
        for w in self.weights:
            z = np.hstack([x, done]) @ w[:-1] + w[-1]
            done = np.hstack([done, _sigmoid(z)[:, None]])
        return done

    def score_column(self, text: Column) -> Column:
        """A struct of one double per category, for a text column."""
        scores, names, features = self.scores, self.categories, self.features

        @F.pandas_udf(", ".join(f"`{c}` double" for c in names))
        def chain(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            reader = _Presence(features)
            for texts in batches:
                yield pd.DataFrame(scores(reader.bits(texts)), columns=names)

        return chain(text_of(text))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


class _Presence:
    """Presence bits of a fixed vocabulary, word by word."""

    def __init__(self, features: Sequence[str]):
        self.place = {f: 1 << i for i, f in enumerate(features)}
        self.n = len(features)
        self.known: dict[str, int] = {}

    def _mask(self, word: str) -> int:
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        mask = 0
        for f in word_features(word):
            mask |= self.place.get(f, 0)
        self.known[word] = mask
        return mask

    def masks(self, texts) -> list[bytes]:
        width, out = (self.n + 7) // 8, []
        for text in texts:
            mask = 0
            for word in set(text.lower().split()):
                found = self.known.get(word)
                mask |= self._mask(word) if found is None else found
            out.append(mask.to_bytes(width, "little"))
        return out

    def bits(self, texts) -> np.ndarray:
        raw = b"".join(self.masks(texts))
        packed = np.frombuffer(raw, np.uint8).reshape(len(texts), (self.n + 7) // 8)
        return np.unpackbits(packed, axis=1, count=self.n, bitorder="little")


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, steps: int = 25) -> np.ndarray:
    """Ridge-penalised logistic regression by damped Newton steps; the last
    weight is the (unpenalised) intercept."""
    n, k = x.shape
    w = np.zeros(k + 1)
    w[-1] = np.log((y.sum() + 0.5) / (n - y.sum() + 0.5))
    if not n or y.min() == y.max() or not k:
        return w
    xb = np.hstack([x, np.ones((n, 1))])
    pen = np.append(np.full(k, ridge), 0.0)

    def loss(v: np.ndarray) -> float:
        z = xb @ v
        return float(np.logaddexp(0, z).sum() - y @ z + 0.5 * pen @ (v * v))

    now = loss(w)
    for _ in range(steps):
        p = _sigmoid(xb @ w)
        grad = xb.T @ (p - y) + pen * w
        hess = (xb * (p * (1 - p))[:, None]).T @ xb + np.diag(pen + 1e-9)
        step, t = np.linalg.solve(hess, grad), 1.0
        while t > 1e-4 and loss(w - t * step) > now:
            t /= 2
        w = w - t * step
        last, now = now, loss(w)
        if last - now <= 1e-6 * (1 + abs(now)):
            break
    return w


def fit_weights(bits: np.ndarray, labels: np.ndarray, ids: Sequence[int],
                folds: int = FOLDS, ridge: float = RIDGE) -> list[np.ndarray]:
    """Weights of the chain: the model of each category is fitted on the bits
    and on the out-of-fold probabilities of the categories before it."""
    fold = np.array([zlib.crc32(str(i).encode()) % folds for i in ids], dtype=np.int64)
    x, weights = bits.astype(np.float64), []
    for j in range(labels.shape[1]):
        y = labels[:, j].astype(np.float64)
        weights.append(fit_logistic(x, y, ridge))
        if j + 1 == labels.shape[1]:
            break
        held = np.zeros(len(x))
        for f in range(folds):
            out = fold == f
            if out.any():
                w = fit_logistic(x[~out], y[~out], ridge) if (~out).any() else weights[-1]
                held[out] = _sigmoid(x[out] @ w[:-1] + w[-1])
        x = np.hstack([x, held[:, None]])
    return weights


def fit_chain(docs: DataFrame, labels: DataFrame, categories: Sequence[str],
              id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS,
              features: int = FEATURES, min_rows: int = MIN_ROWS, folds: int = FOLDS,
              ridge: float = RIDGE) -> ChainModel:
    """Fit a chain over ``categories`` (0/1 columns of ``labels``, in order)."""
    cats, spark = list(categories), docs.sparkSession
    known = labels.dropna(subset=[id_col, *cats]).groupBy(F.col(id_col).alias("id")).agg(
        *[F.max(F.col(c).cast("int")).alias(f"c{j}") for j, c in enumerate(cats)])
    sample = known.orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    names = [f"c{j}" for j in range(len(cats))]
    stages = Stages(spark)
    # <= sample_rows ids, then <= sample_rows different (id, text)
    labelled = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).join(
        F.broadcast(sample), "id").withColumn("digest", F.md5("text"))
    taken = stages.write(labelled.select("id", "digest").distinct().orderBy(
        F.xxhash64("id", "digest"), "id", "digest").limit(sample_rows), "toxicity-taken")
    rows = stages.write(labelled.join(F.broadcast(taken), ["id", "digest"]).groupBy(
        "id", "digest", *names).agg(F.first("text").alias("text")).drop("digest"), "toxicity-sample")
    stages.drop(taken)
    spread = rows.repartition(spark.sparkContext.defaultParallelism)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            seen: dict[str, np.ndarray] = {}
            known: dict[str, list[str]] = {}
            for text, *y in zip(pdf["text"], *(pdf[c] for c in names)):
                add, found = np.array([1, *y], np.int64), set()
                for word in set(text.lower().split()):
                    got = known.get(word)
                    if got is None:
                        got = known[word] = word_features(word)
                    found.update(got)
                for f in found:
                    if f in seen:
                        seen[f] += add
                    else:
                        seen[f] = add.copy()
            if seen:
                out = pd.DataFrame(np.array(list(seen.values())), columns=["n", *names])
                out.insert(0, "feature", list(seen))
                yield out

    total = rows.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in names]).first()
    if not total["n"]:
        return ChainModel(cats, [], [np.array([0.0] * j + [-np.inf]) for j in range(len(cats))])
    counts = stages.write(
        spread.mapInPandas(count, "feature string, n long, " + ", ".join(f"{c} long" for c in names))
        .groupBy("feature").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names])
        .where(F.col("n") >= min_rows), "toxicity-features")
    vocabulary: set[str] = set()
    for c in names:
        pos, neg = max(total[c], 1), max(total["n"] - total[c], 1)
        gap = F.col(c) / pos - (F.col("n") - F.col(c)) / neg
        rate = F.col("n") / F.lit(total["n"])
        strength = gap * gap / (rate * (1 - rate) + F.lit(1e-9))
        best = counts.orderBy(strength.desc(), "feature").limit(features).select("feature")
        vocabulary.update(r[0] for r in best.collect())
    chosen = sorted(vocabulary)

    def present(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = _Presence(chosen)
        for pdf in batches:
            yield pdf[["id", *names]].assign(bits=reader.masks(pdf["text"]))

    seen = spread.mapInPandas(present, "id long, " + ", ".join(f"{c} int" for c in names)
                              + ", bits binary").toPandas().sort_values(["id", "bits"])
    stages.drop(rows, counts)
    packed = np.frombuffer(b"".join(seen["bits"]), np.uint8).reshape(len(seen), -1)
    bits = np.unpackbits(packed, axis=1, count=len(chosen), bitorder="little") if chosen \
        else np.zeros((len(seen), 0), np.uint8)
    return ChainModel(cats, chosen, fit_weights(bits, seen[names].to_numpy(), list(seen["id"]),
                                                folds, ridge))


def label_categories(labels: DataFrame) -> DataFrame:
    """The categories of the shared label table, in chain order: ``low_quality``
    (quality 0) and ``toxic``."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"),
                         F.col("toxic").alias("toxic"))


CATEGORIES = ("low_quality", "toxic")


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", threshold: float = 0.5, **fit) -> DataFrame:
    """doc_id, low_quality and toxic (probabilities) and is_toxic for every row."""
    model = fit_chain(docs, label_categories(labels), CATEGORIES, id_col, text_col, **fit)
    scored = docs.select(F.col(id_col).alias("doc_id"),
                         model.score_column(F.col(text_col)).alias("p"))
    return scored.select("doc_id", "p.low_quality", "p.toxic",
                         (F.col("p.toxic") >= threshold).alias("is_toxic"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
               text_col: str = "text", threshold: float = 0.5, **fit) -> DataFrame:
    """``docs`` without the rows whose toxic probability reaches ``threshold``."""
    model = fit_chain(docs, label_categories(labels), CATEGORIES, id_col, text_col, **fit)
    own = free_name(docs, "toxicity")
    scored = docs.withColumn(own, model.score_column(docs[text_col])["toxic"])
    return scored.where(F.col(own) < threshold).drop(own)
