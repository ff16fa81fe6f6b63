"""Document fingerprints by a homomorphic multiset hash.

A document is the multiset of its paragraphs (lines without outer white space;
blank lines do not count).  Every paragraph is hashed into a wide vector of
``LANES`` entries of +1 or -1 (the bits of a SHAKE-128 stream), and a document's
hash is the sum of its paragraphs' vectors modulo 2^32 in every lane.  So the
order of paragraphs does not matter, a paragraph is inserted by adding and
deleted by subtracting its vector (``insert``, ``delete``), and two documents'
hashes add up to the hash of both.

Two different multisets agree in all lanes with negligible chance: for k
differing paragraphs about (2 / (pi k))^(LANES / 2).  The difference of two
hashes also tells how much differs: a lane's difference is a sum of k signs, so
its mean square estimates k, and ``likeness`` = 1 - k / (paragraphs of both) is
the shared part of the two multisets.

The column ``fingerprint`` is the hash in short: SHA-256 over the lanes and the
number of paragraphs.  Equal texts have equal fingerprints; texts that differ in
paragraph order or outer white space only have, too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm.common import id_long, id_text, text_of
from tabloom.session import Stages

LANES = 1024
#: Paragraph vectors that are unpacked at once.
BLOCK = 4096
#: Ranges of ids at most; beyond, a range holds more rows (it is read as a stream).
MOST_PARTS = 20_000


def paragraphs(text: str) -> list[bytes]:
    return [p for p in (line.strip() for line in text.encode("utf-8", "replace").split(b"\n")) if p]


def add_up(parts: list[bytes]) -> np.ndarray:
    """The hash of a list of paragraphs: lanes of uint32, then their number."""
    out = np.zeros(LANES + 1, np.uint32)
    for i in range(0, len(parts), BLOCK):
        some = parts[i:i + BLOCK]
        raw = b"".join(hashlib.shake_128(p).digest(LANES // 8) for p in some)
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(len(some), -1), axis=1)
        ones = bits.sum(axis=0, dtype=np.int32)
        out[:LANES] += (2 * ones - len(some)).astype(np.uint32)
    out[LANES] = len(parts)
    return out


def hash_text(text: str) -> np.ndarray:
    return add_up(paragraphs(text))


def insert(state: np.ndarray, paragraph: str) -> np.ndarray:
    """The hash after a text is added to the multiset."""
    return state + hash_text(paragraph)


def delete(state: np.ndarray, paragraph: str) -> np.ndarray:
    """The hash after a text that is in the multiset is taken out."""
    return state - hash_text(paragraph)


def short(state: np.ndarray) -> str:
    return hashlib.sha256(state.astype("<u4").tobytes()).hexdigest()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of paragraphs that two hashes have in common (0 to 1;
    exactly 1 for equal hashes, two empty multisets included)."""
    if np.array_equal(a, b):
        return 1.0
    gap = (a[:LANES] - b[:LANES]).view(np.int32).astype(np.float64)
    both = int(a[LANES]) + int(b[LANES])
    return float(np.clip(1 - (gap @ gap) / LANES / max(both, 1), 0, 1))


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n / 2) code points replaced by the first as
    many (or all) of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


FIELDS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")


def _row(doc, text: str, state: np.ndarray, after: str, after_state: np.ndarray,
         with_state: bool) -> tuple:
    new = edited(text, after)
    # the lines before the edit stay: delete the old end, insert the new one
    line = text.rfind("\n", 0, len(text) - len(text) // 2) + 1
    new_state = insert(delete(state, text[line:]), new[line:])
    out = (doc, len(text), hashlib.sha256(new.encode("utf-8", "replace")).hexdigest(), short(state),
           short(new_state), likeness(state, new_state), likeness(state, after_state))
    return (*out, state.astype("<u4").tobytes()) if with_state else out


def _pairs(rows: Iterable[tuple], with_state: bool = False) -> Iterator[tuple]:
    """Result rows of (part, copy, doc, text) rows in order.  A row is paired
    with the next one of its part; copies end a part and give no row."""
    held = None
    for part, copy, doc, text in rows:
        state = hash_text(text)
        if held is not None and held[0] == part and not held[1]:
            yield _row(held[2], held[3], held[4], text, state, with_state)
        held = (part, copy, doc, text, state)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 rows_per_part: int = 5_000, with_state: bool = False) -> DataFrame:
    """One row per row of ``docs``, each also compared with an edited version
    and with the next document in id order (after the last: the first).

    Documents are cut into id ranges at ids that exist; every range's first
    document is copied to the end of the range before (the first range's to the
    last), so each pair meets in one range and texts are shuffled once.
    ``with_state`` adds the hash itself (lanes and count, little-endian).

    Null texts are empty, a null id comes first; documents that share an id
    follow one another by text (equal rows give equal results).  A single
    document is its own next one.  An empty table gives an empty result."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    least = F.lit(-(1 << 63)).cast("long")  # stands for a null id in the order
    key = F.coalesce("doc_id", least)
    n = rows.count()
    schema = FIELDS + ", state binary" * with_state
    if not n:
        return spark.createDataFrame([], schema)
    parts = max(1, min(MOST_PARTS, -(-n // rows_per_part)))
    low, inner = rows.select(key.alias("k")).agg(F.min("k"), F.percentile_approx(
        "k", [i / parts for i in range(parts)], 20 * parts)).first()
    bounds = sorted({low, *inner})

    @F.pandas_udf("array<struct<part: int, copy: boolean>>")
    def ranges(keys: pd.Series) -> pd.Series:
        edge = np.array(bounds, np.int64)
        i = np.searchsorted(edge, keys.to_numpy(), "right") - 1
        first = edge[i] == keys.to_numpy()
        return pd.Series([[{"part": p, "copy": False}] + ([{"part": (p - 1) % len(edge), "copy": True}]
                                                          if f else []) for p, f in zip(i.tolist(), first)])

    dealt = rows.withColumn("k", key).withColumn("to", F.explode(ranges("k"))).select(
        "doc_id", "k", "text", F.col("to.part").alias("part"), F.col("to.copy").alias("copy"))
    ordered = dealt.repartitionByRange(len(bounds), "part").sortWithinPartitions("part", "copy", "k", "text")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def read() -> Iterator[tuple]:
            for pdf in batches:
                yield from zip(pdf["part"], pdf["copy"], pdf["doc_id"], pdf["text"])

        out = []
        for row in _pairs(read(), with_state):
            out.append(row)
            if len(out) == 1000:
                yield pd.DataFrame(out, columns=names)
                out = []
        if out:
            yield pd.DataFrame(out, columns=names)

    names = [f.split()[0] for f in schema.split(", ")]
    return id_long(ordered.select("part", "copy", id_text("doc_id"), "text").mapInPandas(
        compare, schema.replace("doc_id long", "doc_id string")))
