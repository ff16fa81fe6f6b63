"""Near-duplicate classes by SimHash and covering locality-sensitive hashing.

Fingerprints are computed where the text is read (one map over the scan, no
shuffle).  Equal fingerprints collapse to one class before anything is
compared.  Classes within ``radius`` bits are found through 2^(radius+1) - 1
bit masks (Pagh's covering code): bit i carries a vector phi(i) over GF(2) of
radius + 1 entries, and the mask of a vector v keeps the bits with
<phi(i), v> = 1.  The phi of at most ``radius`` differing bits cannot span the
whole space, so some v is orthogonal to all of them and its mask leaves both
fingerprints equal: no pair within the radius is missed.

Buckets of at most ``SMALL_BUCKET`` fingerprints are compared pair by pair
inside the join.  Larger ones are linked through midpoints instead (two
fingerprints at most two bits apart share a neighbour at most one bit away
from both), which needs rows in proportion to the bucket and loses no link.

Null and blank texts have fingerprint zero and are linked like any other; a
null id never names a class (a class of null ids only has a null name).
Repeated rows get the same class.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import ascii_words, free_name, text_of
from tabloom.llm.components import components
from tabloom.session import Stages

SMALL_BUCKET = 32
#: Shingle hashes whose bits are counted at once (a block of 64 bytes each).
BLOCK = 1 << 16


def simhash_text(text: str, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of one text; see ``fingerprint``."""
    import xxhash

    words = ascii_words(text)
    if not words:
        return 0
    size = min(shingle, len(words))
    grams = zip(*(words[j:] for j in range(size)))
    digest, join = xxhash.xxh64_intdigest, b" ".join
    n, ones = len(words) - size + 1, np.zeros(64, np.int64)
    for done in range(0, n, BLOCK):
        m = min(BLOCK, n - done)
        h = np.fromiter((digest(join(g), seed) for g, _ in zip(grams, range(m))), "<u8", m)
        bits = np.unpackbits(h.view(np.uint8).reshape(m, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int = 3, seed: int = 42) -> Column:
    """SimHash as a (signed) 64-bit long: bit b is set when it is set in more
    than half of the XXH64 hashes of the text's word shingles, repeats
    included; fewer words than a shingle count as one shingle."""

    @F.pandas_udf("long")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.fromiter((simhash_text(t, shingle, seed) for t in texts),
                                        np.uint64, len(texts)).view(np.int64))

    return prints(text_of(text))


def covering_masks(radius: int, bits: int = 64) -> list[int]:
    """The masks, as signed longs: one for each non-zero v in GF(2)^(radius+1).
    phi runs over the non-zero vectors in turn, so each mask keeps about
    2^radius / (2^(radius+1) - 1) of the bits."""
    dim = 2 ** (radius + 1) - 1
    masks = []
    for v in range(1, dim + 1):
        mask = sum(1 << i for i in range(bits) if ((i % dim + 1) & v).bit_count() % 2)
        masks.append(mask - (1 << bits) if mask >> (bits - 1) else mask)
    return masks


def _signed_bit(i: int) -> int:
    return -(1 << 63) if i == 63 else 1 << i


def near_edges(prints: DataFrame, radius: int, stages: Stages) -> DataFrame:
    """Links (a, b) that connect all classes of ``prints`` (distinct longs in
    ``fp``) within ``radius`` bits of each other.  Radius 1 or 2."""
    if radius not in (1, 2):
        raise ValueError("the midpoint step covers a radius of 1 or 2")
    masks = covering_masks(radius)
    keyed = prints.select("fp", F.posexplode(F.array(*[
        F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("j", "key"))
    full = stages.write(keyed.groupBy("j", "key").agg(F.count(F.lit(1)).alias("n"))
                        .where("n > 1"), "buckets")
    members = stages.write(keyed.join(full, ["j", "key"]), "members")
    small = members.where(F.col("n") <= SMALL_BUCKET)
    left, right = small.alias("l"), small.alias("r")
    pairs = left.join(right, (F.col("l.j") == F.col("r.j")) & (F.col("l.key") == F.col("r.key"))
                      & (F.col("l.fp") > F.col("r.fp"))
                      & (F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp"))) <= radius)
                      ).select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))
    # members of a large bucket differ only in bits outside its mask
    flips = F.coalesce(*[F.when(F.col("j") == j, F.array(*[
        F.lit(x).cast("long") for x in [0] + [_signed_bit(i) for i in range(64) if not m >> i & 1]]))
        for j, m in enumerate(masks)])
    spots = members.where(F.col("n") > SMALL_BUCKET).select("fp", F.explode(flips).alias("flip"))
    if radius == 1:  # one of the two is the midpoint itself
        spots = spots.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("spot"),
                             (F.col("flip") == 0).alias("own"))
        hubs = spots.groupBy("spot").agg(F.max("own").alias("real"), F.count(F.lit(1)).alias("n")
                                         ).where("real and n > 1").select("spot")
        links = spots.join(hubs, "spot").select(F.col("fp").alias("a"), F.col("spot").alias("b"))
    else:
        spots = spots.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("spot"))
        hubs = spots.groupBy("spot").agg(F.min("fp").alias("hub"), F.max("fp").alias("top")
                                         ).where("hub < top").select("spot", "hub")
        links = spots.join(hubs, "spot").select(F.col("fp").alias("a"), F.col("hub").alias("b"))
    return pairs.union(links).where("a <> b").distinct()


def _classed(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int, seed: int,
             stages: Stages, *more: Column) -> DataFrame:
    """Per row of ``docs``: doc_id, fp, ``more``, component (a fingerprint that names the
    class) and component_id (the class's smallest id)."""
    prints = stages.write(docs.select(
        F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col), shingle, seed).alias("fp"), *more),
        "prints")
    classes = stages.write(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    comp = components(near_edges(classes.select("fp"), radius, stages), stages)
    named = classes.join(comp, classes.fp == comp.node, "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component"))
    names = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_print = stages.write(named.join(names, "component").select(
        F.col("fp").alias("p"), "component", "component_id"), "names")
    return prints.join(by_print, F.col("fp") == F.col("p"), "left").drop("p")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, radius: int = 2, seed: int = 42) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits) and
    component_id, the smallest id reachable over links of at most ``radius``
    differing bits (its own included)."""
    found = _classed(docs, id_col, text_col, shingle, radius, seed, Stages(docs.sparkSession))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = 3, radius: int = 2, seed: int = 42) -> DataFrame:
    """``docs`` with one row of each near-duplicate class: the one with the smallest
    id (rows without an id come last), then the smallest text digest; of rows equal
    in both, any one."""
    stages = Stages(docs.sparkSession)
    digest = F.md5(F.coalesce(F.col(text_col), F.lit("")))
    found = _classed(docs, id_col, text_col, shingle, radius, seed, stages, digest.alias("digest"))
    spots = stages.write(found.groupBy("component", "doc_id", "digest").agg(
        F.count(F.lit(1)).alias("n")), "spots")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")
    first = spots.groupBy(F.col("component").alias("c")).agg(F.min(place).alias("first"))
    judged = stages.write(spots.join(first, F.col("component") == F.col("c")).select(
        F.col("doc_id").alias("j_id"), F.col("digest").alias("j_digest"), "n",
        (F.col("digest").eqNullSafe(F.col("first.digest"))
         & F.col("doc_id").eqNullSafe(F.col("first.doc_id"))).alias("stays")).where("not stays or n > 1"),
        "judged")
    stages.drop(spots)
    own = free_name(docs, "text_digest")
    keyed = docs.withColumn(own, digest)
    same = keyed[id_col].eqNullSafe(F.col("j_id")) & (keyed[own] == F.col("j_digest"))
    # rows neither named as going nor standing more than once stay as they are
    alone = keyed.join(judged.select("j_id", "j_digest"), same, "left_anti")
    if judged.where("stays").limit(1).count():
        several = keyed.join(judged.where("stays").select("j_id", "j_digest"), same, "left_semi")
        alone = alone.union(several.dropDuplicates([id_col, own]))
    return alone.drop(own)
