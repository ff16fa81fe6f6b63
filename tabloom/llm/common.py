"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the shared Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str | Column) -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def id_text(col: str, alias: str = "doc_id") -> Column:
    """An id on its way through Python: as text, because a long column with a null
    becomes doubles there, which hold whole numbers up to 2^53 only."""
    return F.col(f"`{col}`").cast("string").alias(alias)


def id_long(df: DataFrame, col: str = "doc_id") -> DataFrame:
    """``df`` with an id that travelled as text as a long again."""
    return df.withColumn(col, F.col(col).cast("long"))


def ascii_words(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text in UTF-8, A-Z in lower case.

    ``bytes.lower`` changes A-Z only and ``bytes.split`` splits at exactly the
    six ASCII white-space bytes."""
    return text.encode("utf-8", "replace").lower().split()


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that ``df`` does not have (Spark compares names without
    case)."""
    taken = {c.lower() for c in df.columns}
    name = wish
    while name.lower() in taken:
        name += "_"
    return name


def groups_by_size(texts: Iterable[str], limit: int) -> Iterator[list[str]]:
    """Consecutive texts in lists of about ``limit`` characters, so that array
    work on a list needs bounded memory whatever the batch size."""
    group: list[str] = []
    size = 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size >= limit:
            yield group
            group, size = [], 0
    if group:
        yield group
