"""The corpus pipeline: four stages, each written as Parquet and read again.

A stage takes (spark, docs, sf_dir) and returns a DataFrame.  All but the last
return the columns of ``documents``:

1. toxicity: rows whose toxic probability reaches 0.5 go;
2. SimHash near-dedup: one row of each near-duplicate class stays (3-word
   shingles, at most two differing bits);
3. substring dedup: passages that an earlier document holds are cut out of the
   texts, and ``n_chars`` follows; no row goes;
4. best-fit packing: the texts' token pieces with their sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm.chunk_dedup import drop_repeats
from tabloom.llm.common import read_table
from tabloom.llm.packing import pack_documents
from tabloom.llm.simhash import drop_near_duplicates
from tabloom.llm.toxicity import drop_toxic
from tabloom.session import Stages


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = drop_repeats(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", packing),
]

#: The stages train a model, link classes and cut texts: no SQL expresses them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    stages, docs = Stages(spark), read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        out = stages.write(stage(spark, docs, sf_dir), name)
        if i:
            stages.drop(docs)
        docs = out
    return docs
