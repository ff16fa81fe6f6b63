"""Table description: the profile of a file or frame in one call.

``describe_file`` reads a delimited file with the null-token set and
returns the summary row, one row per column (counts, distinct, numeric
statistics, mode) and the top values per column.  The frames are lazy
except for the value counts, which are written once and shared.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tabloom.operators import profile
from tabloom.session import cut_lineage
from tabloom.sources.delimited import DELIMITER, NULL_TOKENS, read_delimited


@dataclass
class Description:
    summary: DataFrame      # name, path, row_count, column_count
    columns: DataFrame      # profile_table rows
    top_values: DataFrame   # column_name, value_rank, value, n, percent


def describe(df: DataFrame, name: str = "", path: str = "", k: int = 5,
             exact_median: bool = True) -> Description:
    counts = cut_lineage(profile.typed_value_counts(df))
    return Description(
        summary=profile.profile_summary(df, name, path),
        columns=profile.profile_table(df, exact_median=exact_median, counts=counts),
        top_values=profile.top_values(df, k=k, counts=counts.select("column_name", "value", "n")))


def describe_file(spark: SparkSession, path: str, null_tokens: Sequence[str] = NULL_TOKENS,
                  sep: str = DELIMITER, k: int = 5) -> Description:
    df = read_delimited(spark, path, null_tokens, sep)
    name = os.path.splitext(os.path.basename(path.rstrip("/")))[0]
    return describe(df, name, path, k)
