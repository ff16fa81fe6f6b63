"""Delimited-text source with a *set* of null tokens and type inference.

Spark's CSV reader takes a single ``nullValue``; tables with several missing
markers (e.g. ``NA`` and ``.``) are read as text, the tokens become NULL in
one projection, and each column is narrowed to BIGINT, DOUBLE or STRING by
one aggregate over the whole table (no driver-side sampling).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.columns import join_small
from tabloom.session import cut_lineage

# Default missing-value tokens and delimiter.
NULL_TOKENS = ("NA", ".")
DELIMITER = ","

_INT_PATTERN = r"^\s*[+-]?[0-9]+\s*$"
_NUMBER_PATTERN = (r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
                   r"|^\s*(NaN|[+-]?Infinity)\s*$")
# What to do with a row that has too many or too few fields, or with a value
# that does not fit the declared type.
ON_BAD = ("raise", "column")
CORRUPT = "_corrupt"


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """(record, first) of delimited files whose quoted fields may hold line breaks; one
    file is read by as many tasks as it has splits.

    Whether a line begins inside quotes depends on the number of quotes before it, so:
    quotes are counted per split, summed up over the splits before (a row per split), and
    counted on inside the split.  A line that begins outside quotes and has an even number
    of quotes is a record.  Any other belongs to the record that was opened last, maybe in
    an earlier split; those lines meet by their record.  Texts are shuffled by split once,
    and records of several lines once more.  ``first`` marks each file's first record.

    Quotes as in RFC 4180: only around fields, doubled inside.  A file with an odd number
    of quotes raises ``ValueError``.  Blank lines outside quotes are no records."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line"), "value").withColumn(
        "quotes", F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = cut_lineage(lines.groupBy("file", "split").agg(F.sum("quotes").alias("n")).withColumn(
        "entered", F.coalesce(F.sum("n").over(before), F.lit(0)) % 2), "csv-splits")
    torn = splits.groupBy("file").agg((F.sum("n") % 2).alias("odd")).where("odd = 1").select("file").first()
    if torn:
        raise ValueError(f"a quote is not closed in {torn['file']}")
    inside = Window.partitionBy("file", "split").orderBy("line")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = join_small(lines, splits.drop("n"), ["file", "split"], "inner")
    known = known.withColumn("place", F.row_number().over(inside)).withColumn(
        "left", (F.sum("quotes").over(upto) + F.col("entered")) % 2).withColumn(
        "met", (F.col("left") + F.col("quotes")) % 2)  # 1: inside quotes after, before the line
    opened = F.when((F.col("met") == 0) & (F.col("left") == 1), F.col("line"))
    known = cut_lineage(known.select(
        "file", "split", "line", "value", ((F.col("split") == 0) & (F.col("place") == 1)).alias("first"),
        ((F.col("met") == 0) & (F.col("left") == 0)).alias("whole"),
        F.last(opened, ignorenulls=True).over(upto).alias("opened")), "csv-lines")
    tail = F.regexp_replace("record", "\r$", "")
    single = known.where("whole").select(F.col("value").alias("record"), "first").where(
        ~F.col("record").rlike(r"^[ \t\r]*$"))
    parts = known.where("not whole")
    # the record that is open at a split's begin: the last one opened in the splits before
    carried = splits.select("file", "split").join(
        parts.groupBy("file", "split").agg(F.max("opened").alias("latest")), ["file", "split"], "left").select(
        "file", "split", F.last("latest", ignorenulls=True).over(before).alias("carried"))
    owned = join_small(parts, carried, ["file", "split"], "inner").withColumn(
        "owner", F.coalesce("opened", "carried"))
    joined = owned.groupBy("file", "owner").agg(  # one record's lines
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "line", "value"))),
                                 lambda x: x["value"]), "\n").alias("record"), F.max("first").alias("first"))
    return single.unionByName(joined.select("record", "first")).select(tail.alias("record"), "first")


def _read_quoted(spark: SparkSession, path: str, schema: T.StructType, sep: str, header: bool, on_bad: str
                 ) -> DataFrame:
    """The fields of ``quoted_records`` as text."""
    records = quoted_records(spark, path)
    if header:
        records = records.where("not first")
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "FAILFAST" if on_bad == "raise" else "PERMISSIVE"}
    if on_bad == "column":
        options["columnNameOfCorruptRecord"] = CORRUPT
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema.fields)
    return records.select(F.from_csv("record", ddl, options).alias("r")).select(
        *[F.col("r").getField(f.name).alias(f.name) for f in schema.fields])


def _read_text(spark: SparkSession, path: str, sep: str, header: bool, multi_line: bool,
               on_bad: str) -> DataFrame:
    """All fields as text, quoted as in RFC 4180: a doubled quote inside quotes is
    a quote, and with ``multi_line`` quotes may hold line breaks."""
    if on_bad not in ON_BAD:
        raise ValueError(f"on_bad must be one of: {', '.join(ON_BAD)}")
    options = {"header": header, "sep": sep, "inferSchema": False, "quote": '"', "escape": '"',
               "multiLine": multi_line, "columnPruning": False}
    try:
        schema = spark.read.options(**options).csv(path).schema
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise FileNotFoundError(f"no delimited file at {path}") from e
        raise
    if multi_line:
        return _read_quoted(spark, path, schema, sep, header, on_bad)
    if on_bad == "raise":
        return spark.read.options(**options).schema(schema).option("mode", "FAILFAST").csv(path)
    return spark.read.options(**options).schema(
        T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])).option(
        "mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path)


def null_tokens_to_null(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS,
                        columns: Sequence[str] | None = None) -> DataFrame:
    """Missing-value tokens become null in ``columns`` (default: all)."""
    toks, cols = list(tokens), set(df.columns if columns is None else columns)
    return df.select(*[F.when(F.col(f"`{c}`").isin(toks), F.lit(None)).otherwise(F.col(f"`{c}`")).alias(c)
                       if c in cols else F.col(f"`{c}`") for c in df.columns])


def infer_types(text: DataFrame) -> dict[str, str]:
    """Narrowest of bigint -> double -> string per text column, from one
    aggregate counting the values each type rejects.  A column without any
    value stays string."""
    aggs = []
    for i, c in enumerate(text.columns):
        x = F.col(c)
        present = x.isNotNull()
        as_int = F.expr(f"try_cast(trim(`{c}`) as bigint)")
        not_int = present & ~(x.rlike(_INT_PATTERN) & as_int.isNotNull())
        not_num = present & ~x.rlike(_NUMBER_PATTERN)
        aggs += [F.count_if(present).alias(f"p{i}"), F.count_if(not_int).alias(f"i{i}"),
                 F.count_if(not_num).alias(f"d{i}")]
    row = text.agg(*aggs).first()
    out = {}
    for i, c in enumerate(text.columns):
        if row[f"p{i}"] == 0:
            out[c] = "string"
        elif row[f"i{i}"] == 0:
            out[c] = "bigint"
        elif row[f"d{i}"] == 0:
            out[c] = "double"
        else:
            out[c] = "string"
    return out


def _declared(c: str, dt: T.DataType, on_bad: str) -> Column:
    """A text column in its declared type; what does not fit raises, or becomes
    null (its text is then in the corrupt column)."""
    value = F.expr(f"try_cast(trim(`{c}`) as {dt.simpleString()})") if not isinstance(
        dt, T.StringType) else F.col(f"`{c}`")
    if on_bad == "column" or isinstance(dt, T.StringType):
        return value.alias(c)
    bad = F.col(f"`{c}`").isNotNull() & value.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit(f"column {c} ({dt.simpleString()}) cannot hold "),
                                              F.col(f"`{c}`"))).cast(dt)).otherwise(value).alias(c)


def read_delimited(spark: SparkSession, path: str, null_tokens: Sequence[str] = NULL_TOKENS,
                   sep: str = DELIMITER, header: bool = True, infer: bool = True,
                   schema: T.StructType | str | None = None, multi_line: bool = False,
                   on_bad: str = "raise") -> DataFrame:
    """Read a delimited file/directory/glob into a typed frame.

    ``schema`` (DDL string or StructType) skips inference; otherwise ``infer``
    narrows every column from text.  A missing path raises
    ``FileNotFoundError`` before any work starts.  Rows with too many or too few
    fields, and values that do not fit ``schema``, raise when they are read; with
    ``on_bad='column'`` such rows stay, and column ``_corrupt`` holds the row's
    text (ragged rows) or the values that did not fit.
    """
    raw = _read_text(spark, path, sep, header, multi_line, on_bad)
    fields = [c for c in raw.columns if c != CORRUPT]
    text = null_tokens_to_null(raw, null_tokens, fields)
    extra = [F.col(CORRUPT)] if on_bad == "column" else []
    if schema is not None:
        st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
        typed = [_declared(f.name, f.dataType, on_bad) for f in st.fields]
        if extra:
            misfits = [F.when(F.col(f"`{f.name}`").isNotNull() & _declared(f.name, f.dataType, on_bad).isNull(),
                              F.concat(F.lit(f"{f.name}="), F.col(f"`{f.name}`"))) for f in st.fields]
            joined = F.nullif(F.concat_ws("; ", *misfits), F.lit(""))
            extra = [F.coalesce(F.col(CORRUPT), joined).alias(CORRUPT)]
        return text.select(*typed, *extra)
    if not infer:
        return text
    types = infer_types(text.select(*fields))
    return text.select(*[(F.trim(F.col(f"`{c}`")).cast(t) if t != "string" else F.col(f"`{c}`")).alias(c)
                         for c, t in types.items()], *extra)


def load_summary(df: DataFrame) -> dict[str, int]:
    """Rows and columns of a loaded table (one count job).

    A ``df.observe`` counter would save the job, but with this Spark build a
    used ``Observation`` makes later jobs of the session fail to serialize,
    so a plain count is used."""
    return {"rows": df.count(), "columns": len(df.columns)}

