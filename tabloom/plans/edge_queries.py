"""Registered queries on awkward inputs: null and repeated keys, null labels,
keys beyond 2^53, many labels, missing scores, quoted text files.

The awkward values are made from the shared tables by key arithmetic, equally in
the query and in its SQL twin.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.operators import encode, evaluate, frequent, split
from tabloom.plans.queries import (RATIO, SEED, THRESH, _metrics_sql, _r, _sql_auc_groups, _t)
from tabloom.session import cut_lineage, scratch_path
from tabloom.sources import delimited

BIG = 2 ** 53
#: Bytes of text in one quoted file: one task writes a file, and many read it.
FILE_BYTES = 256 << 20


def _orders_null_key(spark, sf):
    o = _t(spark, sf, "orders")
    key = F.when(F.col("o_orderkey") % 6 != 0, F.col("o_orderkey"))
    return o.select("o_orderkey", key.alias("k"), "o_orderpriority")


# concat() leaves out a null key on both sides.
_NULL_KEY = f"('0x' || substr(md5(concat('{SEED}', '|', CAST(k AS VARCHAR))), 1, 8))::BIGINT"
_ORDERS_NULL_KEY = ("WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey END AS k "
                    "FROM orders) ")


def q_split_null_key(spark, sf):
    return split.holdout_split(_orders_null_key(spark, sf), "k", RATIO, SEED).select("o_orderkey", "split")


SQL_SPLIT_NULL_KEY = (_ORDERS_NULL_KEY + f"SELECT o_orderkey, CASE WHEN {_NULL_KEY} < {THRESH} "
                      "THEN 'test' ELSE 'train' END AS split FROM o")


def q_kfold_null_key(spark, sf):
    f = split.kfold(_orders_null_key(spark, sf), "k", 5, SEED)
    return f.select("o_orderkey", F.col("fold").cast("bigint").alias("fold"))


SQL_KFOLD_NULL_KEY = _ORDERS_NULL_KEY + f"SELECT o_orderkey, ({_NULL_KEY} % 5)::BIGINT AS fold FROM o"


def q_kfold_stratified_null_label(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", F.when(
        F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority")).alias("label"))
    f = split.stratified_kfold(o, "o_orderkey", "label", 5, SEED, rows_per_bucket=2_000)
    return f.select("o_orderkey", "label", F.col("fold").cast("bigint").alias("fold"))


_KEY_MD5 = f"md5(concat('{SEED}', '|', CAST(o_orderkey AS VARCHAR)))"
SQL_KFOLD_STRATIFIED_NULL_LABEL = f"""WITH o AS (SELECT o_orderkey,
  CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS label FROM orders)
SELECT o_orderkey, label, ((row_number() OVER (PARTITION BY label ORDER BY {_KEY_MD5}, o_orderkey) - 1)
  % 5)::BIGINT AS fold FROM o"""


def q_kfold_stratified_dup(spark, sf):
    """Order lines: every order key several times; its lines stay together."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus")
    f = split.stratified_kfold(li, "l_orderkey", "l_linestatus", 5, SEED)
    return f.groupBy("l_orderkey", "l_linestatus", F.col("fold").cast("bigint").alias("fold")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


SQL_KFOLD_STRATIFIED_DUP = f"""WITH g AS (SELECT l_orderkey, l_linestatus, count(*)::BIGINT AS n
  FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, l_linestatus, ((dense_rank() OVER (PARTITION BY l_linestatus
  ORDER BY md5(concat('{SEED}', '|', CAST(l_orderkey AS VARCHAR))), l_orderkey) - 1) % 5)::BIGINT AS fold, n
FROM g"""


def q_category_map_bigint(spark, sf):
    """Neighbouring keys above 2^53, which a DOUBLE cannot tell apart."""
    p = _t(spark, sf, "part").select((F.col("p_partkey") + F.lit(BIG)).alias("k"))
    cm = encode.fit_categories(p, ["k"])
    return cm.table.select("column_name", "value", F.col("idx").cast("bigint").alias("idx"))


SQL_CATEGORY_MAP_BIGINT = f"""SELECT 'k' AS column_name, CAST(k AS VARCHAR) AS value,
  (row_number() OVER (ORDER BY k) - 1)::BIGINT AS idx
FROM (SELECT DISTINCT p_partkey + {BIG} AS k FROM part)"""


def q_metric_many_labels(spark, sf):
    """A class per customer: no grid of all label pairs is made."""
    o = _t(spark, sf, "orders").select(
        F.col("o_custkey").alias("actual"),
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
        .alias("predicted"))
    return evaluate.evaluate(o, metrics=("accuracy", "precision", "recall", "f1")).metrics.select(
        "metric", _r("value").alias("value"))


SQL_METRIC_MANY_LABELS = "WITH " + _metrics_sql("""pred AS (SELECT 1 AS g, o_custkey AS actual,
  CASE WHEN o_orderkey % 3 = 0 THEN o_custkey + 1 ELSE o_custkey END AS predicted FROM orders)""") + """
SELECT 'accuracy' AS metric, round(accuracy, 6) AS value FROM avgs2
UNION ALL SELECT 'precision', round(precision_macro, 6) FROM avgs2
UNION ALL SELECT 'recall', round(recall_macro, 6) FROM avgs2
UNION ALL SELECT 'f1', round(f1_macro, 6) FROM avgs2"""

_NULL_SCORES = {"A": ("l_discount", 5), "N": ("l_tax", 7), "R": ("l_quantity", 3)}


def q_auc_ovr_null_scores(spark, sf):
    scores = {c: F.when(F.col("l_orderkey") % m != 0, F.col(col)) for c, (col, m) in _NULL_SCORES.items()}
    a = evaluate.roc_auc_ovr(_t(spark, sf, "lineitem"), "l_returnflag", scores, "macro")
    return a.select("class", _r("auc").alias("auc"), "n_pos", "n_neg")


SQL_AUC_OVR_NULL_SCORES = ("WITH s AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS cls, {col}::DOUBLE AS score, CASE WHEN l_returnflag = '{c}' THEN 1 ELSE 0 END AS p "
    f"FROM lineitem WHERE l_orderkey % {m} <> 0" for c, (col, m) in _NULL_SCORES.items()) + "), "
    + _sql_auc_groups("s", "cls")
    + " SELECT cls AS class, round(auc, 6) AS auc, n_pos, n_neg FROM auc"
    " UNION ALL SELECT 'macro', round(avg(auc), 6), NULL::BIGINT, NULL::BIGINT FROM auc")


def q_load_quoted_csv(spark, sf):
    """All documents, with quotes, commas and line breaks, through a CSV file."""
    path = scratch_path(spark, "documents-csv")
    docs = _t(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit('"'), "text", F.lit('", "end')).alias("text"), "source")
    docs.write.options(header=True, quote='"', escape='"').csv(path)
    back = delimited.read_delimited(spark, path, null_tokens=(), multi_line=True,
                                    schema="doc_id bigint, text string, source string")
    return back.select("doc_id", F.md5("text").alias("text_md5"), "source")


SQL_LOAD_QUOTED_CSV = """SELECT doc_id, md5(concat('"', text, '", "end')) AS text_md5, source FROM documents"""


def q_load_quoted_file(spark, sf):
    """All documents through ONE quoted file, read by several tasks; above ``FILE_BYTES`` through as
    many files as keep below it, each read by several tasks."""
    path = scratch_path(spark, "documents-one-csv")
    size = _t(spark, sf, "documents").agg(F.sum(F.octet_length("text"))).first()[0] or 0
    docs = _t(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit('"'), "text", F.lit('", "\r\n\n"')).alias("text"), "source")
    docs.coalesce(max(1, -(-size // FILE_BYTES))).write.options(header=True, quote='"', escape='"').csv(path)
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")  # several splits at every size
    try:
        back = cut_lineage(delimited.read_delimited(spark, path, null_tokens=(), multi_line=True,
                                                    schema="doc_id bigint, text string, source string"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    return back.select("doc_id", F.md5("text").alias("text_md5"), "source")


SQL_LOAD_QUOTED_FILE = """SELECT doc_id, md5(concat('"', text, '", "', chr(13), chr(10), chr(10), '"')) AS text_md5,
  source FROM documents"""


def q_top_values_documents(spark, sf):
    """Most frequent values of all document columns, whole texts among them."""
    t = frequent.frequent_values(_t(spark, sf, "documents"), ["lang", "source", "text", "doc_id", "n_chars"], k=5)
    return t.select("column_name", "value_rank", F.md5("value").alias("value_md5"), "n",
                    _r("percent").alias("percent"))


SQL_TOP_VALUES_DOCUMENTS = " UNION ALL ".join(
    f"""SELECT * FROM (SELECT '{c}' AS column_name, row_number() OVER (ORDER BY n DESC, v) AS value_rank,
  md5(v) AS value_md5, n, round(n / sum(n) OVER () * 100.0, 6) AS percent
  FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM documents WHERE {c} IS NOT NULL GROUP BY 1))
  WHERE value_rank <= 5""" for c in ("lang", "source", "text", "doc_id", "n_chars"))


QUERIES = {
    "split_null_key": q_split_null_key,
    "kfold_null_key": q_kfold_null_key,
    "kfold_stratified_null_label": q_kfold_stratified_null_label,
    "kfold_stratified_dup": q_kfold_stratified_dup,
    "category_map_bigint": q_category_map_bigint,
    "metric_many_labels": q_metric_many_labels,
    "auc_ovr_null_scores": q_auc_ovr_null_scores,
    "load_quoted_csv": q_load_quoted_csv,
    "top_values_documents": q_top_values_documents,
    "load_quoted_file": q_load_quoted_file,
}

ORACLE = {
    "split_null_key": SQL_SPLIT_NULL_KEY,
    "kfold_null_key": SQL_KFOLD_NULL_KEY,
    "kfold_stratified_null_label": SQL_KFOLD_STRATIFIED_NULL_LABEL,
    "kfold_stratified_dup": SQL_KFOLD_STRATIFIED_DUP,
    "category_map_bigint": SQL_CATEGORY_MAP_BIGINT,
    "metric_many_labels": SQL_METRIC_MANY_LABELS,
    "auc_ovr_null_scores": SQL_AUC_OVR_NULL_SCORES,
    "load_quoted_csv": SQL_LOAD_QUOTED_CSV,
    "top_values_documents": SQL_TOP_VALUES_DOCUMENTS,
    "load_quoted_file": SQL_LOAD_QUOTED_FILE,
}
