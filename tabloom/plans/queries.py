"""Registered queries over the shared test tables, with DuckDB oracles.

Each query reads whole tables from ``sf_dir`` and runs one library operator
(or a short composition).  The test tables hold no nulls, so nulls are
injected by key arithmetic, identically in the Spark query and its SQL.
Doubles are rounded to 6 places and integers cast to BIGINT on both sides.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.operators import encode, evaluate, impute, profile, runs, scale, split
from tabloom.plans.tuning import cross_validate, run_concurrently
from tabloom.session import scratch_path
from tabloom.sources import delimited, runlog

SEED = 42
RATIO = 0.2
R = 6


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _r(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, R)


def _null_if(cond, col: str) -> F.Column:
    return F.when(cond, F.lit(None)).otherwise(F.col(col)).alias(col)


# ----------------------------------------------------------- shared inputs

def orders_nulls(spark, sf):
    o = _t(spark, sf, "orders")
    k = F.col("o_orderkey")
    return o.select("o_orderkey", _null_if(k % 17 == 0, "o_custkey"), "o_orderstatus",
                    _null_if(k % 7 == 0, "o_totalprice"), "o_orderdate",
                    _null_if(k % 11 == 0, "o_orderpriority"))


ORDERS_NULLS = """o AS (SELECT o_orderkey,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_custkey END AS o_custkey, o_orderstatus,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice, o_orderdate,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
  FROM orders)"""


def lineitem_nulls(spark, sf):
    li = _t(spark, sf, "lineitem")
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    return li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                     _null_if((k + n) % 9 == 0, "l_quantity"), "l_extendedprice",
                     _null_if(k % 5 == 0, "l_discount"), "l_tax",
                     _null_if((k * 3 + n) % 13 == 0, "l_returnflag"), "l_linestatus",
                     "l_shipdate")


LINEITEM_NULLS = """li AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CASE WHEN (l_orderkey + l_linenumber) % 9 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
  l_extendedprice,
  CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_discount END AS l_discount, l_tax,
  CASE WHEN (l_orderkey * 3 + l_linenumber) % 13 = 0 THEN NULL ELSE l_returnflag END
    AS l_returnflag, l_linestatus, l_shipdate
  FROM lineitem)"""


def _md5(key: str) -> str:
    return f"md5(concat('{SEED}', '|', CAST({key} AS VARCHAR)))"


def _bucket(key: str) -> str:
    return f"('0x' || substr({_md5(key)}, 1, 8))::BIGINT"


THRESH = split.ratio_threshold(RATIO)


def _metrics_sql(pred: str, group: str | None = None) -> str:
    """CTE chain over ``pred(g, actual, predicted)`` ending in ``avgs`` with
    one row per g: accuracy and every precision/recall/f1 average."""
    g = group or "g"
    return f"""{pred},
cnt AS (SELECT {g}, actual, predicted, count(*) AS n FROM pred
        WHERE actual IS NOT NULL GROUP BY {g}, actual, predicted),
cls AS (SELECT {g}, label, sum(tp)::DOUBLE AS tp, sum(pn)::DOUBLE AS pn, sum(sup)::DOUBLE AS sup
        FROM (SELECT {g}, actual AS label, CASE WHEN actual = predicted THEN n ELSE 0 END AS tp,
                     0 AS pn, n AS sup FROM cnt
              UNION ALL SELECT {g}, predicted, 0, n, 0 FROM cnt) GROUP BY {g}, label),
pr AS (SELECT *, coalesce(tp / nullif(pn, 0), 0) AS p, coalesce(tp / nullif(sup, 0), 0) AS r
       FROM cls),
f AS (SELECT *, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f1 FROM pr),
avgs AS (SELECT {g}, coalesce(sum(tp) / nullif(sum(sup), 0), 0) AS accuracy,
    avg(p) AS precision_macro, avg(r) AS recall_macro, avg(f1) AS f1_macro,
    coalesce(sum(tp) / nullif(sum(pn), 0), 0) AS precision_micro,
    coalesce(sum(tp) / nullif(sum(sup), 0), 0) AS recall_micro,
    coalesce(sum(p * sup) / nullif(sum(sup), 0), 0) AS precision_weighted,
    coalesce(sum(r * sup) / nullif(sum(sup), 0), 0) AS recall_weighted,
    coalesce(sum(f1 * sup) / nullif(sum(sup), 0), 0) AS f1_weighted,
    sum(sup) AS support
    FROM f GROUP BY {g}),
avgs2 AS (SELECT *, CASE WHEN precision_micro + recall_micro = 0 THEN 0
    ELSE 2 * precision_micro * recall_micro / (precision_micro + recall_micro) END AS f1_micro
    FROM avgs)"""


# lineitem: actual return flag vs a rule on the discount; 'Z' never occurs
# as an actual value, so the label set holds an absent class.
def lineitem_pred(spark, sf):
    li = _t(spark, sf, "lineitem")
    d = F.col("l_discount")
    pred = (F.when(d < 0.03, "A").when(d < 0.06, "N").when(d < 0.09, "R").otherwise("Z"))
    return li.select(F.col("l_returnflag").alias("actual"), pred.alias("predicted"))


LINEITEM_PRED = """pred AS (SELECT 1 AS g, l_returnflag AS actual,
  CASE WHEN l_discount < 0.03 THEN 'A' WHEN l_discount < 0.06 THEN 'N'
       WHEN l_discount < 0.09 THEN 'R' ELSE 'Z' END AS predicted FROM lineitem)"""


# ================================================================ profiling

def q_profile_summary(spark, sf):
    return profile.profile_summary(orders_nulls(spark, sf), "orders", "orders.parquet")


def q_profile_nulls(spark, sf):
    return profile.profile_nulls(orders_nulls(spark, sf))


def q_profile_numeric(spark, sf):
    p = profile.profile_numeric(lineitem_nulls(spark, sf))
    return p.select("column_name", *[_r(c).alias(c) for c in
                                     ("min_value", "max_value", "mean", "median", "std_dev")])


def q_profile_distinct(spark, sf):
    return profile.profile_distinct(orders_nulls(spark, sf))


def q_profile_table(spark, sf):
    p = profile.profile_table(orders_nulls(spark, sf))
    return p.select("position", "column_name", "dtype", "non_null", "null_count", "nan_count",
                    "unique_count", *[_r(c).alias(c) for c in
                                      ("min_value", "max_value", "mean", "median", "std_dev")],
                    "mode", "mode_count")


def q_value_counts(spark, sf):
    return profile.value_counts(lineitem_nulls(spark, sf),
                                ["l_returnflag", "l_linestatus", "l_linenumber"])


def q_top_values(spark, sf):
    t = profile.top_values(orders_nulls(spark, sf),
                           ["o_orderpriority", "o_orderstatus", "o_custkey"], k=5)
    return t.select("column_name", "value_rank", "value", "n", _r("percent").alias("percent"))


def q_column_mode(spark, sf):
    return profile.column_mode(orders_nulls(spark, sf),
                               ["o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"])


def _profile_sql_cols():
    cols = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
            ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"),
            ("o_orderpriority", "string")]
    return cols


def _sql_profile_nulls():
    parts = []
    for i, (c, t) in enumerate(_profile_sql_cols()):
        nan = f"count_if(isnan({c}))" if t == "double" else "0"
        parts.append(f"SELECT {i + 1}::BIGINT AS position, '{c}' AS column_name, '{t}' AS dtype, "
                     f"count({c})::BIGINT AS non_null, (count(*) - count({c}))::BIGINT AS null_count, "
                     f"({nan})::BIGINT AS nan_count FROM o")
    return f"WITH {ORDERS_NULLS} " + " UNION ALL ".join(parts)


def _sql_distinct_expr(c):
    return (f"(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END))::BIGINT")


def _sql_profile_distinct():
    parts = [f"SELECT '{c}' AS column_name, {_sql_distinct_expr(c)} AS unique_count FROM o"
             for c, _ in _profile_sql_cols()]
    return f"WITH {ORDERS_NULLS} " + " UNION ALL ".join(parts)


def _sql_numeric(cte, src, cols):
    parts = [f"SELECT '{c}' AS column_name, round(min({c})::DOUBLE, 6) AS min_value, "
             f"round(max({c})::DOUBLE, 6) AS max_value, round(avg({c})::DOUBLE, 6) AS mean, "
             f"round(quantile_cont({c}::DOUBLE, 0.5), 6) AS median, "
             f"round(stddev_samp({c}::DOUBLE), 6) AS std_dev FROM {src}" for c in cols]
    return f"WITH {cte} " + " UNION ALL ".join(parts)


def _sql_mode_parts(cols, src):
    """(column_name, mode, mode_count) per column, ties to the smaller text."""
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS column_name, v AS mode, n AS mode_count FROM (
  SELECT CAST({c} AS VARCHAR) AS v, count(*)::BIGINT AS n FROM {src} WHERE {c} IS NOT NULL
  GROUP BY 1 ORDER BY n DESC, v ASC LIMIT 1)""")
    return parts


def _sql_profile_table(cte: str | None = None, src: str = "o",
                       cols: list[tuple[str, str]] | None = None) -> str:
    """Profile oracle over ``src`` (a CTE or a table) for (column, spark type)."""
    cols = cols if cols is not None else _profile_sql_cols()
    nulls = []
    for i, (c, t) in enumerate(cols):
        nan = f"count_if(isnan({c}))" if t == "double" else "0"
        num = t in ("bigint", "double", "int")
        x = f"CASE WHEN isnan({c}) THEN NULL ELSE {c} END" if t == "double" else c

        def stat(e, num=num):
            return f"round(({e})::DOUBLE, 6)" if num else "NULL::DOUBLE"
        nulls.append(
            f"SELECT {i + 1}::BIGINT AS position, '{c}' AS column_name, '{t}' AS dtype, "
            f"count({c})::BIGINT AS non_null, (count(*) - count({c}))::BIGINT AS null_count, "
            f"({nan})::BIGINT AS nan_count, {_sql_distinct_expr(c)} AS unique_count, "
            f"{stat(f'min({x})')} AS min_value, {stat(f'max({x})')} AS max_value, "
            f"{stat(f'avg({x})')} AS mean, "
            f"{stat(f'quantile_cont(({x})::DOUBLE, 0.5)')} AS median, "
            f"{stat(f'stddev_samp(({x})::DOUBLE)')} AS std_dev FROM {src}")
    modes = _sql_mode_parts([c for c, _ in cols], src)
    head = f"WITH {cte if cte is not None else ORDERS_NULLS}, " if (cte or src == "o") else "WITH "
    return (f"{head}s AS ({' UNION ALL '.join(nulls)}), "
            f"m AS ({' UNION ALL '.join(modes)}) "
            "SELECT s.*, m.mode, m.mode_count FROM s LEFT JOIN m USING (column_name)")


EVENTS_COLS = [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"),
               ("event_type", "string"), ("value", "double"), ("props", "string")]


def q_profile_events(spark, sf):
    p = profile.profile_table(_t(spark, sf, "events"))
    return p.select("position", "column_name", "dtype", "non_null", "null_count", "nan_count",
                    "unique_count", *[_r(c).alias(c) for c in
                                      ("min_value", "max_value", "mean", "median", "std_dev")],
                    "mode", "mode_count")


def _profile_of(table):
    def q(spark, sf):
        p = profile.profile_table(_t(spark, sf, table))
        return p.select("position", "column_name", "dtype", "non_null", "null_count",
                        "nan_count", "unique_count",
                        *[_r(c).alias(c) for c in
                          ("min_value", "max_value", "mean", "median", "std_dev")],
                        "mode", "mode_count")
    return q


PAGES_COLS = [("page_id", "bigint"), ("url", "string"), ("html", "string")]
BENCHMARK_COLS = [("item_id", "bigint"), ("text", "string")]


def q_category_map_part(spark, sf):
    cm = encode.fit_categories(_t(spark, sf, "part"), ["p_brand", "p_type", "p_size"])
    return cm.table.select("column_name", "value", F.col("idx").cast("bigint").alias("idx"))


SQL_CATEGORY_MAP_PART = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, v AS value, (row_number() OVER (ORDER BY k) - 1)::BIGINT AS idx
  FROM (SELECT DISTINCT {c} AS k, CAST({c} AS VARCHAR) AS v FROM part WHERE {c} IS NOT NULL)"""
    for c in ("p_brand", "p_type", "p_size"))


def _sql_value_counts():
    parts = [f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*)::BIGINT AS n "
             f"FROM li GROUP BY 2" for c in ("l_returnflag", "l_linestatus", "l_linenumber")]
    return f"WITH {LINEITEM_NULLS} " + " UNION ALL ".join(parts)


def _sql_top_values():
    parts = []
    for c in ("o_orderpriority", "o_orderstatus", "o_custkey"):
        parts.append(f"""SELECT '{c}' AS column_name, value_rank, value, n,
  round(n * 100.0 / tot, 6) AS percent FROM (
  SELECT CAST({c} AS VARCHAR) AS value, count(*)::BIGINT AS n,
         row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR) ASC)::BIGINT AS value_rank,
         sum(count(*)) OVER () AS tot
  FROM o WHERE {c} IS NOT NULL GROUP BY 1) WHERE value_rank <= 5""")
    return f"WITH {ORDERS_NULLS} " + " UNION ALL ".join(parts)


def _sql_column_mode():
    parts = _sql_mode_parts(["o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"], "o")
    return f"WITH {ORDERS_NULLS} " + " UNION ALL ".join(parts)


# ================================================================ imputation

def _fill_query(spark, sf, strategy):
    o = orders_nulls(spark, sf)
    p = impute.fit_fill(o, ["o_custkey", "o_totalprice"], ["o_orderpriority"], strategy)
    out = impute.apply_fill(o, p)
    cust = _r("o_custkey") if strategy != "mode" else F.col("o_custkey").cast("bigint")
    return out.select("o_orderkey", cust.alias("o_custkey"),
                      _r("o_totalprice").alias("o_totalprice"), "o_orderpriority")


def q_impute_mean(spark, sf):
    return _fill_query(spark, sf, "mean")


def q_impute_median(spark, sf):
    return _fill_query(spark, sf, "median")


def q_impute_mode(spark, sf):
    return _fill_query(spark, sf, "mode")


def _sql_mode_value(c):
    return (f"(SELECT {c} FROM o WHERE {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY count(*) DESC, {c} ASC LIMIT 1)")


def _sql_fill(strategy):
    prio = _sql_mode_value("o_orderpriority")
    if strategy == "mean":
        cust = "round(coalesce(o_custkey::DOUBLE, (SELECT avg(o_custkey) FROM o)), 6)"
        tot = "round(coalesce(o_totalprice, (SELECT avg(o_totalprice) FROM o)), 6)"
    elif strategy == "median":
        cust = ("round(coalesce(o_custkey::DOUBLE, "
                "(SELECT quantile_cont(o_custkey::DOUBLE, 0.5) FROM o)), 6)")
        tot = "round(coalesce(o_totalprice, (SELECT quantile_cont(o_totalprice, 0.5) FROM o)), 6)"
    else:
        cust = f"coalesce(o_custkey, {_sql_mode_value('o_custkey')})::BIGINT"
        tot = f"round(coalesce(o_totalprice, {_sql_mode_value('o_totalprice')}), 6)"
    return (f"WITH {ORDERS_NULLS} SELECT o_orderkey, {cust} AS o_custkey, {tot} AS o_totalprice, "
            f"coalesce(o_orderpriority, {prio}) AS o_orderpriority FROM o")


def q_impute_all_null(spark, sf):
    o = _t(spark, sf, "orders")
    none = F.col("o_orderkey") > 0          # true for every key: all-null columns
    df = o.select("o_orderkey", F.when(none, None).otherwise(F.col("o_totalprice")).alias("x"),
                  F.when(none, None).otherwise(F.col("o_orderstatus")).alias("s"))
    p = impute.fit_fill(df, ["x"], ["s"], "median")
    return impute.apply_fill(df, p).select("o_orderkey", _r("x").alias("x"), "s")


SQL_IMPUTE_ALL_NULL = """WITH d AS (SELECT o_orderkey,
  CASE WHEN o_orderkey > 0 THEN NULL ELSE o_totalprice END AS x,
  CASE WHEN o_orderkey > 0 THEN NULL ELSE o_orderstatus END AS s FROM orders)
SELECT o_orderkey, round(coalesce(x, (SELECT quantile_cont(x, 0.5) FROM d), 0), 6) AS x,
  coalesce(s, (SELECT s FROM d WHERE s IS NOT NULL GROUP BY s ORDER BY count(*) DESC, s LIMIT 1),
           'UNKNOWN') AS s FROM d"""


# ================================================================ encoding

def q_category_map(spark, sf):
    cm = encode.fit_categories(orders_nulls(spark, sf),
                               ["o_orderpriority", "o_orderstatus", "o_custkey"])
    return cm.table.select("column_name", "value", F.col("idx").cast("bigint").alias("idx"))


def _sql_category_map():
    parts = []
    for c, order in (("o_orderpriority", "v"), ("o_orderstatus", "v"), ("o_custkey", "k")):
        parts.append(f"""SELECT '{c}' AS column_name, v AS value,
  (row_number() OVER (ORDER BY {order}) - 1)::BIGINT AS idx
  FROM (SELECT DISTINCT {c} AS k, CAST({c} AS VARCHAR) AS v FROM o WHERE {c} IS NOT NULL)""")
    return f"WITH {ORDERS_NULLS} " + " UNION ALL ".join(parts)


def q_encode_known(spark, sf):
    o = orders_nulls(spark, sf)
    out = encode.encode(o, ["o_orderpriority"])
    return out.select("o_orderkey", "o_orderpriority",
                      F.col("o_orderpriority_encoded").cast("bigint").alias("o_orderpriority_encoded"))


SQL_ENCODE_KNOWN = f"""WITH {ORDERS_NULLS},
m AS (SELECT v, (row_number() OVER (ORDER BY v) - 1) AS idx
      FROM (SELECT DISTINCT o_orderpriority AS v FROM o WHERE o_orderpriority IS NOT NULL))
SELECT o_orderkey, o_orderpriority,
  (CASE WHEN o_orderpriority IS NULL THEN NULL ELSE coalesce(m.idx, -1) END)::BIGINT
    AS o_orderpriority_encoded
FROM o LEFT JOIN m ON o.o_orderpriority = m.v"""


def q_encode_unseen(spark, sf):
    o = orders_nulls(spark, sf)
    train, _ = split.train_test(o, "o_orderkey", RATIO, SEED)
    cm = encode.fit_categories(train, ["o_custkey"])
    out = encode.apply_categories(o, cm, ["o_custkey"])
    return out.select("o_orderkey", "o_custkey",
                      F.col("o_custkey_encoded").cast("bigint").alias("o_custkey_encoded"))


SQL_ENCODE_UNSEEN = f"""WITH {ORDERS_NULLS},
train AS (SELECT * FROM o WHERE {_bucket('o_orderkey')} >= {THRESH}),
m AS (SELECT k, (row_number() OVER (ORDER BY k) - 1) AS idx
      FROM (SELECT DISTINCT o_custkey AS k FROM train WHERE o_custkey IS NOT NULL))
SELECT o_orderkey, o_custkey,
  (CASE WHEN o_custkey IS NULL THEN NULL ELSE coalesce(m.idx, -1) END)::BIGINT AS o_custkey_encoded
FROM o LEFT JOIN m ON o.o_custkey = m.k"""


def q_label_index(spark, sf):
    li = _t(spark, sf, "lineitem")
    cm = encode.fit_categories(li, ["l_returnflag"])
    enc = encode.apply_categories(li, cm, ["l_returnflag"])
    return (enc.groupBy(F.col("l_returnflag").alias("label"),
                        F.col("l_returnflag_encoded").cast("bigint").alias("label_idx"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n")))


SQL_LABEL_INDEX = """SELECT l_returnflag AS label,
  (dense_rank() OVER (ORDER BY l_returnflag) - 1)::BIGINT AS label_idx, count(*)::BIGINT AS n
FROM lineitem GROUP BY l_returnflag"""


def q_preprocess_train_apply(spark, sf):
    o = orders_nulls(spark, sf)
    s = split.holdout_split(o, "o_orderkey", RATIO, SEED)
    train = s.where(F.col("split") == "train")
    pp = encode.fit_preprocess(train, ["o_orderpriority"], ["o_totalprice"], "median")
    out = encode.apply_preprocess(s, pp)
    return out.select("o_orderkey", "split", _r("o_totalprice").alias("o_totalprice"),
                      "o_orderpriority",
                      F.col("o_orderpriority_encoded").cast("bigint").alias("o_orderpriority_encoded"))


SQL_PREPROCESS_TRAIN_APPLY = f"""WITH {ORDERS_NULLS},
s AS (SELECT *, CASE WHEN {_bucket('o_orderkey')} < {THRESH} THEN 'test' ELSE 'train' END AS split
      FROM o),
train AS (SELECT * FROM s WHERE split = 'train'),
fill AS (SELECT (SELECT quantile_cont(o_totalprice, 0.5) FROM train) AS tp,
  (SELECT o_orderpriority FROM train WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority
   ORDER BY count(*) DESC, o_orderpriority LIMIT 1) AS pr),
filled AS (SELECT o_orderkey, split, coalesce(o_totalprice, fill.tp) AS o_totalprice,
  coalesce(o_orderpriority, fill.pr) AS o_orderpriority FROM s, fill),
m AS (SELECT v, (row_number() OVER (ORDER BY v) - 1) AS idx FROM (
  SELECT DISTINCT coalesce(o_orderpriority, fill.pr) AS v FROM train, fill))
SELECT o_orderkey, split, round(o_totalprice, 6) AS o_totalprice, o_orderpriority,
  coalesce(m.idx, -1)::BIGINT AS o_orderpriority_encoded
FROM filled LEFT JOIN m ON filled.o_orderpriority = m.v"""


# ================================================================ scaling

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def q_zscore_params(spark, sf):
    p = scale.fit_zscore(lineitem_nulls(spark, sf), LI_NUM)
    rows = [(c, m, s) for c, (m, s) in p.stats.items()]
    # The fitted parameters are a handful of literals; turn them into a frame.
    return spark.createDataFrame(rows, "column_name string, mean double, std_dev double").select(
        "column_name", _r("mean").alias("mean"), _r("std_dev").alias("std_dev"))


SQL_ZSCORE_PARAMS = f"WITH {LINEITEM_NULLS} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std_dev "
    f"FROM li" for c in LI_NUM)


def q_zscore_apply(spark, sf):
    li = lineitem_nulls(spark, sf)
    out = scale.apply_zscore(li, scale.fit_zscore(li, ["l_quantity", "l_discount"]))
    return out.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
                      _r("l_quantity_norm").alias("l_quantity_norm"),
                      _r("l_discount_norm").alias("l_discount_norm"))


SQL_ZSCORE_APPLY = f"""WITH {LINEITEM_NULLS},
st AS (SELECT avg(l_quantity) mq, stddev_samp(l_quantity) sq, avg(l_discount) md,
              stddev_samp(l_discount) sd FROM li)
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber,
  round((l_quantity - mq) / sq, 6) AS l_quantity_norm,
  round((l_discount - md) / sd, 6) AS l_discount_norm FROM li, st"""


def q_zscore_zero_variance(spark, sf):
    li = _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.length("l_returnflag").cast("double").alias("flag_len"),
        "l_tax")
    out = scale.apply_zscore(li, scale.fit_zscore(li, ["flag_len", "l_tax"]))
    return out.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
                      _r("flag_len_norm").alias("flag_len_norm"),
                      _r("l_tax_norm").alias("l_tax_norm"))


SQL_ZSCORE_ZERO_VARIANCE = """WITH li AS (SELECT l_orderkey, l_linenumber,
  length(l_returnflag)::DOUBLE AS flag_len, l_tax FROM lineitem),
st AS (SELECT stddev_samp(flag_len) sf, avg(flag_len) mf, avg(l_tax) mt, stddev_samp(l_tax) st
       FROM li)
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber,
  round(CASE WHEN sf = 0 THEN 0.0 ELSE (flag_len - mf) / sf END, 6) AS flag_len_norm,
  round(CASE WHEN st = 0 THEN 0.0 ELSE (l_tax - mt) / st END, 6) AS l_tax_norm FROM li, st"""


def q_extract_features(spark, sf):
    li = lineitem_nulls(spark, sf)
    out = scale.extract_features(li, ["l_quantity", "l_returnflag", "l_discount", "no_such_col"])
    return out.select(_r("l_quantity").alias("l_quantity"), "l_returnflag",
                      _r("l_discount").alias("l_discount"),
                      _r("l_quantity_norm").alias("l_quantity_norm"),
                      _r("l_discount_norm").alias("l_discount_norm"))


SQL_EXTRACT_FEATURES = f"""WITH {LINEITEM_NULLS},
st AS (SELECT avg(l_quantity) mq, stddev_samp(l_quantity) sq, avg(l_discount) md,
              stddev_samp(l_discount) sd FROM li)
SELECT round(l_quantity, 6) AS l_quantity, l_returnflag, round(l_discount, 6) AS l_discount,
  round((l_quantity - mq) / sq, 6) AS l_quantity_norm,
  round((l_discount - md) / sd, 6) AS l_discount_norm FROM li, st"""


def q_select_features(spark, sf):
    out, _missing = scale.select_features(orders_nulls(spark, sf),
                                          ["o_totalprice", "o_orderpriority", "no_such_col"],
                                          keep=["o_orderkey"])
    return out.select("o_orderkey", _r("o_totalprice").alias("o_totalprice"), "o_orderpriority")


SQL_SELECT_FEATURES = (f"WITH {ORDERS_NULLS} SELECT o_orderkey, round(o_totalprice, 6) AS "
                       "o_totalprice, o_orderpriority FROM o")


def q_drop_null_target(spark, sf):
    from tabloom.operators.train import drop_null_target

    kept, _dropped = drop_null_target(orders_nulls(spark, sf), "o_orderpriority", count=False)
    return kept.select("o_orderkey", "o_orderpriority")


SQL_DROP_NULL_TARGET = (f"WITH {ORDERS_NULLS} SELECT o_orderkey, o_orderpriority FROM o "
                        "WHERE o_orderpriority IS NOT NULL")


# ================================================================ splits

def q_split_hash(spark, sf):
    return split.holdout_split(_t(spark, sf, "orders"), "o_orderkey", RATIO, SEED).select(
        "o_orderkey", "split")


SQL_SPLIT_HASH = (f"SELECT o_orderkey, CASE WHEN {_bucket('o_orderkey')} < {THRESH} "
                  "THEN 'test' ELSE 'train' END AS split FROM orders")


def q_split_exact(spark, sf):
    return split.holdout_split(_t(spark, sf, "orders"), "o_orderkey", RATIO, SEED,
                               mode="exact").select("o_orderkey", "split")


SQL_SPLIT_EXACT = f"""WITH r AS (SELECT o_orderkey,
  row_number() OVER (ORDER BY {_md5('o_orderkey')}, o_orderkey) AS rn FROM orders)
SELECT o_orderkey, CASE WHEN rn <= (SELECT CAST(floor(count(*) * {RATIO}) AS BIGINT) FROM orders)
  THEN 'test' ELSE 'train' END AS split FROM r"""


def q_split_stratified_exact(spark, sf):
    """Exact counts for each class; a quarter of the labels are null, keys occur several times."""
    o = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.when(
        F.col("l_orderkey") % 4 != 0, F.col("l_returnflag")).alias("label"))
    return split.holdout_split(o, "l_orderkey", RATIO, SEED, mode="exact", stratify="label")


SQL_SPLIT_STRATIFIED_EXACT = f"""WITH o AS (SELECT l_orderkey, l_linenumber,
  CASE WHEN l_orderkey % 4 <> 0 THEN l_returnflag END AS label FROM lineitem),
g AS (SELECT label, l_orderkey, count(*) AS c FROM o GROUP BY label, l_orderkey),
r AS (SELECT label, l_orderkey, sum(c) OVER (PARTITION BY label ORDER BY {_md5('l_orderkey')}, l_orderkey) - c AS before,
  CAST(floor(sum(c) OVER (PARTITION BY label) * CAST({RATIO} AS DOUBLE)) AS BIGINT) AS need FROM g)
SELECT o.*, CASE WHEN r.before < r.need THEN 'test' ELSE 'train' END AS split
FROM o JOIN r ON o.l_orderkey = r.l_orderkey AND o.label IS NOT DISTINCT FROM r.label"""


def q_split_three_way(spark, sf):
    return split.three_way_split(_t(spark, sf, "orders"), "o_orderkey", 0.2, 0.1, SEED).select(
        "o_orderkey", "split")


SQL_SPLIT_THREE_WAY = (f"SELECT o_orderkey, CASE WHEN {_bucket('o_orderkey')} < "
                       f"{split.ratio_threshold(0.2)} THEN 'test' WHEN {_bucket('o_orderkey')} < "
                       f"{split.ratio_threshold(0.3)} THEN 'validation' ELSE 'train' END AS split "
                       "FROM orders")


def q_kfold_hash(spark, sf):
    return split.kfold(_t(spark, sf, "orders"), "o_orderkey", 5, SEED).select(
        "o_orderkey", F.col("fold").cast("bigint").alias("fold"))


SQL_KFOLD_HASH = f"SELECT o_orderkey, ({_bucket('o_orderkey')} % 5)::BIGINT AS fold FROM orders"


def q_kfold_stratified(spark, sf):
    f = split.stratified_kfold(_t(spark, sf, "orders"), "o_orderkey", "o_orderpriority", 5, SEED)
    return f.select("o_orderkey", "o_orderpriority", F.col("fold").cast("bigint").alias("fold"))


SQL_KFOLD_STRATIFIED = f"""SELECT o_orderkey, o_orderpriority,
  ((row_number() OVER (PARTITION BY o_orderpriority ORDER BY {_md5('o_orderkey')}, o_orderkey)
    - 1) % 5)::BIGINT AS fold FROM orders"""


# ================================================================ training helpers

def q_class_weights(spark, sf):
    from tabloom.operators.train import class_weights

    w = class_weights(_t(spark, sf, "embeddings"), "label")
    return w.select(F.col("label").cast("bigint").alias("label"), "n",
                    _r("weight").alias("weight"))


SQL_CLASS_WEIGHTS = """SELECT label::BIGINT AS label, count(*)::BIGINT AS n,
  round((SELECT count(*) FROM embeddings)::DOUBLE
        / ((SELECT count(DISTINCT label) FROM embeddings) * count(*)), 6) AS weight
FROM embeddings GROUP BY label"""


def q_prediction_summary(spark, sf):
    return evaluate.prediction_summary(lineitem_pred(spark, sf))


SQL_PREDICTION_SUMMARY = f"""WITH {LINEITEM_PRED}
SELECT count(*)::BIGINT AS n_predictions, count(DISTINCT predicted)::BIGINT AS n_distinct FROM pred"""


# ================================================================ metrics

def _labels_pred(spark, sf):
    lb = _t(spark, sf, "labels")
    return lb.select(F.col("quality").cast("bigint").alias("actual"),
                     F.col("toxic").cast("bigint").alias("predicted"))


def q_metric_accuracy(spark, sf):
    return evaluate.metric_table(_labels_pred(spark, sf), metrics=("accuracy",)).select(
        "metric", _r("value").alias("value"))


SQL_METRIC_ACCURACY = ("WITH " + _metrics_sql(
    "pred AS (SELECT 1 AS g, quality::BIGINT AS actual, toxic::BIGINT AS predicted FROM labels)")
    + " SELECT 'accuracy' AS metric, round(accuracy, 6) AS value FROM avgs2")


def _avg_query(average):
    def q(spark, sf):
        return evaluate.metric_table(lineitem_pred(spark, sf),
                                     metrics=("accuracy", "precision", "recall", "f1"),
                                     average=average).select("metric", _r("value").alias("value"))
    return q


def _avg_sql(average):
    return ("WITH " + _metrics_sql(LINEITEM_PRED) + " " + " UNION ALL ".join(
        [f"SELECT 'accuracy' AS metric, round(accuracy, 6) AS value FROM avgs2"]
        + [f"SELECT '{m}', round({m}_{average}, 6) FROM avgs2"
           for m in ("precision", "recall", "f1")]))


def q_confusion_long(spark, sf):
    return evaluate.confusion_matrix(lineitem_pred(spark, sf))


SQL_CONFUSION_LONG = f"""WITH {LINEITEM_PRED},
lab AS (SELECT DISTINCT label FROM (SELECT actual AS label FROM pred WHERE actual IS NOT NULL
        UNION ALL SELECT predicted FROM pred WHERE actual IS NOT NULL)),
cnt AS (SELECT actual, predicted, count(*) AS n FROM pred WHERE actual IS NOT NULL GROUP BY 1, 2)
SELECT a.label AS actual, p.label AS predicted, coalesce(cnt.n, 0)::BIGINT AS n
FROM lab a JOIN lab p ON TRUE
LEFT JOIN cnt ON cnt.actual = a.label AND cnt.predicted = p.label"""


def q_class_report(spark, sf):
    r = evaluate.class_report(lineitem_pred(spark, sf))
    return r.select("label", *[_r(c).alias(c) for c in ("precision", "recall", "f1")], "support")


SQL_CLASS_REPORT = ("WITH " + _metrics_sql(LINEITEM_PRED) + """
SELECT CAST(label AS VARCHAR) AS label, round(p, 6) AS precision, round(r, 6) AS recall,
  round(f1, 6) AS f1, sup::BIGINT AS support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(accuracy, 6), support::BIGINT FROM avgs2
UNION ALL SELECT 'macro avg', round(precision_macro, 6), round(recall_macro, 6),
  round(f1_macro, 6), support::BIGINT FROM avgs2
UNION ALL SELECT 'weighted avg', round(precision_weighted, 6), round(recall_weighted, 6),
  round(f1_weighted, 6), support::BIGINT FROM avgs2""")


def q_class_report_roles(spark, sf):
    """Speaker role predicted from the turn position (even: user, odd:
    assistant); 'system' is never predicted."""
    c = _t(spark, sf, "conversations")
    pred = F.when(F.col("turn") % 2 == 0, "user").otherwise("assistant")
    r = evaluate.class_report(c.select(F.col("role").alias("actual"), pred.alias("predicted")))
    return r.select("label", *[_r(x).alias(x) for x in ("precision", "recall", "f1")], "support")


SQL_CLASS_REPORT_ROLES = ("WITH " + _metrics_sql(
    "pred AS (SELECT 1 AS g, role AS actual, CASE WHEN turn % 2 = 0 THEN 'user' "
    "ELSE 'assistant' END AS predicted FROM conversations)") + """
SELECT CAST(label AS VARCHAR) AS label, round(p, 6) AS precision, round(r, 6) AS recall,
  round(f1, 6) AS f1, sup::BIGINT AS support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(accuracy, 6), support::BIGINT FROM avgs2
UNION ALL SELECT 'macro avg', round(precision_macro, 6), round(recall_macro, 6),
  round(f1_macro, 6), support::BIGINT FROM avgs2
UNION ALL SELECT 'weighted avg', round(precision_weighted, 6), round(recall_weighted, 6),
  round(f1_weighted, 6), support::BIGINT FROM avgs2""")


def q_label_set(spark, sf):
    return evaluate.label_set(lineitem_pred(spark, sf))


SQL_LABEL_SET = f"""WITH {LINEITEM_PRED}
SELECT DISTINCT label FROM (SELECT actual AS label FROM pred WHERE actual IS NOT NULL
  UNION ALL SELECT predicted FROM pred WHERE actual IS NOT NULL)"""


def q_auc_binary(spark, sf):
    li = _t(spark, sf, "lineitem")
    a = evaluate.roc_auc_binary(li.withColumn("y", (F.col("l_returnflag") == "R").cast("int")),
                                "y", "l_discount", positive=1)
    return a.select(_r("auc").alias("auc"), "n_pos", "n_neg")


def _sql_auc_groups(src: str, cls_expr: str) -> str:
    return f"""g AS (SELECT {cls_expr} AS cls, score, sum(p) AS pos, sum(1 - p) AS neg FROM {src}
             GROUP BY 1, 2),
cum AS (SELECT *, sum(neg) OVER (PARTITION BY cls ORDER BY score
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg FROM g),
auc AS (SELECT cls, sum(pos::DOUBLE * ((cum_neg - neg)::DOUBLE + neg::DOUBLE / 2.0))
          / (sum(pos)::DOUBLE * sum(neg)::DOUBLE) AS auc,
        sum(pos)::BIGINT AS n_pos, sum(neg)::BIGINT AS n_neg FROM cum GROUP BY cls)"""


SQL_AUC_BINARY = ("WITH s AS (SELECT l_discount::DOUBLE AS score, "
                  "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS p FROM lineitem), "
                  + _sql_auc_groups("s", "1")
                  + " SELECT round(auc, 6) AS auc, n_pos, n_neg FROM auc")

OVR_SCORES = {"A": "l_discount", "N": "l_tax", "R": "l_quantity"}


def q_auc_ovr_macro(spark, sf):
    a = evaluate.roc_auc_ovr(_t(spark, sf, "lineitem"), "l_returnflag", OVR_SCORES, "macro")
    return a.select("class", _r("auc").alias("auc"), "n_pos", "n_neg")


SQL_AUC_OVR_MACRO = ("WITH s AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS cls, {col}::DOUBLE AS score, CASE WHEN l_returnflag = '{c}' THEN 1 ELSE 0 END"
    f" AS p FROM lineitem" for c, col in OVR_SCORES.items()) + "), "
    + _sql_auc_groups("s", "cls")
    + " SELECT cls AS class, round(auc, 6) AS auc, n_pos, n_neg FROM auc"
    " UNION ALL SELECT 'macro', round(avg(auc), 6), NULL::BIGINT, NULL::BIGINT FROM auc")


def q_confusion_wide(spark, sf):
    w = evaluate.confusion_wide(lineitem_pred(spark, sf))
    return w.select("actual", *[F.col(c).cast("bigint").alias(f"pred_{c}")
                                for c in w.columns if c != "actual"])


SQL_CONFUSION_WIDE = f"""WITH {LINEITEM_PRED},
lab AS (SELECT DISTINCT actual AS label FROM pred WHERE actual IS NOT NULL
        UNION SELECT DISTINCT predicted FROM pred WHERE actual IS NOT NULL)
SELECT lab.label AS actual,
  count(*) FILTER (WHERE p.predicted = 'A')::BIGINT AS pred_A,
  count(*) FILTER (WHERE p.predicted = 'N')::BIGINT AS pred_N,
  count(*) FILTER (WHERE p.predicted = 'R')::BIGINT AS pred_R,
  count(*) FILTER (WHERE p.predicted = 'Z')::BIGINT AS pred_Z
FROM lab LEFT JOIN pred p ON p.actual = lab.label GROUP BY lab.label"""


def q_prediction_counts(spark, sf):
    return evaluate.prediction_counts(lineitem_pred(spark, sf))


SQL_PREDICTION_COUNTS = f"""WITH {LINEITEM_PRED}
SELECT predicted AS label, count(*)::BIGINT AS n FROM pred GROUP BY predicted"""


def q_auc_ovr_weighted(spark, sf):
    a = evaluate.roc_auc_ovr(_t(spark, sf, "lineitem"), "l_returnflag", OVR_SCORES, "weighted")
    return a.select("class", _r("auc").alias("auc"), "n_pos", "n_neg")


SQL_AUC_OVR_WEIGHTED = ("WITH s AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS cls, {col}::DOUBLE AS score, CASE WHEN l_returnflag = '{c}' THEN 1 ELSE 0 END"
    f" AS p FROM lineitem" for c, col in OVR_SCORES.items()) + "), "
    + _sql_auc_groups("s", "cls")
    + " SELECT cls AS class, round(auc, 6) AS auc, n_pos, n_neg FROM auc"
    " UNION ALL SELECT 'weighted', round(sum(auc * n_pos) / sum(n_pos), 6), NULL::BIGINT,"
    " NULL::BIGINT FROM auc")


def q_auc_document_length(spark, sf):
    """How well the raw document length ranks quality documents."""
    docs = _t(spark, sf, "documents").select("doc_id", "n_chars")
    lab = _t(spark, sf, "labels").select("doc_id", "quality")
    a = evaluate.roc_auc_binary(docs.join(lab, "doc_id"), "quality", "n_chars", positive=1)
    return a.select(_r("auc").alias("auc"), "n_pos", "n_neg")


SQL_AUC_DOCUMENT_LENGTH = ("WITH s AS (SELECT d.n_chars::DOUBLE AS score, "
                           "CASE WHEN l.quality = 1 THEN 1 ELSE 0 END AS p "
                           "FROM documents d JOIN labels l USING (doc_id)), "
                           + _sql_auc_groups("s", "1")
                           + " SELECT round(auc, 6) AS auc, n_pos, n_neg FROM auc")


# ================================================================ CV and runs

def _status_rule(threshold_col):
    return F.when(F.col("o_totalprice") > threshold_col, "O").otherwise("F")


def q_cv_summary(spark, sf):
    o = split.kfold(_t(spark, sf, "orders"), "o_orderkey", 5, SEED)

    def fit(train):
        return scale.fit_zscore(train, ["o_totalprice"]).stats["o_totalprice"][0]

    def predict(mean, test):
        return test.withColumn("prediction", _status_rule(F.lit(mean)))

    _per, summary = cross_validate(o, "fold", fit, predict, "o_orderstatus", "prediction",
                                   metrics=("accuracy", "f1"))
    return summary.select("metric", _r("mean").alias("mean"), _r("std").alias("std"))


SQL_CV_SUMMARY = ("WITH " + f"""o AS (SELECT o_orderkey, o_orderstatus, o_totalprice,
  ({_bucket('o_orderkey')} % 5) AS fold FROM orders),
folds AS (SELECT DISTINCT fold FROM o),
thr AS (SELECT folds.fold, avg(o.o_totalprice) AS t FROM folds JOIN o ON o.fold <> folds.fold
        GROUP BY folds.fold),
""" + _metrics_sql("""pred AS (SELECT o.fold AS g, o_orderstatus AS actual,
  CASE WHEN o_totalprice > thr.t THEN 'O' ELSE 'F' END AS predicted
  FROM o JOIN thr ON o.fold = thr.fold)""") + """
SELECT 'accuracy' AS metric, round(avg(accuracy), 6) AS mean, round(stddev_samp(accuracy), 6) AS std
FROM avgs2 UNION ALL
SELECT 'f1', round(avg(f1_macro), 6), round(stddev_samp(f1_macro), 6) FROM avgs2""")

RUN_THRESHOLDS = {"run_1": 100000.0, "run_2": 150000.0, "run_3": 200000.0, "run_4": 250000.0}
EXPERIMENT = "status_rule"
RUN_TS = _dt.datetime(2024, 1, 1)


def build_run_log(spark, sf) -> DataFrame:
    """Score a threshold rule on orders per run, log every run, read back."""
    o = _t(spark, sf, "orders").select("o_orderstatus", "o_totalprice")
    path = scratch_path(spark, "runlog")
    def one(item):
        i, (run, t) = item
        scored = o.withColumn("prediction", _status_rule(F.lit(t)))
        ev = evaluate.evaluate(scored, "o_orderstatus", "prediction")
        return runlog.run_rows(spark, EXPERIMENT, run, params={"threshold": t},
                               metrics=ev.metrics, confusion=ev.counts, report=ev.report,
                               run_ts=RUN_TS + _dt.timedelta(minutes=i))

    parts = run_concurrently(one, list(enumerate(RUN_THRESHOLDS.items())), 4)
    rows = parts[0]
    for r in parts[1:]:
        rows = rows.unionByName(r)
    runlog.append_run(rows, path)          # one append for the whole sweep
    return runlog.read_runs(spark, path, EXPERIMENT)


def q_run_log_roundtrip(spark, sf):
    """All kinds: parameters, metrics, confusion counts and class reports."""
    return build_run_log(spark, sf).select("experiment", "run", "kind", "key", _r("value_num").alias("value_num"))


def _sql_runs_metrics():
    preds = " UNION ALL ".join(
        f"SELECT '{run}' AS g, o_orderstatus AS actual, "
        f"CASE WHEN o_totalprice > {t} THEN 'O' ELSE 'F' END AS predicted FROM orders"
        for run, t in RUN_THRESHOLDS.items())
    return "WITH " + _metrics_sql(f"pred AS ({preds})")


SQL_RUN_LOG_ROUNDTRIP = (_sql_runs_metrics() + " " + " UNION ALL ".join(
    [f"SELECT '{EXPERIMENT}' AS experiment, '{run}' AS run, 'param' AS kind, 'threshold' AS key,"
     f" round({t}, 6) AS value_num" for run, t in RUN_THRESHOLDS.items()]
    + [f"SELECT '{EXPERIMENT}', g, 'metric', 'accuracy', round(accuracy, 6) FROM avgs2"]
    + [f"SELECT '{EXPERIMENT}', g, 'metric', '{m}', round({m}_macro, 6) FROM avgs2"
       for m in ("precision", "recall", "f1")]
    + [f"SELECT '{EXPERIMENT}', g, 'confusion', actual || '|' || predicted, n FROM cnt"]
    + [f"SELECT '{EXPERIMENT}', g, 'report', label || '|{s}', round({c}, 6) FROM f"
       for s, c in (("precision", "p"), ("recall", "r"), ("f1", "f1"), ("support", "sup"))]
    + [f"SELECT '{EXPERIMENT}', g, 'report', '{a} avg|{s}', round({c}, 6) FROM avgs2"
       for a in ("macro", "weighted") for s, c in
       (*[(m, f"{m}_{a}") for m in ("precision", "recall", "f1")], ("support", "support"))]
    + [f"SELECT '{EXPERIMENT}', g, 'report', 'accuracy|{s}', {c} FROM avgs2" for s, c in
       (("precision", "NULL"), ("recall", "NULL"), ("f1", "round(accuracy, 6)"), ("support", "support"))]))


def q_best_run(spark, sf):
    b = runs.best_run(build_run_log(spark, sf), "accuracy")
    return b.select("experiment", "run", _r("accuracy").alias("accuracy"))


SQL_BEST_RUN = (_sql_runs_metrics() + f" SELECT '{EXPERIMENT}' AS experiment, g AS run, "
                "round(accuracy, 6) AS accuracy FROM avgs2 ORDER BY accuracy DESC, g LIMIT 1")


def q_leaderboard(spark, sf):
    lb = runs.leaderboard(build_run_log(spark, sf))
    return lb.select("experiment", "run", *[_r(m).alias(m) for m in
                                            ("accuracy", "precision", "recall", "f1")])


SQL_LEADERBOARD = (_sql_runs_metrics() + f" SELECT '{EXPERIMENT}' AS experiment, g AS run, "
                   "round(accuracy, 6) AS accuracy, round(precision_macro, 6) AS precision, "
                   "round(recall_macro, 6) AS recall, round(f1_macro, 6) AS f1 FROM avgs2")


# ================================================================ sources

CUSTOMER_TOKENS = {  # column -> (token, key modulus) injected into the text file
    "c_nationkey": ("NA", 13), "c_acctbal": (".", 7), "c_mktsegment": ("NA", 5)}


def write_customer_csv(spark, sf) -> str:
    """Customer as a header CSV with ``NA`` / ``.`` missing markers."""
    c = _t(spark, sf, "customer")
    k = F.col("c_custkey")
    cols = [k.cast("string").alias("c_custkey"), F.col("c_name")]
    for name in ("c_nationkey", "c_acctbal", "c_mktsegment"):
        tok, mod = CUSTOMER_TOKENS[name]
        cols.append(F.when(k % mod == 0, F.lit(tok)).otherwise(F.col(name).cast("string"))
                    .alias(name))
    path = scratch_path(spark, "customer-csv")
    c.select(*cols).write.option("header", True).csv(path)
    return path


def q_load_null_tokens(spark, sf):
    df = delimited.read_delimited(spark, write_customer_csv(spark, sf))
    return df.select("c_custkey", "c_name", "c_nationkey", _r("c_acctbal").alias("c_acctbal"),
                     "c_mktsegment")


SQL_LOAD_NULL_TOKENS = """SELECT c_custkey::BIGINT AS c_custkey, c_name,
  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_nationkey::BIGINT END AS c_nationkey,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE round(c_acctbal, 6) END AS c_acctbal,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer"""


def q_infer_types(spark, sf):
    df = delimited.read_delimited(spark, write_customer_csv(spark, sf))
    rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position bigint, column_name string, dtype string")


def _sql_inferred(position: int, column: str) -> str:
    """The narrowest type that every written value of a customer column fits."""
    token, mod = CUSTOMER_TOKENS.get(column, (None, None))
    value = f"CAST({column} AS VARCHAR)"
    present = f"WHERE c_custkey % {mod} <> 0" if mod else ""
    return f"""SELECT {position}::BIGINT AS position, '{column}' AS column_name,
  CASE WHEN bool_and(TRY_CAST({value} AS BIGINT) IS NOT NULL AND NOT contains({value}, '.')) THEN 'bigint'
       WHEN bool_and(TRY_CAST({value} AS DOUBLE) IS NOT NULL) THEN 'double' ELSE 'string' END AS dtype
FROM customer {present}"""


SQL_INFER_TYPES = " UNION ALL ".join(_sql_inferred(i + 1, c) for i, c in enumerate(
    ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")))


# ================================================================ registry

QUERIES = {
    "load_null_tokens": q_load_null_tokens,
    "infer_types": q_infer_types,
    "profile_summary": q_profile_summary,
    "profile_nulls": q_profile_nulls,
    "profile_numeric": q_profile_numeric,
    "profile_distinct": q_profile_distinct,
    "profile_table": q_profile_table,
    "profile_events": q_profile_events,
    "profile_pages": _profile_of("pages"),
    "profile_benchmark": _profile_of("benchmark"),
    "category_map_part": q_category_map_part,
    "value_counts": q_value_counts,
    "top_values": q_top_values,
    "column_mode": q_column_mode,
    "impute_mean": q_impute_mean,
    "impute_median": q_impute_median,
    "impute_mode": q_impute_mode,
    "impute_all_null": q_impute_all_null,
    "category_map": q_category_map,
    "encode_known": q_encode_known,
    "encode_unseen": q_encode_unseen,
    "label_index": q_label_index,
    "preprocess_train_apply": q_preprocess_train_apply,
    "zscore_params": q_zscore_params,
    "zscore_apply": q_zscore_apply,
    "zscore_zero_variance": q_zscore_zero_variance,
    "extract_features": q_extract_features,
    "select_features": q_select_features,
    "drop_null_target": q_drop_null_target,
    "split_hash": q_split_hash,
    "split_exact": q_split_exact,
    "split_stratified_exact": q_split_stratified_exact,
    "split_three_way": q_split_three_way,
    "kfold_hash": q_kfold_hash,
    "kfold_stratified": q_kfold_stratified,
    "class_weights": q_class_weights,
    "prediction_summary": q_prediction_summary,
    "metric_accuracy": q_metric_accuracy,
    "metric_macro": _avg_query("macro"),
    "metric_micro": _avg_query("micro"),
    "metric_weighted": _avg_query("weighted"),
    "confusion_long": q_confusion_long,
    "class_report": q_class_report,
    "class_report_roles": q_class_report_roles,
    "label_set": q_label_set,
    "auc_binary": q_auc_binary,
    "auc_ovr_macro": q_auc_ovr_macro,
    "auc_ovr_weighted": q_auc_ovr_weighted,
    "auc_document_length": q_auc_document_length,
    "confusion_wide": q_confusion_wide,
    "prediction_counts": q_prediction_counts,
    "cv_summary": q_cv_summary,
    "run_log_roundtrip": q_run_log_roundtrip,
    "best_run": q_best_run,
    "leaderboard": q_leaderboard,
}

ORACLE = {
    "load_null_tokens": SQL_LOAD_NULL_TOKENS,
    "infer_types": SQL_INFER_TYPES,
    "profile_summary": ("SELECT 'orders' AS name, 'orders.parquet' AS path, "
                        "count(*)::BIGINT AS row_count, 6::BIGINT AS column_count FROM orders"),
    "profile_nulls": _sql_profile_nulls(),
    "profile_numeric": _sql_numeric(LINEITEM_NULLS, "li", ["l_orderkey", "l_partkey", "l_suppkey",
                                                           "l_linenumber"] + LI_NUM),
    "profile_distinct": _sql_profile_distinct(),
    "profile_table": _sql_profile_table(),
    "profile_events": _sql_profile_table(None, "events", EVENTS_COLS),
    "profile_pages": _sql_profile_table(None, "pages", PAGES_COLS),
    "profile_benchmark": _sql_profile_table(None, "benchmark", BENCHMARK_COLS),
    "category_map_part": SQL_CATEGORY_MAP_PART,
    "value_counts": _sql_value_counts(),
    "top_values": _sql_top_values(),
    "column_mode": _sql_column_mode(),
    "impute_mean": _sql_fill("mean"),
    "impute_median": _sql_fill("median"),
    "impute_mode": _sql_fill("mode"),
    "impute_all_null": SQL_IMPUTE_ALL_NULL,
    "category_map": _sql_category_map(),
    "encode_known": SQL_ENCODE_KNOWN,
    "encode_unseen": SQL_ENCODE_UNSEEN,
    "label_index": SQL_LABEL_INDEX,
    "preprocess_train_apply": SQL_PREPROCESS_TRAIN_APPLY,
    "zscore_params": SQL_ZSCORE_PARAMS,
    "zscore_apply": SQL_ZSCORE_APPLY,
    "zscore_zero_variance": SQL_ZSCORE_ZERO_VARIANCE,
    "extract_features": SQL_EXTRACT_FEATURES,
    "select_features": SQL_SELECT_FEATURES,
    "drop_null_target": SQL_DROP_NULL_TARGET,
    "split_hash": SQL_SPLIT_HASH,
    "split_exact": SQL_SPLIT_EXACT,
    "split_stratified_exact": SQL_SPLIT_STRATIFIED_EXACT,
    "split_three_way": SQL_SPLIT_THREE_WAY,
    "kfold_hash": SQL_KFOLD_HASH,
    "kfold_stratified": SQL_KFOLD_STRATIFIED,
    "class_weights": SQL_CLASS_WEIGHTS,
    "prediction_summary": SQL_PREDICTION_SUMMARY,
    "metric_accuracy": SQL_METRIC_ACCURACY,
    "metric_macro": _avg_sql("macro"),
    "metric_micro": _avg_sql("micro"),
    "metric_weighted": _avg_sql("weighted"),
    "confusion_long": SQL_CONFUSION_LONG,
    "class_report": SQL_CLASS_REPORT,
    "class_report_roles": SQL_CLASS_REPORT_ROLES,
    "label_set": SQL_LABEL_SET,
    "auc_binary": SQL_AUC_BINARY,
    "auc_ovr_macro": SQL_AUC_OVR_MACRO,
    "auc_ovr_weighted": SQL_AUC_OVR_WEIGHTED,
    "auc_document_length": SQL_AUC_DOCUMENT_LENGTH,
    "confusion_wide": SQL_CONFUSION_WIDE,
    "prediction_counts": SQL_PREDICTION_COUNTS,
    "cv_summary": SQL_CV_SUMMARY,
    "run_log_roundtrip": SQL_RUN_LOG_ROUNDTRIP,
    "best_run": SQL_BEST_RUN,
    "leaderboard": SQL_LEADERBOARD,
}
