"""Delimited source (F2), run log (F8), run comparison, model store."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tabloom.operators import runs
from tabloom.session import scratch_path
from tabloom.sources import delimited, runlog

F2 = '''kind,port,length_m,draught_m,crew,built,flag
ketch,Oslo,12.5,2.5,4,1990,N
ketch,Oslo,13.5,1,6,2001,S
ketch,"Bergen, old ""quay""",20.25,3,10,1975,S
ketch,Oslo,.,NA,NA,NA,.
NA,NA,NA,NA,NA,NA,NA
'''


def _write_text(spark, text):
    path = scratch_path(spark, "f2")
    spark.createDataFrame([(line,) for line in text.strip().split("\n")], "v string") \
        .coalesce(1).write.text(path)
    return path


def test_read_delimited_tokens_and_types(spark):
    df = delimited.read_delimited(spark, _write_text(spark, F2))
    assert df.columns == ["kind", "port", "length_m", "draught_m", "crew", "built", "flag"]
    assert df.count() == 5
    types = dict(df.dtypes)
    assert types["length_m"] == "double" and types["draught_m"] == "double"
    assert types["crew"] == "bigint" and types["flag"] == "string"
    rows = df.collect()
    assert all(v is None for v in rows[4])
    assert rows[3]["length_m"] is None and rows[3]["flag"] is None
    assert rows[2]["port"] == 'Bergen, old "quay"'


def test_read_delimited_missing_path(spark):
    with pytest.raises(FileNotFoundError):
        delimited.read_delimited(spark, "/nonexistent/dir/file.csv")


def test_run_log_roundtrip_and_compare(spark):
    path = scratch_path(spark, "runs")
    t0 = dt.datetime(2024, 1, 1)
    conf = spark.createDataFrame([(0, 0, 3), (0, 1, 1), (1, 1, 3)], "actual int, predicted int, n long")
    for i, (run, acc) in enumerate([("a", 0.8), ("b", 0.9), ("c", 0.9)]):
        runlog.log_run(spark, path, "exp", run, params={"n_estimators": 100, "max_depth": 5},
                       metrics={"accuracy": acc, "f1": acc - 0.1}, confusion=conf,
                       run_ts=t0 + dt.timedelta(minutes=i))
    back = runlog.read_runs(spark, path, "exp")
    assert back.where("kind = 'param'").count() == 6
    assert back.where("kind = 'confusion'").count() == 9
    best = runs.best_run(back, "accuracy").first()
    assert best["run"] == "b" and best["accuracy"] == pytest.approx(0.9)
    lb = runs.leaderboard(back, ["accuracy", "f1"]).collect()
    assert [r["run"] for r in lb] == ["b", "c", "a"]
    assert set(back.columns) == set(runlog.COLUMNS)
    other = runlog.read_runs(spark, path, "nope")
    assert other.count() == 0


def test_describe_file(spark):
    from tabloom.plans.describe import describe_file

    d = describe_file(spark, _write_text(spark, F2))
    s = d.summary.first()
    assert (s["row_count"], s["column_count"]) == (5, 7)
    cols = {r["column_name"]: r for r in d.columns.collect()}
    assert cols["flag"]["null_count"] == 2 and cols["flag"]["unique_count"] == 3
    assert cols["length_m"]["median"] == pytest.approx(13.5)
    top = [r for r in d.top_values.collect() if r["column_name"] == "kind"]
    assert top[0]["value"] == "ketch" and top[0]["percent"] == pytest.approx(100.0)


def test_read_delimited_with_schema(spark):
    ddl = ("kind string, port string, length_m double, draught_m double, crew int, built bigint, "
           "flag string")
    df = delimited.read_delimited(spark, _write_text(spark, F2), schema=ddl)
    assert dict(df.dtypes)["crew"] == "int"
    rows = df.collect()
    assert rows[2]["draught_m"] == 3.0 and rows[3]["crew"] is None
    assert delimited.load_summary(df) == {"rows": 5, "columns": 7}


def test_stage_paths_recorded(spark):
    from tabloom.session import cut_lineage, stage_paths

    before = len(stage_paths())
    cut_lineage(spark.range(3))
    after = stage_paths()
    assert len(after) == before + 1 and after[-1].split("/")[-1].startswith("stage-")


def test_infer_types_edge_cases(spark):
    rows = [("1", "1", " 7 ", "a", None, "1D", "1e3"), ("2", "2.5", "8", "1", None, "2F", ".5"),
            (None, "NaN", "-3", "2", None, "3d", "7.")]
    text = spark.createDataFrame(rows, "i string, d string, s string, t string, e string, j string, x string")
    assert delimited.infer_types(text) == {"i": "bigint", "d": "double", "s": "bigint", "t": "string",
                                           "e": "string", "j": "string", "x": "double"}


def test_quotes_and_line_breaks(spark):
    text = 'name,n\n"he said ""x, y"" ok",1\n"two\nlines",2\n'
    path = _write_text(spark, text)
    rows = delimited.read_delimited(spark, path, multi_line=True).collect()
    assert [tuple(r) for r in rows] == [('he said "x, y" ok', 1), ("two\nlines", 2)]


@pytest.mark.parametrize("line", ["3,4,5", "3"])
def test_ragged_rows_raise_or_are_marked(spark, line):
    path = _write_text(spark, f"a,b\n1,2\n{line}\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        delimited.read_delimited(spark, path, infer=False).collect()
    df = delimited.read_delimited(spark, path, infer=False, on_bad="column")
    marked = {r["_corrupt"] for r in df.collect()}
    assert marked == {None, line} and df.count() == 2


def test_values_outside_the_schema_raise_or_are_marked(spark):
    path = _write_text(spark, "a,b\n1,2\noops,NA\n")
    with pytest.raises(Exception, match="cannot hold"):
        delimited.read_delimited(spark, path, schema="a int, b int").collect()
    rows = delimited.read_delimited(spark, path, schema="a int, b int", on_bad="column").collect()
    assert [tuple(r) for r in rows] == [(1, 2, None), (None, None, "a=oops")]


def test_runs_logged_at_once_and_again_are_kept_once(spark):
    from concurrent.futures import ThreadPoolExecutor

    path = scratch_path(spark, "runs")
    log = lambda i: runlog.log_run(spark, path, f"e{i % 2}", f"r{i}", params={"i": i}, metrics={"accuracy": i / 10})
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(log, range(8)))
    log(3)  # as after a failure
    back = runlog.read_runs(spark, path).collect()
    assert sorted((r.experiment, r.run, r.kind, r.value_num) for r in back) == sorted(
        (f"e{i % 2}", f"r{i}", kind, v) for i in range(8) for kind, v in (("param", float(i)), ("metric", i / 10)))
    assert {r.run for r in runlog.read_runs(spark, path, "e1").collect()} == {"r1", "r3", "r5", "r7"}
