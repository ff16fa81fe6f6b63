"""Quoted files with line breaks, split at every place, against Python's csv reader."""
import csv
import io
import os

import pytest

from tabloom.sources.delimited import quoted_records, read_delimited

ROWS = [("1", "plain", "x"), ("2", 'a "quoted" word', "y"), ("3", "two\nlines", "z"), ("4", "a,b\r\n\n\"c\"\n", ""),
        ("5", "é" * 30, "w"), ("6", '"', '\n"\n')]


def write(path, rows, end="\n", header=("k", "text", "more")):
    out = io.StringIO()
    csv.writer(out, lineterminator=end, quoting=csv.QUOTE_MINIMAL).writerows([header, *rows])
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(out.getvalue())
    return os.path.getsize(path)


def test_splits_at_every_offset(spark, tmp_path):
    size = write(tmp_path / "t.csv", ROWS)
    held = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    want = sorted((k, t, m or None) for k, t, m in ROWS)
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        for part in (7, 11, 23, size // 2):  # split points fall on every kind of place
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(part))
            assert spark.read.option("lineSep", "\n").text(str(tmp_path / "t.csv")).rdd.getNumPartitions() > 1
            got = read_delimited(spark, str(tmp_path / "t.csv"), null_tokens=(), multi_line=True, infer=False)
            assert sorted(tuple(r) for r in got.collect()) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held[0])
        spark.conf.set("spark.sql.files.openCostInBytes", held[1])


def test_two_files_line_ends_and_blank_lines(spark, tmp_path):
    write(tmp_path / "a.csv", ROWS[:3], "\r\n")
    write(tmp_path / "b.csv", ROWS[3:] + [("7", "", "end")])
    with open(tmp_path / "a.csv", "a", newline="") as f:
        f.write("\r\n\n  \n")
    got = read_delimited(spark, str(tmp_path), null_tokens=(), multi_line=True, infer=False).collect()
    assert sorted(tuple(r) for r in got) == sorted((k, t or None, m or None) for k, t, m in [*ROWS, ("7", "", "end")])


def test_ragged_rows_and_open_quotes(spark, tmp_path):
    (tmp_path / "r.csv").write_text('k,text\n1,"a\nb"\n2,"c\nd",extra\n')
    rows = {r["k"]: r for r in read_delimited(spark, str(tmp_path / "r.csv"), null_tokens=(), multi_line=True,
                                              infer=False, on_bad="column").collect()}
    assert rows["1"]["text"] == "a\nb" and rows["1"]["_corrupt"] is None
    assert rows["2"]["_corrupt"] == '2,"c\nd",extra'
    with pytest.raises(Exception):
        read_delimited(spark, str(tmp_path / "r.csv"), null_tokens=(), multi_line=True, infer=False).collect()
    (tmp_path / "o.csv").write_text('k,text\n1,"open\n2,b\n')
    with pytest.raises(ValueError, match="not closed"):
        quoted_records(spark, str(tmp_path / "o.csv"))


def test_no_header_and_types(spark, tmp_path):
    (tmp_path / "n.csv").write_text('1,"x\ny"\nNA,z\n')
    got = read_delimited(spark, str(tmp_path / "n.csv"), multi_line=True, header=False)
    assert dict(got.dtypes) == {"_c0": "bigint", "_c1": "string"}
    assert sorted((tuple(r) for r in got.collect()), key=repr) == [(1, "x\ny"), (None, "z")]


def test_document_files_are_bounded(spark, tmp_path, monkeypatch):
    """One task writes one file, so the files grow in number and not in size."""
    from tabloom.plans import edge_queries

    texts = [f'a "{i}"\n, b\r\n' * 40 for i in range(40)] + [None, ""]
    docs = spark.createDataFrame([(i, t, f"s{i % 3}") for i, t in enumerate(texts)],
                                 "doc_id long, text string, source string")
    docs.repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    want = edge_queries.q_load_quoted_file(spark, str(tmp_path)).collect()
    paths, read = [], edge_queries.delimited.read_delimited
    monkeypatch.setattr(edge_queries.delimited, "read_delimited", lambda s, p, **kw: (paths.append(p), read(s, p, **kw))[1])
    monkeypatch.setattr(edge_queries, "FILE_BYTES", sum(len(t or "") for t in texts) // 4 + 1)
    got = edge_queries.q_load_quoted_file(spark, str(tmp_path)).collect()
    folder = paths[0].removeprefix("file:")
    sizes = [os.path.getsize(os.path.join(folder, f)) for f in os.listdir(folder) if f.endswith(".csv")]
    assert len(sizes) == 4 and max(sizes) < sum(sizes) / 2
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr) and len(got) == 42
