"""CSV folders whose files differ in their headers or have rows that do not fit."""

import pytest

from loanclean.sources.staging import staging_path
from loanclean.sources.text_csv import file_headers, read_named_csv, read_text_csv
from loanclean.streaming.incremental import clean_new_files

FILES = {
    "a.csv": 'a,b,c\n1,2,3\n4,"x,""y",6\n7,8\n9,10,11,12\n13,14,\n15,16,17,,\n"18,19,20\n21,NA,23\n',
    "b.csv": "﻿c,b,a\n33,32,31\n",  # a byte order mark before the header
    "c.csv": "c,a\n43,41\n",
    "d.csv": 'b,a,c,a,"x,y"\n52,51,53,no,no\n',
    "empty.csv": "",
    "header_only.csv": "a,b,c\n",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("mixed")
    for name, text in FILES.items():
        (path / name).write_text(text, encoding="utf-8")
    return str(path)


def test_columns_come_by_name(spark, folder):
    scan = read_named_csv(spark, folder, ["a", "b", "c"], position="pos")
    want = {("1", "2", "3"), ("4", 'x,"y', "6"), ("7", "8", None), ("13", "14", None), ("21", None, "23"), ("31", "32", "33"), ("41", None, "43"), ("51", "52", "53")}
    rows = scan.rows.collect()
    assert {tuple(r)[:3] for r in rows} == want and len(rows) == len(want) == len({r.pos for r in rows})
    # one column alone, or one that a file lacks, gives the same rows
    assert sorted(str(r.b) for r in scan.rows.select("b").collect()) == sorted(str(w[1]) for w in want)
    assert scan.rows.count() == len(want)


def test_nothing_is_dropped_without_a_word(spark, folder):
    scan = read_named_csv(spark, folder, ["a", "b", "c"])
    got = {(r.reason, r.n_cells, r.expected, r.record, r.a, r.c) for r in scan.rejects.collect()}
    assert got == {
        ("short", 2, 3, "7,8", "7", None),
        ("surplus", 4, 3, "9,10,11,12", "9", "11"),
        ("surplus", 5, 3, "15,16,17,,", "15", "17"),
        ("quote", 3, 3, '"18,19,20', "18,19,20", None),
    }
    assert all(r.file.endswith("a.csv") for r in scan.rejects.collect())
    assert {(r.file.split("/")[-1], r.column, r.problem) for r in scan.headers.collect()} == {("c.csv", "b", "missing"), ("d.csv", "a", "repeated"), ("d.csv", "x,y", "extra")}


def test_a_strict_scan_stops(spark, folder):
    with pytest.raises(ValueError, match="b in .*c.csv"):
        read_text_csv(spark, folder, ["a", "b", "c"])
    with pytest.raises(Exception, match="does not fit its header"):
        read_text_csv(spark, f"{folder}/a.csv", ["a", "b", "c"]).collect()
    assert [tuple(r) for r in read_text_csv(spark, [f"{folder}/b.csv", f"{folder}/d.csv"], ["c", "a"]).collect()] == [("33", "31"), ("53", "51")]


def test_headers_of_large_files_are_read_once(spark, tmp_path):
    """A file of many parts has one header, and its rows are all there."""
    lines = "".join(f"{i},{'x' * (i % 90)}\n" for i in range(40000))
    (tmp_path / "one.csv").write_text("a,b\n" + lines)
    (tmp_path / "two.csv").write_text("b,a\n" + "y,1\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300000")
    try:
        assert spark.read.text(str(tmp_path / "one.csv")).rdd.getNumPartitions() > 4
        assert sorted(r.header for r in file_headers(spark, str(tmp_path)).collect()) == ["a,b", "b,a"]
        scan = read_named_csv(spark, str(tmp_path), ["a", "b"])
        assert scan.rows.count() == 40001 and scan.rows.selectExpr("sum(cast(a as long))").first()[0] == sum(range(40000)) + 1
        assert scan.rejects.isEmpty() and scan.headers.isEmpty()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_staged_rows_keep_their_positions(spark, folder):
    scan = read_named_csv(spark, folder, ["a"], position="pos", staged=True)
    assert "parquet" in scan.rows._jdf.queryExecution().executedPlan().toString().lower()
    assert {(r.a, r.pos) for r in scan.rows.collect()} == {(r.a, r.pos) for r in scan.rows.repartition(3).collect()}


def test_no_files_with_headers(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    scan = read_named_csv(spark, str(tmp_path), ["a", "b"], position="pos")
    assert scan.rows.columns == ["a", "b", "pos"] and scan.rows.isEmpty() and scan.rejects.isEmpty() and scan.headers.isEmpty()


def test_a_stream_refuses_other_headers(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        clean_new_files(spark, str(source), staging_path(spark, "out"), staging_path(spark, "check"), ["a", "b"]).awaitTermination()
