"""CSV files that disagree about their columns (S2, S4, S6) and how they split."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sparkmart.sinks.files import write_csv, write_dated_csv
from sparkmart.sources.csv_catalogue import column_names, csv_files, with_line_breaks
from sparkmart.sources.files import read_csv, read_snapshots


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return str(path)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def schema(spark, ddl):
    return spark.createDataFrame([], ddl).schema


def test_header_record_of_each_file(spark, tmp_path):
    put(tmp_path / "a b%.csv", "﻿x,y\n1,2\n")
    put(tmp_path / "b.csv", '\n"two\nlines","say ""hi"""\r\n1,2\r\n')
    put(tmp_path / "c.csv", "")
    put(tmp_path / "d.csv", "x,,x,x")
    got = {f.path.rsplit("/", 1)[1]: f.header for f in csv_files(spark, str(tmp_path))}
    assert got == {
        "a b%.csv": ("x", "y"), "b.csv": ("two\nlines", 'say "hi"'), "d.csv": ("x", "_c1", "x.1", "x.2")
    }
    assert column_names(["a", "a", None]) == ("a", "a.1", "_c2")


def test_columns_by_each_files_own_header(spark, tmp_path):
    put(tmp_path / "1.csv", "a,b\n1,x\n")
    put(tmp_path / "2.csv", 'b,a\n"y\nz",2\n')
    put(tmp_path / "3.csv", "b,extra,a\nw,9,3\n")
    put(tmp_path / "4.csv", "a,b\n")
    got = read_csv(spark, str(tmp_path), schema=schema(spark, "a int, b string"))
    assert rows(got) == [(1, "x"), (2, "y\nz"), (3, "w")]
    free = read_csv(spark, str(tmp_path))
    assert sorted(free.columns) == ["a", "b", "extra"]
    assert rows(free.select("a", "b", "extra")) == [("1", "x", None), ("2", "y\nz", None), ("3", "w", "9")]
    inferred = read_csv(spark, str(tmp_path), infer_schema=True)
    assert dict(inferred.dtypes)["a"] == "int" and inferred.agg(F.sum("a")).first()[0] == 6
    with pytest.raises(ValueError, match="no column c"):
        read_csv(spark, str(tmp_path), schema=schema(spark, "a int, c string"))


def test_inferred_types_that_differ(spark, tmp_path):
    put(tmp_path / "1.csv", "a,b,c\n1,1,2\n")
    put(tmp_path / "2.csv", "c,b,a\n3,t,2.5\n")
    got = read_csv(spark, str(tmp_path), infer_schema=True)
    assert dict(got.dtypes) == {"a": "double", "b": "string", "c": "int"}
    assert rows(got.select("a", "b", "c")) == [(1.0, "1", 2), (2.5, "t", 3)]


def test_files_without_records_and_without_header(spark, tmp_path):
    put(tmp_path / "e" / "1.csv", "")
    s = schema(spark, "a int, b string")
    assert rows(read_csv(spark, str(tmp_path / "e"), schema=s)) == []
    put(tmp_path / "n" / "1.csv", "1,x\n2,\"y\nz\"\n")
    assert rows(read_csv(spark, str(tmp_path / "n"), schema=s, header=False)) == [(1, "x"), (2, "y\nz")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_csv(spark, str(tmp_path / "none"), schema=s)


def test_awkward_text_round_trip(spark, tmp_path):
    values = [" a ", "x\ry", "x\r\ny", "\n", '"', '""', 'a"b', ",", "\\", "\\n", "é　", "\ttab", "'", "#c"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v string")
    path = write_csv(df.repartition(3), str(tmp_path / "t"))
    assert rows(read_csv(spark, path, schema=df.schema)) == rows(df)


def test_a_large_file_is_read_by_several_tasks(spark, tmp_path):
    lines = "".join(f"{i},name {i}\n" for i in range(20_000))
    plain = put(tmp_path / "plain.csv", "id,name\n" + lines)
    broken = put(tmp_path / "broken.csv", 'name,id\n"a\nb",-1\n' + "".join(f"n,{i}\n" for i in range(50_000)))
    s = schema(spark, "id int, name string")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        assert with_line_breaks(spark, [plain, broken]) == {f"file:{broken}"}
        df = read_csv(spark, plain, schema=s)
        assert df.rdd.getNumPartitions() >= 4
        assert df.agg(F.sum("id"), F.count("name")).first() == (sum(range(20_000)), 20_000)
        both = read_csv(spark, str(tmp_path), schema=s)
        assert both.count() == 70_001 and both.filter("id = -1").first()["name"] == "a\nb"
        assert read_csv(spark, broken, schema=s).rdd.getNumPartitions() == 1
        numbers = put(tmp_path / "numbers" / "n.csv", "id\n" + "1\n" * 100_000)
        assert read_csv(spark, numbers, schema=schema(spark, "id int")).rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_snapshots_with_reversed_columns(spark, tmp_path):
    base = str(tmp_path / "raw")
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    write_dated_csv(df, base, "t.csv", "2024-03-01")
    write_dated_csv(df.select("b", "a"), base, "t.csv", "2024-03-02")
    got = read_snapshots(spark, base, "t.csv", schema=df.schema)
    assert got.columns == ["a", "b", "snapshot_date"]
    assert rows(got.select("a", "b")) == [(1, "x"), (1, "x"), (2, "y"), (2, "y")]
    assert got.select("snapshot_date").distinct().count() == 2
