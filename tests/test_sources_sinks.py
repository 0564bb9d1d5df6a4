"""Sources and sinks: S1–S9, K1–K6."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from datetime import date

import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.sinks.audit import AuditRow, append_audit
from sparkmart.sinks.files import (
    csv_safe,
    write_csv,
    write_dated_csv,
    write_partitioned_parquet,
)
from sparkmart.sources.config import parse_sources
from sparkmart.sources.files import (
    PANDAS_NA_TOKENS,
    read_audit_log,
    read_csv,
    read_latest_snapshot,
    read_partitioned_parquet,
    read_snapshots,
)
from sparkmart.sources.jdbc import jdbc_options
from sparkmart.sources.xlsx import parse_first_sheet, read_xlsx


def tmp():
    return tempfile.mkdtemp(prefix="sparkmart-test-")


def test_csv_na_tokens_become_null(spark):
    d = tmp()
    path = os.path.join(d, "c.csv")
    with open(path, "w") as fh:
        fh.write("id,name,score\n1,NA,3.5\n2,Budi,null\n3,,n/a\n4,Cici,4\n")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    rows = read_csv(spark, path, schema=schema, na_tokens=PANDAS_NA_TOKENS).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, None, 3.5), (2, "Budi", None), (3, None, None), (4, "Cici", 4.0)]
    plain = read_csv(spark, path, schema=schema).orderBy("id").collect()
    assert plain[0]["name"] == "NA"  # Spark alone keeps the token as text


def test_csv_text_survives_and_columns_are_found_by_name(spark, tmp_path):
    rows = [("  a  ", 'say "hi"\nand, bye', 1), ("b", "", 2), ("c", None, 3), ("\tt", " \n ", 4)]
    df = spark.createDataFrame(rows, "`unit.price` string, text string, n long")
    path = write_csv(df.repartition(2), str(tmp_path / "t"))
    back = read_csv(spark, path, schema=df.schema)
    want = [(a, b or None, n) for a, b, n in rows]  # CSV has no empty text apart from NULL
    assert sorted(map(tuple, back.collect()), key=lambda r: r[2]) == want
    (tmp_path / "o.csv").write_text('b,a\n1,"x\ny"\n')
    got = read_csv(spark, str(tmp_path / "o.csv"), 
                   schema=spark.createDataFrame([], "a string, b int").schema).collect()
    assert [tuple(r) for r in got] == [("x\ny", 1)]


def test_no_snapshot_folder(spark, tmp_path):
    from sparkmart.sources.files import read_latest_snapshot, snapshot_dates

    assert snapshot_dates(spark, str(tmp_path / "none"), "x.csv") == []
    with pytest.raises(FileNotFoundError):
        read_latest_snapshot(spark, str(tmp_path / "none"), "x.csv")


def test_csv_round_trip_and_array_vector_safety(spark):
    df = spark.createDataFrame(
        [(1, ["a", "b, c"], Vectors.dense([1.0, 2.0]))],
        T.StructType([T.StructField("id", T.IntegerType()),
                      T.StructField("items", T.ArrayType(T.StringType())),
                      T.StructField("v", VectorUDT())]),
    )
    safe = csv_safe(df)
    assert safe.columns == ["id", "items"] and safe.first()["items"] == "a, b, c"
    path = write_csv(df, os.path.join(tmp(), "out"))
    back = read_csv(spark, path, schema=safe.schema).first()
    assert back["items"] == "a, b, c"


def test_snapshots_all_and_latest(spark):
    base = os.path.join(tmp(), "raw", "customers")
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "z")], "id int, v string")
    write_dated_csv(a, base, "c.csv", "2024-03-01")
    write_dated_csv(b, base, "c.csv", "2024-03-02")
    write_dated_csv(b, base, "c.csv", "2024-03-02")  # same-day rerun overwrites
    schema = a.schema
    every = read_snapshots(spark, base, "c.csv", schema=schema)
    assert every.count() == 4
    assert {r["snapshot_date"] for r in every.collect()} == {date(2024, 3, 1), date(2024, 3, 2)}
    latest = read_latest_snapshot(spark, base, "c.csv", schema=schema).orderBy("id").collect()
    assert [(r["id"], r["v"]) for r in latest] == [(1, "x"), (2, "z")]
    from sparkmart.sources.csv_catalogue import list_files

    listed = list_files(spark, base, recursive=True).collect()
    assert listed and all(r["path"].endswith(".csv") and r["length"] > 0 for r in listed)
    assert {r["path"].split("/")[-3] for r in listed} == {"2024-03-01", "2024-03-02"}


def test_partition_pruning_in_plan(spark):
    df = spark.createDataFrame([(1, "A"), (2, "B"), (3, "A")], "id int, city string")
    path = write_partitioned_parquet(df, os.path.join(tmp(), "by_city"), ["city"])
    assert sorted(os.listdir(path))[-2:] == ["city=A", "city=B"]
    pruned = read_partitioned_parquet(spark, path).where(F.col("city") == "A")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(city" in plan and "(city" in plan
    assert pruned.count() == 2


def test_audit_append_and_multiline_read(spark):
    path = os.path.join(tmp(), "logs", "ingestion_log")
    note = 'connection failed: "db"\n(see docs)'
    append_audit(spark, [AuditRow("t1", "a", "csv", 3, "SUCCESS", "OK")], path)
    append_audit(spark, [AuditRow("t2", "b", "rdbms", 0, "FAILED", note)], path)
    rows = {r["dataset_name"]: r for r in read_audit_log(spark, path).collect()}
    assert rows["a"]["rows"] == 3 and rows["b"]["notes"] == note


def _workbook() -> bytes:
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rns = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/workbook.xml",
                   f'<workbook {ns} {rns}><sheets><sheet name="P" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId1" Target="worksheets/sheet1.xml" Type="x"/></Relationships>')
        z.writestr("xl/sharedStrings.xml",
                   f'<sst {ns}><si><t>product_id</t></si><si><t>product_name</t></si>'
                   f'<si><t>price</t></si><si><t>added</t></si><si><r><t>Lap</t></r><r><t>top</t></r></si></sst>')
        z.writestr("xl/styles.xml", f'<styleSheet {ns}><cellXfs count="2"><xf numFmtId="0"/>'
                                    f'<xf numFmtId="14"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f"""<worksheet {ns}><sheetData>
<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="C1" t="s"><v>2</v></c><c r="D1" t="s"><v>3</v></c></row>
<row r="2"><c r="A2"><v>1</v></c><c r="B2" t="s"><v>4</v></c><c r="C2"><v>7500000</v></c><c r="D2" s="1"><v>45292</v></c></row>
<row r="3"><c r="A3"><v>2</v></c><c r="B3" t="inlineStr"><is><t>Mouse</t></is></c><c r="C3"><v>150000.5</v></c></row>
</sheetData></worksheet>""")
    return buf.getvalue()


def test_xlsx_parse_and_distributed_read(spark):
    rows = parse_first_sheet(_workbook())
    assert rows[0] == ["product_id", "product_name", "price", "added"]
    assert rows[1][:3] == [1, "Laptop", 7500000] and rows[1][3].date() == date(2024, 1, 1)
    d = tmp()
    for i in range(3):
        with open(os.path.join(d, f"p{i}.xlsx"), "wb") as fh:
            fh.write(_workbook())
    schema = "product_id long, product_name string, price double, added date"
    df = read_xlsx(spark, d, T.StructType.fromDDL(schema))
    assert df.count() == 6
    assert sorted({r["product_name"] for r in df.collect()}) == ["Laptop", "Mouse"]
    text = read_xlsx(spark, d)
    assert text.columns == ["product_id", "product_name", "price", "added"]


def test_jdbc_options():
    q = jdbc_options("jdbc:postgresql://h:5432/db", query="SELECT * FROM orders", user="u")
    assert q["query"] == "SELECT * FROM orders" and "dbtable" not in q
    p = jdbc_options("jdbc:postgresql://h:5432/db", query="SELECT * FROM orders",
                     partition_column="order_id", lower_bound=1, upper_bound=1000, num_partitions=4)
    assert p["dbtable"] == "(SELECT * FROM orders) AS src" and "query" not in p
    assert (p["partitionColumn"], p["numPartitions"]) == ("order_id", "4")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", query="q", table="t")


def test_declared_sources_order():
    cfg = {
        "files": [{"name": "f", "source_type": "csv", "path": "p.csv", "target": "raw/csv/f/f.csv"}],
        "rdbms": {"host": "h", "port": 5432, "database": "d", "username": "u",
                  "sources": [{"name": "c", "query": "SELECT 1", "target": "raw/rdbms/c/c.csv"}]},
    }
    specs = parse_sources(cfg)
    assert [s.name for s in specs] == ["c", "f"]
    assert specs[0].jdbc_url == "jdbc:postgresql://h:5432/d"


def test_object_store_conf():
    from sparkmart.session import object_store_conf

    conf = object_store_conf("store:9000", "key", "secret")
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.access.key"] == "key"
    assert object_store_conf("https://s", "k", "s", secure=True)["spark.hadoop.fs.s3a.endpoint"] == "https://s"


def test_a_landing_counts_once_it_is_committed(spark, tmp_path):
    import shutil

    from sparkmart.sinks import manifest
    from sparkmart.sources.files import snapshot_dates

    base = str(tmp_path / "raw")
    frame = lambda v: spark.createDataFrame([(1, v), (2, v)], "id int, v string")
    values = lambda df: sorted((str(r["snapshot_date"]), r["id"], r["v"]) for r in df.collect())
    schema = frame("a").schema
    write_csv(frame("old"), f"{base}/2024-02-28/c.csv")  # landed by another tool
    write_dated_csv(frame("a"), base, "c.csv", "2024-03-01")
    write_dated_csv(frame("b"), base, "c.csv", "2024-03-02")

    def dies(df, path, mode):
        write_csv(df, path, mode)
        raise RuntimeError("lost")

    for day in ("2024-03-02", "2024-03-03"):  # a rerun and a new day that die before their commit
        with pytest.raises(RuntimeError):
            manifest.land(dies, frame("half"), base, "c.csv", day)
    want = [("2024-02-28", 1, "old"), ("2024-02-28", 2, "old"), ("2024-03-01", 1, "a"), ("2024-03-01", 2, "a"),
            ("2024-03-02", 1, "b"), ("2024-03-02", 2, "b")]
    assert values(read_snapshots(spark, base, "c.csv", schema=schema)) == want
    assert values(read_latest_snapshot(spark, base, "c.csv", schema=schema)) == want[4:]
    assert snapshot_dates(spark, base, "c.csv") == ["2024-02-28", "2024-03-01", "2024-03-02"]
    assert values(read_snapshots(spark, base, "c.csv", schema=schema, dates=["2024-02-28", "2024-03-01"])) == want[:4]
    # The next landing of the day replaces both the earlier one and what the dead one left.
    write_dated_csv(frame("c"), base, "c.csv", "2024-03-02")
    assert sorted(r["v"] for r in read_csv(spark, f"{base}/2024-03-02/c.csv", schema=schema).collect()) == ["c", "c"]
    # The newest snapshot does not need the older folders.
    shutil.move(f"{base}/2024-03-01", str(tmp_path / "away"))
    assert [v for _, _, v in values(read_latest_snapshot(spark, base, "c.csv", schema=schema))] == ["c", "c"]


def test_parts_of_a_date_add_up(spark, tmp_path):
    base = str(tmp_path)
    one = lambda i: spark.createDataFrame([(i,)], "id int")
    for i, part in ((1, "batch_id=0"), (2, "batch_id=1"), (3, "batch_id=1")):  # the last is a retry
        write_dated_csv(one(i), base, "c.csv", "2024-03-01", part)
    rows = read_latest_snapshot(spark, base, "c.csv", schema=one(1).schema).collect()
    assert sorted(r["id"] for r in rows) == [1, 3]


def test_partitioned_write_does_not_multiply_files(spark, tmp_path):
    """16 tasks with rows of all 26 cities: far fewer than a file per task and
    city, and several for a city that is larger than a partition should be."""
    rows = spark.range(0, 40_000, 1, 16).selectExpr(
        "id", "IF(id % 3 = 0, 'hot', concat('c', id % 25)) AS city", "sha2(string(id), 256) AS text"
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        path = write_partitioned_parquet(rows, str(tmp_path / "p"), ["city"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {c: len([f for f in os.listdir(f"{path}/{c}") if f.endswith(".parquet")])
             for c in os.listdir(path) if c.startswith("city=")}
    assert len(files) == 26 and files["city=hot"] > 1 and sum(files.values()) <= 16 * 26 / 4
    back = read_partitioned_parquet(spark, path)
    assert back.exceptAll(rows.select(back.columns)).isEmpty() and back.count() == 40_000
