"""Ingestion runs (N4, N5, K1, K4): the three statuses and the landed snapshot."""

from __future__ import annotations

import os
import tempfile
from datetime import datetime, timezone

from sparkmart.ingest import run_all
from sparkmart.sinks.files import write_csv
from sparkmart.sources.config import SourceSpec
from sparkmart.sources.files import read_audit_log, read_snapshots


def test_three_statuses_and_landing(spark):
    d = tempfile.mkdtemp(prefix="sparkmart-ingest-")
    good = spark.createDataFrame([(1, "Ottla", "Kolding"), (2, "Brisa", "Aveiro")],
                                 "`Customer ID` int, `Customer Name` string, City string")
    sparse = spark.createDataFrame([(1, None, None), (2, None, "x")], "a int, b string, c string")
    write_csv(good, f"{d}/in/good")
    write_csv(sparse, f"{d}/in/sparse")
    specs = [
        SourceSpec("customers_from_csv", "csv", "raw/csv/customers/customers.csv", path=f"{d}/in/good"),
        SourceSpec("sparse", "csv", "raw/csv/sparse/sparse.csv", path=f"{d}/in/sparse"),
        SourceSpec("missing", "csv", "raw/csv/missing/m.csv", path=f"{d}/in/nope"),
    ]
    clock = datetime(2024, 5, 6, 23, 59, tzinfo=timezone.utc)
    rows = run_all(spark, specs, f"{d}/lake", f"{d}/lake/logs/log", run_clock=clock)
    assert [(r.dataset_name, r.status, r.rows) for r in rows] == [
        ("customers_from_csv", "SUCCESS", 2), ("sparse", "REJECTED", 0), ("missing", "FAILED", 0),
    ]
    assert rows[0].notes == "OK" and "[ERROR]" in rows[1].notes
    assert os.path.isdir(f"{d}/lake/raw/csv/customers/2024-05-06/customers.csv")
    landed = read_snapshots(spark, f"{d}/lake/raw/csv/customers", "customers.csv")
    assert set(landed.columns) >= {"customer_id", "customer_name", "city", "source_type",
                                   "ingestion_time", "snapshot_date"}
    assert {r["ingestion_time"] for r in landed.collect()} == {clock.isoformat()}
    log = read_audit_log(spark, f"{d}/lake/logs/log")
    assert log.count() == 3
    again = run_all(spark, specs, f"{d}/lake2", f"{d}/lake2/logs/log", run_clock=clock,
                    max_parallel_sources=3)
    assert [(r.dataset_name, r.status, r.rows) for r in again] == [
        (r.dataset_name, r.status, r.rows) for r in rows
    ]


def test_cli_and_storage_settings(spark, tmp_path):
    from sparkmart.ingest import main
    from sparkmart.sources.config import load_storage

    (tmp_path / "storage.yaml").write_text('endpoint: "localhost:9000"\nbucket: "datalake"\nsecure: false\n')
    st = load_storage(str(tmp_path / "storage.yaml"))
    assert st.base_uri == "s3a://datalake" and st.endpoint == "localhost:9000" and not st.secure
    (tmp_path / "c.csv").write_text("Customer ID,Name\n1,Ottla\n2,Brisa\n")
    (tmp_path / "sources.yaml").write_text(
        f"files:\n  - {{name: c, source_type: csv, path: {tmp_path}/c.csv, target: raw/csv/c/c.csv}}\n"
    )
    assert main(["--sources", str(tmp_path / "sources.yaml"), "--raw-base", str(tmp_path / "lake")]) == 0
    assert list((tmp_path / "lake" / "raw" / "csv" / "c").iterdir())


def test_parquet_and_xlsx_sources(spark, tmp_path):
    from test_sources_sinks import _workbook

    from sparkmart.sinks.files import write_parquet

    write_parquet(spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string"),
                  str(tmp_path / "p"))
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "products.xlsx").write_bytes(_workbook())
    specs = [
        SourceSpec("from_parquet", "parquet", "raw/pq/t/t.csv", path=str(tmp_path / "p")),
        SourceSpec("products_from_xlsx", "xlsx", "raw/xlsx/products/products.csv",
                   path=str(tmp_path / "x")),
    ]
    rows = run_all(spark, specs, str(tmp_path / "lake"), str(tmp_path / "lake" / "log"))
    assert [(r.dataset_name, r.status, r.rows) for r in rows] == [
        ("from_parquet", "SUCCESS", 2), ("products_from_xlsx", "SUCCESS", 2),
    ]
