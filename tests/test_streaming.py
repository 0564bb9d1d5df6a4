"""Streaming ingestion: files are taken once, across restarts of the stream."""

from __future__ import annotations

import tempfile

import pytest

from sparkmart.sinks.files import write_csv
from sparkmart.sources.files import PANDAS_NA_TOKENS, read_audit_log, read_csv
from sparkmart.streaming.landing import ingest_landing_stream


def test_incremental_batches_survive_restart(spark):
    d = tempfile.mkdtemp(prefix="sparkmart-stream-")
    schema = "`Customer ID` int, Name string"
    first = spark.createDataFrame([(1, "a"), (2, "b")], schema)
    second = spark.createDataFrame([(3, "c")], schema)
    bad = spark.createDataFrame([(None, None), (4, None)], schema)
    ckpt = f"{d}/ckpt"
    target = "raw/stream/c/c.csv"

    def run():
        q = ingest_landing_stream(spark, f"{d}/landing/*", first.schema, "c", "csv", target,
                                  f"{d}/lake", f"{d}/lake/log", checkpoint=ckpt)
        q.awaitTermination()

    write_csv(first, f"{d}/landing/one")
    run()
    write_csv(second, f"{d}/landing/two")
    run()
    run()  # nothing new: no batch, no audit row
    write_csv(bad, f"{d}/landing/three")
    run()
    landed = read_csv(spark, f"{d}/lake/raw/stream/c/*/c.csv/*")
    assert sorted(r["customer_id"] for r in landed.collect()) == ["1", "2", "3"]
    log = sorted((r["rows"], r["status"]) for r in read_audit_log(spark, f"{d}/lake/log").collect())
    assert log == [(0, "REJECTED"), (1, "SUCCESS"), (2, "SUCCESS")]


def test_a_batch_retried_on_another_day_lands_once(spark, tmp_path, monkeypatch):
    from datetime import datetime, timezone

    from sparkmart.streaming import landing as L

    class Clock(datetime):
        day = 1

        @classmethod
        def now(cls, tz=None):
            return datetime(2030, 1, cls.day, 23, 59, tzinfo=timezone.utc)

    monkeypatch.setattr(L, "datetime", Clock)
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    write_csv(rows, f"{tmp_path}/landing/one")

    def run():
        q = L.ingest_landing_stream(spark, f"{tmp_path}/landing/*", rows.schema, "c", "csv", "raw/c/c.csv",
                                    f"{tmp_path}/lake", f"{tmp_path}/log", checkpoint=f"{tmp_path}/ckpt")
        q.awaitTermination()

    real, fails = L.append_audit, [True]

    def failing(spark, audit_rows, path, mode="append"):
        if fails and audit_rows[0].status == "SUCCESS":
            fails.clear()
            raise RuntimeError("lost after the write")
        real(spark, audit_rows, path, mode)

    monkeypatch.setattr(L, "append_audit", failing)
    with pytest.raises(Exception, match="lost after the write"):
        run()
    assert [r["status"] for r in read_audit_log(spark, f"{tmp_path}/log").collect()] == ["FAILED"]
    Clock.day = 2
    run()
    landed = read_csv(spark, f"{tmp_path}/lake/raw/c/*/c.csv/*").collect()
    assert sorted(r["id"] for r in landed) == ["1", "2"]
    log = read_audit_log(spark, f"{tmp_path}/log").collect()
    assert [(r["rows"], r["status"]) for r in log] == [(2, "SUCCESS")]


def test_stream_reads_as_the_batch_run(spark, tmp_path):
    """Other column order, quoted line break, blanks, missing-value tokens:
    same rows and same audit."""
    from sparkmart.ingest import run_source
    from sparkmart.sources.config import SourceSpec

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_text('b,a\n"x\ny", 1\n" z ",2\n')
    (tmp_path / "in" / "2.csv").write_text("a,c,b\n3,drop,NA\n4,drop,w\n")
    schema = spark.createDataFrame([], "a int, b string").schema
    q = ingest_landing_stream(spark, f"{tmp_path}/in", schema, "c", "csv", "raw/c/c.csv",
                              f"{tmp_path}/s", f"{tmp_path}/s/log", checkpoint=f"{tmp_path}/ckpt")
    q.awaitTermination()
    streamed = read_csv(spark, f"{tmp_path}/s/raw/c/*/c.csv/*").drop("ingestion_time")

    def extract(sp, spec):
        return read_csv(sp, spec.path, schema=schema, na_tokens=PANDAS_NA_TOKENS)

    spec = SourceSpec("c", "csv", "raw/c/c.csv", path=f"{tmp_path}/in")
    audit = run_source(spark, spec, f"{tmp_path}/b", extract=extract)
    landed = read_csv(spark, f"{tmp_path}/b/raw/c/*/c.csv").drop("ingestion_time")
    order = lambda df: sorted(map(tuple, df.select("a", "b", "source_type").collect()), key=str)
    assert order(streamed) == order(landed) == [
        ("1", "x\ny", "csv"), ("2", " z ", "csv"), ("3", None, "csv"), ("4", "w", "csv")
    ]
    log = read_audit_log(spark, f"{tmp_path}/s/log").first()
    assert (log["rows"], log["status"], log["notes"]) == (audit.rows, audit.status, audit.notes)
