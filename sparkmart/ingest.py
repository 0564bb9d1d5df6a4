"""Ingestion runs (N4, N5): extract → validate → (reject) → standardise →
land a dated snapshot → audit.

Each source is one DataFrame; the driver sees only the quality summary row
and the audit rows.  The extracted frame is persisted between validation and
the write so the source is read once.  One source's failure is logged and
never stops the next.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from sparkmart.operators.quality import DEFAULT_NULL_THRESHOLD, validate
from sparkmart.operators.standardize import standardize_columns
from sparkmart.sinks.audit import (
    STATUS_FAILED,
    STATUS_REJECTED,
    STATUS_SUCCESS,
    AuditRow,
    append_audit,
)
from sparkmart.sinks.files import write_dated_csv
from sparkmart.sinks.manifest import dated_path
from sparkmart.sources.config import SourceSpec
from sparkmart.sources.files import PANDAS_NA_TOKENS, read_csv
from sparkmart.sources.jdbc import read_jdbc
from sparkmart.sources.xlsx import read_xlsx


def default_extract(spark: SparkSession, spec: SourceSpec, password: str | None = None) -> DataFrame:
    if spec.source_type == "rdbms":
        return read_jdbc(
            spark, spec.jdbc_url, query=spec.query, user=spec.jdbc_user, password=password,
            **spec.options,
        )
    if spec.source_type == "csv":
        return read_csv(spark, spec.path, na_tokens=PANDAS_NA_TOKENS)
    if spec.source_type == "xlsx":
        return read_xlsx(spark, spec.path)
    if spec.source_type == "parquet":
        return spark.read.parquet(spec.path)
    raise ValueError(f"unknown source type {spec.source_type!r}")


def raw_target(raw_base: str, target: str, run_date: str) -> str:
    """``raw/x/y/file.csv`` → ``<raw_base>/raw/x/y/<run_date>/file.csv``."""
    folder, filename = raw_folder(raw_base, target)
    return dated_path(folder, run_date, filename)


def raw_folder(raw_base: str, target: str) -> tuple[str, str]:
    folder, filename = target.rsplit("/", 1)
    return f"{raw_base.rstrip('/')}/{folder}", filename


def run_source(
    spark: SparkSession,
    spec: SourceSpec,
    raw_base: str,
    *,
    run_clock: datetime | None = None,
    extract: Callable[[SparkSession, SourceSpec], DataFrame] | None = None,
    null_threshold: float = DEFAULT_NULL_THRESHOLD,
) -> AuditRow:
    clock = run_clock or datetime.now(timezone.utc)
    stamp = clock.isoformat()
    extract = extract or default_extract
    df = None
    try:
        df = extract(spark, spec).persist(StorageLevel.MEMORY_AND_DISK)
        report = validate(df, spec.name, null_threshold)
        if not report.is_valid:
            return AuditRow(stamp, spec.name, spec.source_type, 0, STATUS_REJECTED,
                            " | ".join(report.messages))
        out = standardize_columns(df, spec.source_type, ingestion_time=stamp)
        folder, filename = raw_folder(raw_base, spec.target)
        write_dated_csv(out, folder, filename, clock.date().isoformat())
        notes = " | ".join(report.messages) if report.messages else "OK"
        return AuditRow(stamp, spec.name, spec.source_type, report.n_rows, STATUS_SUCCESS, notes)
    except Exception as e:  # noqa: BLE001 - every failure becomes an audit row
        return AuditRow(stamp, spec.name, spec.source_type, 0, STATUS_FAILED, str(e))
    finally:
        if df is not None:
            df.unpersist()


def run_all(
    spark: SparkSession,
    specs: list[SourceSpec],
    raw_base: str,
    audit_path: str,
    *,
    run_clock: datetime | None = None,
    extract: Callable[[SparkSession, SourceSpec], DataFrame] | None = None,
    null_threshold: float = DEFAULT_NULL_THRESHOLD,
    max_parallel_sources: int = 1,
) -> list[AuditRow]:
    """Run sources (databases first, as listed) and append the audit.

    One UTC clock serves the snapshot folder date and ``ingestion_time``.
    With ``max_parallel_sources > 1`` several sources' Spark jobs run at the
    same time from a thread pool (the scheduler interleaves their tasks);
    audit rows keep the listed order either way.
    """
    clock = run_clock or datetime.now(timezone.utc)
    ordered = sorted(specs, key=lambda s: 0 if s.source_type == "rdbms" else 1)

    def one(spec: SourceSpec) -> AuditRow:
        return run_source(spark, spec, raw_base, run_clock=clock, extract=extract,
                          null_threshold=null_threshold)

    if max_parallel_sources > 1:
        with ThreadPoolExecutor(max_workers=max_parallel_sources) as pool:
            rows = list(pool.map(one, ordered))
    else:
        rows = [one(s) for s in ordered]
    append_audit(spark, rows, audit_path)
    return rows


def main(argv: list[str] | None = None) -> int:
    """Command line: ``python -m sparkmart.ingest --sources sources.yaml ...``.

    The raw zone is ``--raw-base`` (any Hadoop URI) or the bucket named in
    ``--storage``; object-store credentials come from the cluster's Hadoop
    configuration (``spark.hadoop.fs.s3a.*``), not from this tool.
    """
    import argparse

    from sparkmart.session import build_session
    from sparkmart.sources.config import load_sources, load_storage

    ap = argparse.ArgumentParser(description="ingest declared sources into the raw zone")
    ap.add_argument("--sources", required=True)
    ap.add_argument("--storage", help="storage settings file (bucket, endpoint, secure)")
    ap.add_argument("--raw-base", help="raw-zone base URI; overrides --storage")
    ap.add_argument("--audit", help="audit log folder (default: <raw-base>/logs/ingestion_log)")
    ap.add_argument("--db-password-env", default="DB_PASSWORD",
                    help="environment variable that holds the database password")
    ap.add_argument("--master", default=None)
    ap.add_argument("--parallel", type=int, default=1)
    a = ap.parse_args(argv)
    extra = {}
    raw_base = a.raw_base
    if raw_base is None:
        if not a.storage:
            ap.error("give --raw-base or --storage")
        st = load_storage(a.storage)
        raw_base = st.base_uri
        if st.endpoint:
            scheme = "https" if st.secure else "http"
            ep = st.endpoint if "://" in st.endpoint else f"{scheme}://{st.endpoint}"
            extra = {"spark.hadoop.fs.s3a.endpoint": ep, "spark.hadoop.fs.s3a.path.style.access": "true"}
    spark = build_session(a.master, app_name="sparkmart-ingest", extra_conf=extra)
    specs = load_sources(a.sources)

    def extract(sp: SparkSession, spec: SourceSpec) -> DataFrame:
        return default_extract(sp, spec, password=os.environ.get(a.db_password_env))

    rows = run_all(spark, specs, raw_base, a.audit or f"{raw_base}/logs/ingestion_log",
                   extract=extract, max_parallel_sources=a.parallel)
    for r in rows:
        print(f"[{r.status}] {r.dataset_name}: {r.rows} rows — {r.notes}")
    return 0 if all(r.status != STATUS_FAILED for r in rows) else 1


if __name__ == "__main__":
    raise SystemExit(main())
