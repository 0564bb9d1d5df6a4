"""Audit log (K4): one row per ingestion attempt, appended as CSV.

The rows of a run form one small DataFrame written with ``mode("append")``:
every part file carries its own header, and the reader
(:func:`sparkmart.sources.files.read_audit_log`) skips them, so the log is
"header only when new" per file and safe to append from any run.
"""

from __future__ import annotations

from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, SparkSession

from sparkmart.sources.files import AUDIT_SCHEMA

# The three ingestion statuses.
STATUS_SUCCESS = "SUCCESS"
STATUS_REJECTED = "REJECTED"
STATUS_FAILED = "FAILED"


@dataclass
class AuditRow:
    timestamp: str
    dataset_name: str
    source_type: str
    rows: int
    status: str
    notes: str


def audit_frame(spark: SparkSession, rows: list[AuditRow]) -> DataFrame:
    return spark.createDataFrame([astuple(r) for r in rows], AUDIT_SCHEMA)


def append_audit(spark: SparkSession, rows: list[AuditRow], path: str, mode: str = "append") -> None:
    """``mode="overwrite"`` on a path of its own makes a retried append safe."""
    if not rows:
        return
    (
        audit_frame(spark, rows)
        .coalesce(1)
        .write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .csv(path)
    )
