"""Incremental ingestion of files as they land (N4 as a stream).

The batch ingestion run reads a whole source each time.  For a landing
folder that keeps receiving files, the same steps run as a Structured
Streaming query.  What streams is the *names* of the files: the file source
tracks which were already taken (in the checkpoint), and each micro-batch hands
its names to the batch run's reader, so that columns are found by each file's
header and line breaks, blanks and missing-value tokens mean what they mean
there.  The batch is validated, standardised, written to the dated raw zone
and audited inside ``foreachBatch``.

Restart safety: a batch's clock is that of its first attempt, kept beside the
checkpoint, so a retry (even on another day) rewrites the same dated folder
``batch_id=<n>`` and the same audit file.  A batch that fails leaves a FAILED
audit row, which its successful retry replaces.  The checkpoint is the
caller's: a restart with another one takes all files again.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sparkmart.ingest import raw_folder
from sparkmart.operators.quality import DEFAULT_NULL_THRESHOLD, validate
from sparkmart.operators.standardize import standardize_columns
from sparkmart.sinks.audit import STATUS_FAILED, STATUS_REJECTED, STATUS_SUCCESS, AuditRow, append_audit
from sparkmart.sinks.files import write_dated_csv
from sparkmart.sources.files import PANDAS_NA_TOKENS, read_csv

FILES = "path string, modificationTime timestamp, length long, content binary"


def ingest_landing_stream(
    spark: SparkSession,
    landing_dir: str,
    schema: T.StructType,
    name: str,
    source_type: str,
    target: str,
    raw_base: str,
    audit_path: str,
    checkpoint: str,
    null_threshold: float = DEFAULT_NULL_THRESHOLD,
    available_now: bool = True,
    max_files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it takes every file present
    and stops (call ``awaitTermination``).  ``max_files_per_trigger`` bounds
    the names that a batch brings to the driver."""
    files = (
        spark.readStream.format("binaryFile").schema(FILES)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(landing_dir).select("path")  # the files' contents are not read here
    )

    def first_attempt(batch_id: int) -> datetime:
        path = f"{checkpoint.rstrip('/')}-clocks/{batch_id}"
        now = datetime.now(timezone.utc).isoformat()
        # "ignore": a folder that an earlier attempt wrote stays as it is
        spark.createDataFrame([(now,)], "clock string").coalesce(1).write.mode("ignore").json(path)
        row = spark.read.schema("clock string").json(path).first()
        return datetime.fromisoformat(row["clock"] if row else now)

    def process(batch: DataFrame, batch_id: int) -> None:
        clock = first_attempt(batch_id)
        stamp = clock.isoformat()
        audit = f"{audit_path.rstrip('/')}/{name}-batch-{batch_id}"
        paths = sorted(r["path"] for r in batch.collect())
        if not paths:
            return
        data = None
        try:
            data = read_csv(spark, paths, schema=schema, na_tokens=PANDAS_NA_TOKENS)
            data = data.persist(StorageLevel.MEMORY_AND_DISK)
            report = validate(data, name, null_threshold)
            if report.n_rows == 0:
                return
            if not report.is_valid:
                row = AuditRow(stamp, name, source_type, 0, STATUS_REJECTED, " | ".join(report.messages))
            else:
                out = standardize_columns(data, source_type, ingestion_time=stamp)
                folder, filename = raw_folder(raw_base, target)
                day = clock.date().isoformat()
                write_dated_csv(out, folder, filename, day, part=f"batch_id={batch_id}")
                notes = " | ".join(report.messages) if report.messages else "OK"
                row = AuditRow(stamp, name, source_type, report.n_rows, STATUS_SUCCESS, notes)
            append_audit(spark, [row], audit, mode="overwrite")
        except Exception as e:
            failed = AuditRow(stamp, name, source_type, 0, STATUS_FAILED, str(e)[:500])
            append_audit(spark, [failed], audit, mode="overwrite")
            raise
        finally:
            if data is not None:
                data.unpersist()

    writer = (
        files.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .queryName(f"ingest_{name}")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="30 seconds"
    )
    return writer.start()
