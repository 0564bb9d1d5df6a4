"""Manifest of the dated raw zone.

Each landing writes its files first and then one small row that names them,
under ``base/_manifests/<name>.rows``.  Readers take dates and files from
those rows: a landing that died half-way is not seen, a landing that runs
again on the same day replaces the earlier one in one step, and finding the
newest date opens no folder of an older one.

A row is ``(date, part, landed, files)``: of the rows of one date and part
the one that landed last counts.  A batch landing has the part ``""``; a
stream's batches have one each and add up to their date.

Folders without a manifest (landed by other tools) are read as they lie, and
so are dates before the first one that a manifest names.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS = "date string, part string, landed long, files array<string>"


def dated_path(base: str, run_date: str, name: str, part: str = "") -> str:
    """``base/<YYYY-MM-DD>/<name>`` — the raw-zone layout."""
    path = f"{base.rstrip('/')}/{run_date}/{name}"
    return f"{path}/{part}" if part else path


def _rows_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/_manifests/{name}.rows"


def missing_path(e: Exception) -> bool:
    return "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e)


def _names(spark: SparkSession, path: str) -> set[str]:
    """Names of the files that lie in one folder (not in folders below it)."""
    try:
        files = spark.read.format("binaryFile").load(path).select("path")
        found = [r["path"].rsplit("/", 2) for r in files.collect()]
        return {name for _, folder, name in found if folder == path.rsplit("/", 1)[1]}
    except Exception as e:  # noqa: BLE001 - no such folder yet
        if missing_path(e):
            return set()
        raise


def committed(spark: SparkSession, base: str, name: str) -> DataFrame | None:
    """The rows that count, or None without a manifest."""
    try:
        rows = spark.read.schema(ROWS).json(_rows_path(base, name))
    except Exception as e:  # noqa: BLE001 - nothing has landed with a manifest
        if missing_path(e):
            return None
        raise
    last = rows.groupBy("date", "part").agg(F.max_by("files", "landed").alias("files"))
    return None if last.isEmpty() else last


def land(write, df: DataFrame, base: str, name: str, run_date: str, part: str = "") -> str:
    """Write ``df`` with ``write(df, path, mode)`` into its dated folder, commit
    the new files, and remove those that they replace (an earlier landing's,
    or what a landing left that died before its commit)."""
    spark = df.sparkSession
    path = dated_path(base, run_date, name, part)
    before = _names(spark, path)
    write(df, path, "append")
    files = sorted(_names(spark, path) - before)
    row = spark.createDataFrame([(run_date, part, time.time_ns(), files)], ROWS)
    row.coalesce(1).write.mode("append").json(_rows_path(base, name))
    if before:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
        for old in before:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(at, old), False)
    return path


def snapshot_files(
    spark: SparkSession, base: str, name: str, dates: list[str] | None = None, latest: bool = False
) -> list[str] | None:
    """Paths of the committed files of ``dates``, of the newest date
    (``latest``) or of all dates; None without a manifest."""
    rows = committed(spark, base, name)
    if rows is None:
        return None
    if dates is not None:
        rows = rows.where(F.col("date").isin(list(dates)))
    if latest:
        rows = rows.where(F.col("date") == rows.agg(F.max("date")).first()[0])
    return [f"{dated_path(base, r['date'], name, r['part'])}/{f}" for r in rows.collect() for f in r["files"]]


def committed_dates(spark: SparkSession, base: str, name: str) -> list[str]:
    rows = committed(spark, base, name)
    return [] if rows is None else sorted(r["date"] for r in rows.select("date").distinct().collect())
