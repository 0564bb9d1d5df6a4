"""What lies in a set of CSV files: sizes, header records, line breaks.

Files of one dataset need not agree: a later landing may have other columns or
the same ones in another order.  The header record of every file is read by
one slim job (a task a file, ended after its first record), so that a reader
can scan the files of each header under their own column names.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class CsvFile:
    path: str
    length: int
    header: tuple[str, ...]


def list_files(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    """Files under a path or glob with size and modification time.
    ``binaryFile`` prunes the content column, so no file is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    return reader.load(path).select("path", "length", "modificationTime")


def _one_task_a_file(spark: SparkSession) -> SparkSession:
    """A session of the same application (own settings) that opens every file
    in a task of its own and hands Python a few rows at a time."""
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 40))
    own.conf.set("spark.sql.files.openCostInBytes", str(1 << 40))
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    return own


def _first_record(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first record of the file whose lines come; nothing after it is read.
    A record goes on over line breaks inside quotes."""
    lines: list[str] = []
    for batch in batches:
        for path, start, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if start:  # a later part of a very large file
                return
            if not lines and not line.lstrip("﻿").strip():
                continue
            lines.append(line)
            record = "\n".join(lines)
            if record.count('"') % 2 == 0:
                names = next(csv.reader([record.lstrip("﻿")], strict=False))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([names], pa.list_(pa.string()))], ["path", "header"]
                )
                return


def csv_files(spark: SparkSession, path: str | list[str]) -> list[CsvFile]:
    """The files under ``path`` that hold a header record, with their columns.

    Two rows a file come to the driver, which lists the same files to plan any
    scan of them.
    """
    listed = {r["path"]: r["length"] for r in list_files(spark, path).collect() if r["length"]}
    if not listed:
        return []
    lines = _one_task_a_file(spark).read.text(path)
    lines = lines.select("_metadata.file_path", "_metadata.file_block_start", "value")
    heads = lines.mapInArrow(_first_record, "path string, header array<string>").collect()
    return sorted(
        (CsvFile(p, listed[p], column_names(r["header"])) for r in heads if (p := unquote(r["path"])) in listed),
        key=lambda f: f.path,
    )


def column_names(header: list[str | None]) -> tuple[str, ...]:
    """A header's columns: one without a name is ``_c<place>``, a name that
    comes again gets ``.1``, ``.2`` ... as table readers do."""
    seen: dict[str, int] = {}
    names: list[str] = []
    for i, name in enumerate(header):
        name = name or f"_c{i}"
        n = seen.get(name, 0)
        seen[name] = n + 1
        names.append(f"{name}.{n}" if n else name)
    return tuple(names)


def with_line_breaks(spark: SparkSession, paths: list[str]) -> set[str]:
    """Those of ``paths`` in which a quoted value may hold a line break: some
    line has an odd number of quotes.  One splittable pass over the lines; a
    file name for each such file comes back."""
    if not paths:
        return set()
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    odd = spark.read.text(paths).filter(quotes % 2 == 1)
    return {unquote(r[0]) for r in odd.select("_metadata.file_path").distinct().collect()}
