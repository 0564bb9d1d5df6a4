"""File sources: CSV (S2, S6), dated snapshots (S4, S5), partitioned Parquet
(S7), the audit log (S8).

Readers take an explicit schema wherever one is known: inference costs an
extra pass over the input and can re-type columns between runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.sinks import manifest
from sparkmart.sources.csv_catalogue import CsvFile, csv_files, with_line_breaks

# The tokens a pandas CSV reader treats as missing by default.
# Spark's CSV reader only maps the empty string to NULL, so ``read_csv``
# nulls these out to keep the same meaning for ingested files.
PANDAS_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

SNAPSHOT_DATE_PATTERN = r"/(\d{4}-\d{2}-\d{2})/"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    header: bool = True,
    na_tokens: tuple[str, ...] | None = None,
    infer_schema: bool = False,
    multi_line: bool | None = None,
    path_column: str | None = None,
) -> DataFrame:
    """Read CSV files or folders of part files as they are.

    With a header, every file's columns are found by its own header record
    (files are grouped by header, one scan a header): columns may come in any
    order, and those that ``schema`` does not name are not read.  A column of
    ``schema`` that a file lacks is an error; without a schema it is NULL
    there.  Without a header, columns go by place.

    Blanks at either end of a value are kept and quoted line breaks belong to
    their value.  A file that may hold such breaks is read by one task;
    ``multi_line`` says whether any may, and None looks: only files larger than
    a split are looked at, and not if all wanted columns are numbers or dates,
    since smaller ones are one task either way.

    Empty values are NULL and ``na_tokens`` become NULL.  Values that do not
    parse as their declared type become NULL (``try_cast``) instead of failing
    the job.  ``path_column`` adds the path of each row's file.
    """
    def scan(**options) -> DataFrameReader:
        return spark.read.options(
            escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **options
        )

    if not header:
        reader = scan(multiLine=multi_line is not False)
        reader = reader.schema(_texts(len(schema.fields))) if schema is not None else reader
        raw = reader.csv(path)
        names = [f.name for f in schema.fields] if schema is not None else raw.columns
        return _typed(raw, list(names), schema, na_tokens, path_column)

    files = csv_files(spark, path)
    if not files:  # files without a single record
        names = [f.name for f in schema.fields] if schema is not None else []
        empty = scan().schema(_texts(len(names))).csv(path)
        return _typed(empty, names, schema, na_tokens, path_column).limit(0)
    whole = _unsplit(spark, files, schema, multi_line)
    groups: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for f in files:
        groups.setdefault((f.header, f.path in whole), []).append(f.path)
    frames = []
    for (names, unsplit), paths in groups.items():
        where = path if len(groups) == 1 else paths
        if infer_schema and schema is None and na_tokens is None:
            inferred = scan(header=True, multiLine=unsplit, inferSchema=True).csv(where).schema
            kinds = _named(names, [k.dataType for k in inferred])
        else:
            kinds = _named(names, [T.StringType()] * len(names))
        raw = scan(header=True, multiLine=unsplit).schema(kinds).csv(where)
        frames.append(_typed(raw, list(names), schema, na_tokens, path_column))
    return _united(frames)


def _texts(n: int) -> T.StructType:
    return _named([f"c{i}" for i in range(n)], [T.StringType()] * n)


def _named(names: list[str] | tuple[str, ...], kinds: list[T.DataType]) -> T.StructType:
    """A scan's schema; names that differ only in case are replaced by places."""
    if len({n.lower() for n in names}) < len(names):
        names = [f"c{i}" for i in range(len(names))]
    return T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)])


def _typed(
    raw: DataFrame, names: list[str], schema: T.StructType | None,
    na_tokens: tuple[str, ...] | None, path_column: str | None,
) -> DataFrame:
    """The columns of ``raw``, which are called ``names``, as ``schema`` wants them."""
    tokens = list(na_tokens or ())
    found = dict(zip(names, raw.columns, strict=False))

    def value(column: str) -> Column:
        c = F.col("`" + column.replace("`", "``") + "`")
        return F.when(~c.isin(tokens), c) if tokens else c

    if schema is None:
        columns = [value(c).alias(n) for n, c in found.items()]
    else:
        missing = [f.name for f in schema.fields if f.name not in found]
        if missing:
            raise ValueError(f"no column {', '.join(missing)} in a file with {', '.join(names)}")
        columns = [
            (
                value(found[f.name]) if isinstance(f.dataType, T.StringType)
                else value(found[f.name]).try_cast(f.dataType)
            ).alias(f.name)
            for f in schema.fields
        ]
    if path_column is not None:
        columns.append(F.col("_metadata.file_path").alias(path_column))
    return raw.select(*columns)


def _unsplit(
    spark: SparkSession, files: list[CsvFile], schema: T.StructType | None, multi_line: bool | None
) -> set[str]:
    """The files to be read by one task each."""
    if multi_line is not None:
        return {f.path for f in files} if multi_line else set()
    numbers = schema is not None and not any(isinstance(f.dataType, T.StringType) for f in schema.fields)
    # Another column that is not wanted may hold text, and so a line break.
    if numbers and all(set(f.header) <= set(schema.names) for f in files):
        return set()
    split = _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes", "128m"))
    large = [f.path for f in files if f.length > split]
    return {f.path for f in files if f.length <= split} | with_line_breaks(spark, large)


def _bytes(text: str) -> int:
    text = text.strip().lower().removesuffix("b")
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}.get(text[-1:], 1)
    return int(text.rstrip("kmgt")) * unit


def _united(frames: list[DataFrame]) -> DataFrame:
    """All rows by column name; a column whose inferred types differ is a
    double if all are numbers, and text otherwise."""
    kinds: dict[str, set] = {}
    for df in frames:
        for f in df.schema.fields:
            kinds.setdefault(f.name, set()).add(f.dataType)
    for name, found in kinds.items():
        if len(found) > 1:
            kind = T.DoubleType() if all(isinstance(k, T.NumericType) for k in found) else T.StringType()
            quoted = "`" + name.replace("`", "``") + "`"
            frames = [
                df.withColumn(name, F.col(quoted).cast(kind)) if name in df.columns else df for df in frames
            ]
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def read_partitioned_parquet(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Parquet under ``key=value`` folders.  A filter on a partition column
    becomes a ``PartitionFilters`` entry and skips whole folders."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_snapshots(
    spark: SparkSession,
    base: str,
    filename: str,
    schema: T.StructType | None = None,
    dates: list[str] | None = None,
) -> DataFrame:
    """Every dated snapshot ``base/<YYYY-MM-DD>/<filename>``, with the
    folder date as ``snapshot_date`` (from the file path metadata column).
    The manifest says which files count; folders that are older than it, or
    have none, are read as they lie."""
    files = manifest.snapshot_files(spark, base, filename, dates)
    if files is None:
        older = dates
    else:
        first = manifest.committed_dates(spark, base, filename)[0]
        older = _folder_dates(spark, base, filename) if dates is None else dates
        older = [d for d in older if d < first]
    if older is None:
        paths: str | list[str] = f"{base}/*/{filename}"
    else:
        paths = [f"{base}/{d}/{filename}" for d in older] + (files or [])
        if not paths:
            raise FileNotFoundError(f"no such snapshots under {base}")
    df = read_csv(spark, paths, schema=schema, path_column="__path")
    date = F.to_date(F.regexp_extract("__path", SNAPSHOT_DATE_PATTERN, 1))
    return df.withColumn("snapshot_date", date).drop("__path")


def snapshot_dates(spark: SparkSession, base: str, filename: str) -> list[str]:
    """Dates of the snapshots of ``filename`` under ``base``."""
    dates = manifest.committed_dates(spark, base, filename)
    return [d for d in _folder_dates(spark, base, filename) if not dates or d < dates[0]] + dates


def _folder_dates(spark: SparkSession, base: str, filename: str) -> list[str]:
    """Dates of the folders under ``base`` holding ``filename``.

    A ``binaryFile`` read selecting only the path lists files without opening
    them; the result is one row per date folder.
    """
    try:
        files = spark.read.format("binaryFile").load(f"{base}/*/{filename}")
        dates = files.select(F.regexp_extract("path", SNAPSHOT_DATE_PATTERN, 1).alias("d"))
        return sorted(r["d"] for r in dates.where(F.col("d") != "").distinct().collect())
    except Exception as e:  # noqa: BLE001 - no matching folder at all
        if manifest.missing_path(e):
            return []
        raise


def read_latest_snapshot(
    spark: SparkSession, base: str, filename: str, schema: T.StructType | None = None
) -> DataFrame:
    """Only the newest snapshot.  Its date and files come from the manifest,
    so older folders are not even listed; without a manifest the newest folder
    of a listing is taken."""
    dates = manifest.committed_dates(spark, base, filename) or _folder_dates(spark, base, filename)
    if not dates:
        raise FileNotFoundError(f"no dated snapshot folders under {base}")
    return read_snapshots(spark, base, filename, schema=schema, dates=[dates[-1]])


def latest_per_key(df: DataFrame, keys: list[str], order_col: str = "snapshot_date") -> DataFrame:
    """The newest row of every key across all snapshots (history-aware S5).

    ``max_by`` over a struct of the row is an ordinary aggregate: each task
    keeps one candidate per key before the shuffle, so a key present in
    every snapshot — or holding a third of all rows — costs one row per task,
    unlike a window that sorts all of a key's rows in one task.
    """
    others = [c for c in df.columns if c not in keys]
    latest = df.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in others]), F.col(order_col)).alias("__row")
    )
    return latest.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in others])


AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("dataset_name", T.StringType()),
        T.StructField("source_type", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("notes", T.StringType()),
    ]
)


def read_audit_log(spark: SparkSession, path: str) -> DataFrame:
    """The audit log with its subfolders (a stream's batches have one each);
    notes may span lines and hold doubled quotes."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    return reader.option("recursiveFileLookup", True).schema(AUDIT_SCHEMA).csv(path)
