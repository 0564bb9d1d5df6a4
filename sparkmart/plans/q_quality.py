"""Quality, standardisation, snapshot and ingestion queries:
V1–V5, N1–N5, K1, K4, S2, S4, S5, S8."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart import adapter
from sparkmart import ingest as ing
from sparkmart.operators import quality
from sparkmart.operators.standardize import standardize_columns
from sparkmart.plans import query
from sparkmart.plans.oracle import with_domain
from sparkmart.session import scratch_path
from sparkmart.sinks.files import write_csv, write_dated_csv
from sparkmart.sources.config import SourceSpec, load_sources
from sparkmart.sources.files import (
    latest_per_key,
    read_audit_log,
    read_csv,
    read_latest_snapshot,
    read_snapshots,
)

LINEITEM_COLS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
    "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
)


# --------------------------------------------------------------- duplicates
@query(
    "quality_duplicates",
    f"""
WITH t AS (SELECT {LINEITEM_COLS} FROM lineitem
           UNION ALL SELECT {LINEITEM_COLS} FROM lineitem WHERE l_returnflag = 'R'),
g AS (SELECT count(*) AS c FROM t GROUP BY {LINEITEM_COLS})
SELECT CAST(sum(c) AS BIGINT) AS n_rows, CAST(sum(c - 1) AS BIGINT) AS duplicate_rows FROM g""",
)
def quality_duplicates(spark, sf_dir):
    li = adapter.table(spark, sf_dir, "lineitem")
    doubled = li.unionByName(li.where(F.col("l_returnflag") == "R"))
    return quality.quality_summary(doubled).select("n_rows", "duplicate_rows")


# ----------------------------------------------------- planted-null frame
# customer keyed by nation and segment only, with NULL balance when negative
# and NULL segment for BUILDING: repeated rows, two columns with nulls.
PLANTED_NAME = "customers_planted"
PLANTED_SQL = """p AS (
  SELECT c_nationkey AS nation_key,
         CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS segment,
         CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance
  FROM customer)"""


def _planted(spark, sf_dir):
    c = adapter.table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_nationkey").alias("nation_key"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
    )


PLANTED_STATS = PLANTED_SQL + """,
s AS (SELECT count(*) AS n,
             count(*) - count(nation_key) AS n0,
             count(*) - count(segment) AS n1,
             count(*) - count(balance) AS n2 FROM p),
d AS (SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS dups
      FROM (SELECT count(*) AS c FROM p GROUP BY nation_key, segment, balance))"""


@query(
    "quality_null_columns",
    "WITH " + PLANTED_STATS + """
SELECT * FROM (
  SELECT 0 AS position, 'nation_key' AS column_name, n0 AS null_count FROM s
  UNION ALL SELECT 1, 'segment', n1 FROM s
  UNION ALL SELECT 2, 'balance', n2 FROM s) WHERE null_count > 0""",
)
def quality_null_columns(spark, sf_dir):
    return quality.null_columns_frame(_planted(spark, sf_dir))


@query(
    "quality_null_ratio",
    "WITH " + PLANTED_STATS + """
SELECT n0 + n1 + n2 AS null_cells, n * 3 AS total_cells,
       (n0 + n1 + n2) / (n * 3) AS null_ratio,
       (n0 + n1 + n2) / (n * 3) > 0.3 AS rejected FROM s""",
)
def quality_null_ratio(spark, sf_dir):
    return quality.null_ratio_frame(_planted(spark, sf_dir), 0.3)


@query(
    "quality_verdict",
    "WITH " + PLANTED_STATS + f""",
msgs AS (
  SELECT 1 AS k, printf('[WARNING] {PLANTED_NAME}: terdapat %d baris duplikat.', dups) AS message
  FROM d WHERE dups > 0
  UNION ALL
  SELECT 2, '[WARNING] {PLANTED_NAME}: kolom dengan null -> ' ||
            concat_ws(', ', CASE WHEN n0 > 0 THEN 'nation_key' END,
                            CASE WHEN n1 > 0 THEN 'segment' END,
                            CASE WHEN n2 > 0 THEN 'balance' END)
  FROM s WHERE n0 + n1 + n2 > 0
  UNION ALL
  SELECT 3, printf('[ERROR] {PLANTED_NAME}: rasio null %.1f%% melewati batas %.1f%% — data ditolak.',
                   (n0 + n1 + n2) / (n * 3) * 100, 30.0)
  FROM s WHERE (n0 + n1 + n2) / (n * 3) > 0.3)
SELECT CAST(row_number() OVER (ORDER BY k) - 1 AS INTEGER) AS seq, message,
       NOT EXISTS (SELECT 1 FROM msgs WHERE k = 3) AS is_valid
FROM msgs""",
)
def quality_verdict(spark, sf_dir):
    return quality.verdict_frame(_planted(spark, sf_dir), PLANTED_NAME, 0.3)


@query(
    "quality_empty_verdict",
    """SELECT CAST(0 AS INTEGER) AS seq, '[ERROR] customers_none: dataframe kosong.' AS message,
       FALSE AS is_valid FROM customer HAVING count(*) FILTER (WHERE c_custkey < 0) = 0""",
)
def quality_empty_verdict(spark, sf_dir):
    """A source whose query finds no row is refused (no key is negative)."""
    found = adapter.table(spark, sf_dir, "customer").where("c_custkey < 0")
    return quality.verdict_frame(found, "customers_none")


# ------------------------------------------------------------ standardise
FIXED_INGESTION_TIME = "2024-01-01T00:00:00+00:00"


@query(
    "standardized_customer",
    with_domain()
    + f"""SELECT customer_id, customer_name, city, segment AS market_segment,
       'rdbms' AS source_type, '{FIXED_INGESTION_TIME}' AS ingestion_time FROM customers""",
)
def standardized_customer(spark, sf_dir):
    c = adapter.customers(spark, sf_dir)
    raw = c.select(
        F.col("customer_id").alias("Customer ID"),
        F.col("customer_name").alias(" Customer Name "),
        F.col("city").alias("CITY"),
        F.col("segment").alias("Market Segment"),
    )
    return standardize_columns(raw, "rdbms", ingestion_time=FIXED_INGESTION_TIME)


# -------------------------------------------------------------- snapshots
SNAPSHOT_DATES = ("2024-01-01", "2024-01-02")
SUPPLIER_SCHEMA = T.StructType(
    [
        T.StructField("s_suppkey", T.LongType()),
        T.StructField("s_name", T.StringType()),
        T.StructField("s_nationkey", T.IntegerType()),
        T.StructField("s_acctbal", T.DoubleType()),
    ]
)
# the later snapshot renames the suppliers of nation 0 (one changed value each)
CHANGED_NATION = 0


def _land_supplier_snapshots(spark, sf_dir) -> str:
    """Two dated snapshots of the whole supplier table."""
    base = scratch_path(spark, "raw-supplier")
    s = adapter.table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_name", "s_nationkey", "s_acctbal"
    )
    changed = s.withColumn(
        "s_name",
        F.when(F.col("s_nationkey") == CHANGED_NATION, F.lower("s_name")).otherwise(F.col("s_name")),
    )
    write_dated_csv(s, base, "supplier.csv", SNAPSHOT_DATES[0])
    write_dated_csv(changed, base, "supplier.csv", SNAPSHOT_DATES[1])
    return base


_SNAP_FIRST = (
    "SELECT s_suppkey, s_name, s_nationkey, s_acctbal,"
    f" '{SNAPSHOT_DATES[0]}' AS snapshot_date FROM supplier"
)
_SNAP_SECOND = (
    f"SELECT s_suppkey, CASE WHEN s_nationkey = {CHANGED_NATION} THEN lower(s_name) ELSE s_name END"
    f" AS s_name, s_nationkey, s_acctbal, '{SNAPSHOT_DATES[1]}' AS snapshot_date FROM supplier"
)


def _with_text_date(df):
    return df.withColumn("snapshot_date", F.date_format("snapshot_date", "yyyy-MM-dd"))


@query("snapshot_all", f"{_SNAP_FIRST} UNION ALL {_SNAP_SECOND}")
def snapshot_all(spark, sf_dir):
    base = _land_supplier_snapshots(spark, sf_dir)
    return _with_text_date(read_snapshots(spark, base, "supplier.csv", schema=SUPPLIER_SCHEMA))


@query("snapshot_latest", _SNAP_SECOND)
def snapshot_latest(spark, sf_dir):
    base = _land_supplier_snapshots(spark, sf_dir)
    return _with_text_date(read_latest_snapshot(spark, base, "supplier.csv", schema=SUPPLIER_SCHEMA))


@query(
    "snapshot_latest_per_key",
    f"""WITH a AS ({_SNAP_FIRST} UNION ALL {_SNAP_SECOND})
SELECT s_suppkey, arg_max(s_name, snapshot_date) AS s_name,
       arg_max(s_nationkey, snapshot_date) AS s_nationkey,
       arg_max(s_acctbal, snapshot_date) AS s_acctbal, max(snapshot_date) AS snapshot_date
FROM a GROUP BY s_suppkey""",
)
def snapshot_latest_per_key(spark, sf_dir):
    base = _land_supplier_snapshots(spark, sf_dir)
    df = read_snapshots(spark, base, "supplier.csv", schema=SUPPLIER_SCHEMA)
    return _with_text_date(latest_per_key(df, ["s_suppkey"], "snapshot_date"))


# ------------------------------------------------- files that disagree
@query(
    "csv_mixed_headers",
    """SELECT p_partkey, p_name, p_brand, p_size, p_retailprice, '2024-01-01' AS snapshot_date FROM part
UNION ALL
SELECT p_partkey, p_name, p_brand, p_size, p_retailprice, '2024-01-02' FROM part""",
)
def csv_mixed_headers(spark, sf_dir):
    """Two landings of the part table, the second with its columns reversed
    and one more: every file is read by its own header."""
    base = scratch_path(spark, "raw-part")
    columns = ["p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"]
    part = adapter.table(spark, sf_dir, "part")
    write_dated_csv(part.select(columns), base, "part.csv", SNAPSHOT_DATES[0])
    write_dated_csv(part.select("p_type", *columns[::-1]), base, "part.csv", SNAPSHOT_DATES[1])
    schema = part.select(columns).schema
    return _with_text_date(read_snapshots(spark, base, "part.csv", schema=schema))


@query(
    "csv_text_roundtrip",
    "SELECT doc_id, nullif(text, '') AS text, nullif(lang, '') AS lang, nullif(source, '') AS source, "
    "n_chars FROM documents",
)
def csv_text_roundtrip(spark, sf_dir):
    """Every document through a CSV folder and back: quotes, commas, line
    breaks and blanks survive (an empty text is NULL there)."""
    docs = adapter.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    path = write_csv(docs, scratch_path(spark, "documents-csv"))
    return read_csv(spark, path, schema=docs.schema)


# -------------------------------------------------------------- ingestion
@query(
    "ingest_audit",
    with_domain()
    + """
SELECT 'customers_from_csv' AS dataset_name, 'csv' AS source_type,
       count(*) AS n_rows, 'SUCCESS' AS status, 'OK' AS notes FROM customers
UNION ALL SELECT 'balances_from_csv', 'csv', CAST(0 AS BIGINT), 'REJECTED', (
  SELECT concat_ws(' | ',
    '[WARNING] balances_from_csv: kolom dengan null -> Balance, Segment',
    printf('[ERROR] balances_from_csv: rasio null %.1f%% melewati batas 30.0%% — data ditolak.',
           100 * (sum((c_acctbal < 9000)::INT) + sum((c_mktsegment <> 'BUILDING')::INT)) / (3 * count(*))))
  FROM customer)
UNION ALL SELECT 'missing_file', 'csv', CAST(0 AS BIGINT), 'FAILED', 'PATH_NOT_FOUND'""",
)
def ingest_audit(spark, sf_dir):
    """Three planted sources: a clean file, a mostly-null file, a missing path."""
    landing = scratch_path(spark, "landing")
    good = adapter.customers(spark, sf_dir).select("customer_id", "customer_name", "city", "age")
    sparse = adapter.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Customer ID"),
        F.when(F.col("c_acctbal") >= 9000, F.col("c_acctbal")).alias("Balance"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_mktsegment")).alias("Segment"),
    )
    write_csv(good, f"{landing}/customers")
    write_csv(sparse, f"{landing}/balances")
    specs = [
        SourceSpec("customers_from_csv", "csv", "raw/csv/customers/customers_from_csv.csv",
                   path=f"{landing}/customers"),
        SourceSpec("balances_from_csv", "csv", "raw/csv/balances/balances_from_csv.csv",
                   path=f"{landing}/balances"),
        SourceSpec("missing_file", "csv", "raw/csv/missing/missing.csv",
                   path=f"{landing}/does-not-exist"),
    ]
    raw_base = scratch_path(spark, "datalake")
    audit_path = f"{raw_base}/logs/ingestion_log"
    ing.run_all(spark, specs, raw_base, audit_path, run_clock=datetime.now(timezone.utc))
    log = read_audit_log(spark, audit_path)
    # Of a failure, the error's class: the rest of its text names a scratch folder.
    notes = F.when(F.col("status") == "FAILED", F.regexp_extract("notes", r"^\[(\w+)", 1))
    return log.select(
        "dataset_name", "source_type", F.col("rows").alias("n_rows"), "status",
        F.coalesce(notes, "notes").alias("notes"),
    )


@query(
    "ingest_from_yaml",
    with_domain()
    + """SELECT 'customers_declared' AS dataset_name, 'csv' AS source_type, count(*) AS n_rows,
       'SUCCESS' AS status, count(*) AS landed FROM customers
UNION ALL SELECT 'parts_declared', 'parquet', (SELECT count(*) FROM part), 'SUCCESS', (SELECT count(*) FROM part)""",
)
def ingest_from_yaml(spark, sf_dir):
    """Sources declared in a YAML file in the lake: a CSV folder and the part
    table, run and counted where they land."""
    lake = scratch_path(spark, "declared")
    customers = adapter.customers(spark, sf_dir).select("customer_id", "customer_name", "city", "age")
    write_csv(customers, f"{lake}/in/customers")
    text = f"""files:
  - name: customers_declared
    source_type: csv
    path: {lake}/in/customers
    target: raw/csv/customers/customers.csv
  - name: parts_declared
    source_type: parquet
    path: {sf_dir}/part.parquet
    target: raw/parquet/part/part.csv
"""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{lake}/sources")
    specs = load_sources(f"{lake}/sources", spark)
    ing.run_all(spark, specs, lake, f"{lake}/log")
    log = read_audit_log(spark, f"{lake}/log")
    landed = None
    for spec in specs:
        files = read_csv(spark, ing.raw_target(lake, spec.target, "*"))
        one = files.agg(F.count(F.lit(1)).alias("landed")).withColumn("dataset_name", F.lit(spec.name))
        landed = one if landed is None else landed.unionByName(one)
    return log.join(landed, "dataset_name").select(
        "dataset_name", "source_type", F.col("rows").alias("n_rows"), "status", "landed"
    )
