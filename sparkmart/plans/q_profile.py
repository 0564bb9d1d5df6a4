"""Profiling, rollup and join queries: A4–A9, A13–A15, J4–J6, P1, P5, P12, T1, T2,
plus the partitioned-write / pruned-read and CSV round trips (K2, K3, S6, S7, B4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart import adapter
from sparkmart.operators import features as feat
from sparkmart.operators import profile, rollups
from sparkmart.plans import query
from sparkmart.plans.oracle import VALUE, features_sql, money_sum, r2, with_domain
from sparkmart.session import scratch_path
from sparkmart.sinks import files as sinks
from sparkmart.sources import files as sources

FILTER_CITY = "NATION_7"
TOP_K_CUSTOMERS = 5


# ---------------------------------------------------------------- frequencies
@query(
    "city_frequency",
    with_domain() + "SELECT city, count(*) AS n_customers FROM customers GROUP BY city",
)
def city_frequency(spark, sf_dir):
    return profile.frequency(adapter.customers(spark, sf_dir), "city", "n_customers")


@query(
    "category_frequency",
    with_domain() + "SELECT category, count(*) AS n_products FROM products GROUP BY category",
)
def category_frequency(spark, sf_dir):
    return profile.frequency(adapter.products(spark, sf_dir), "category", "n_products")


@query(
    "distinct_cities",
    with_domain() + "SELECT DISTINCT city FROM customers",
)
def distinct_cities(spark, sf_dir):
    return profile.distinct_sorted(adapter.customers(spark, sf_dir), "city")


@query(
    "table_counts",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in adapter.TABLES
    ),
)
def table_counts(spark, sf_dir):
    frames = {t: adapter.table(spark, sf_dir, t) for t in adapter.TABLES}
    return profile.table_counts(spark, frames)


# ------------------------------------------------------------------- describe
DESCRIBE_DIGITS = 6


def _describe_sql(src: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, count({x}) AS n, "
            f"{r2(f'avg({x})', DESCRIBE_DIGITS)} AS mean, "
            f"{r2(f'stddev_samp({x})', DESCRIBE_DIGITS)} AS stddev, "
            f"min({x}) AS min_value, max({x}) AS max_value FROM {src}"
        )
    return " UNION ALL ".join(parts)


def _describe(df, cols):
    d = profile.describe(df, cols, digits=DESCRIBE_DIGITS)
    return d.withColumnRenamed("count", "n").withColumnRenamed("min", "min_value").withColumnRenamed(
        "max", "max_value"
    )


@query("describe_age", with_domain() + _describe_sql("customers", ["age"]))
def describe_age(spark, sf_dir):
    return _describe(adapter.customers(spark, sf_dir), ["age"])


@query("describe_quantity", with_domain() + _describe_sql("line_items", ["quantity"]))
def describe_quantity(spark, sf_dir):
    return _describe(adapter.line_items(spark, sf_dir), ["quantity"])


@query("describe_price_stock", with_domain() + _describe_sql("products", ["price", "stock"]))
def describe_price_stock(spark, sf_dir):
    return _describe(adapter.products(spark, sf_dir), ["price", "stock"])


def _describe_text_sql(src: str, number: str, texts: list[str]) -> str:
    parts = [f"SELECT *, NULL::VARCHAR AS min_text, NULL::VARCHAR AS max_text FROM ({_describe_sql(src, [number])})"]
    for c in texts:
        x = f"TRY_CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}', count({c}), {r2(f'avg({x})', DESCRIBE_DIGITS)},"
            f" {r2(f'stddev_samp({x})', DESCRIBE_DIGITS)}, NULL::DOUBLE, NULL::DOUBLE, min({c}), max({c}) FROM {src}"
        )
    return " UNION ALL ".join(parts)


@query("describe_text", with_domain() + _describe_text_sql("products", "price", ["product_name", "category"]))
def describe_text(spark, sf_dir):
    """A9 over numbers and texts in one pass."""
    return _describe(adapter.products(spark, sf_dir), ["price", "product_name", "category"])


FEATURE_DESCRIBE = ["age", "total_orders", "total_spend"]


@query(
    "describe_features",
    with_domain(features_sql()) + _describe_sql("feats", FEATURE_DESCRIBE),
)
def describe_features(spark, sf_dir):
    c, li, p, o = adapter.feature_inputs(spark, sf_dir)
    f = feat.customer_features_unlabeled(c, li, p, orders=o)
    return _describe(f, FEATURE_DESCRIBE)


# ------------------------------------------------------------------ histograms
HIST_BINS = 10


def _hist_sql(col: str) -> str:
    x = f"CAST({col} AS DOUBLE)"
    return with_domain(
        features_sql(),
        f"b AS (SELECT min({x}) AS lo, max({x}) AS hi FROM feats)",
        f"""c AS (
  SELECT CAST(CASE WHEN b.hi = b.lo THEN 0
                   ELSE least(floor(({x} - b.lo) * {HIST_BINS} / (b.hi - b.lo)), {HIST_BINS - 1})
              END AS INTEGER) AS bin, count(*) AS n_rows
  FROM feats, b WHERE {col} IS NOT NULL GROUP BY 1)""",
    ) + f"""
SELECT CAST(r.range AS INTEGER) AS bin,
       b.lo + CAST(r.range AS INTEGER) * ((b.hi - b.lo) / {HIST_BINS}) AS bin_lo,
       b.lo + (CAST(r.range AS INTEGER) + 1) * ((b.hi - b.lo) / {HIST_BINS}) AS bin_hi,
       coalesce(c.n_rows, 0) AS n_rows
FROM range({HIST_BINS}) r CROSS JOIN b LEFT JOIN c ON c.bin = r.range"""


def _hist(spark, sf_dir, col):
    c, li, p, o = adapter.feature_inputs(spark, sf_dir)
    f = feat.customer_features_unlabeled(c, li, p, orders=o).persist()
    return profile.histogram(f, col, HIST_BINS).withColumnRenamed("count", "n_rows")


@query("hist_age", _hist_sql("age"))
def hist_age(spark, sf_dir):
    return _hist(spark, sf_dir, "age")


@query("hist_orders", _hist_sql("total_orders"))
def hist_orders(spark, sf_dir):
    return _hist(spark, sf_dir, "total_orders")


@query("hist_spend", _hist_sql("total_spend"))
def hist_spend(spark, sf_dir):
    return _hist(spark, sf_dir, "total_spend")


# --------------------------------------------------------- joins and rollups
CUSTOMER_CATEGORIES_SQL = f"""
cc AS (
  SELECT ol.customer_id, count(ol.order_id) AS total_orders,
         {money_sum(VALUE)} AS total_spend,
         count(DISTINCT p.category) AS categories_bought
  FROM order_lines ol JOIN products p ON ol.product_id = p.product_id
  GROUP BY ol.customer_id)"""


def _customer_categories(spark, sf_dir):
    _, li, p, o = adapter.feature_inputs(spark, sf_dir)
    return rollups.customer_categories(li, o, p)


@query("customer_categories", with_domain(CUSTOMER_CATEGORIES_SQL) + "SELECT * FROM cc")
def customer_categories(spark, sf_dir):
    return _customer_categories(spark, sf_dir)


@query(
    "top_customers_by_spend",
    with_domain(CUSTOMER_CATEGORIES_SQL)
    + f"SELECT * FROM cc ORDER BY total_spend DESC, customer_id LIMIT {TOP_K_CUSTOMERS}",
)
def top_customers_by_spend(spark, sf_dir):
    return rollups.top_k(_customer_categories(spark, sf_dir), TOP_K_CUSTOMERS, "total_spend", "customer_id")


@query(
    "city_category_rollup",
    with_domain()
    + f"""
SELECT c.city, p.category, count(ol.order_id) AS total_orders,
       {money_sum(VALUE)} AS total_spend,
       count(DISTINCT ol.customer_id) AS unique_customers
FROM order_lines ol JOIN products p ON ol.product_id = p.product_id
JOIN customers c ON ol.customer_id = c.customer_id
GROUP BY c.city, p.category""",
)
def city_category_rollup(spark, sf_dir):
    c, li, p, o = adapter.feature_inputs(spark, sf_dir)
    return rollups.city_category_rollup(li, o, p, c)


SPEND_WITH_CITY_SQL = with_domain(
    CUSTOMER_CATEGORIES_SQL,
    "swc AS (SELECT cc.*, c.city FROM cc JOIN customers c ON cc.customer_id = c.customer_id)",
)


def _spend_with_city(spark, sf_dir):
    return rollups.with_city(_customer_categories(spark, sf_dir), adapter.customers(spark, sf_dir))


@query("spend_with_city", SPEND_WITH_CITY_SQL + "SELECT * FROM swc")
def spend_with_city(spark, sf_dir):
    return _spend_with_city(spark, sf_dir)


@query("city_filter", SPEND_WITH_CITY_SQL + f"SELECT * FROM swc WHERE city = '{FILTER_CITY}'")
def city_filter(spark, sf_dir):
    return _spend_with_city(spark, sf_dir).where(F.col("city") == FILTER_CITY)


@query("city_partition_roundtrip", SPEND_WITH_CITY_SQL + "SELECT * FROM swc")
def city_partition_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "customers_by_city")
    df = _spend_with_city(spark, sf_dir)
    sinks.write_partitioned_parquet(df, path, ["city"])
    return sources.read_partitioned_parquet(spark, path, schema=df.schema)


@query(
    "city_partition_pruned",
    SPEND_WITH_CITY_SQL + f"SELECT * FROM swc WHERE city = '{FILTER_CITY}'",
)
def city_partition_pruned(spark, sf_dir):
    path = scratch_path(spark, "customers_by_city")
    df = _spend_with_city(spark, sf_dir)
    sinks.write_partitioned_parquet(df, path, ["city"])
    return sources.read_partitioned_parquet(spark, path, schema=df.schema).where(
        F.col("city") == FILTER_CITY
    )


@query("csv_roundtrip_features", with_domain(features_sql()) + "SELECT * FROM labeled")
def csv_roundtrip_features(spark, sf_dir):
    c, li, p, o = adapter.feature_inputs(spark, sf_dir)
    f = feat.customer_features(c, li, p, orders=o)
    path = scratch_path(spark, "customer_features_csv")
    sinks.write_csv(f, path)
    return sources.read_csv(spark, path, schema=f.schema)


@query(
    "preview_features",
    with_domain(features_sql()) + "SELECT * FROM labeled ORDER BY customer_id LIMIT 10",
)
def preview_features(spark, sf_dir):
    """The first rows of the feature table (a preview is the feature)."""
    c, li, p, o = adapter.feature_inputs(spark, sf_dir)
    return feat.customer_features(c, li, p, orders=o).orderBy("customer_id").limit(10)


@query(
    "schema_listing",
    """SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS position, column_name,
       CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
            ELSE lower(column_type) END AS data_type
FROM (DESCRIBE SELECT * FROM part)""",
)
def schema_listing(spark, sf_dir):
    return profile.schema_rows(adapter.table(spark, sf_dir, "part")).drop("nullable")


@query(
    "city_pruning_report",
    SPEND_WITH_CITY_SQL
    + f"""SELECT 'partitioned' AS layout, count(*) AS rows, count(*) AS rows_scanned
FROM swc WHERE city = '{FILTER_CITY}'
UNION ALL
SELECT 'unpartitioned', count(*) FILTER (WHERE city = '{FILTER_CITY}'), count(*) FROM swc""",
)
def city_pruning_report(spark, sf_dir):
    """Same filter on a city-partitioned and a flat copy of the table."""
    from sparkmart.reports import pruning_report

    df = _spend_with_city(spark, sf_dir)
    part = sinks.write_partitioned_parquet(df, scratch_path(spark, "customers_by_city"), ["city"])
    flat = sinks.write_parquet(df, scratch_path(spark, "customers_flat"))
    return pruning_report(spark, part, flat, "city", FILTER_CITY).drop("files_read")
