"""Feature queries: F1, F2, J1/J3/J4, P4, P6, P7, A10."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart import adapter
from sparkmart.operators import features as feat
from sparkmart.operators.quantiles import approx_quantile, quantile_disc, rank_error
from sparkmart.plans import query
from sparkmart.plans.oracle import features_sql, with_domain

# Planted cases.  The test tables have no orphan keys and no nulls, so a few
# queries add rows; the tables themselves are always read whole.
#  - every line of 48 or more pieces comes again for a product that is in no
#    catalogue → order lines of unknown products
#  - every twentieth customer comes again under an id of its own → customers
#    without orders
#  - customers with a negative balance get no recorded age → nullable age
UNKNOWN_FROM = 48
NEW_IDS = 1_000_000_000_000


def _with_unknown_products(lines):
    more = lines.where(F.col("quantity") >= UNKNOWN_FROM)
    return lines.unionByName(more.withColumn("product_id", -F.col("product_id")))


def _with_new_customers(customers):
    more = customers.where(F.col("customer_id") % 20 == 0)
    return customers.unionByName(more.withColumn("customer_id", F.col("customer_id") + NEW_IDS))


def _nullable_age(customers):
    return customers.withColumn("age", F.when(F.col("acctbal") >= 0, F.col("age")))


UNKNOWN_SQL = f"""planted_lines AS (
  SELECT * FROM order_lines UNION ALL
  SELECT * REPLACE (-product_id AS product_id) FROM order_lines WHERE quantity >= {UNKNOWN_FROM})"""
NEW_SQL = f"""planted_customers AS (
  SELECT * FROM customers UNION ALL
  SELECT * REPLACE (customer_id + {NEW_IDS} AS customer_id) FROM customers WHERE customer_id % 20 = 0)"""
_FROM_PLANTED = ("FROM customers c", "FROM planted_customers c")


@query("customer_features", with_domain(features_sql()) + "SELECT * FROM labeled")
def customer_features(spark, sf_dir):
    c, li, p, o = adapter.feature_inputs(spark, sf_dir)
    return feat.customer_features(c, li, p, orders=o)


@query(
    "customer_features_large",
    with_domain(
        features_sql(
            join="INNER",
            cust_cols="c.customer_id, c.customer_name, c.city, c.age, c.acctbal, c.segment",
            round_avg=False,
        )
    )
    + "SELECT * FROM labeled",
)
def customer_features_large(spark, sf_dir):
    c, li, p, o = adapter.feature_inputs(spark, sf_dir)
    return feat.customer_features(
        c, li, p, customer_cols=None, unknown_products="drop", round_average=False,
        fill="all_numeric", orders=o,
    )


@query(
    "features_unknown_keep",
    with_domain(UNKNOWN_SQL, features_sql(lines_cte="planted_lines")) + "SELECT * FROM labeled",
)
def features_unknown_keep(spark, sf_dir):
    c, li, p, o = adapter.feature_inputs(spark, sf_dir)
    return feat.customer_features(c, _with_unknown_products(li), p, unknown_products="keep", orders=o)


@query(
    "features_unknown_drop",
    with_domain(UNKNOWN_SQL, features_sql(join="INNER", lines_cte="planted_lines"))
    + "SELECT * FROM labeled",
)
def features_unknown_drop(spark, sf_dir):
    c, li, p, o = adapter.feature_inputs(spark, sf_dir)
    return feat.customer_features(c, _with_unknown_products(li), p, unknown_products="drop", orders=o)


@query(
    "customers_without_orders_filled",
    with_domain(NEW_SQL, features_sql().replace(*_FROM_PLANTED)) + "SELECT * FROM labeled",
)
def customers_without_orders_filled(spark, sf_dir):
    c, li, p, o = adapter.feature_inputs(spark, sf_dir)
    return feat.customer_features(_with_new_customers(c), li, p, orders=o)


_NULL_AGE_CUSTOMERS = (
    "customers_na AS (SELECT customer_id, customer_name, city,"
    " CASE WHEN acctbal >= 0 THEN age END AS age FROM planted_customers)"
)


@query(
    "fill_all_numeric",
    with_domain(
        NEW_SQL,
        _NULL_AGE_CUSTOMERS,
        features_sql().replace("FROM customers c", "FROM customers_na c"),
    )
    + "SELECT customer_id, customer_name, city, coalesce(age, 0) AS age, total_orders, total_spend,"
    " avg_spend_per_order, is_high_value FROM labeled",
)
def fill_all_numeric(spark, sf_dir):
    c, li, p, o = adapter.feature_inputs(spark, sf_dir)
    c = _nullable_age(_with_new_customers(c)).select("customer_id", "customer_name", "city", "age")
    return feat.customer_features(c, li, p, fill="all_numeric", orders=o)


@query(
    "high_value_label_counts",
    with_domain(features_sql())
    + "SELECT is_high_value, count(*) AS n_customers FROM labeled GROUP BY is_high_value",
)
def high_value_label_counts(spark, sf_dir):
    f = customer_features(spark, sf_dir)
    return (
        f.groupBy("is_high_value")
        .agg(F.count(F.lit(1)).alias("n_customers"))
        .orderBy(F.desc("n_customers"), "is_high_value")
    )


def _pre_label(spark, sf_dir):
    c, li, p, o = adapter.feature_inputs(spark, sf_dir)
    return feat.customer_features_unlabeled(c, li, p, orders=o).persist()


@query(
    "exact_median_spend",
    with_domain(features_sql())
    + "SELECT quantile_disc(total_spend, 0.5) AS median_spend, count(*) AS n_customers FROM feats",
)
def exact_median_spend(spark, sf_dir):
    f = _pre_label(spark, sf_dir)
    value = quantile_disc(f, "total_spend", 0.5)
    n = f.count()
    schema = T.StructType(
        [T.StructField("median_spend", T.DoubleType()), T.StructField("n_customers", T.LongType())]
    )
    return spark.createDataFrame([(value, n)], schema)


@query("approx_median_spend")
def approx_median_spend(spark, sf_dir):
    f = _pre_label(spark, sf_dir)
    value = approx_quantile(f, "total_spend", 0.5, 0.01)
    schema = T.StructType([T.StructField("approx_median_spend", T.DoubleType())])
    return spark.createDataFrame([(value,)], schema)


@query(
    "approx_median_rank",
    with_domain(features_sql()) + "SELECT count(*) AS n_customers, TRUE AS within_one_percent FROM feats",
)
def approx_median_rank(spark, sf_dir):
    """The sketch's median, judged by its rank among all customers."""
    f = _pre_label(spark, sf_dir)
    value = approx_quantile(f, "total_spend", 0.5, 0.01)
    ok = rank_error(f, "total_spend", 0.5, value) <= 0.01
    rows = f.agg(F.count(F.lit(1)).alias("n_customers"))
    return rows.withColumn("within_one_percent", F.lit(ok))
