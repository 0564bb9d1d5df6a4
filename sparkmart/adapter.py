"""Views of the driver's TPC-H-style test tables in the retail domain.

customers   ← customer ⋈ nation       (city = nation name, age derived from the key)
products    ← part                    (category = p_type, price = p_retailprice)
order_lines ← lineitem ⋈ orders       (one row per order line)

Every frame is a lazy projection over the parquet scan, so Catalyst prunes
columns and pushes filters into the reader.  The lineitem ⋈ orders join is
the one large join of the domain; it is left to the planner (sort-merge on
``orderkey`` at scale, AQE splits a skewed order).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    # nation has 25 rows by the TPC-H spec: the planner broadcasts it by size.
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey, "inner").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("n_name").alias("city"),
        (F.lit(18) + F.col("c_custkey") % 43).cast(T.IntegerType()).alias("age"),
        F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        F.col("p_size").alias("stock"),
    )


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines without the customer (lineitem alone)."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
    )


def order_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order header: order → customer and date."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line with its customer (line items ⋈ order header)."""
    return line_items(spark, sf_dir).join(order_customers(spark, sf_dir), "order_id", "inner").select(
        "order_id", "line_number", "customer_id", "product_id", "quantity", "order_date"
    )


def domain(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return customers(spark, sf_dir), order_lines(spark, sf_dir), products(spark, sf_dir)


def feature_inputs(spark: SparkSession, sf_dir: str):
    """(customers, line items, products, order header) for the per-order
    pre-aggregated feature plan."""
    return (
        customers(spark, sf_dir),
        line_items(spark, sf_dir),
        products(spark, sf_dir),
        order_customers(spark, sf_dir),
    )
