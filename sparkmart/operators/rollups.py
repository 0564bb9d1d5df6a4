"""Join + aggregate reports: customer × categories (A15), city × category
(A14, J6), customer spend with city (J5), top-k (T2).

Scale notes.  Both reports take order lines without a customer and an order
header.  Lines are priced and reduced per order first, in each task before any
exchange, so what meets the order header is slim partial sums and never raw
lines; a hot customer, order or category collapses there too.  Distinct
categories are bits of a word (bitwise-or per order, then per customer, then
counted) instead of a distinct stage; A14 reduces to (customer, category) pairs
before the customer join, so ``unique_customers`` is a plain count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.money import ExactSum
from sparkmart.operators.features import line_values, spend_per_order

#: Categories up to this many are coded as bits, 64 to a column.
CODED = 1024


def _coded(products: DataFrame) -> tuple[DataFrame, int] | None:
    """``products`` with ``code``, the place of its category in the sorted
    list of all; None if there are more than :data:`CODED` (the driver sees at
    most one more than that)."""
    found = products.select("category").distinct().filter("category IS NOT NULL").limit(CODED + 1).collect()
    names = sorted(r["category"] for r in found)
    if len(names) > CODED:
        return None
    kind = products.schema["category"].dataType.simpleString()
    codes = products.sparkSession.createDataFrame(list(enumerate(names)), f"code int, category {kind}")
    return products.join(F.broadcast(codes), "category", "left"), len(names)  # CODED rows at most


def _words(n: int) -> list[str]:
    return [f"categories_{w}" for w in range(max(1, -(-n // 64)))]


def _bits(n: int) -> list[Column]:
    """For every word, the bit-or of the lines' category bits in it."""
    return [
        F.bit_or(F.when(F.shiftright("code", 6) == w, F.expr("shiftleft(1L, code & 63)"))).alias(name)
        for w, name in enumerate(_words(n))
    ]


def customer_categories(lines: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """A15 (J4 + A1 + A2 + A4): lines, spend and distinct categories per
    customer.  ``orders`` is the order header (order → customer); a NULL
    category is not counted."""
    coded = _coded(products)
    if coded is None:
        return _customer_categories_by_pair(lines, orders, products)
    products, n = coded
    priced = line_values(lines, products, "drop", extra_product_cols=("code",))
    spend = ExactSum.of(priced, "value")
    per_customer = (
        spend_per_order(priced, spend, *_bits(n))
        .join(orders.select("order_id", "customer_id"), "order_id")
        .groupBy("customer_id")
        .agg(
            F.sum("n_lines").alias("total_orders"),
            *spend.merged(),
            *[F.bit_or(w).alias(w) for w in _words(n)],
        )
    )
    count = sum((F.bit_count(F.coalesce(w, F.lit(0))).cast("long") for w in _words(n)), F.lit(0).cast("long"))
    return per_customer.select(
        "customer_id", "total_orders", spend.total().alias("total_spend"), count.alias("categories_bought")
    )


def _pairs(lines: DataFrame, orders: DataFrame, products: DataFrame) -> tuple[DataFrame, ExactSum]:
    """One row per (customer, category): lines and carried spend."""
    priced = line_values(lines, products, "drop", extra_product_cols=("category",))
    spend = ExactSum.of(priced, "value")
    per_order = priced.groupBy("order_id", "category").agg(
        F.count("order_id").alias("n_lines"), *spend.first(F.col("value"))
    )
    pairs = (
        per_order.select("order_id", "category", "n_lines", *spend.carried())
        .join(orders.select("order_id", "customer_id"), "order_id")
        .groupBy("customer_id", "category")
        .agg(F.sum("n_lines").alias("n_lines"), *spend.merged())
    )
    return pairs.select("customer_id", "category", "n_lines", *spend.carried()), spend


def _customer_categories_by_pair(lines: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    pairs, spend = _pairs(lines, orders, products)
    per_customer = pairs.groupBy("customer_id").agg(
        F.sum("n_lines").alias("total_orders"), *spend.merged(), F.count("category").alias("categories_bought")
    )
    return per_customer.select(
        "customer_id", "total_orders", spend.total().alias("total_spend"), "categories_bought"
    )


def city_category_rollup(
    lines: DataFrame, orders: DataFrame, products: DataFrame, customers: DataFrame
) -> DataFrame:
    """Orders, spend, unique customers per (city, category), by spend."""
    pairs, spend = _pairs(lines, orders, products)
    with_city = pairs.join(customers.select("customer_id", "city"), "customer_id", "inner")
    return (
        with_city.groupBy("city", "category")
        .agg(
            F.sum("n_lines").alias("total_orders"),
            *spend.merged(),
            F.count(F.lit(1)).alias("unique_customers"),
        )
        .select("city", "category", "total_orders", spend.total().alias("total_spend"), "unique_customers")
        .orderBy(F.desc("total_spend"), "city", "category")
    )


def with_city(per_customer: DataFrame, customers: DataFrame) -> DataFrame:
    """Attach the customer's city (inner, one row per customer)."""
    return per_customer.join(customers.select("customer_id", "city"), "customer_id", "inner")


def top_k(df: DataFrame, k: int, by: str, *tie_break: str) -> DataFrame:
    """The k largest ``by`` with a deterministic tie-break.

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each task keeps
    its own top k and the driver merges k × tasks rows — no global sort.
    """
    return df.orderBy(F.desc(by), *[F.asc(c) for c in tie_break]).limit(k)
