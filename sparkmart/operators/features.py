"""Per-customer features (F1, F2) and baskets.

F1 chain: order lines ⟕ product price → line value → per-customer count /
sum / average → customers ⟕ aggregate → fill → median of spend → label.

Plan shape (see ``explain``): the price join is a broadcast hash join while
the product table is under the session's broadcast threshold and a
sort-merge join beyond it (the planner checks the size); aggregates are
partial per task then final after one shuffle, so a hot customer or order
collapses map-side; the customers ⟕ aggregate join is 1:1 and reuses the
aggregate's partitioning on ``customer_id``.  When lines come without a
customer (line items + an order header), lines are reduced per order
before the header join (:func:`spend_aggregate_by_order`), so the largest
join shuffles orders instead of lines.  The median is computed by
:func:`sparkmart.operators.quantiles.quantile_disc` on the persisted
pre-label frame, so the joins run once.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.functions.money import ExactSum, line_value
from sparkmart.operators.quantiles import approx_quantile, quantile_disc

FEATURE_COLUMNS = (
    "total_orders",
    "total_spend",
    "avg_spend_per_order",
)


def line_values(
    order_lines: DataFrame,
    products: DataFrame,
    unknown_products: str = "keep",
    extra_product_cols: tuple[str, ...] = (),
) -> DataFrame:
    """Order lines with ``value`` = quantity × price in the inputs' own types.

    ``unknown_products="keep"`` is the left join (J1): a line of an unknown
    product stays, counts as an order and has a NULL value.  ``"drop"`` is
    the inner join (J4): such lines vanish.
    """
    how = {"keep": "left", "drop": "inner"}[unknown_products]
    prices = products.select("product_id", "price", *extra_product_cols)
    types = order_lines.schema["quantity"].dataType, products.schema["price"].dataType
    return order_lines.join(prices, on="product_id", how=how).withColumn(
        "value", line_value(F.col("quantity"), F.col("price"), types)
    )


def _spend_columns(agg: DataFrame, spend: ExactSum, key: str) -> DataFrame:
    total = spend.total()
    return agg.select(
        key,
        "total_orders",
        total.alias("total_spend"),
        F.try_divide(total.cast("double"), F.col("priced_lines")).alias("avg_spend_per_order"),
    )


def spend_aggregate(lines: DataFrame, key: str = "customer_id") -> DataFrame:
    """count(order_id) / exact sum / average of line value per key."""
    spend = ExactSum.of(lines, "value")
    agg = lines.groupBy(key).agg(
        F.count("order_id").alias("total_orders"),
        *spend.first(F.col("value")),
        F.count("value").alias("priced_lines"),
    )
    return _spend_columns(agg, spend, key)


def spend_per_order(priced: DataFrame, spend: ExactSum, *more: Column) -> DataFrame:
    """Priced lines reduced to one row per order (map-side first), so that
    what meets the order header is orders and not lines."""
    per_order = priced.groupBy("order_id").agg(
        F.count("order_id").alias("n_lines"),
        *spend.first(F.col("value")),
        F.count("value").alias("priced_lines"),
        *more,
    )
    kept = [c for c in per_order.columns if c not in spend.columns]
    return per_order.select(*kept, *spend.carried())


def spend_aggregate_by_order(
    lines: DataFrame, orders: DataFrame, products: DataFrame, unknown_products: str = "keep"
) -> DataFrame:
    """Same result as ``spend_aggregate(line_values(order_lines, ...))`` when
    lines carry no customer and an order header maps order → customer.

    Lines are priced and reduced to one row per order *before* the order
    header join, so that join (and its shuffle) sees orders, not lines —
    several times fewer rows — and the later customer aggregate merges
    per-order partials.  A hot order collapses in the partial aggregate.
    """
    priced = line_values(lines, products, unknown_products)
    spend = ExactSum.of(priced, "value")
    per_order = spend_per_order(priced, spend)
    per_customer = (
        per_order.join(orders.select("order_id", "customer_id"), "order_id", "inner")
        .groupBy("customer_id")
        .agg(
            F.sum("n_lines").alias("total_orders"),
            *spend.merged(),
            F.sum("priced_lines").alias("priced_lines"),
        )
    )
    return _spend_columns(per_customer, spend, "customer_id")


def label_high_value(df: DataFrame, threshold: float | None, col: str = "total_spend") -> DataFrame:
    """``is_high_value`` = 1 when ``col >= threshold`` (ties are high), else 0."""
    cond: Column = F.col(col) >= F.lit(threshold) if threshold is not None else F.lit(False)
    return df.withColumn("is_high_value", F.when(cond, 1).otherwise(0).cast(T.IntegerType()))


def customer_features_unlabeled(
    customers: DataFrame,
    order_lines: DataFrame,
    products: DataFrame,
    *,
    customer_cols: tuple[str, ...] | None = ("customer_id", "customer_name", "city", "age"),
    unknown_products: str = "keep",
    round_average: bool = True,
    fill: str = "features",
    orders: DataFrame | None = None,
) -> DataFrame:
    """Feature table before the label (lazy; see :func:`customer_features`).

    With ``orders`` (order → customer), ``order_lines`` are lines without a
    customer column and the per-order pre-aggregation plan is used.
    """
    if orders is not None:
        agg = spend_aggregate_by_order(order_lines, orders, products, unknown_products)
    else:
        agg = spend_aggregate(line_values(order_lines, products, unknown_products))
    if round_average:
        agg = agg.withColumn("avg_spend_per_order", F.round(F.col("avg_spend_per_order"), 2))
    base = customers if customer_cols is None else customers.select(*customer_cols)
    feats = base.join(agg, on="customer_id", how="left")
    if fill == "all_numeric":
        return feats.fillna(0)
    return feats.fillna({"total_orders": 0, "total_spend": 0.0, "avg_spend_per_order": 0.0})


def spend_median(feats: DataFrame, median: str = "exact") -> float | None:
    if median == "exact":
        return quantile_disc(feats, "total_spend", 0.5)
    return approx_quantile(feats, "total_spend", 0.5, 0.01)


def customer_features(
    customers: DataFrame,
    order_lines: DataFrame,
    products: DataFrame,
    *,
    customer_cols: tuple[str, ...] | None = ("customer_id", "customer_name", "city", "age"),
    unknown_products: str = "keep",
    round_average: bool = True,
    fill: str = "features",
    median: str = "exact",
    persist: bool = True,
    orders: DataFrame | None = None,
) -> DataFrame:
    """Build the customer feature table.

    customer_cols    customer columns to keep (``None`` keeps all: F2)
    unknown_products "keep" (J1, F1) or "drop" (J4, F2)
    round_average    ``round(avg, 2)`` as in the original (F1) or raw (F2)
    fill             "features": fill the three feature columns (F1, P6);
                     "all_numeric": ``fillna(0)`` on every numeric column (F2, P7)
    median           "exact" (k-th value, distributed) or "approx" (sketch, 1 %)
    orders           order header (order_id → customer_id) when ``order_lines``
                     carry no customer: lines are pre-aggregated per order
    """
    feats = customer_features_unlabeled(
        customers, order_lines, products, customer_cols=customer_cols,
        unknown_products=unknown_products, round_average=round_average, fill=fill,
        orders=orders,
    )
    if persist:
        # The median passes and the caller's action share one evaluation of
        # the joins; MEMORY_AND_DISK keeps lineage, so a lost executor's
        # blocks are recomputed rather than failing the job.
        feats = feats.persist(StorageLevel.MEMORY_AND_DISK)
    return label_high_value(feats, spend_median(feats, median))


def baskets(
    order_lines: DataFrame,
    products: DataFrame,
    basket_key: str | list[str] = "customer_id",
    item_col: str = "product_name",
    unknown_products: str = "keep",
) -> DataFrame:
    """Distinct item names per basket (F3) as ``items: array<string>``.

    ``collect_set`` merges map-side, so each task ships at most one set per
    basket; the set size is bounded by the number of distinct items.
    A basket whose lines all miss the product table gets ``[]`` (the left
    join keeps it; ``collect_set`` skips NULL).
    """
    keys = [basket_key] if isinstance(basket_key, str) else list(basket_key)
    how = {"keep": "left", "drop": "inner"}[unknown_products]
    named = order_lines.join(products.select("product_id", item_col), on="product_id", how=how)
    return named.groupBy(*keys).agg(F.array_sort(F.collect_set(item_col)).alias("items"))
