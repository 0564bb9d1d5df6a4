"""DuckDB SQL for each registered query (the correctness oracle).

Each statement starts from the driver's pre-registered views and rebuilds the
retail domain with the same formulas as :mod:`sparkmart.adapter` and
:mod:`sparkmart.functions`.
"""

from __future__ import annotations

DOMAIN = """
customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name, n_name AS city,
         CAST(18 + c_custkey % 43 AS INTEGER) AS age,
         c_acctbal AS acctbal, c_mktsegment AS segment
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS brand,
         p_type AS category, p_retailprice AS price, p_size AS stock
  FROM part),
line_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_id,
         l_quantity AS quantity
  FROM lineitem),
order_lines AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_number, o_custkey AS customer_id,
         l_partkey AS product_id, l_quantity AS quantity, o_orderdate AS order_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

VALUE = "(ol.quantity * p.price)"


def money_sum(x: str) -> str:
    """The exact sum of a double, as :class:`sparkmart.functions.money.ExactSum`
    defines it: whole units and billionths are summed as integers."""
    nano = f"sum(CAST(floor(({x} - floor({x})) * 1000000000 + 0.5) AS HUGEINT))"
    whole = f"sum(CAST(floor({x}) AS HUGEINT))"
    return (
        f"(CAST({whole} + {nano} // 1000000000 AS DOUBLE)"
        f" + CAST({nano} % 1000000000 AS DOUBLE) / 1000000000)"
    )


def r2(x: str, digits: int = 2) -> str:
    """``round_half_up`` of :mod:`sparkmart.functions` (plain double arithmetic)."""
    s = 10 ** digits
    return f"(floor(({x}) * {s} + 0.5) / {s})"


def spark_round(x: str, digits: int) -> str:
    """Spark's ``round`` on a double: the shortest decimal text of the value,
    rounded half-up.  DuckDB's own ``round`` on doubles rounds the binary
    value instead, so go through text and DECIMAL."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


def features_sql(
    *,
    join: str = "LEFT",
    products_cte: str = "products",
    lines_cte: str = "order_lines",
    cust_cols: str = "c.customer_id, c.customer_name, c.city, c.age",
    round_avg: bool = True,
) -> str:
    """CTE text ending in ``feats`` (pre-label) and ``labeled``."""
    avg = "a.total_spend / NULLIF(a.priced_lines, 0)"
    if round_avg:
        avg = spark_round(avg, 2)
    return f"""
lv AS (
  SELECT ol.customer_id, ol.order_id, {VALUE} AS value
  FROM {lines_cte} ol {join} JOIN {products_cte} p ON ol.product_id = p.product_id),
agg AS (
  SELECT customer_id, count(order_id) AS total_orders,
         {money_sum("value")} AS total_spend,
         count(value) AS priced_lines
  FROM lv GROUP BY customer_id),
feats AS (
  SELECT {cust_cols},
         coalesce(a.total_orders, 0) AS total_orders,
         coalesce(a.total_spend, CAST(0 AS DOUBLE)) AS total_spend,
         coalesce({avg}, CAST(0 AS DOUBLE)) AS avg_spend_per_order
  FROM customers c LEFT JOIN agg a ON c.customer_id = a.customer_id),
labeled AS (
  SELECT *, CAST(CASE WHEN total_spend >= (SELECT quantile_disc(total_spend, 0.5) FROM feats)
                      THEN 1 ELSE 0 END AS INTEGER) AS is_high_value
  FROM feats)"""


def with_domain(*ctes: str) -> str:
    parts = [DOMAIN.strip()] + [c.strip() for c in ctes if c.strip()]
    return "WITH " + ",\n".join(parts) + "\n"
