"""Basket and association-rule queries: F3, M6, M7, P9, P10, T2, K6."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart import adapter
from sparkmart.functions import items_text
from sparkmart.mining import rules as R
from sparkmart.operators.features import baskets
from sparkmart.plans import query
from sparkmart.plans.oracle import with_domain

# Order × brand baskets: about 3.8 distinct brands per order over 25 brands.
# Itemsets and rules of every size are reported; the SQL oracle lists each
# basket's subsets recursively (an enumeration for the check only).
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.1
TOP_RULES = 20


@query(
    "baskets_by_customer_type",
    with_domain()
    + """SELECT ol.customer_id, string_agg(DISTINCT p.category, ', ' ORDER BY p.category) AS items
FROM order_lines ol LEFT JOIN products p ON ol.product_id = p.product_id GROUP BY ol.customer_id""",
)
def baskets_by_customer_type(spark, sf_dir):
    b = baskets(adapter.order_lines(spark, sf_dir), adapter.products(spark, sf_dir),
                "customer_id", "category")
    return b.select("customer_id", items_text(F.col("items")).alias("items"))


@query(
    "baskets_by_order_brand",
    with_domain()
    + """SELECT l.l_orderkey AS order_id, string_agg(DISTINCT p.brand, ', ' ORDER BY p.brand) AS items
FROM lineitem l LEFT JOIN products p ON l.l_partkey = p.product_id GROUP BY l.l_orderkey""",
)
def baskets_by_order_brand(spark, sf_dir):
    b = _order_brand_baskets(spark, sf_dir)
    return b.select("order_id", items_text(F.col("items")).alias("items"))


def _order_brand_baskets(spark, sf_dir):
    # an order's basket needs only its lines: no join to the order header
    return baskets(adapter.line_items(spark, sf_dir), adapter.products(spark, sf_dir),
                   "order_id", "brand")


def _mine(spark, sf_dir):
    b = _order_brand_baskets(spark, sf_dir)  # fp_growth persists what it mines
    return R.fp_growth(b, "items", MIN_SUPPORT, MIN_CONFIDENCE)


RULE_CTES = f"""
b AS (SELECT DISTINCT l.l_orderkey AS basket, p.brand AS item
      FROM lineitem l LEFT JOIN products p ON l.l_partkey = p.product_id),
nb AS (SELECT count(DISTINCT basket) AS n FROM b),
lim AS (SELECT ceil({MIN_SUPPORT} * n) AS least FROM nb),
i1 AS (SELECT item FROM b WHERE item IS NOT NULL GROUP BY item
       HAVING count(*) >= (SELECT least FROM lim)),
f AS (SELECT b.basket, b.item FROM b JOIN i1 ON b.item = i1.item),
subsets AS (
  SELECT basket, [item] AS items, item AS last FROM f
  UNION ALL
  SELECT s.basket, list_append(s.items, f.item), f.item
  FROM subsets s JOIN f ON f.basket = s.basket AND f.item > s.last),
itemsets AS (
  SELECT items, count(*) AS freq FROM subsets GROUP BY items
  HAVING count(*) >= (SELECT least FROM lim)),
parts AS (
  SELECT i.items, i.freq, c.cons, list_filter(i.items, lambda x: x <> c.cons) AS ante
  FROM itemsets i, unnest(i.items) AS c(cons) WHERE len(i.items) > 1),
rules AS (
  SELECT array_to_string(p.ante, ', ') AS antecedent, p.cons AS consequent,
         p.freq / fa.freq AS confidence,
         (p.freq / fa.freq) / (fc.freq / nb.n) AS lift,
         p.freq / nb.n AS support
  FROM parts p JOIN itemsets fa ON fa.items = p.ante
       JOIN itemsets fc ON fc.items = [p.cons] CROSS JOIN nb
  WHERE p.freq / fa.freq >= {MIN_CONFIDENCE})"""


def _recursive(sql: str) -> str:
    return with_domain(RULE_CTES).replace("WITH ", "WITH RECURSIVE ", 1) + sql


ITEMSETS_SQL = _recursive("SELECT array_to_string(items, ', ') AS items, len(items)::INTEGER AS size, freq FROM itemsets")
RULES_SQL = _recursive("SELECT antecedent, consequent, confidence, lift, support FROM rules")


@query("frequent_itemsets", ITEMSETS_SQL)
@query("frequent_items_and_pairs", ITEMSETS_SQL)
def frequent_itemsets(spark, sf_dir):
    """Itemsets of every size (the second name is the older one)."""
    freq, _ = _mine(spark, sf_dir)
    return R.itemsets_as_text(freq)


@query("association_rules", RULES_SQL)
@query("rules_single_antecedent", RULES_SQL)
def association_rules(spark, sf_dir):
    """Rules with antecedents of every size (the second name is the older one)."""
    _, rules = _mine(spark, sf_dir)
    return R.rules_as_text(rules).drop("rule")


RULE_TEXT = "'[' || antecedent || '] → [' || consequent || ']' AS rule"


@query(
    "rules_as_text",
    _recursive(f"SELECT {RULE_TEXT}, antecedent, consequent, confidence, lift, support FROM rules"),
)
def rules_as_text(spark, sf_dir):
    _, rules = _mine(spark, sf_dir)
    return R.rules_as_text(rules)


@query(
    "rules_top_lift",
    _recursive(
        f"""SELECT {RULE_TEXT}, antecedent, consequent, confidence, lift, support FROM rules
ORDER BY lift DESC, antecedent, consequent LIMIT {TOP_RULES}"""
    ),
)
def rules_top_lift(spark, sf_dir):
    _, rules = _mine(spark, sf_dir)
    return R.top_rules(R.rules_as_text(rules), TOP_RULES)
