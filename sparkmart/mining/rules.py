"""Frequent itemsets and association rules (M6, M7) with MLlib FP-Growth.

FP-Growth is Spark's parallel FP-growth: items are ranked by a distributed
count, each transaction is cut into conditional transactions shipped to the
partition owning each item group, and every partition grows its own
FP-tree.  No transaction list or tree is gathered on the driver.

Baskets must hold distinct items (build them with ``collect_set``); an empty
basket still counts in the transaction total ``n``.  An itemset is frequent
when ``freq >= ceil(min_support * n)``; a rule keeps
``confidence = freq(A ∪ C) / freq(A) >= min_confidence`` and reports
``lift = confidence / (freq(C) / n)`` and ``support = freq(A ∪ C) / n``.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.functions import items_text, rule_label


def estimate_frequent_itemsets(baskets: DataFrame, items_col: str, min_support: float) -> dict:
    """Estimate of how many itemsets FP-Growth would emit (for information only).

    One aggregate over (item, count) — as many rows as distinct items.  With
    the frequent items' supports sorted descending (s1 ≥ s2 ≥ …), itemsets
    larger than the largest k with s1·…·sk ≥ min_support are not expected if
    items were independent, and at most C(m, j) itemsets of each size j ≤ k
    exist (m = frequent items).  Correlated items can exceed the estimate;
    dense baskets (every item in most baskets) make it explode, which is
    exactly when mining cannot finish.
    """
    import math

    n = baskets.count()
    if n == 0:
        return {"baskets": 0, "frequent_items": 0, "max_size": 0, "estimate": 0}
    min_count = math.ceil(min_support * n)
    counts = (
        baskets.select(F.explode(items_col).alias("item"))
        .groupBy("item")
        .count()
        .where(F.col("count") >= min_count)
        .select("count")
        .collect()
    )
    sup = sorted((r["count"] / n for r in counts), reverse=True)
    k, prod = 0, 1.0
    for s in sup:
        if prod * s < min_support:
            break
        prod *= s
        k += 1
    est = sum(math.comb(len(sup), j) for j in range(1, k + 1))
    return {"baskets": n, "frequent_items": len(sup), "max_size": k, "estimate": est}


def equal_together(baskets: DataFrame, items_col: str) -> DataFrame:
    """The item column with equal baskets in one task, where they share a path
    of its FP-trees: these then grow with the distinct baskets and not with
    all, which saves building, measuring and sending them."""
    n = int(baskets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return baskets.select(items_col).repartition(n, items_col)


def fp_growth(
    baskets: DataFrame,
    items_col: str = "items",
    min_support: float = 0.1,
    min_confidence: float = 0.5,
    num_partitions: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(freq_itemsets[items, freq], rules[antecedent, consequent, confidence, lift, support])``."""
    fp = FPGrowth(itemsCol=items_col, minSupport=min_support, minConfidence=min_confidence)
    if num_partitions:
        fp = fp.setNumPartitions(num_partitions)
    # fit caches its input unless the input is already persisted; persist the
    # item column once here so the lazy mining after fit reads the same copy
    items = equal_together(baskets, items_col).persist(StorageLevel.MEMORY_AND_DISK)
    model = fp.fit(items)
    # The itemsets are a lazy result of the mining; rule generation reads
    # them twice (candidates, then a join), so keep them once.  The cache is
    # matched by plan, so the model's own handle reuses it as well.
    freq = model.freqItemsets.persist(StorageLevel.MEMORY_AND_DISK)
    return freq, model.associationRules


def itemsets_as_text(freq_itemsets: DataFrame) -> DataFrame:
    return freq_itemsets.select(
        items_text(F.col("items")).alias("items"),
        F.size("items").alias("size"),
        F.col("freq"),
    )


def rules_as_text(rules: DataFrame) -> DataFrame:
    """Both sides as sorted text plus a ``[A] → [C]`` label."""
    return rules.select(
        rule_label(F.col("antecedent"), F.col("consequent")).alias("rule"),
        items_text(F.col("antecedent")).alias("antecedent"),
        items_text(F.col("consequent")).alias("consequent"),
        "confidence",
        "lift",
        "support",
    )


def top_rules(rules_text: DataFrame, k: int, by: str = "lift") -> DataFrame:
    """T2 on rules: the k best by ``by``, ties broken by the rule text."""
    return rules_text.orderBy(F.desc(by), "antecedent", "consequent").limit(k)
