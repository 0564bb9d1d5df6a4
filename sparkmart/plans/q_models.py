"""Model queries: F5–F7, M1–M5, A11, A12.

The library's learned models (K-Means, decision tree) get rows-only checks;
their SQL-expressible parts (scaling, indexing, split, metrics on a fixed rule
or score), K-Means at its fixed point and the best single split are checked
against DuckDB.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart import adapter
from sparkmart.functions import round_half_up
from sparkmart.mining import exact
from sparkmart.mining import models as M
from sparkmart.mining.prep import indexer, split_column, standardized
from sparkmart.operators import features as feat
from sparkmart.plans import query
from sparkmart.plans.oracle import features_sql, r2, spark_round, with_domain

Z_DIGITS = 6
METRIC_DIGITS = 9
TEST_RATIO = 0.2
KMEANS_FEATURES = ["age", "total_orders", "total_spend"]
TREE_NUMERIC = ["age", "total_orders", "total_spend", "avg_spend_per_order"]
RULE_AGE = 40


def _features(spark, sf_dir):
    c, li, p, o = adapter.feature_inputs(spark, sf_dir)
    return feat.customer_features(c, li, p, orders=o)


def _unlabeled(spark, sf_dir):
    c, li, p, o = adapter.feature_inputs(spark, sf_dir)
    return feat.customer_features_unlabeled(c, li, p, orders=o)


# ------------------------------------------------------------ preparation
def _z_sql() -> str:
    stats = ", ".join(
        f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in KMEANS_FEATURES
    )
    zs = ", ".join(
        f"{r2(f'CASE WHEN s_{c} = 0 THEN 0 ELSE ({c} - m_{c}) / s_{c} END', Z_DIGITS)} AS z_{c}"
        for c in KMEANS_FEATURES
    )
    return with_domain(features_sql(), f"st AS (SELECT {stats} FROM feats)") + (
        f"SELECT customer_id, {zs} FROM feats CROSS JOIN st"
    )


@query("standardized_features", _z_sql())
def standardized_features(spark, sf_dir):
    c, li, p, o = adapter.feature_inputs(spark, sf_dir)
    f = feat.customer_features_unlabeled(c, li, p, orders=o)
    return standardized(f, KMEANS_FEATURES, "customer_id", digits=Z_DIGITS)


@query(
    "category_index",
    with_domain()
    + """SELECT category,
       CAST(row_number() OVER (ORDER BY count(*) DESC, category) - 1 AS DOUBLE) AS category_idx
FROM products GROUP BY category""",
)
def category_index(spark, sf_dir):
    p = adapter.products(spark, sf_dir)
    model = indexer("category").fit(p)
    return model.transform(p).select("category", "category_idx").distinct()


@query(
    "hash_split_counts",
    with_domain()
    + f"""SELECT CASE WHEN CAST(((customer_id % 2147483648) * 2654435761) % 4294967296 AS DOUBLE)
                        / 4294967296 < {TEST_RATIO} THEN 'test' ELSE 'train' END AS split,
       count(*) AS n_customers
FROM customers GROUP BY 1""",
)
def hash_split_counts(spark, sf_dir):
    c = adapter.customers(spark, sf_dir)
    return c.groupBy(split_column("customer_id", TEST_RATIO).alias("split")).agg(
        F.count(F.lit(1)).alias("n_customers")
    )


# ---------------------------------------------------------------- K-Means
def _kmeans(spark, sf_dir):
    return M.run_kmeans(_features(spark, sf_dir), KMEANS_FEATURES, k=3, seed=42)


@query("kmeans_assignments")
def kmeans_assignments(spark, sf_dir):
    clustered, _ = _kmeans(spark, sf_dir)
    return clustered.select("customer_id", "cluster")


@query("kmeans_profile")
def kmeans_profile(spark, sf_dir):
    clustered, _ = _kmeans(spark, sf_dir)
    return M.cluster_profile(clustered)


@query("kmeans_centers")
def kmeans_centers(spark, sf_dir):
    _, model = _kmeans(spark, sf_dir)
    return M.cluster_centers(spark, model, KMEANS_FEATURES)


@query(
    "kmeans_invariants",
    with_domain()
    + """SELECT count(*) AS n_rows, CAST(3 AS BIGINT) AS n_clusters, CAST(0 AS BIGINT) AS rows_off,
       CAST(0 AS BIGINT) AS centers_off FROM customers""",
)
def kmeans_invariants(spark, sf_dir):
    """K-Means on every customer, carried to its fixed point: every row is at
    its nearest centre and every centre is the mean of its rows."""
    f = _unlabeled(spark, sf_dir)
    out, model = exact.fixed_point_kmeans(f, KMEANS_FEATURES, 3, "customer_id")
    return exact.kmeans_invariants(f, out, model)


@query(
    "profile_by_label",
    with_domain(features_sql())
    + f"""SELECT is_high_value, count(customer_id) AS n_customers,
       {spark_round('avg(age)', 1)} AS mean_age, {spark_round('avg(total_orders)', 1)} AS mean_orders,
       {spark_round('avg(total_spend)', 0)} AS mean_spend
FROM labeled GROUP BY is_high_value""",
)
def profile_by_label(spark, sf_dir):
    """A11's arithmetic on a fixed grouping (the label), checkable by SQL."""
    return M.cluster_profile(_features(spark, sf_dir), key="is_high_value")


# ---------------------------------------------------------- decision tree
def _tree(spark, sf_dir):
    return M.run_decision_tree(
        _features(spark, sf_dir), TREE_NUMERIC, ["city"], "is_high_value", TEST_RATIO, 42
    )


@query("tree_predictions")
def tree_predictions(spark, sf_dir):
    preds, _ = _tree(spark, sf_dir)
    return M.probability_of_one(preds).select("customer_id", "is_high_value", "prediction", "p_high")


@query("tree_metrics")
def tree_metrics(spark, sf_dir):
    preds, auc = _tree(spark, sf_dir)
    m = M.classification_metrics(preds, "is_high_value")
    row = (auc, m["accuracy"], m["f1"], m["weightedPrecision"], m["weightedRecall"])
    return spark.createDataFrame(
        [row],
        "auc double, accuracy double, f1 double, weighted_precision double, weighted_recall double",
    )


STUMP_SQL = f"""
v AS (SELECT CAST(age AS DOUBLE) AS v, count(*) FILTER (WHERE is_high_value = 0) AS c0,
             count(*) FILTER (WHERE is_high_value = 1) AS c1
      FROM labeled WHERE age IS NOT NULL GROUP BY age),
u AS (SELECT (v + lead(v) OVER (ORDER BY v)) / 2 AS threshold,
             sum(c0) OVER w AS l0, sum(c1) OVER w AS l1, sum(c0) OVER () AS t0, sum(c1) OVER () AS t1
      FROM v WINDOW w AS (ORDER BY v ROWS UNBOUNDED PRECEDING)),
g AS (SELECT *, ((l0 * l0 + l1 * l1) / (l0 + l1)
                 + ((t0 - l0) * (t0 - l0) + (t1 - l1) * (t1 - l1)) / (t0 + t1 - l0 - l1)
                 - (t0 * t0 + t1 * t1) / (t0 + t1)) / (t0 + t1) AS gain
      FROM u WHERE threshold IS NOT NULL)"""


@query(
    "tree_stump",
    with_domain(features_sql(), STUMP_SQL)
    + f"""SELECT threshold, CAST(l0 + l1 AS BIGINT) AS n_left, CAST(t0 + t1 - l0 - l1 AS BIGINT) AS n_right,
       CAST(l0 AS BIGINT) AS left_0, CAST(l1 AS BIGINT) AS left_1, {r2("gain", METRIC_DIGITS)} AS gain
FROM g ORDER BY round(gain, 12) DESC, threshold LIMIT 1""",
)
def tree_stump(spark, sf_dir):
    """The best single split of the label by age."""
    got = exact.best_split(_features(spark, sf_dir), "age", "is_high_value")
    return got.withColumn("gain", round_half_up(F.col("gain"), METRIC_DIGITS))


# -------------------------------------------- metrics on a fixed rule / score
RULE_PREDS_SQL = f"""preds AS (
  SELECT customer_id, is_high_value AS y, CASE WHEN age >= {RULE_AGE} THEN 1 ELSE 0 END AS p,
         total_orders FROM labeled)"""


def _rule_preds(spark, sf_dir):
    f = _features(spark, sf_dir)
    return f.withColumn(
        "prediction", F.when(F.col("age") >= RULE_AGE, 1.0).otherwise(0.0).cast(T.DoubleType())
    )


@query(
    "confusion_fixed_rule",
    with_domain(features_sql(), RULE_PREDS_SQL)
    + """SELECT y AS is_high_value, count(*) FILTER (WHERE p = 0) AS pred_0,
       count(*) FILTER (WHERE p = 1) AS pred_1 FROM preds GROUP BY y""",
)
def confusion_fixed_rule(spark, sf_dir):
    return M.confusion_matrix(_rule_preds(spark, sf_dir), "is_high_value")


def _metrics_sql() -> str:
    cm = """cm AS (
  SELECT count(*) FILTER (WHERE y = 1 AND p = 1) AS tp, count(*) FILTER (WHERE y = 0 AND p = 0) AS tn,
         count(*) FILTER (WHERE y = 0 AND p = 1) AS fp, count(*) FILTER (WHERE y = 1 AND p = 0) AS fn,
         count(*) AS n FROM preds),
pr AS (
  SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS p1,
            CASE WHEN tn + fn = 0 THEN 0 ELSE tn / (tn + fn) END AS p0,
            CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS r1,
            CASE WHEN tn + fp = 0 THEN 0 ELSE tn / (tn + fp) END AS r0 FROM cm),
f AS (
  SELECT *, CASE WHEN p1 + r1 = 0 THEN 0 ELSE 2 * p1 * r1 / (p1 + r1) END AS f1c,
            CASE WHEN p0 + r0 = 0 THEN 0 ELSE 2 * p0 * r0 / (p0 + r0) END AS f0c FROM pr)"""
    d = METRIC_DIGITS
    return with_domain(features_sql(), RULE_PREDS_SQL, cm) + f"""SELECT
  {r2('(tp + tn) / n', d)} AS accuracy,
  {r2('f1c * (tp + fn) / n + f0c * (tn + fp) / n', d)} AS f1,
  {r2('p1 * (tp + fn) / n + p0 * (tn + fp) / n', d)} AS weighted_precision,
  {r2('r1 * (tp + fn) / n + r0 * (tn + fp) / n', d)} AS weighted_recall
FROM f"""


@query("metrics_fixed_rule", _metrics_sql())
def metrics_fixed_rule(spark, sf_dir):
    m = M.classification_metrics(_rule_preds(spark, sf_dir), "is_high_value")
    vals = [m["accuracy"], m["f1"], m["weightedPrecision"], m["weightedRecall"]]
    df = spark.createDataFrame(
        [tuple(vals)], "accuracy double, f1 double, weighted_precision double, weighted_recall double"
    )
    return df.select(*[round_half_up(F.col(c), METRIC_DIGITS).alias(c) for c in df.columns])


@query(
    "auc_fixed_score",
    with_domain(features_sql(), RULE_PREDS_SQL)
    + f"""
, rk AS (SELECT y, rank() OVER (ORDER BY total_orders)
                   + (count(*) OVER (PARTITION BY total_orders) - 1) / 2.0 AS r FROM preds),
s AS (SELECT sum(CASE WHEN y = 1 THEN r ELSE 0 END) AS rs,
             CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE) AS npos,
             CAST(count(*) FILTER (WHERE y = 0) AS DOUBLE) AS nneg FROM rk)
SELECT {r2('(rs - npos * (npos + 1) / 2) / (npos * nneg)', METRIC_DIGITS)} AS auc FROM s""",
)
def auc_fixed_score(spark, sf_dir):
    f = _features(spark, sf_dir).withColumn("score", F.col("total_orders").cast(T.DoubleType()))
    auc = M.area_under_roc(f, "is_high_value", "score")
    df = spark.createDataFrame([(auc,)], "auc double")
    return df.select(round_half_up(F.col("auc"), METRIC_DIGITS).alias("auc"))
