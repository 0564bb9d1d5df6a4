"""Customer segmentation (M1, M2, A11), high-value classifier (M3) and
evaluation (M4, M5, A12).

The model input is persisted before ``fit`` (every iteration is a pass over
it).  K-Means results depend on how rows are partitioned (k-means|| samples
per partition), so the input is hash-partitioned on the key and sorted inside
partitions first: the same data and partition count give the same model.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.functions import round_half_up
from sparkmart.mining.prep import assembler, hash_split, indexer, scaler
from sparkmart.sinks.files import drop_vectors


def stable_input(df: DataFrame, key: str, num_partitions: int | None = None) -> DataFrame:
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        df.repartition(n, key).sortWithinPartitions(key).persist(StorageLevel.MEMORY_AND_DISK)
    )


def run_kmeans(
    df: DataFrame,
    feature_cols: list[str],
    k: int = 3,
    seed: int = 42,
    key: str = "customer_id",
    max_iter: int = 20,
) -> tuple[DataFrame, PipelineModel]:
    """M1: assemble → standardise → K-Means; adds ``cluster``, drops vectors."""
    data = stable_input(df, key)
    pipe = Pipeline(
        stages=[
            assembler(feature_cols, "raw_features"),
            scaler("raw_features", "features"),
            KMeans(featuresCol="features", predictionCol="cluster", k=k, seed=seed, maxIter=max_iter),
        ]
    )
    model = pipe.fit(data)
    return model.transform(data).drop("raw_features", "features"), model


def cluster_centers(spark: SparkSession, model: PipelineModel, feature_cols: list[str]) -> DataFrame:
    """M2: centres in standardised units and mapped back to raw units."""
    sc = model.stages[1]
    km = model.stages[-1]
    mean, std = sc.mean.toArray(), sc.std.toArray()
    rows = []
    for ci, center in enumerate(km.clusterCenters()):
        for j, c in enumerate(feature_cols):
            rows.append((ci, c, float(center[j]), float(center[j] * std[j] + mean[j])))
    return spark.createDataFrame(
        rows, "cluster int, feature string, center_std double, center_raw double"
    )


def cluster_profile(clustered: DataFrame, key: str = "cluster", exact_round: bool = False) -> DataFrame:
    """Size and mean age / orders / spend per cluster (or any key).

    ``exact_round`` uses the half-up form that gives the same double in every
    engine instead of ``round`` (which rounds the decimal text of a double).
    """
    rnd = round_half_up if exact_round else F.round
    return (
        clustered.groupBy(key)
        .agg(
            F.count("customer_id").alias("n_customers"),
            rnd(F.avg("age"), 1).alias("mean_age"),
            rnd(F.avg("total_orders"), 1).alias("mean_orders"),
            rnd(F.avg("total_spend"), 0).alias("mean_spend"),
        )
        .orderBy(key)
    )


def run_decision_tree(
    df: DataFrame,
    numeric_cols: list[str],
    categorical_cols: list[str],
    label_col: str = "is_high_value",
    test_ratio: float = 0.2,
    seed: int = 42,
    key: str = "customer_id",
    split: str = "hash",
    max_depth: int = 5,
    leak_free: bool = False,
) -> tuple[DataFrame, float | None]:
    """M3 + M4: decision tree on numeric + indexed categorical columns.

    ``split="hash"`` uses the key hash (same rows everywhere); ``"random"``
    is ``randomSplit`` as in the original, which depends on partitioning.
    The label is derived from ``total_spend``, so spend columns leak it;
    ``leak_free=True`` drops them from the inputs.
    """
    if leak_free:
        numeric_cols = [c for c in numeric_cols if "spend" not in c]
    if split == "hash":
        train, test = hash_split(df, key, test_ratio)
    else:
        train, test = df.randomSplit([1 - test_ratio, test_ratio], seed=seed)
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    # Index categories first: the fitted indexers know each category count,
    # and maxBins must exceed it (plus the extra bucket for unseen values).
    index = Pipeline(stages=[indexer(c) for c in categorical_cols]).fit(train)
    n_cats = max((len(m.labels) for m in index.stages), default=0)
    inputs = numeric_cols + [f"{c}_idx" for c in categorical_cols]
    tree = DecisionTreeClassifier(
        featuresCol="features", labelCol=label_col, predictionCol="prediction",
        maxDepth=max_depth, maxBins=max(32, n_cats + 2), seed=seed,
    )
    model = Pipeline(stages=[assembler(inputs, "features"), tree]).fit(index.transform(train))
    preds = model.transform(index.transform(test)).drop("features")
    return preds, area_under_roc(preds, label_col, "rawPrediction")


def area_under_roc(preds: DataFrame, label_col: str, score_col: str) -> float | None:
    """M4: exact ROC AUC (``numBins=0``: no down-sampling of the curve).
    NULL when the test part holds one class only."""
    classes = preds.agg(F.count_distinct(label_col).alias("k")).first()["k"]
    if classes < 2:
        return None
    ev = BinaryClassificationEvaluator(
        labelCol=label_col, rawPredictionCol=score_col, metricName="areaUnderROC", numBins=0
    )
    return ev.evaluate(preds.withColumn(label_col, F.col(label_col).cast(T.DoubleType())))


MULTICLASS_METRICS = ("accuracy", "f1", "weightedPrecision", "weightedRecall")


def classification_metrics(preds: DataFrame, label_col: str, pred_col: str = "prediction") -> dict:
    """M5: accuracy, F1, weighted precision and recall.

    One aggregate job counts (label, prediction) pairs — at most classes²
    rows reach the driver — and the four metrics follow from those counts
    with the evaluator's definitions (per-class precision / recall / F1,
    weighted by the label's share; an undefined ratio counts as 0).
    """
    counts = (
        preds.groupBy(F.col(label_col).cast(T.DoubleType()).alias("y"),
                      F.col(pred_col).cast(T.DoubleType()).alias("p"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    cell = {(r["y"], r["p"]): r["n"] for r in counts}
    n = sum(cell.values())
    classes = sorted({y for y, _ in cell} | {p for _, p in cell})
    by_label = {c: sum(v for (y, _), v in cell.items() if y == c) for c in classes}
    by_pred = {c: sum(v for (_, p), v in cell.items() if p == c) for c in classes}
    out = {"accuracy": 0.0, "f1": 0.0, "weightedPrecision": 0.0, "weightedRecall": 0.0}
    if n == 0:
        return out
    for c in classes:
        tp = cell.get((c, c), 0)
        prec = tp / by_pred[c] if by_pred[c] else 0.0
        rec = tp / by_label[c] if by_label[c] else 0.0
        f1 = 2 * prec * rec / (prec + rec) if prec + rec else 0.0
        w = by_label[c] / n
        out["accuracy"] += tp / n
        out["weightedPrecision"] += prec * w
        out["weightedRecall"] += rec * w
        out["f1"] += f1 * w
    return out


def classification_metrics_mllib(preds: DataFrame, label_col: str, pred_col: str = "prediction") -> dict:
    """The same four metrics through ``MulticlassClassificationEvaluator``
    (one job per metric); kept to cross-check :func:`classification_metrics`."""
    data = preds.select(
        F.col(label_col).cast(T.DoubleType()).alias("label"),
        F.col(pred_col).cast(T.DoubleType()).alias("prediction"),
    ).persist()
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    out = {m: ev.setMetricName(m).evaluate(data) for m in MULTICLASS_METRICS}
    data.unpersist()
    return out


def confusion_matrix(preds: DataFrame, label_col: str, pred_col: str = "prediction",
                     classes: tuple | None = None) -> DataFrame:
    """Count by (label, prediction), pivoted; missing cells are 0.

    Every class found in the labels or predictions has a column; ``classes``
    adds columns for classes that may be missing from the data.  The counts
    (classes squared rows) are aggregated before the pivot.
    """
    counts = preds.groupBy(
        F.col(label_col), F.col(pred_col).cast(T.DoubleType()).alias("__pred")
    ).agg(F.count(F.lit(1)).alias("__n")).persist()
    found = {r[0] for r in counts.select(F.col(label_col).cast(T.DoubleType())).distinct().collect()}
    found |= {r[0] for r in counts.select("__pred").distinct().collect()}
    every = sorted({float(c) for c in found if c is not None} | {float(c) for c in classes or ()})
    out = counts.groupBy(label_col).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("__pred") == c, F.col("__n"))), F.lit(0)).cast("long")
            .alias(f"pred_{int(c) if c.is_integer() else c}")
            for c in every
        ]
    )
    rows = out.collect()  # classes rows
    counts.unpersist()
    return preds.sparkSession.createDataFrame(rows, out.schema)


def csv_ready_predictions(preds: DataFrame) -> DataFrame:
    """K5: drop vector columns (rawPrediction, probability) before a CSV write."""
    return drop_vectors(preds)


def probability_of_one(preds: DataFrame) -> DataFrame:
    return preds.withColumn("p_high", vector_to_array("probability")[1])
