"""End-to-end pipeline (B1, B5): load → features → clusters → classifier →
rules, each stage reading the previous stage's output back from storage.

Hand-over through Parquet under ``base`` (explicit schema, no inference)
means any stage can be rerun alone after a failure (``resume`` skips those
that finished), and each stage's plan starts from files rather than from the
whole lineage before it.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.mining import models as M
from sparkmart.mining import rules as R
from sparkmart.operators import features as feat
from sparkmart.sinks.files import csv_safe, write_parquet
from sparkmart.sinks.manifest import missing_path


@dataclass
class EndToEndConfig:
    k: int = 5
    kmeans_features: list[str] = field(default_factory=lambda: ["age", "total_orders", "total_spend"])
    tree_numeric: list[str] = field(
        default_factory=lambda: ["age", "total_orders", "total_spend", "avg_spend_per_order"]
    )
    tree_categorical: list[str] = field(default_factory=lambda: ["city"])
    item_col: str = "name"
    # a customer's purchases of one day
    basket_key: list[str] = field(default_factory=lambda: ["customer_id", "order_date"])
    min_support: float = 0.05
    min_confidence: float = 0.3


def _timed(timings: list, stage: str, fn):
    t0 = time.perf_counter()
    out = fn()
    timings.append((stage, time.perf_counter() - t0))
    return out


STAGE_ROW = "config string, rows long"


class _Stages:
    """The finished stages of a run: one small row under ``base/stages`` each,
    written after the stage's output.  Once a stage has to run, all later ones
    do, since they may read what it wrote."""

    def __init__(self, spark: SparkSession, base: str, config: str, resume: bool):
        self.spark, self.base, self.config, self.resume = spark, f"{base.rstrip('/')}/stages", config, resume

    def finished(self, stage: str) -> int | None:
        """Rows that the stage wrote in an earlier run of the same settings."""
        if self.resume:
            try:
                row = self.spark.read.schema(STAGE_ROW).json(f"{self.base}/{stage}").first()
            except Exception as e:  # noqa: BLE001 - the stage never finished
                if not missing_path(e):
                    raise
                row = None
            if row is not None and row["config"] == self.config:
                return row["rows"]
        self.resume = False
        return None

    def begin(self, stage: str) -> None:
        """What an earlier run says of the stage no longer holds."""
        self._put(stage, "", None)

    def finish(self, stage: str, rows: int) -> None:
        self._put(stage, self.config, rows)

    def _put(self, stage: str, config: str, rows: int | None) -> None:
        row = self.spark.createDataFrame([(config, rows)], STAGE_ROW)
        row.coalesce(1).write.mode("overwrite").json(f"{self.base}/{stage}")


def run_end_to_end(
    spark: SparkSession,
    customers: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    base: str,
    cfg: EndToEndConfig | None = None,
    resume: bool = False,
) -> tuple[list[tuple[str, float]], dict[str, int]]:
    """Run all stages; returns (stage timings, rows written per stage).

    ``resume`` goes on with a run under ``base`` that ended early: stages that
    finished there with the same settings are not run again and have no
    timing.  The caller vouches that the inputs are the same.
    """
    cfg = cfg or EndToEndConfig()
    timings: list[tuple[str, float]] = []
    written: dict[str, int] = {}
    paths = {s: f"{base.rstrip('/')}/processed/{s}" for s in
             ("customer_features", "customer_clusters", "classification_results", "association_rules")}
    inputs = [customers, orders, products]
    cached: list[DataFrame] = []
    stages = _Stages(spark, base, repr(cfg), resume)

    def load():
        for df in inputs:
            if not df.is_cached:  # a frame that the caller keeps stays the caller's
                cached.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return [df.count() for df in inputs]

    def preprocessing():
        f = feat.customer_features(customers, orders, products, customer_cols=None, unknown_products="drop",
                                   round_average=False, fill="all_numeric")
        write_parquet(f, paths["customer_features"])

    def clustering():
        features = spark.read.parquet(paths["customer_features"])
        clustered, _ = M.run_kmeans(features, cfg.kmeans_features, k=cfg.k, seed=42)
        write_parquet(clustered, paths["customer_clusters"])

    def classification():
        features = spark.read.parquet(paths["customer_features"])
        preds, _ = M.run_decision_tree(features, cfg.tree_numeric, cfg.tree_categorical)
        write_parquet(csv_safe(preds), paths["classification_results"])

    def association():
        b = feat.baskets(orders, products, cfg.basket_key, cfg.item_col, "drop")
        _, rules = R.fp_growth(b, "items", cfg.min_support, cfg.min_confidence)
        write_parquet(R.rules_as_text(rules), paths["association_rules"])

    work = [
        ("preprocessing", "customer_features", preprocessing),
        ("clustering", "customer_clusters", clustering),
        ("classification", "classification_results", classification),
        ("association", "association_rules", association),
    ]
    try:
        for stage, output, run in work:
            rows = stages.finished(stage)
            if rows is None:
                if not any(name == "load" for name, _ in timings):
                    _timed(timings, "load", load)
                stages.begin(stage)
                _timed(timings, stage, run)
                rows = spark.read.parquet(paths[output]).count()
                stages.finish(stage, rows)
            written[output] = rows
    finally:
        for df in cached:
            df.unpersist()
    return timings, written


def stage_rows_frame(spark: SparkSession, written: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(list(written.items()), "stage string, rows_written long").orderBy(
        F.col("stage")
    )
