"""Models whose result can be checked exactly: K-Means carried on to a fixed
point (M1, M2) and the best single split of a decision tree (M3).

The library's own K-Means stops at a tolerance and depends on how rows are
dealt out.  :func:`fixed_point_kmeans` starts from the row with the smallest
hash of its key, adds the row farthest from all starts so far until there are
``k``, and repeats Lloyd's step until no centre changes.  Sums are exact
(:class:`~sparkmart.functions.money.ExactSum`), so neither partitioning nor
row order matters.  Each step is one aggregate of ``k`` rows; the driver holds
the ``k`` centres.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.functions.money import ExactSum


@dataclass
class FixedPoint:
    features: list[str]
    mean: list[float]
    std: list[float]
    centers: list[list[float]]  # in standard units
    sizes: list[int]
    steps: int

    def standard(self) -> list[Column]:
        """The features in standard units (a constant one is 0 everywhere)."""
        return [
            ((F.col(c).cast("double") - F.lit(m)) / F.lit(s)) if s > 0 else F.lit(0.0)
            for c, m, s in zip(self.features, self.mean, self.std, strict=True)
        ]

    def distances(self, point: list[Column]) -> list[Column]:
        """Squared distances to each centre."""
        return [
            sum(((x - F.lit(v)) * (x - F.lit(v)) for x, v in zip(point, c, strict=True)), F.lit(0.0))
            for c in self.centers
        ]

    def nearest(self, point: list[Column]) -> Column:
        """The nearest centre's number; the first of equals."""
        d = F.array(*self.distances(point))
        return (F.array_position(d, F.array_min(d)) - 1).cast("int")


def _sums(df: DataFrame, columns: list[Column], key: str | None = None) -> list:
    """Row count and exact totals of ``columns``, per ``key`` if one is given."""
    data = df.select(*([key] if key else []), *[c.cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    sums = [ExactSum(f"s{i}", data.schema[f"x{i}"].dataType) for i in range(len(columns))]
    first = [a for i, s in enumerate(sums) for a in s.first(F.col(f"x{i}"))]
    agg = (data.groupBy(key) if key else data).agg(F.count(F.lit(1)).alias("n"), *first)
    return agg.select(*([key] if key else []), "n", *[s.total().alias(s.name) for s in sums]).collect()


def fixed_point_kmeans(
    df: DataFrame, features: list[str], k: int, key: str, max_steps: int = 200
) -> tuple[DataFrame, FixedPoint]:
    """``df`` with ``cluster`` and the model.  With fewer than ``k`` different
    points there are as many clusters as points; rows with a NULL feature get
    a NULL cluster and take no part."""
    known = df.dropna(subset=features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n, *totals = _sums(known, [F.col(c) for c in features])[0]
        if not n:
            raise ValueError("no row has all features")
        model = FixedPoint(features, [t / n for t in totals], [1.0] * len(features), [], [], 0)
        centred = [F.col(c).cast("double") - F.lit(m) for c, m in zip(features, model.mean, strict=True)]
        _, *squares = _sums(known, [x * x for x in centred])[0]
        model.std = [math.sqrt(s / (n - 1)) if n > 1 else 0.0 for s in squares]
        point = model.standard()
        place = F.struct(F.xxhash64(key), F.col(key), F.array(*point).alias("p"))
        model.centers = [list(known.agg(F.min(place).alias("m")).first()["m"]["p"])]
        while len(model.centers) < k:
            far = F.array_min(F.array(*model.distances(point)))
            best = known.agg(
                F.max(F.struct(far.alias("d"), -F.xxhash64(key), F.array(*point).alias("p"))).alias("m")
            ).first()["m"]
            if best["d"] <= 0:
                break
            model.centers.append(list(best["p"]))
        for step in range(1, max_steps + 1):
            rows = _sums(known.withColumn("__cluster", model.nearest(point)), point, "__cluster")
            new, sizes = [list(c) for c in model.centers], [0] * len(model.centers)
            for c, m, *sums in rows:
                new[c], sizes[c] = [s / m for s in sums], m
            same = new == model.centers
            model.centers, model.sizes, model.steps = new, sizes, step
            if same:
                break
        else:
            raise RuntimeError(f"centres still move after {max_steps} steps")
    finally:
        known.unpersist()
    every = [F.col(c).isNotNull() for c in features]
    whole = every[0]
    for e in every[1:]:
        whole = whole & e
    return df.withColumn("cluster", F.when(whole, model.nearest(model.standard()))), model


def kmeans_invariants(df: DataFrame, clustered: DataFrame, model: FixedPoint) -> DataFrame:
    """One row: rows, clusters, rows that are nearer to another centre than
    their own, and centres that are not the mean of their rows (to 1e-8).
    Worked out from the rows again, feature by feature."""
    point = model.standard()
    d = model.distances(point)
    own = F.element_at(F.array(*d), F.col("cluster") + 1)
    rows = clustered.agg(
        F.count("cluster").alias("n_rows"), F.count_if(own > F.least(*d, F.lit(float("inf")))).alias("rows_off")
    )
    means = clustered.dropna(subset=["cluster"]).groupBy("cluster").agg(
        F.array(*[F.avg(x) for x in point]).alias("mean")
    )
    centers = df.sparkSession.createDataFrame(
        list(enumerate(model.centers)), "cluster int, center array<double>"
    )
    off = F.exists(F.zip_with("mean", "center", lambda a, b: F.abs(a - b)), lambda x: x > 1e-8)
    clusters = centers.join(means, "cluster", "left").agg(
        F.count("mean").alias("n_clusters"), F.count_if(F.coalesce(off, F.lit(True))).alias("centers_off")
    )
    return rows.crossJoin(clusters).select("n_rows", "n_clusters", "rows_off", "centers_off")  # one row each


def best_split(df: DataFrame, feature: str, label: str, classes: tuple = (0, 1)) -> DataFrame:
    """The split ``feature <= threshold`` that leaves the least Gini impurity,
    over every midpoint between neighbouring values: ``threshold, n_left,
    n_right, left_<class> ..., gain`` (no row if there is one value only).

    One aggregate gives class counts per distinct value; running counts come
    from a range shuffle of those (sorted inside each partition, with the
    partitions' totals as offsets), so no task holds all values.  Rows with a
    NULL feature or a label of no class are left out; the smallest of equally
    good thresholds is taken.
    """
    names = [f"left_{c}" for c in classes]
    counts = (
        df.filter(F.col(feature).isNotNull() & F.col(label).isin(list(classes)))
        .groupBy(F.col(feature).cast("double").alias("v"))
        .agg(*[F.count_if(F.col(label) == c).alias(n) for c, n in zip(classes, names, strict=True)])
    )
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        counts.repartitionByRange(parts, "v").sortWithinPartitions("v")
        .withColumn("part", F.spark_partition_id()).persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        # One row a partition.
        totals = placed.groupBy("part").agg(
            F.min("v").alias("first"), *[F.sum(n).alias(n) for n in names]
        ).orderBy("part").collect()
        if not totals:
            return _splits(df, names, [])
        sums = [sum(t[n] for t in totals) for n in names]
        offsets, so_far = [], [0] * len(names)
        for i, t in enumerate(totals):
            after = totals[i + 1]["first"] if i + 1 < len(totals) else None
            offsets.append((t["part"], after, *so_far))
            so_far = [a + t[n] for a, n in zip(so_far, names, strict=True)]
        ddl = "part int, after double, " + ", ".join(f"base_{n} long" for n in names)
        offsets = df.sparkSession.createDataFrame(offsets, ddl)
        order = Window.partitionBy("part").orderBy("v")
        upto = order.rowsBetween(Window.unboundedPreceding, 0)
        run = placed.join(F.broadcast(offsets), "part").select(  # a row a partition
            ((F.col("v") + F.coalesce(F.lead("v").over(order), "after")) / 2).alias("threshold"),
            *[(F.sum(n).over(upto) + F.col(f"base_{n}")).alias(n) for n in names],
        ).filter("threshold IS NOT NULL")
        n = float(sum(sums))
        left = sum((F.col(x) for x in names), F.lit(0))
        right = F.lit(int(n)) - left

        def purity(parts_, size):
            return sum((p * p for p in parts_), F.lit(0.0)) / size

        at_left = purity([F.col(x).cast("double") for x in names], left)
        at_right = purity([F.lit(float(t)) - F.col(x) for t, x in zip(sums, names, strict=True)], right)
        before = sum(t * t for t in sums) / n
        found = run.select(
            "threshold", left.alias("n_left"), right.alias("n_right"), *names,
            ((at_left + at_right - F.lit(before)) / F.lit(n)).alias("gain"),
        )
        row = found.agg(F.max(F.struct("gain", (-F.col("threshold")).alias("t"), "n_left", "n_right", *names)).alias("m"))
        m = row.first()["m"]
        return _splits(df, names, [] if m is None else [(-m["t"], m["n_left"], m["n_right"], *[m[x] for x in names], m["gain"])])
    finally:
        placed.unpersist()


def _splits(df: DataFrame, names: list[str], rows: list[tuple]) -> DataFrame:
    ddl = "threshold double, n_left long, n_right long, " + ", ".join(f"{n} long" for n in names) + ", gain double"
    return df.sparkSession.createDataFrame(rows, ddl)
