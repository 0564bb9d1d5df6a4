"""Session construction and shared-storage helpers.

The library never assumes a machine-local folder on a cluster: scratch
output and checkpoints go under ``spark.checkpoint.dir`` as configured by the
cluster.  Only when that setting is unset (local runs, tests) do we pick a
fresh folder under the system temp dir.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Sized for local[8] test runs; on a cluster the caller's own settings win
# (getOrCreate keeps an existing session's configuration).
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # MLlib's iterative algorithms (K-Means, trees, FP-Growth) shuffle and
    # cache JVM objects through RDDs; Kryo is faster and more compact there.
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def build_session(
    master: str | None = None,
    app_name: str = "sparkmart",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults.

    ``extra_conf`` is where object-store settings go, e.g. the output of
    :func:`object_store_conf`.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def object_store_conf(
    endpoint: str,
    access_key: str,
    secret_key: str,
    path_style: bool = True,
    secure: bool = False,
) -> dict[str, str]:
    """Hadoop S3A settings for an S3-compatible store.

    The ``hadoop-aws`` jar must be on the cluster classpath; paths are then
    plain ``s3a://bucket/...`` URIs everywhere in the library.
    """
    scheme = "https" if secure else "http"
    if "://" not in endpoint:
        endpoint = f"{scheme}://{endpoint}"
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(secure).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a ``local[...]`` session (not ``local-cluster``) without that setting gets a fresh temp
    folder (tests, laptops); on a cluster a machine-local folder would be
    invisible to other executors, so an unset setting is an error there.
    Works without a SparkContext handle (Spark Connect) from the conf alone.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions expose no context
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(
                "set spark.checkpoint.dir to a shared folder (e.g. an object-store or HDFS path)"
            )
        configured = tempfile.mkdtemp(prefix="sparkmart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "scratch", f"{name}-{uuid.uuid4().hex[:12]}")
