"""SparkSession settings the pipeline's semantics depend on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the results depend on: UTC for timestamp_micros / date(ts),
# ANSI for raising casts, and an error on duplicate map keys so a param key
# that occurs twice in one event fails like a multi-row scalar subquery.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "EXCEPTION",
}

# The JIT leaves methods of more than 8,000 bytes of bytecode interpreted. The wide
# projections of staging generate such methods, so they are run without whole-stage
# code instead, as methods that are split and compiled (staging takes about half the time).
SPEED_CONF = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to an existing session (idempotent)."""
    for key, value in {**SEMANTIC_CONF, **SPEED_CONF}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, app_name: str = "playmetrics",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Session for local runs and tests; on a cluster the launcher's settings win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        # Generated code for wide projections exceeds the JIT's 8 KB method
        # limit; without this flag those methods run interpreted (~2x slower).
        "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
        "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **SEMANTIC_CONF,
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    sc = spark.sparkContext
    return (sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
            or spark.conf.get("spark.checkpoint.dir", None))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder, set on the context. Without a configured one a local master
    gets a scratch folder; a cluster has to name one that all its machines share."""
    sc = spark.sparkContext
    directory = checkpoint_dir(spark)
    if directory is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError(f"{sc.master}: set spark.checkpoint.dir to a folder that the "
                               "driver and all executors share")
        directory = tempfile.mkdtemp(prefix="playmetrics-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(directory)
    return sc.getCheckpointDir() or directory


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique table path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
