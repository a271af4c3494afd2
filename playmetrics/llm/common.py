"""Helpers the operators share: table reads, normalisation, worker set-up."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playmetrics.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

BATCH_BYTES = 8 << 20

REPO_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> SparkSession:
    """Name the checkpoint folder and let Python workers import this package.

    The folder is the session's ``spark.checkpoint.dir`` where that is set. On
    a cluster the package travels as ``--py-files``; the path added here covers
    sessions whose workers share the driver's file system.
    """
    ensure_checkpoint_dir(spark)
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if REPO_ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([REPO_ROOT, *filter(None, paths)])
    # bounds what a Python worker holds at once, however long the texts are
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{table}.parquet")


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Actions in here leave no shuffle files behind.

    Once rows are in the checkpoint folder nothing reads those files again, so
    Spark removes them at the end of the action rather than whenever the driver
    happens to collect its garbage.
    """
    before = spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_UP, before)


def settled(df: DataFrame) -> DataFrame:
    """``df`` checkpointed, without the shuffle files of its making."""
    with tidy(df.sparkSession):
        # a new plan, since a plan takes the setting when it is made
        return df.select("*").checkpoint()


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null reads as empty.

    ``lower`` equals A-Z lowering on ASCII text and is several times faster
    than ``translate``, which only texts with other characters need.
    """
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc32_mod(column: Column, modulus: int) -> Column:
    """crc32 of the value written as text, modulo ``modulus``."""
    return F.crc32(column.cast("string").cast("binary")) % modulus


def unused_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until no column of ``df`` has that name (in any case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def tokenizer_path(name: str) -> str:
    """Where the installed public tokenizer files keep ``name`` (same place on every worker)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def label_sample(labels: DataFrame, most: int, seed: int, id_col: str = "doc_id") -> DataFrame:
    """At most ``most`` label rows with an identifier: those whose seeded hash is least."""
    return (labels.where(F.col(id_col).isNotNull())
            .orderBy(F.xxhash64(F.lit(seed), F.col(id_col)), id_col).limit(most))
