"""A table that a stream's micro-batches build up, each counted once.

A batch writes its own folder, replacing what an earlier attempt at it left, and
then an entry in the ledger. Only batches in the ledger are read, and a batch
that is there already is not written again, so a batch that is repeated after a
crash, before or after its entry, adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmetrics.sources.files import exists
from playmetrics.sources.ledger import LATE, Ledger

BATCH_COLUMN = "batch"


class BatchTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, f"{path.rstrip('/')}/rows"
        self.ledger = Ledger(spark, f"{path.rstrip('/')}/ledger")

    def write(self, rows: DataFrame, batch: int) -> None:
        done = self.ledger.batches().where(F.col(BATCH_COLUMN) == batch)
        if not done.isEmpty():
            return
        folder = f"{self.path}/{BATCH_COLUMN}={batch}"
        rows.write.mode("overwrite").parquet(folder)
        written = self.spark.read.schema(rows.schema).parquet(folder).count()  # from the footers
        self.ledger.record_batch(batch, written)

    def read(self, schema: T.StructType) -> DataFrame:
        """Rows of all batches in the ledger."""
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(T.StructType(
            [*schema.fields, T.StructField(BATCH_COLUMN, T.LongType())])).parquet(self.path)
        return rows.join(self.ledger.batches().select(BATCH_COLUMN), BATCH_COLUMN, "left_semi").drop(
            BATCH_COLUMN)

    def late_rows(self) -> int:
        """Rows that came after the watermark, over all batches."""
        return self.ledger.batches(LATE).agg(F.sum("num_rows")).first()[0] or 0
