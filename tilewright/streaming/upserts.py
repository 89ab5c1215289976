"""A catalogue table kept up to date by a stream of changed objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from tilewright.operators.catalogue import upsert


def latest(delta: DataFrame, key: str, order: str) -> DataFrame:
    """Of each key the row of largest ``order``."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return delta.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def keep_current(changes: DataFrame, folder: str, key: str, order: str, checkpoint: str) -> StreamingQuery:
    """Applies a stream of changes to the table in ``folder``, a version per micro batch: ``folder/v=N``.

    A version is written whole before it counts (its success mark), so a batch that is tried again writes the same
    version from the same one before it.
    """
    spark = changes.sparkSession

    def apply(batch: DataFrame, n: int) -> None:
        new = latest(batch, key, order)
        if n > 0:
            new = upsert(spark.read.schema(batch.schema).parquet(f"{folder}/v={n - 1}"), new, key)
        new.write.mode("overwrite").parquet(f"{folder}/v={n}")

    return changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
