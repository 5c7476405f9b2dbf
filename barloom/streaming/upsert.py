"""Continuous upserts of bars.

Each micro-batch is written as its own partition, which a replay of the same batch replaces:
the write costs as much as the batch, not the table. Reading merges by key: the oldest
non-null value of every cell wins, as when new bars only fill what the history lacks. Within a
batch a key may stand once; two rows would have no order, so a repeated key stops the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barloom.schema import BAR_COLUMNS, KEY, VALUES
from barloom.session import CODEC, shuffles_freed

BATCH = "batch"


def write_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    repeated = F.raise_error(F.concat(F.lit("two bars for one symbol and date in a batch: "), KEY[0])).cast("double")
    once = batch.groupBy(*KEY).agg(
        *[F.when(F.count(F.lit(1)) > 1, repeated).otherwise(F.max(c)).alias(c) for c in VALUES]
    )
    with shuffles_freed(batch.sparkSession):
        (
            once.select(BAR_COLUMNS)
            .withColumn(BATCH, F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BATCH)
            .parquet(path, compression=CODEC)
        )


def stream_upsert(bars: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Start writing a stream of bars to the table at ``path``; runs until the input ends."""
    return (
        bars.writeStream.foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    """Current state of the table: one row per key, merged cell by cell."""
    stored = spark.read.parquet(path)
    cells = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(BATCH))).alias(c) for c in VALUES]
    return stored.groupBy(*KEY).agg(*cells)


def compact(spark: SparkSession, path: str, target: str) -> None:
    """Write the merged state as the base batch of a new table."""
    write_batch(read_upserted(spark, path), -1, target)
