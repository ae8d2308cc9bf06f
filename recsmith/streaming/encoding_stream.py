"""Incremental encoding over a stream of log files (E1 in append mode).

The append-only code table as a stream: each micro-batch writes the codes
of the values it brings as a partition of its own (``version=<batch id>``),
next to those of earlier batches, so existing codes never change and a batch
costs only its new codes. A batch that is replayed reads the versions before
it and overwrites its own partition: nothing appears twice.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from recsmith.operators.encode import fit_encoding
from recsmith.sources.io import path_exists


def read_state(spark: SparkSession, state_dir: str, field: str, before: int | None = None) -> DataFrame | None:
    """(value, id) of all batches, or of those before a batch; None if there
    are none."""
    path = os.path.join(state_dir, field)
    if not path_exists(spark, path):
        return None
    versions = spark.read.parquet(path)
    if before is not None:
        versions = versions.where(F.col("version") < before)
    versions = versions.select("value", "id")
    return None if versions.isEmpty() else versions


def append_encodings(batch: DataFrame, batch_id: int, state_dir: str, fields: list[str],
                     is_unk: bool = False) -> None:
    """``foreachBatch`` body: extend each field's code table with the batch."""
    spark = batch.sparkSession
    for field in fields:
        known = read_state(spark, state_dir, field, before=batch_id)
        codes = fit_encoding(batch, field, known, is_padding=True, is_unk=is_unk)
        if known is not None:
            codes = codes.join(known.select(F.col("value").alias("_known")), F.col("value").eqNullSafe(F.col("_known")), "left_anti")
        codes.write.mode("overwrite").parquet(os.path.join(state_dir, field, f"version={batch_id}"))


def start_encoding_stream(spark: SparkSession, source_dir: str, schema: StructType, state_dir: str,
                          checkpoint_dir: str, fields: list[str], available_now: bool = True):
    """Stream Parquet log files from ``source_dir`` and keep the code tables
    under ``state_dir`` current. Returns the StreamingQuery."""
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source_dir)
    writer = (stream.writeStream
              .foreachBatch(lambda df, bid: append_encodings(df, bid, state_dir, fields))
              .option("checkpointLocation", checkpoint_dir))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
