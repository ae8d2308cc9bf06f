"""Sources and sinks (S1..S9): file layouts the pipelines read and write.

Everything is a distributed Spark read or write; partitioned layouts use
directory partitioning so stage filters become partition pruning. Scratch
output goes under the cluster's shared checkpoint directory, never a
machine-local temp folder.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from recsmith.session import ensure_checkpoint_dir

CLICK_SCHEMA = StructType([StructField("user_id", LongType()), StructField("item_id", LongType()),
                           StructField("time_us", LongType())])


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return os.path.join(ensure_checkpoint_dir(spark), "recsmith-io", f"{name}-{uuid.uuid4().hex}")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of the path (works for
    any cluster file system, not only local disk)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


# ------------------------------------------------------------------ S1 / S7

def write_click_logs(df: DataFrame, base: str) -> None:
    """Header-less CSV parts under ``phase=<train|test>/stage=<n>``. Rows are
    rebalanced by (phase, stage): small stages come out as one file, a large
    one is split over as many tasks as its volume needs."""
    (df.select("user_id", "item_id", "time_us", "phase", "stage")
     .hint("rebalance", "phase", "stage")
     .write.mode("overwrite").partitionBy("phase", "stage").csv(base))


def read_click_logs(spark: SparkSession, base: str, max_stage: int,
                    schema: StructType = CLICK_SCHEMA) -> DataFrame:
    """S1 (+U1): read train and test parts of stages 0..max_stage with an
    explicit schema; the stage comes from the directory name (Q15), so the
    filter prunes whole directories."""
    df = spark.read.schema(schema).option("basePath", base).csv(base)
    return df.where(F.col("stage") <= max_stage)


def write_csv(df: DataFrame, path: str) -> None:
    """S7 write: CSV with a header row."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """S7 read: CSV with a header row and an explicit schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


# ------------------------------------------------------------------ S2

def write_item_vectors_csv(df: DataFrame, path: str, split: int) -> None:
    """Item vectors as ``id,[t1, t2, ...],[i1, i2, ...]`` text lines."""
    def fmt(a):
        return F.array_join(F.transform(a, lambda x: x.cast("string")), ", ")
    line = F.concat(F.col("item_id").cast("string"), F.lit(",["), fmt(F.slice("vec", 1, split)), F.lit("],["),
                    fmt(F.expr(f"slice(vec, {split + 1}, greatest(size(vec) - {split}, 0))")), F.lit("]"))
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def read_item_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Strip brackets, cast to float, split into the two vectors."""
    raw = spark.read.text(path)
    pat = r"^([^,]+),\[(.*)\],\[(.*)\]$"

    def vec(i):
        return F.split(F.regexp_extract("value", pat, i), r",\s*").cast("array<float>")
    return raw.select(F.regexp_extract("value", pat, 1).cast("bigint").alias("item_id"),
                      vec(2).alias("text_vec"), vec(3).alias("image_vec"))


# ------------------------------------------------------------------ S4 / S6

def write_training_set(df: DataFrame, path: str, array_cols: dict[str, int]) -> None:
    """S4 write: overwrite a fixed-shape training set (Parquet). The record
    contract is checked inline: every array column must have its declared
    length, else the write fails."""
    checked = df
    for c, n in array_cols.items():
        checked = checked.withColumn(
            c, F.when(F.size(c) == n, F.col(c)).otherwise(F.raise_error(F.lit(f"{c} must have length {n}"))))
    checked.write.mode("overwrite").parquet(path)


def read_training_set(spark: SparkSession, path: str) -> DataFrame:
    """S4 read."""
    return spark.read.parquet(path)


def write_parts(df: DataFrame, path: str, num_parts: int, key: str) -> None:
    """Rows dealt by ``key`` into ``num_parts`` folders ``part=<n>``; each
    folder is written by as many tasks as its volume needs."""
    part = F.pmod(F.xxhash64(key), F.lit(num_parts)).cast("int")
    df.withColumn("part", part).hint("rebalance", "part").write.mode("overwrite").partitionBy("part").parquet(path)


# ------------------------------------------------------------------ S5

def write_vectors_text(df: DataFrame, path: str, dim: int) -> None:
    """word2vec text layout: the ``count dim`` header line in a file of its
    own under ``header/``, then ``id v1 .. vd`` lines under ``rows/``, written
    in parallel; concatenated they are the one-file layout."""
    body = df.select(F.concat_ws(" ", F.col("item_id").cast("string"),
                                 F.array_join(F.transform("vec", lambda x: x.cast("string")), " ")).alias("value"))
    header = df.agg(F.concat_ws(" ", F.count(F.lit(1)).cast("string"), F.lit(str(dim))).alias("value"))
    body.write.mode("overwrite").text(os.path.join(path, "rows"))
    header.write.mode("overwrite").text(os.path.join(path, "header"))


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """S5 read: (item_id, vec, declared_count, declared_dim)."""
    def lines(part):
        return spark.read.text(os.path.join(path, part)).select(F.split("value", " ").alias("t"))
    head = lines("header").select(F.col("t")[0].cast("bigint").alias("declared_count"),
                                  F.col("t")[1].cast("int").alias("declared_dim"))
    body = lines("rows").select(F.col("t")[0].cast("bigint").alias("item_id"),
                                F.expr("slice(t, 2, size(t) - 1)").cast("array<float>").alias("vec"))
    one = F.lit(1)
    return (body.withColumn("_one", one)
            .join(F.broadcast(head.limit(1).withColumn("_one", one)), "_one", "left").drop("_one"))


# ------------------------------------------------------------------ S8

def materialize_if_absent(spark: SparkSession, path: str, build) -> DataFrame:
    """Reuse a saved derived table if it was committed (its ``_SUCCESS``
    marker is there), else build and save it (a distributed write; the driver
    never holds the data). What a failed write left behind is overwritten."""
    if not path_exists(spark, os.path.join(path, "_SUCCESS")):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
