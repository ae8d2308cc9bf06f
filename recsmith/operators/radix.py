"""Exact percentiles of many columns and groups by radix selection.

A double becomes a 64-bit key of the same order. The first round counts, for
every (group, column), the keys by their top 16 bits; the bucket that holds a
wanted rank is looked up in the running counts, and the next round counts the
next 16 bits of the keys in these buckets only. After four rounds the keys of
the ranks are known to the last bit. A round is one scan with map-side combined
counts, for all columns, groups and percentiles together: nothing is sorted,
and a value held by a third of the rows is one count. A window over a
histogram has at most 65,536 rows.

Defined results: nulls are left out; NaN is the largest value, -0.0 is 0.0;
null groups are groups; a (group, column) without values has no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recsmith.session import cut_lineage

_BITS, _ROUNDS = 16, 4
_SIGN = np.uint64(1 << 63)


def order_keys(x: np.ndarray) -> np.ndarray:
    """Unsigned keys in the order of the doubles."""
    bits = np.where(np.isnan(x), np.float64("nan"), x + 0.0).view(np.uint64)
    return np.where(bits & _SIGN, ~bits, bits | _SIGN)


def from_keys(keys: np.ndarray) -> np.ndarray:
    return np.where(keys & _SIGN, keys ^ _SIGN, ~keys).view(np.float64)


def _key_rows(df: DataFrame, cols: list[str], by: list[str]) -> DataFrame:
    """(_g, _u): one row for each value, _g the struct of group and column."""
    plain = df.select(*[F.col(c).alias(f"_b{i}") for i, c in enumerate(by)], *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(cols)])
    schema = T.StructType([plain.schema[f"_b{i}"] for i in range(len(by))] + [T.StructField("_c", T.IntegerType()), T.StructField("_u", T.LongType())])

    def scan(batches):
        for batch in batches:
            for i in range(len(cols)):
                column = batch.column(len(by) + i)
                there = column.is_valid()
                keys = order_keys(column.filter(there).to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([*[batch.column(k).filter(there) for k in range(len(by))], pa.array(np.full(len(keys), i), pa.int32()),
                                                  pa.array(keys.view(np.int64))], names=schema.names)

    return plain.mapInArrow(scan, schema).select(F.struct(*[f"_b{i}" for i in range(len(by))], "_c").alias("_g"), "_u")


def grouped_percentiles(df: DataFrame, cols: list[str], probs: list[float], by: list[str] | None = None) -> DataFrame:
    """(by..., column, prob, value): exact percentiles with linear interpolation
    at position p * (n - 1)."""
    by = by or []
    keys = cut_lineage(_key_rows(df, cols, by))
    wanted = found = None
    for turn in range(_ROUNDS):
        prefix = F.lit(0).cast("bigint") if turn == 0 else F.shiftrightunsigned("_u", 64 - _BITS * turn)
        rows = keys.select("_g", prefix.alias("_prefix"),
                           F.shiftrightunsigned("_u", 64 - _BITS * (turn + 1)).bitwiseAND(F.lit((1 << _BITS) - 1)).alias("_digit"))
        if wanted is not None:
            places = wanted.select("_g", "_prefix").distinct()
            rows = rows.join(places, ["_g", "_prefix"], "left_semi")
        counts = rows.groupBy("_g", "_prefix", "_digit").agg(F.count(F.lit(1)).alias("_n"))
        upto = Window.partitionBy("_g", "_prefix").orderBy("_digit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        counts = cut_lineage(counts.withColumn("_cum", F.sum("_n").over(upto)))
        if wanted is None:
            sizes = counts.groupBy("_g").agg(F.sum("_n").alias("_size"))
            asked = sizes.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs]))).withColumn("_pos", F.col("prob") * (F.col("_size") - 1))
            found = cut_lineage(asked.select("_g", "prob", "_pos", F.floor("_pos").alias("_lo"), F.ceil("_pos").alias("_hi")))
            ranks = found.select("_g", F.explode(F.array("_lo", "_hi")).alias("_rank")).distinct()
            wanted = ranks.select("_g", "_rank", F.lit(0).cast("bigint").alias("_prefix"), F.col("_rank").alias("_rest"))
        hit = wanted.join(counts, ["_g", "_prefix"]).where((F.col("_cum") > F.col("_rest")) & (F.col("_cum") - F.col("_n") <= F.col("_rest")))
        wanted = cut_lineage(hit.select("_g", "_rank", F.shiftleft("_prefix", _BITS).bitwiseOR(F.col("_digit")).alias("_prefix"),
                                        (F.col("_rest") - F.col("_cum") + F.col("_n")).alias("_rest")))

    def decode(batches):
        for batch in batches:
            value = from_keys(batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(value)], names=["_g", "_rank", "_v"])

    values = wanted.select("_g", "_rank", "_prefix").mapInArrow(
        decode, T.StructType([wanted.schema["_g"], wanted.schema["_rank"], T.StructField("_v", T.DoubleType())]))
    values = cut_lineage(values)
    low = values.select("_g", F.col("_rank").alias("_lo"), F.col("_v").alias("_vlo"))
    high = values.select("_g", F.col("_rank").alias("_hi"), F.col("_v").alias("_vhi"))
    value = F.when((F.col("_hi") == F.col("_lo")) | (F.col("_vlo") == F.col("_vhi")), F.col("_vlo")).otherwise(
        (F.col("_hi") - F.col("_pos")) * F.col("_vlo") + (F.col("_pos") - F.col("_lo")) * F.col("_vhi"))
    names = F.array(*[F.lit(c) for c in cols])
    return found.join(low, ["_g", "_lo"]).join(high, ["_g", "_hi"]).select(
        *[F.col(f"_g._b{i}").alias(c) for i, c in enumerate(by)], F.element_at(names, F.col("_g._c") + 1).alias("column"), "prob", value.alias("value"))
