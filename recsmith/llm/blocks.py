"""Sums of large fixed-size tables over the tasks of a scan."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from recsmith.llm.common import written

#: Rows of the table in one block.
BLOCK = 256


def as_blocks(total: np.ndarray) -> pa.RecordBatch:
    """(block, data) rows of a table of int64, without empty blocks."""
    ids, data = [], []
    for k in range(0, len(total), BLOCK):
        part = total[k:k + BLOCK]
        if part.any():
            ids.append(k // BLOCK)
            data.append(part.astype("<i8").tobytes())
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(data, pa.binary())], names=["block", "data"])


def summed(parts: DataFrame, rows: int, width: int) -> np.ndarray:
    """The sum of all blocks as one (rows, width) table on the driver; its size
    is fixed, whatever the input. Each block is added up as its parts stream by."""

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(data, dtype="<i8")
                if block in total:
                    total[block] += part
                else:
                    total[block] = part.copy()
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())],
                                         names=["block", "data"])

    out = np.zeros((rows, width), dtype=np.int64)
    for r in written(parts.repartition("block").mapInArrow(add, "block int, data binary")).collect():
        part = np.frombuffer(r.data, dtype="<i8").reshape(-1, width)
        out[r.block * BLOCK:r.block * BLOCK + len(part)] += part
    return out
