"""Sums of long arrays over all tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Numbers in one row of a partial sum; partial sums that are left to the driver for each number.
_CHUNK, _FAN = 1 << 13, 16


def array_sum(rows: DataFrame, partial: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int) -> np.ndarray:
    """The sum over all tasks of the ``size`` numbers that ``partial`` makes of a task's rows.

    A task gives one array, cut into chunks; chunks are added in groups of tasks, and the driver adds what
    those groups give: at most ``_FAN`` times ``size`` numbers, however many tasks there are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = partial(batches)
        for chunk, at in enumerate(range(0, len(flat), _CHUNK)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int32()), pa.array([flat[at : at + _CHUNK].tobytes()], pa.binary())], names=["chunk", "sums"]
            )

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(s.as_py()) for s in table.column("sums"))
        return pa.table({"chunk": table.column("chunk")[:1], "sums": pa.array([total.tobytes()], pa.binary())})

    parts = rows.mapInArrow(run, "chunk int, sums binary")
    grouped = parts.groupBy("chunk", F.pmod(F.spark_partition_id(), F.lit(_FAN)).alias("some"))
    total = np.zeros(size)
    for r in grouped.applyInArrow(add, "chunk int, sums binary").collect():
        part = np.frombuffer(r["sums"])
        total[r["chunk"] * _CHUNK : r["chunk"] * _CHUNK + len(part)] += part
    return total
