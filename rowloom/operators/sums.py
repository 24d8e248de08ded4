"""Sums of long vectors over all tasks."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CELL = 1024


def summed(rows: DataFrame, of_task: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int) -> np.ndarray:
    """The sum of vectors of ``size`` numbers, one from each task's batches.

    Vectors travel in cells of fixed size, which are added as a stream; the driver gets one vector, whatever the tasks.
    """
    width = -(-size // CELL) * CELL
    schema = "cell int, total binary"

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(width)
        cells[:size] = of_task(batches)
        cells = cells.reshape(-1, CELL)
        some = np.flatnonzero(cells.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([cells[i].tobytes() for i in some], pa.binary())], names=["cell", "total"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for cell, total in zip(batch.column(0).to_pylist(), batch.column(1)):
                held = totals.setdefault(cell, np.zeros(CELL))
                held += np.frombuffer(total.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array([t.tobytes() for t in totals.values()], pa.binary())], names=["cell", "total"])

    out = np.zeros(width).reshape(-1, CELL)
    for cell, total in rows.mapInArrow(send, schema).repartition("cell").mapInArrow(add, schema).toLocalIterator():
        out[cell] = np.frombuffer(bytes(total))
    return out.reshape(-1)[:size]
