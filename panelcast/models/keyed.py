"""Sums of matrices by key: partial sums a task, one task a key to finish them.

The models reduce their rows to cross-products; the rows stay where they are, a task sends one row a key it has met, and
what a key's sums are good for (a solve, a decomposition) happens where they meet, not on the driver.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

Sums = list[np.ndarray]
_PARTIAL = "key string, sums binary"


def keyed_sums(rows: DataFrame, partial: Callable[[dict], Iterator[tuple[str, Sums]]], finish: Callable[[str, Sums], Iterator[tuple]],
               schema: str, arrow: pa.Schema) -> DataFrame:
    """``partial(row)`` yields (key, arrays); arrays of a key are added up, and ``finish(key, sums)`` yields result rows."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Sums] = {}
        for b in batches:
            for row in b.to_pylist():
                for key, arrays in partial(row):
                    held[key] = [x + y for x, y in zip(held[key], arrays, strict=True)] if key in held else list(arrays)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array([pickle.dumps(v) for v in held.values()], pa.binary())],
                                             names=["key", "sums"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None

        def batch():
            out = list(finish(now, held))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)

        for b in batches:
            for key, raw in zip(b.column("key").to_pylist(), b.column("sums").to_pylist(), strict=True):
                arrays = pickle.loads(raw)
                if key == now:
                    held = [x + y for x, y in zip(held, arrays, strict=True)]
                    continue
                if now is not None:
                    yield from batch()
                now, held = key, arrays
        if now is not None:
            yield from batch()

    return rows.mapInArrow(task, _PARTIAL).repartition("key").sortWithinPartitions("key").mapInArrow(solve, schema)
