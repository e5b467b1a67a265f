"""Vectors in Arrow columns as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def finite(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Place and doubles of every vector that has components, none null or non-finite."""
    for place, vector in enumerate(column.to_pylist()):
        if vector and None not in vector:
            values = np.array(vector, dtype=np.float64)
            if np.isfinite(values).all():
                yield place, values


def packed(vectors: DataFrame, change=None, kind: str = "<f8") -> DataFrame:
    """vec_id and x, the vector as little-endian numbers; ``change`` returns None to leave one out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = [], []
            names = batch.column(0).to_pylist()
            for place, values in finite(batch.column(1)):
                values = change(values) if change else values
                if values is not None:
                    ids.append(names[place])
                    rows.append(values.astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rows, pa.binary())], ["vec_id", "x"])

    narrow = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("embedding"))
    return narrow.where("vec_id IS NOT NULL AND embedding IS NOT NULL").mapInArrow(run, "vec_id long, x binary")
