"""Embedding rows for the vector operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from granary.llm.common import ship


def vector_bytes(df: DataFrame, id_col: str, vector_col: str, scale: float | None = None, keep_zero: bool = False) -> DataFrame:
    """(vec_id, vec): components as little-endian doubles, or floor(scale * x) as 64-bit integers.

    vec is null where the vector is null, empty, or holds a null or a non-finite component;
    also where it is zero, unless keep_zero.
    """
    ship(df.sparkSession)

    def converted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for vector in batch.column(1):
                x = None
                if vector.is_valid and vector.values.null_count == 0 and len(vector.values):
                    x = vector.values.to_numpy(zero_copy_only=False).astype("<f8")
                    if not np.isfinite(x).all() or not (keep_zero or x.any()):
                        x = None
                if x is not None and scale is not None:
                    x = np.floor(scale * x).astype("<i8")
                out.append(None if x is None else (x + 0).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(out, pa.binary())], ["vec_id", "vec"]
            )

    return df.select(id_col, vector_col).mapInArrow(converted, "vec_id long, vec binary")


def matrix(rows, dtype: str) -> np.ndarray:
    """Equally long byte strings as a matrix."""
    return np.frombuffer(b"".join(rows), dtype).reshape(len(rows), -1)
