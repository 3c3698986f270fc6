"""Packing of vector tables into blocks: one row for each block, with its arrays as bytes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vec: str) -> Column:
    """The vector isn't null and has finite components only."""
    ok = F.forall(vec, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(F.col(vec).isNotNull() & ok, F.lit(False))


def matrix(column) -> np.ndarray:
    """A list column of equal lengths as a float64 matrix."""
    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else flat.reshape(0, 0)


def unpack(data: bytes, kind=np.float64, width: int | None = None) -> np.ndarray:
    out = np.frombuffer(data, kind)
    return out if width is None else out.reshape(-1, width) if width else out.reshape(len(out), 0)
