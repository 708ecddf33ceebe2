"""Vectors as whole numbers: what counts as usable, and Arrow columns as integer matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from geoledger.llm.common import ship_with_tasks

#: A component x becomes floor(SCALE * x).
SCALE = 256
#: Components of this size or more are treated like infinite ones: squares and products must fit 64 bits.
LIMIT = float(1 << 16)

ship_with_tasks(__name__)


def usable(vector: str) -> Column:
    """The vector has components and all of them are numbers below the limit; false where it is null."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LIMIT))
    return F.coalesce((F.size(vector) > 0) & whole, F.lit(False))


def integer_matrices(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By dimension: row numbers and int64 rows of floor(256 * x); all rows must be usable."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    whole = np.floor(column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False) * SCALE).astype(np.int64)
    starts = np.append(0, np.cumsum(lengths))
    out = {}
    for dim in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == dim)
        out[dim] = rows, whole[starts[rows][:, None] + np.arange(dim)]
    return out
