"""What the two operators on vectors share: which vectors count, and as what."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vec: str) -> Column:
    """Whether an array of doubles is not null, not zero, without null or non-finite parts."""
    return F.coalesce(F.expr(f"exists({vec}, x -> x != 0) and forall({vec}, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def unpack(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1)
