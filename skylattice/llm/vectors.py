"""Whole-number vectors in exact arithmetic, and consecutive rows of sorted batches.

Vectors travel as the doubles they came as and are turned into whole numbers
where they are used. What fits is held as 64-bit integers, and products that fit
go through floating point, where they are exact; anything larger, up to the
limits of a double, is held as Python integers, which are slower and as exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The widest decimal column; larger numbers are held at its ends.
LARGEST = 10**38 - 1
WIDE = pa.decimal128(38, 0)


def finite(column: str = "embedding") -> Column:
    """Whether a vector is there, not empty, and without null or non-finite components."""
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce((F.size(column) > 0) & fine, F.lit(False))


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of every component, exactly."""
    if np.abs(x).max(initial=0) * scale < 1 << 62:
        return np.floor(x * scale).astype(np.int64)
    # A double of 2**52 or more is a whole number, however it is scaled.
    exact = [int(v) * scale if abs(v) >= 1 << 52 else math.floor(v * scale) for v in x.ravel().tolist()]
    out = np.empty(len(exact), object)
    out[:] = exact
    return out.reshape(x.shape)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two whole-number matrices."""
    if a.dtype != object and b.dtype != object:
        bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
        if bound < 1 << 53:
            return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
        if bound < 1 << 62:
            return a @ b.T
    return a.astype(object) @ b.astype(object).T


def best_first(scores: np.ndarray, good: np.ndarray) -> np.ndarray:
    """For each row the columns by falling score, earlier columns first among equals, those not good last."""
    last = 1 << 2200 if scores.dtype == object else np.iinfo(np.int64).max
    return np.argsort(np.where(good, -scores, last), axis=1, kind="stable")


def decimals(values: np.ndarray) -> pa.Array:
    """Whole numbers as a decimal column; what 38 digits cannot hold is held at the ends."""
    if values.dtype != object:
        return pa.array(values).cast(WIDE)
    return pa.array([held(v) for v in values], WIDE)


def held(value: int) -> Decimal:
    return Decimal(min(max(value, -LARGEST), LARGEST))


def ordered(values: np.ndarray) -> pa.Array:
    """Whole numbers of any size as a binary column that sorts as they do: sign and length, then the digits."""
    return pa.array([_ordered(v) for v in values.tolist()], pa.binary())


def _ordered(value: int) -> bytes:
    size = (abs(value).bit_length() + 7) // 8
    if value >= 0:
        return (0x8000 + size).to_bytes(2, "big") + value.to_bytes(size, "big")
    return (0x8000 - size).to_bytes(2, "big") + ((1 << 8 * size) - 1 + value).to_bytes(size, "big")


def number(mark: bytes) -> int:
    """What ``ordered`` has made ``mark`` of."""
    value, size = int.from_bytes(mark[2:], "big"), len(mark) - 2
    return value if mark[0] & 0x80 else value + 1 - (1 << 8 * size)


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def runs(batches, size: int, key: str) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with the same key, at most ``size`` together."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        while rows.num_rows:
            same = rows.column(key).to_numpy() == rows.column(key)[0].as_py()
            end = rows.num_rows if same.all() else int(same.argmin())
            if end == rows.num_rows and end < size:
                break
            end = min(end, size)
            yield rows.slice(0, end).combine_chunks().to_batches()[0]
            rows = rows.slice(end)
        held = rows
    if held is not None and held.num_rows:
        yield held.combine_chunks().to_batches()[0]


def dealt(df: DataFrame, parts: int, *columns: str) -> DataFrame:
    """Each row once for every ``part`` from 0 to ``parts`` - 1."""
    return df.select(*(columns or df.columns), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
