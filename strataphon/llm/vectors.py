"""Checking and packing of embedding rows, shared by the vector operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def matrix(column: pa.Array, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, float64 matrix) of the usable vectors: not null, not zero, every component finite.

    Only vectors of length ``width`` are taken; without one, callers pass vectors of one length.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy()
    sizes = np.diff(offsets)
    sizes[np.asarray(column.is_null())] = 0
    values = column.values
    flat = values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null component becomes NaN
    rows = np.flatnonzero(sizes > 0)
    if not len(rows):
        return rows, np.zeros((0, 0))
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    rows = rows[bad[offsets[rows + 1]] == bad[offsets[rows]]]
    if not len(rows):
        return rows, np.zeros((0, 0))
    width = int(sizes[rows[0]]) if width is None else width
    rows = rows[sizes[rows] == width]
    out = flat[offsets[rows][:, None] + np.arange(width)]
    good = out.any(axis=1)
    return rows[good], out[good]
