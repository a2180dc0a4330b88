"""Arrow <-> NumPy helpers for vector columns inside ``mapInArrow`` tasks.

Fixed-length ``list<double|float>`` columns are converted through their flat value
buffers (no per-row Python objects), which is what makes the Arrow-batched kernels cheap.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def to_matrix(col) -> tuple[np.ndarray, np.ndarray]:
    """list column -> (matrix n x d as float64, valid-row mask). Rows must share one length."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    valid = ~np.asarray(col.is_null().to_numpy(zero_copy_only=False), dtype=bool)
    if n == 0:
        return np.zeros((0, 0)), valid
    offs = col.offsets.to_numpy()
    lens = np.diff(offs)
    d = int(lens[valid].max()) if valid.any() else 0
    if valid.any() and (lens[valid] != d).any():
        raise ValueError("vectors of different lengths in one column")
    flat = col.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if (~valid).any():
        M = np.zeros((n, d))
        M[valid] = flat[offs[:-1][valid][:, None] + np.arange(d)]
        return M, valid
    start = offs[0]
    return flat[start:start + n * d].reshape(n, d), valid


def from_matrix(M: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    """matrix n x d -> list<double> column; rows that are not ``valid`` become null."""
    M = np.ascontiguousarray(M, dtype=np.float64)
    n, d = M.shape
    offs = pa.array(np.arange(0, (n + 1) * d, d, dtype=np.int32))
    mask = None if valid is None or valid.all() else pa.array(~valid)
    return pa.ListArray.from_arrays(offs, pa.array(M.ravel()), mask=mask)
