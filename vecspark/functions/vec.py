"""Column expressions over packed vectors (``array<float|double>`` columns).

These stay JVM-side (higher-order functions); they are meant for per-row work on
bounded sets (query vectors, parameters). Bulk one-against-all scans use the
Arrow-batched kernels in :mod:`vecspark.operators.embed`.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: formula-made weights shared with the SQL oracle -------------
# value(a, b) = ((a*a*31 + a*(b+1)*7919 + b*b*17) % 1000003 - 500001) / 1000003
FORMULA_MOD = 1000003
FORMULA_SHIFT = 500001
# -----------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(v) -> Column:
    return _col(v).cast("array<double>")


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(to_double(a), to_double(b), lambda x, y: x * y), F.lit(0.0),
                       lambda acc, x: acc + x)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b) -> Column:
    """Cosine similarity; 0 when either vector is all zeros."""
    na, nb = norm(a), norm(b)
    return F.when((na == 0) | (nb == 0), F.lit(0.0)).otherwise(dot(a, b) / (na * nb))


def combine(cols: list, weights: list[float]) -> Column:
    """Weighted sum of vectors, e.g. ``b - a + c`` = ``combine([b, a, c], [1, -1, 1])``."""
    def axpy(w: float):
        return lambda x, y: x + y * F.lit(float(w))

    acc = F.transform(to_double(cols[0]), lambda x: x * F.lit(float(weights[0])))
    for c, w in zip(cols[1:], weights[1:]):
        acc = F.zip_with(acc, to_double(c), axpy(w))
    return acc


def argmax(v) -> Column:
    """0-based index of the largest element; ties -> lowest index."""
    return (F.array_position(_col(v), F.array_max(_col(v))) - 1).cast("int")


def relu(v) -> Column:
    return F.transform(_col(v), lambda x: F.greatest(x, F.lit(0.0)))


def vsum(v) -> Column:
    return F.aggregate(to_double(v), F.lit(0.0), lambda acc, x: acc + x)


def formula_value(a: Column, b: Column) -> Column:
    """Formula-made weight for row ``a`` (from 1) and position ``b`` (from 0), as double."""
    a = a.cast("bigint")
    b = b.cast("bigint")
    return (((a * a * 31 + a * (b + 1) * 7919 + b * b * 17) % FORMULA_MOD) - FORMULA_SHIFT) \
        / F.lit(float(FORMULA_MOD))


def formula_vec(a: Column, dim: int) -> Column:
    """Formula-made vector of length ``dim`` for row id ``a``."""
    return F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda b: formula_value(a, b))


def formula_matrix_np(rows: np.ndarray, dim: int) -> np.ndarray:
    """NumPy twin of :func:`formula_vec` for many rows at once (bit-identical doubles)."""
    a = np.asarray(rows, dtype=np.int64)[:, None]
    b = np.arange(dim, dtype=np.int64)[None, :]
    num = (a * a * 31 + a * (b + 1) * 7919 + b * b * 17) % FORMULA_MOD - FORMULA_SHIFT
    return num.astype(np.float64) / float(FORMULA_MOD)


def formula_sql(a: str, dim: int) -> str:
    """DuckDB SQL twin of :func:`formula_vec`."""
    return (f"list_transform(range({dim}), lambda b: ((CAST(({a}) AS BIGINT) * ({a}) * 31 + "
            f"CAST(({a}) AS BIGINT) * (b + 1) * 7919 + b * b * 17) % {FORMULA_MOD} - {FORMULA_SHIFT}) "
            f"/ CAST({FORMULA_MOD} AS DOUBLE))")
