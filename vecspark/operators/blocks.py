"""Re-indexing of a distributed matrix across rows (O17, O19): another row length, and the transpose.

A matrix is a table ``<id, vec>`` of dense 0-based rows of one length. The results' rows may be as long as the table was
high, so they are stored in blocks: ``<row, block, vals>``, where ``vals`` are the columns from ``block * size`` on, ``size`` of
them but in a row's last block. Each source row is cut into the pieces that fall into one target block, and
pieces meet by (row, block) in one exchange; a group holds one block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tensor import infer_shape

SIZE = 4096


def reshape_rows(df: DataFrame, id_col: str, vec_col: str, length: int, rows: int, new_length: int = -1, new_rows: int = -1, size: int = SIZE) -> DataFrame:
    """O17 over rows: the ``rows`` x ``length`` matrix read in row-major order as ``new_rows`` x ``new_length`` (one may be -1)."""
    _, wide = infer_shape([new_rows, new_length], rows * length)

    def cut(batches):
        for b in batches:
            out = [], [], [], []
            for i, vec in zip(b.column(0).to_pylist(), b.column(1)):
                at, end = i * length, (i + 1) * length
                vals = vec.values
                while at < end:
                    row, col = divmod(at, wide)
                    stop = min(end, at + wide - col, at + size - col % size)
                    for c, v in zip(out, (row, col // size, col % size, vals.slice(at - i * length, stop - at).to_numpy(zero_copy_only=False))):
                        c.append(v)
                    at = stop
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.float64())))],
                                             names=["row", "block", "at", "vals"])
    pieces = _checked(df, id_col, vec_col, length).mapInArrow(cut, "row long, block int, at int, vals array<double>")
    held = pieces.groupBy("row", "block").agg(F.sort_array(F.collect_list(F.struct("at", "vals"))).alias("p"))
    return held.select("row", "block", F.flatten(F.col("p.vals")).alias("vals"))


def transpose_rows(df: DataFrame, id_col: str, vec_col: str, length: int, size: int = SIZE) -> DataFrame:
    """O19 over rows: the transpose, ``length`` rows of as many columns as the table has rows. Squares of ``size`` rows and up to
    ``size`` columns are gathered in one exchange and turned in place."""
    def cut(batches):
        for b in batches:
            ids = b.column(0).to_numpy()
            for j in range(0, length, size):
                part = pa.array([v.values.slice(j, size).to_numpy(zero_copy_only=False) for v in b.column(1)], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array((ids // size).astype(np.int32)), pa.array(np.full(len(ids), j // size, np.int32)), b.column(0), part],
                                                 names=["block", "cols", "at", "vals"])

    def turn(key, t):
        t = t.sort_by("at")
        first, ids = key[1].as_py() * size, t.column("at").to_numpy()
        if (np.diff(ids) != 1).any() or ids[0] % size:
            raise ValueError("row ids are not dense")
        vals = t.column("vals").combine_chunks()
        x = vals.flatten().to_numpy().reshape(len(ids), -1)
        n = x.shape[1]
        out = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * len(ids)), pa.array(np.ascontiguousarray(x.T).ravel()))
        return pa.table({"row": np.arange(first, first + n, dtype=np.int64), "block": pa.array(np.full(n, key[0].as_py(), np.int32)), "vals": out})
    pieces = _checked(df, id_col, vec_col, length).mapInArrow(cut, "block int, cols int, at long, vals array<double>")
    return pieces.groupBy("block", "cols").applyInArrow(turn, "row long, block int, vals array<double>")


def _checked(df: DataFrame, id_col: str, vec_col: str, length: int) -> DataFrame:
    """(id, vec) in doubles; a row of another length fails the job."""
    bad = F.raise_error(F.concat(F.lit(f"a row is not {length} long: "), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    vec = F.when(F.size(vec_col) == length, F.col(vec_col).cast("array<double>")).otherwise(bad)
    return df.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"))


def cells(blocks: DataFrame, size: int = SIZE) -> DataFrame:
    """``<row, col, v>``, a row a value."""
    return blocks.select("row", "block", F.posexplode("vals").alias("p", "v")).select("row", (F.col("block").cast("long") * size + F.col("p")).alias("col"), "v")
