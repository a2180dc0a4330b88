"""Layer operators over tables of vectors and the parameter table.

O45 param_shapes, O46 linear, O47 relu, O48 conv2d, O49 max_pool, O50 batch_norm.

Two forms are offered. The relational form (long tables joined to a broadcast parameter
table, then aggregated) is exact and readable, and is what the SQL oracle mirrors. The
packed form runs the layer as a NumPy matrix product per Arrow batch with the
parameters broadcast -- no shuffle at all -- and is the bulk path.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import nn
from ..functions import vec as V
from ..functions.arrow import from_matrix, to_matrix

MAX_PARAM_BYTES = 1 << 30    # parameters collected to the driver and broadcast
ROWS = 256    # rows that go through a network at a time


# ------------------------------------------------------------------ parameter table

def formula_params(spark: SparkSession, spec: dict[str, tuple[int, int, int]]) -> DataFrame:
    """Parameter table ``<name, row, vec>`` from formula-made weights.

    ``spec``: name -> (rows, dim, a0); row r gets ``formula_vec(a0 + r, dim)``.
    """
    out = None
    for name, (rows, dim, a0) in spec.items():
        part = spark.range(rows).select(F.lit(name).alias("name"), F.col("id").cast("int").alias("row"),
                                        V.formula_vec(F.col("id") + a0, dim).alias("vec"))
        out = part if out is None else out.unionByName(part)
    return out


def param_shapes(params: DataFrame) -> DataFrame:
    """``<name, rows, cols>`` per parameter (rows = max(row)+1, cols = max vector length)."""
    return params.groupBy("name").agg((F.max("row") + 1).cast("long").alias("rows"),
                                      F.max(F.size("vec")).cast("long").alias("cols"))


def collect_params(params: DataFrame) -> dict[str, np.ndarray]:
    """Parameters -> dict of NumPy arrays (biases and BN vectors flattened to 1-D).
    The table is bounded by the model size, checked before collecting."""
    from .ranking import estimated_bytes
    n = estimated_bytes(params, F.size("vec") * 8)
    if n > MAX_PARAM_BYTES:
        raise ValueError(f"parameter table takes {n} bytes, above {MAX_PARAM_BYTES}")
    pdf = params.select("name", "row", "vec").toPandas().sort_values(["name", "row"])
    out = {}
    for name, g in pdf.groupby("name", sort=False):
        M = np.stack([np.asarray(v, dtype=np.float64) for v in g["vec"]])
        out[name] = M[0] if M.shape[0] == 1 else M
    return out


# ------------------------------------------------------------------ packed (bulk) path

def apply_network(df: DataFrame, vec_col: str, layers: list[tuple], params: dict[str, np.ndarray],
                  keep: list[str], out: str = "scores", with_pred: bool = True) -> DataFrame:
    """Run a network over every row: ``keep`` columns + ``out`` (array<double>) [+ ``pred``].

    Parameters are broadcast once; each Arrow batch is one NumPy forward pass. A null vector gets null
    scores and a null class, which metrics count as not correct.
    """
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast((layers, params))
    schema_keep = [f"{c} {df.schema[c].dataType.simpleString()}" for c in keep]
    schema = ", ".join(schema_keep + [f"{out} array<double>"] + (["pred int"] if with_pred else []))

    def kernel(batches):
        lay, prm = bc.value
        for b in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            X, valid = to_matrix(b.column(vec_col))
            S = None
            if valid.any():
                S = nn.forward(X, lay, prm)
                S = S.reshape(S.shape[0], -1)
            cols = [b.column(c) for c in keep]
            cols.append(pa.nulls(b.num_rows, pa.list_(pa.float64())) if S is None else from_matrix(S, valid))
            names = list(keep) + [out]
            if with_pred:
                cols.append(pa.nulls(b.num_rows, pa.int32()) if S is None
                            else pa.array(nn.argmax_rows(S).astype(np.int32), mask=~valid))
                names.append("pred")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return df.select(*keep, vec_col).mapInArrow(kernel, schema)


def linear(df: DataFrame, vec_col: str, W: np.ndarray, b: np.ndarray, keep: list[str],
           out: str = "y") -> DataFrame:
    """O46 (bulk): y = x W^T + b per row."""
    return apply_network(df, vec_col, [("linear", "l")], {"l.weight": W, "l.bias": b}, keep, out,
                         with_pred=False)


def relu(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Element-wise max(x, 0), JVM-side."""
    return df.withColumn(out or col, V.relu(col))


# ------------------------------------------------------------------ relational path

def conv2d_long(images: DataFrame, kernels: DataFrame, bias: DataFrame, h: int, w: int, k: int,
                id_col: str = "id") -> DataFrame:
    """O48 (relational): valid conv, stride 1, many channels.

    images ``<id, ch, y, x, v>``; kernels ``<out_ch, ch, ky, kx, w>``; bias ``<out_ch, b>``.
    Each pixel meets the kernel taps of its channel (equi-join on ``ch``, kernel broadcast),
    is shifted to the output cell it feeds, out-of-range cells are dropped, and the taps
    are summed per output cell. Output ``<id, out_ch, oy, ox, v>`` with size (n-f)/1+1.
    """
    oh, ow = h - k + 1, w - k + 1
    j = images.join(F.broadcast(kernels), "ch")
    j = j.select(id_col, "out_ch", (F.col("y") - F.col("ky")).alias("oy"), (F.col("x") - F.col("kx")).alias("ox"),
                 (F.col("v").cast("double") * F.col("w")).alias("p"))
    j = j.where((F.col("oy") >= 0) & (F.col("oy") < oh) & (F.col("ox") >= 0) & (F.col("ox") < ow))
    s = j.groupBy(id_col, "out_ch", "oy", "ox").agg(F.sum("p").alias("s"))
    return s.join(F.broadcast(bias), "out_ch").select(
        id_col, F.col("out_ch").alias("ch"), F.col("oy").cast("int").alias("y"), F.col("ox").cast("int").alias("x"),
        (F.col("s") + F.col("b")).alias("v"))


def max_pool_long(images: DataFrame, h: int, w: int, k: int = 2, id_col: str = "id") -> DataFrame:
    """O49 (relational): k x k max pooling, stride k, odd edges dropped. Groups hold k*k rows."""
    hh, ww = (h // k) * k, (w // k) * k
    return (images.where((F.col("y") < hh) & (F.col("x") < ww))
            .groupBy(id_col, "ch", F.expr(f"cast(y div {k} as int)").alias("y"),
                     F.expr(f"cast(x div {k} as int)").alias("x"))
            .agg(F.max("v").alias("v")))


def batch_norm_long(x_long: DataFrame, stats: DataFrame, eps: float = nn.BN_EPS) -> DataFrame:
    """Inference batch norm on the long form.

    stats ``<pos, mean, var, gamma, beta>`` (one row per feature, broadcast);
    ``(v - mean) / sqrt(var + eps) * gamma + beta``. Dropout at inference is the identity.
    """
    j = x_long.join(F.broadcast(stats), "pos")
    return j.select(*[c for c in x_long.columns if c != "v"],
                    ((F.col("v").cast("double") - F.col("mean")) / F.sqrt(F.col("var") + F.lit(eps))
                     * F.col("gamma") + F.col("beta")).alias("v"))


def feature_stats(x_long: DataFrame) -> DataFrame:
    """Per-feature mean and population variance (the statistics batch norm normalises with)."""
    v = F.col("v").cast("double")
    return x_long.groupBy("pos").agg(F.avg(v).alias("mean"), F.var_pop(v).alias("var"))
