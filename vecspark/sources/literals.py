"""Tables from literals and synthetic tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _infer(values) -> str:
    flat = np.asarray(values).ravel()
    if flat.dtype.kind == "b":
        return "boolean"
    if flat.dtype.kind in "iu":
        return "bigint"
    return "double"


def tensor_table(spark: SparkSession, values, dtype: str | None = None) -> DataFrame:
    """O3: a rank-1..4 literal tensor as ``<id, vec>`` (axis 0 -> rows, the rest flattened
    row-major into ``vec``). ``dtype`` states the element type; otherwise it is inferred
    (integers -> bigint, else double), like a tensor factory does."""
    a = np.asarray(values)
    t = dtype or _infer(a)
    if a.ndim == 0:
        a = a.reshape(1, 1)
    elif a.ndim == 1:
        a = a.reshape(1, -1)
    conv = {"double": float, "float": float, "bigint": int, "int": int, "boolean": bool}[t]
    rows = [(i, [conv(x.item()) for x in a[i].ravel()]) for i in range(a.shape[0])]
    base = "double" if t == "float" else ("bigint" if t == "int" else t)
    return spark.createDataFrame(rows, f"id long, vec array<{base}>") \
        .select("id", F.col("vec").cast(f"array<{t}>").alias("vec"))


def random_table(spark: SparkSession, rows: int, cols: int, dist: str = "normal", seed: int = 0,
                 partitions: int | None = None) -> DataFrame:
    """``<id, vec>`` of standard-normal (``normal``) or uniform [0,1) (``uniform``) values.

    Generated in parallel from ``spark.range``; each element depends on (seed, id, position)
    only, so the result does not depend on partitioning and survives recomputation.
    """
    ids = spark.range(0, rows, numPartitions=partitions) if partitions else spark.range(rows)
    lg = ids.select("id", F.explode(F.sequence(F.lit(0), F.lit(cols - 1))).alias("pos"))
    h1 = F.xxhash64(F.lit(seed), F.col("id"), F.col("pos"), F.lit(1))
    h2 = F.xxhash64(F.lit(seed), F.col("id"), F.col("pos"), F.lit(2))
    u1 = (F.pmod(h1, F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    u2 = (F.pmod(h2, F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    if dist == "normal":   # Box-Muller
        v = F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * np.pi) * u2)
    elif dist == "uniform":
        v = u1
    else:
        raise ValueError(dist)
    return (lg.select("id", "pos", v.alias("v")).groupBy("id")
            .agg(F.sort_array(F.collect_list(F.struct("pos", "v"))).alias("_s"))
            .select("id", F.col("_s.v").alias("vec")))


def make_regression(spark: SparkSession, n: int, p: int = 1, noise: float = 20.0, seed: int = 1,
                    informative: int | None = None) -> DataFrame:
    """``<id, x array<double>, y double>`` with ``y = x . w + bias(0) + noise * N(0,1)``.

    Features are standard normal; coefficients are drawn once from a seeded generator as
    ``100 * U[0,1)`` for the informative features (0 for the rest), as a regression
    generator does. Rows are generated in parallel (same scheme as :func:`random_table`).
    """
    rng = np.random.default_rng(seed)
    k = p if informative is None else informative
    coef = np.zeros(p)
    coef[:k] = 100.0 * rng.random(k)
    X = random_table(spark, n, p, "normal", seed)
    e = random_table(spark, n, 1, "normal", seed + 7919).select("id", F.col("vec")[0].alias("e"))
    w = F.array(*[F.lit(float(c)) for c in coef])
    y = F.aggregate(F.zip_with("vec", w, lambda a, b: a * b), F.lit(0.0), lambda acc, z: acc + z)
    return X.join(e, "id").select("id", F.col("vec").alias("x"), (y + F.lit(noise) * F.col("e")).alias("y")), coef
