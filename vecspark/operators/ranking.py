"""Distributed global numbering and size-checked broadcast.

``global_row_number`` gives every row its 1-based position in a total order without a
single-task window: rows are range-partitioned on the order, each partition numbers its
rows locally, and a tiny table of per-partition counts (one row per partition) supplies
the offsets. The staged rows are checkpointed to the shared checkpoint folder so the
range bounds (sampled at run time) cannot change between the counting pass and the
numbering pass, and so a lost executor recomputes from the written table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_PART = "_vs_part"
_LOCAL = "_vs_local"


def global_row_number(df: DataFrame, order: list[Column], name: str = "row_id",
                      start: int = 1) -> DataFrame:
    """Append ``name`` = ``start`` + 0-based rank of each row under ``order``.

    ``order`` must be a total order (ties broken) for the numbering to be deterministic.
    """
    ensure_checkpoint_dir(df.sparkSession)
    staged = (df.repartitionByRange(*order)
                .sortWithinPartitions(*order)
                .withColumn(_PART, F.spark_partition_id())
                .withColumn(_LOCAL, F.monotonically_increasing_id()
                            - F.shiftleft(F.col(_PART).cast("bigint"), 33)))
    staged = staged.checkpoint(eager=True)
    # one row per partition: a bounded table, safe to number in one task and broadcast
    offsets = (staged.groupBy(_PART).agg(F.count(F.lit(1)).alias("_vs_n"))
               .withColumn("_vs_off", F.coalesce(
                   F.sum("_vs_n").over(Window.orderBy(_PART)
                                       .rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)))
               .select(_PART, "_vs_off"))
    return (staged.join(F.broadcast(offsets), _PART)
            .withColumn(name, F.col("_vs_off") + F.col(_LOCAL) + F.lit(start))
            .drop(_PART, _LOCAL, "_vs_off"))


# Byte bounds for broadcasting a data-derived table. JVM hash-join broadcasts are built on
# the driver (override: vecspark.broadcastBytes); NumPy matrices shipped to Python workers
# as broadcast variables use a separate bound (override: vecspark.pythonBroadcastBytes). A matrix that is broadcast in slices, of which a worker holds one
# at a time, has a bound for all of them (override: vecspark.slicedBroadcastBytes): every machine keeps them on disk.
BROADCAST_BYTES = 64 << 20
PYTHON_BROADCAST_BYTES = 256 << 20
SLICED_BROADCAST_BYTES = 8 << 30
ROW_OVERHEAD = 48


def broadcast_limit(spark) -> int:
    v = spark.conf.get("vecspark.broadcastBytes", None)
    return int(v) if v else BROADCAST_BYTES


def python_broadcast_limit(spark) -> int:
    v = spark.conf.get("vecspark.pythonBroadcastBytes", None)
    return int(v) if v else PYTHON_BROADCAST_BYTES


def sliced_broadcast_limit(spark) -> int:
    v = spark.conf.get("vecspark.slicedBroadcastBytes", None)
    return int(v) if v else SLICED_BROADCAST_BYTES


def estimated_bytes(df: DataFrame, row_bytes: Column) -> int:
    """Measured size of a table: one aggregate pass summing a per-row byte estimate."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes).alias("b")).first()
    return int(r["n"] or 0) * ROW_OVERHEAD + int(r["b"] or 0)


def fits_broadcast(df: DataFrame, row_bytes: Column, max_bytes: int | None = None) -> bool:
    """True when the table's measured size is within the (JVM) broadcast byte bound."""
    limit = max_bytes if max_bytes is not None else broadcast_limit(df.sparkSession)
    return estimated_bytes(df, row_bytes) <= limit
