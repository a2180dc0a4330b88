"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Links of a partition, about: a table of fewer than its partitions would hold lies in fewer of them.
PART = 100_000


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node of the links ``a`` - ``b``, ``root`` the smallest node reachable.

    Each round joins the links with one smallest neighbour per node (a pre-aggregated minimum) and is
    checkpointed to the shared folder; links never leave the executors. Rounds grow with the
    logarithm of the longest chain. Ids may be of any ordered type; null links and loops are ignored."""
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    e = e.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct().checkpoint()
    mark = None
    while True:
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == mark:
            break
        mark = now
        parts = 1 + now[0] // PART
        e = e.coalesce(parts)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(parts)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = small.unionByName(low.withColumnRenamed("m", "v")).distinct().coalesce(parts).checkpoint()
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
