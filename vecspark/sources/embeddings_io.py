"""Embedding-set and report sinks/sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Ids of a bucket, one directory of a saved set.
BUCKET = 65_536
#: Keys whose buckets are listed for a look-up, about; more are joined.
LISTED_KEYS = 100_000


def save_embeddings(df: DataFrame, path: str, mode: str = "overwrite", bucket: int = BUCKET) -> None:
    """Write ``<model, word_id, vec>`` as Parquet in directories by ``model`` and ``bucket`` (``bucket`` ids each), sorted
    by id, so that a model, or the ids of a look-up, are found without reading the rest."""
    rows = df.select("model", F.floor(F.col("word_id") / F.lit(bucket)).cast("long").alias("bucket"), "word_id", "vec")
    rows = rows.repartitionByRange("model", "word_id").sortWithinPartitions("model", "bucket", "word_id")
    rows.write.mode(mode).partitionBy("model", "bucket").parquet(path)


def load_embeddings(spark: SparkSession, path: str, models: list[str] | None = None) -> DataFrame:
    """Read embedding sets back; the ``model`` filter prunes partitions (directories)."""
    df = spark.read.parquet(path)
    if models is not None:
        df = df.where(F.col("model").isin(models))
    return df.select("model", "word_id", "vec")


def lookup_embeddings(spark: SparkSession, path: str, keys: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """O36 on a saved set: the rows of ``keys`` (``model``, ``word_id`` and any other columns) with ``vec``, null where the set has none.

    Up to ``LISTED_KEYS`` different keys: only the directories of their models and buckets are listed in the scan's partition
    filter, their id range is pushed to the row groups' statistics, and the keys are broadcast. More
    keys are joined, as then most buckets hold some. ``bucket`` must be what the set was saved with."""
    wanted = keys.where("model is not null and word_id is not null").select("model", F.col("word_id").cast("long").alias("word_id")).distinct()
    listed = wanted.limit(LISTED_KEYS + 1).collect()
    saved = spark.read.parquet(path)
    key = ["model", "word_id"]
    if len(listed) > LISTED_KEYS:
        found = saved.select(*key, "vec").join(wanted, key)
    elif not listed:
        return keys.withColumn("vec", F.lit(None).cast(saved.schema["vec"].dataType))
    else:
        at = sorted({r["word_id"] // bucket for r in listed})
        ids = [r["word_id"] for r in listed]
        here = saved.where(F.col("model").isin(sorted({r["model"] for r in listed})) & F.col("bucket").isin(at) & F.col("word_id").between(min(ids), max(ids)))
        if len(ids) <= 64:
            here = here.where(F.col("word_id").isin(sorted(set(ids))))
        found = here.select(*key, "vec").join(F.broadcast(wanted), key)
    return keys.withColumn("word_id", F.col("word_id").cast("long")).join(found, key, "left")


def write_report(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """Write a ranked report (CSV with header, or Parquet)."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", "true").csv(path)
    else:
        w.parquet(path)


def read_report(spark: SparkSession, path: str, schema: str, fmt: str = "csv") -> DataFrame:
    if fmt == "csv":
        return spark.read.option("header", "true").schema(schema).csv(path)
    return spark.read.parquet(path)
