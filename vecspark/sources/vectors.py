"""Labelled-vector source (O2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_labelled(spark: SparkSession, path: str, id_col: str, vec_col: str, label_col: str,
                  scale: float = 1.0) -> DataFrame:
    """Parquet of labelled vectors -> ``<id, features array<double>, label int>``.

    ``scale`` divides every element (255 turns byte pixels into 0-1 values, as image
    loaders do); only the three columns are read.
    """
    df = spark.read.parquet(path).select(id_col, vec_col, label_col)
    feats = F.col(vec_col).cast("array<double>")
    if scale != 1.0:
        feats = F.transform(feats, lambda x: x / F.lit(float(scale)))
    return df.select(F.col(id_col).alias("id"), feats.alias("features"), F.col(label_col).cast("int").alias("label"))
