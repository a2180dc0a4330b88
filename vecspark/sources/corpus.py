"""Text corpus sources (O1): one row per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str, sep: str = "\n", numbered: bool = False) -> DataFrame:
    """Plain text files -> ``<doc_id, line_no, line>``.

    ``doc_id`` is the file's 0-based rank by path (files without a line have none), ``line_no`` the 0-based number
    of a line in its file; ``numbered`` adds ``line_id``, its number over all files in order of path. A line ends at ``sep``;
    one after the last ``sep`` is a line only if it is not empty.

    A file is read by as many tasks as it has splits. Lines are staged once with the split they come
    from; the splits' line counts, one row a split, are summed up in order to the number of each
    split's first line, and joined back."""
    from ..operators.ranking import fits_broadcast, global_row_number
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    raw = spark.read.option("lineSep", sep).text(path)
    staged = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line")).checkpoint()
    splits = staged.groupBy("file", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    files = global_row_number(splits.groupBy("file").agg(F.sum("n").alias("in_file")), [F.col("file")], name="doc_id", start=0)
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = splits.withColumn("before", before).join(files.select("file", "doc_id"), "file")
    if numbered:
        splits = _running_total(splits, ["doc_id", "block"], "n", "over")
    splits = splits.drop("n").checkpoint()
    small = fits_broadcast(splits, F.length("file") + 40)
    out = staged.join(F.broadcast(splits) if small else splits, ["file", "block"])
    line_no = F.col("at") - F.col("first") + F.col("before")
    more = [(F.col("at") - F.col("first") + F.col("over")).alias("line_id")] if numbered else []
    return out.select("doc_id", line_no.alias("line_no"), "line", *more)


def _running_total(df: DataFrame, order: list[str], col: str, name: str) -> DataFrame:
    """Appends the sum of ``col`` over the rows before each row in ``order``, by range partitions and their sums."""
    staged = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()).checkpoint()
    w = lambda w: F.coalesce(F.sum(col).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = staged.groupBy("_part").agg(F.sum(col).alias(col)).select("_part", w(Window.orderBy("_part")).alias("_base"))  # a row a partition
    local = staged.withColumn(name, w(Window.partitionBy("_part").orderBy(*order)))
    return local.join(F.broadcast(parts), "_part").withColumn(name, F.col(name) + F.col("_base")).drop("_part", "_base")


def lines_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Split a text column on newlines -> ``<doc_id, line_no, line>`` (a generator, no shuffle)."""
    return df.select(F.col(id_col).alias("doc_id"),
                     F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line"))


def balance(df: DataFrame) -> DataFrame:
    """Spread a scan over the cluster when it yields fewer splits than there are cores.

    A large input already has many splits and is returned unchanged (no shuffle); a
    table stored as a few large row groups would otherwise run all per-row text work
    (line splitting, tokenising) in a handful of tasks.
    """
    spark = df.sparkSession
    par = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < par:
        return df.repartition(par)
    return df


def read_documents(spark: SparkSession, sf_dir: str, lang: str | None = None) -> DataFrame:
    """The ``documents`` table, pruned to id and text (and filtered by language if asked)."""
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    if lang is not None:
        df = df.where(F.col("lang") == lang)
    return balance(df.select("doc_id", "text"))


def write_text_files(docs: DataFrame, path: str, file_bytes: int = 256 << 20, least: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """The texts as plain text files of about ``file_bytes`` (``least`` files at least), in order of id from file to file and
    within one; null texts are left out. Each file is written by one task."""
    rows = docs.where(F.col(text_col).isNotNull())
    size = rows.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    parts = max(least, -(-size // file_bytes))
    rows.repartitionByRange(parts, id_col, text_col).sortWithinPartitions(id_col, text_col).select(text_col).write.text(path)
