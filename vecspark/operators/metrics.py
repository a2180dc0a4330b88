"""Metrics: bincount, correct count, accuracy, confusion matrix, training log, cross-entropy.

O26 bincount, O31 num_correct, O32 accuracy, O33 confusion_matrix, O34 training_log,
O51 cross_entropy (over a whole vocabulary: :mod:`.softmax`). All are aggregates with partial
(map-side) aggregation; zero-filled grids are distributed ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bincount(df: DataFrame, col: str) -> DataFrame:
    """Count of each value 0..max(col), zero-filled. A null or negative value fails the job. The grid is a
    distributed range joined to the counts, so a label of any size makes no array; no rows for an empty table."""
    v = F.col(col).cast("long")
    v = F.when(v >= 0, v).otherwise(F.raise_error(F.lit("bincount takes integers from 0 only")))
    counts = df.groupBy(v.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    top = counts.agg(F.max("value")).first()[0]
    grid = df.sparkSession.range(0 if top is None else top + 1).select(F.col("id").alias("value"))
    return grid.join(counts, "value", "left").select(F.col("value").cast(df.schema[col].dataType).alias("value"),
                                                     F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def is_correct(pred: str, label: str) -> Column:
    """Whether prediction and label are equal; a null on either side counts as not correct."""
    return F.coalesce(F.col(pred) == F.col(label), F.lit(False))


def num_correct(df: DataFrame, pred: str = "pred", label: str = "label") -> DataFrame:
    """Number of rows whose prediction equals the label."""
    return df.agg(F.coalesce(F.sum(is_correct(pred, label).cast("long")), F.lit(0)).alias("num_correct"))


def accuracy(df: DataFrame, pred: str = "pred", label: str = "label") -> DataFrame:
    """Fraction of correct predictions among all rows, with the counts it came from."""
    right = is_correct(pred, label)
    return df.agg(F.coalesce(F.sum(right.cast("long")), F.lit(0)).alias("num_correct"),
                  F.count(F.lit(1)).alias("n"), F.avg(right.cast("double")).alias("accuracy"))


#: Stands for all values that are no class (null among them) in a confusion matrix.
OTHER = -1


def confusion_matrix(df: DataFrame, classes: int, truth: str = "label", pred: str = "pred",
                     names: list[str] | None = None, wide: bool = False) -> DataFrame:
    """Zero-filled confusion matrix, rows = truth, columns = prediction, classes 0..``classes``-1.

    Long form ``<truth, pred, n>`` (classes x classes rows); ``wide=True`` pivots the
    prediction into columns ``p0..p{K-1}`` (or ``names``). ``names`` also adds
    ``truth_name``/``pred_name`` columns in the long form. Rows whose truth or prediction is no class, or null, are
    counted under class ``OTHER`` ("other"): further rows, and in the wide form a last column ``other``, that are
    there only if there are such rows. The counts add up to the rows of ``df``.
    """
    known = lambda c: F.when(F.col(c).cast("long").between(0, classes - 1), F.col(c).cast("int")).otherwise(F.lit(OTHER))
    counts = df.groupBy(known(truth).alias("truth"), known(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(classes * classes).select(F.expr(f"cast(id div {classes} as int)").alias("truth"), F.expr(f"cast(id % {classes} as int)").alias("pred"))
    long = grid.join(counts, ["truth", "pred"], "full").select("truth", "pred", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    shown = {i: nm for i, nm in enumerate(names or [])} | {OTHER: "other"}
    named = F.create_map(*[x for i, nm in shown.items() for x in (F.lit(i), F.lit(nm))])
    if wide:
        columns = list(range(classes))
        labels = list(names or [f"p{i}" for i in range(classes)])
        if counts.where(F.col("pred") == OTHER).limit(1).count():
            columns, labels = [*columns, OTHER], [*labels, "other"]
        out = long.groupBy("truth").pivot("pred", columns).agg(F.first("n"))
        out = out.select("truth", *[F.coalesce(F.col(str(i)), F.lit(0)).alias(nm) for i, nm in zip(columns, labels)])
        return out.withColumn("truth_name", named[F.col("truth")]) if names else out
    if names:
        long = long.withColumn("truth_name", named[F.col("truth")]).withColumn("pred_name", named[F.col("pred")])
    return long


def log_softmax_loss(scores: Column, label: Column) -> Column:
    """Per-row cross-entropy from raw scores: ``max + ln(sum(exp(s - max))) - s[label]``."""
    s = scores.cast("array<double>")
    m = F.array_max(s)
    lse = m + F.log(F.aggregate(s, F.lit(0.0), lambda acc, x: acc + F.exp(x - m)))
    return lse - F.element_at(s, label.cast("int") + 1)


def cross_entropy(df: DataFrame, scores: str = "scores", label: str = "label") -> DataFrame:
    """Mean cross-entropy over rows (log-softmax inside), plus its sum and row count."""
    l = log_softmax_loss(F.col(scores), F.col(label))
    return df.agg(F.avg(l).alias("loss"), F.sum(l).alias("loss_sum"), F.count(F.lit(1)).alias("n"))


def training_log(steps: DataFrame) -> DataFrame:
    """Per epoch -- loss sum and mean over steps, rows, correct predictions, passes."""
    return steps.groupBy("epoch").agg(
        F.sum("loss").alias("loss_sum"), F.avg("loss").alias("loss_mean"),
        F.sum("rows").alias("rows"), F.sum("correct").alias("correct"),
        F.count(F.lit(1)).alias("passes"))
