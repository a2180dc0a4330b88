"""Registered metric queries over the MLP/CNN predictions of ``embeddings``:
O2, O20, O31-O34, O43, O44, O51."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import tensor as TS
from ..operators import windows as W
from ..sources.vectors import read_labelled
from . import nets as N
from .q_layers import score
from .registry import register

PRED = "WITH " + N.MLP_SQL + ",\npreds AS (" + N.preds_sql("mlp") + ")\n"
SCORES = "WITH " + N.MLP_SQL + ",\n"


def mlp_preds(spark, sf):
    return score(spark, sf, "mlp")


@register("labelled_vectors", "SELECT vec_id AS id, label, CAST(len(embedding) AS INTEGER) AS dim, "
          "round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS vsum FROM embeddings")
def labelled_vectors(spark, sf):
    from ..functions import vec as V
    df = read_labelled(spark, f"{sf}/embeddings.parquet", "vec_id", "embedding", "label", scale=1.0)
    return df.select("id", "label", F.size("features").alias("dim"), F.round(V.vsum("features"), 6).alias("vsum"))


@register("stack_truth_pred", PRED + "SELECT vec_id, label AS truth, pred FROM preds")
def stack_truth_pred(spark, sf):
    return mlp_preds(spark, sf).select("vec_id", F.col("label").alias("truth"), "pred")


@register("stack_rows", PRED + "SELECT CAST(0 AS INTEGER) AS k, vec_id, CAST(label AS INTEGER) AS v FROM preds "
          "UNION ALL SELECT 1, vec_id, pred FROM preds")
def stack_rows(spark, sf):
    p = mlp_preds(spark, sf)
    return TS.stack_rows([p.select("vec_id", F.col(c).cast("int").alias("v")) for c in ("label", "pred")])


@register("num_correct", PRED + "SELECT CAST(sum(CAST(pred = label AS BIGINT)) AS BIGINT) AS num_correct FROM preds")
def num_correct(spark, sf):
    return M.num_correct(mlp_preds(spark, sf))


@register("accuracy", PRED + "SELECT CAST(sum(CAST(pred = label AS BIGINT)) AS BIGINT) AS num_correct, count(*) AS n, "
          "round(avg(CAST(pred = label AS DOUBLE)), 6) AS accuracy FROM preds")
def accuracy(spark, sf):
    return M.accuracy(mlp_preds(spark, sf)).withColumn("accuracy", F.round("accuracy", 6))


CONF_SQL = PRED + """, grid AS (SELECT CAST(t AS INTEGER) AS truth, CAST(p AS INTEGER) AS pred
                   FROM range(10) a(t) CROSS JOIN range(10) b(p)),
cm AS (SELECT g.truth, g.pred, CAST(count(pr.vec_id) AS BIGINT) AS n
       FROM grid g LEFT JOIN preds pr ON pr.label = g.truth AND pr.pred = g.pred GROUP BY g.truth, g.pred)
"""


@register("confusion_long", CONF_SQL + "SELECT truth, pred, n FROM cm")
def confusion_long(spark, sf):
    return M.confusion_matrix(mlp_preds(spark, sf), 10)


@register("confusion_wide", CONF_SQL + "SELECT truth, " + ", ".join(
    f"CAST(sum(n) FILTER (WHERE pred = {i}) AS BIGINT) AS p{i}" for i in range(10)) + " FROM cm GROUP BY truth")
def confusion_wide(spark, sf):
    return M.confusion_matrix(mlp_preds(spark, sf), 10, wide=True)


@register("confusion_named", CONF_SQL + "SELECT truth, pred, n, 'class ' || truth AS truth_name, "
          "'class ' || pred AS pred_name FROM cm")
def confusion_named(spark, sf):
    return M.confusion_matrix(mlp_preds(spark, sf), 10, names=[f"class {i}" for i in range(10)])


CE_SQL = SCORES + """lse AS (SELECT vec_id, max(score) + ln(sum(exp(score - m))) AS lse
        FROM (SELECT vec_id, score, max(score) OVER (PARTITION BY vec_id) AS m FROM mlp) GROUP BY vec_id),
ce AS (SELECT l.vec_id, l.lse - s.score AS loss FROM lse l JOIN embeddings e USING (vec_id)
       JOIN mlp s ON s.vec_id = l.vec_id AND s.k = e.label)
"""


@register("cross_entropy", CE_SQL + "SELECT round(avg(loss), 6) AS loss, round(sum(loss), 6) AS loss_sum, "
          "count(*) AS n FROM ce")
def cross_entropy(spark, sf):
    r = M.cross_entropy(mlp_preds(spark, sf))
    return r.select(F.round("loss", 6).alias("loss"), F.round("loss_sum", 6).alias("loss_sum"), "n")


@register("training_log", CE_SQL + """, steps AS (
  SELECT 0 AS epoch, CAST(c.vec_id // 100 AS INTEGER) AS step, count(*) AS rows, avg(c.loss) AS loss,
         sum(CAST(p.pred = p.label AS BIGINT)) AS correct
  FROM ce c JOIN (""" + N.preds_sql("mlp") + """) p USING (vec_id) GROUP BY c.vec_id // 100)
SELECT epoch, round(sum(loss), 6) AS loss_sum, round(avg(loss), 6) AS loss_mean, CAST(sum(rows) AS BIGINT) AS rows,
       CAST(sum(correct) AS BIGINT) AS correct, count(*) AS passes FROM steps GROUP BY epoch""")
def training_log(spark, sf):
    p = W.assign_batches(mlp_preds(spark, sf), size=100, id_col="vec_id")
    loss = M.log_softmax_loss(F.col("scores"), F.col("label"))
    steps = p.groupBy(F.lit(0).alias("epoch"), F.col("batch_id").alias("step")).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(loss).alias("loss"),
        F.sum((F.col("pred") == F.col("label")).cast("long")).alias("correct"))
    return M.training_log(steps).select("epoch", F.round("loss_sum", 6).alias("loss_sum"),
                                        F.round("loss_mean", 6).alias("loss_mean"), "rows", "correct", "passes")


@register("batch_assignment", "SELECT vec_id, CAST((row_number() OVER (ORDER BY vec_id) - 1) // 32 AS INTEGER) "
          "AS batch_id FROM embeddings")
def batch_assignment(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id")
    return W.assign_batches(e, size=32, order=["vec_id"])


@register("shuffled_batches", "SELECT vec_id, CAST((row_number() OVER (ORDER BY md5('7:' || vec_id), vec_id) - 1) // 32 AS INTEGER) "
          "AS batch_id FROM embeddings")
def shuffled_batches(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id")
    return W.assign_batches(e, size=32, shuffle=True, seed=7, order=["vec_id"])


@register("concat_batches", "WITH " + N.MLP_SQL + ",\n" + N.CNN_SQL + """
SELECT 'mlp' AS model, vec_id, label, pred FROM (""" + N.preds_sql("mlp") + """)
UNION ALL SELECT 'cnn', vec_id, label, pred FROM (""" + N.preds_sql("cnn") + ")")
def concat_batches(spark, sf):
    parts = [score(spark, sf, m).select(F.lit(m).alias("model"), "vec_id", "label", "pred") for m in ("mlp", "cnn")]
    return W.concat(parts)
