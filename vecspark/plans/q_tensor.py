"""Registered tensor-table queries over ``embeddings`` (N x 64, read as N x 8 x 8 images or
N x 4 x 4 x 4 H x W x C blocks): O15-O19, O24, O26-O30."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vec as V
from ..functions.vec import formula_sql
from ..operators import blocks as B
from ..operators import embed as E
from ..operators import metrics as M
from ..operators import softmax as SM
from ..operators import tensor as TS
from ..operators import windows as W
from . import corpus as C
from .oracle_parts import CORPUS
from .registry import register


def emb(spark, sf):
    return spark.read.parquet(f"{sf}/embeddings.parquet")


LONG = ("WITH lg AS (SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos, "
        "unnest(embedding) AS v FROM embeddings)\n")


@register("elementwise", LONG + "SELECT vec_id, pos, round((CAST(v AS DOUBLE) + 1) * 2, 6) AS v FROM lg")
def elementwise(spark, sf):
    e = TS.elementwise(emb(spark, sf).select("vec_id", "embedding"), "embedding", [("add", 1.0), ("mul", 2.0)])
    return TS.to_long(e, "vec_id", "embedding").withColumn("v", F.round("v", 6))


@register("cast_vectors", LONG + "SELECT vec_id, pos, round(CAST(v AS DOUBLE), 6) AS v FROM lg")
def cast_vectors(spark, sf):
    e = TS.cast_vec(emb(spark, sf).select("vec_id", "embedding"), "embedding", "double")
    return TS.to_long(e, "vec_id", "embedding").withColumn("v", F.round("v", 6))


@register("reshape", LONG + "SELECT vec_id, CAST(pos // 16 AS INTEGER) AS i0, CAST(pos % 16 AS INTEGER) AS i1, "
          "round(CAST(v AS DOUBLE), 6) AS v FROM lg")
def reshape(spark, sf):
    lg = TS.to_long(emb(spark, sf), "vec_id", "embedding")
    r = TS.reshape(lg, [-1, 16], numel=64)
    return r.select("vec_id", "i0", "i1", F.round(F.col("v").cast("double"), 6).alias("v"))


@register("reshape_rows", LONG + """, n AS (SELECT count(*) AS n FROM embeddings)
SELECT (vec_id * 64 + pos) // (2 * n) AS row, (vec_id * 64 + pos) % (2 * n) AS col, round(CAST(v AS DOUBLE), 6) AS v FROM lg, n""")
def reshape_rows(spark, sf):
    """N x 64 as 32 rows of 2 N: rows that grow with the table, in blocks."""
    e = emb(spark, sf)
    blocks = B.reshape_rows(e, "vec_id", "embedding", 64, e.count(), new_rows=32, size=256)
    return B.cells(blocks, 256).select("row", "col", F.round("v", 6).alias("v"))


@register("transpose_rows", LONG + "SELECT CAST(pos AS BIGINT) AS row, vec_id AS col, round(CAST(v AS DOUBLE), 6) AS v FROM lg")
def transpose_rows(spark, sf):
    return B.cells(B.transpose_rows(emb(spark, sf), "vec_id", "embedding", 64, size=128), 128).select("row", "col", F.round("v", 6).alias("v"))


@register("shape_facts", "SELECT count(*) AS n_rows, max(len(embedding)) AS n_cols, 2 AS rank, "
          "CAST(sum(len(embedding)) AS BIGINT) AS numel, min(len(embedding)) = max(len(embedding)) AS uniform FROM embeddings")
def shape_facts(spark, sf):
    return TS.shape_of(emb(spark, sf), "embedding").select(
        F.col("n_rows").cast("long"), F.col("n_cols").cast("long"), F.col("rank").cast("int"),
        F.col("numel").cast("long"), "uniform")


@register("image_layout", LONG + """
SELECT 'reshape' AS mode, vec_id, CAST(pos // 16 AS INTEGER) AS ch, CAST((pos // 4) % 4 AS INTEGER) AS y,
       CAST(pos % 4 AS INTEGER) AS x, pos AS new_pos, round(CAST(v AS DOUBLE), 6) AS v FROM lg
UNION ALL
SELECT 'transpose', vec_id, CAST(pos % 4 AS INTEGER), CAST(pos // 16 AS INTEGER), CAST((pos // 4) % 4 AS INTEGER),
       CAST((pos % 4) * 16 + (pos // 16) * 4 + (pos // 4) % 4 AS INTEGER), round(CAST(v AS DOUBLE), 6) FROM lg""")
def image_layout(spark, sf):
    lg = TS.to_long(emb(spark, sf), "vec_id", "embedding")
    out = None
    for mode in ("reshape", "transpose"):
        m = TS.image_layout(lg, 4, 4, 4, mode).select(
            F.lit(mode).alias("mode"), "vec_id", "ch", "y", "x", "new_pos",
            F.round(F.col("v").cast("double"), 6).alias("v"))
        out = m if out is None else out.unionByName(m)
    return out


@register("row_argmax", "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS idx, "
          "round(CAST(list_max(embedding) AS DOUBLE), 6) AS max FROM embeddings")
def row_argmax(spark, sf):
    e = TS.argmax(emb(spark, sf).select("vec_id", "embedding"), "embedding")
    return e.select("vec_id", "idx", F.round(F.array_max("embedding").cast("double"), 6).alias("max"))


@register("overall_argmax", LONG + "SELECT arg_max(vec_id * 64 + pos, {'v': v, 'i': -(vec_id * 64 + pos)}) AS idx, "
          "round(CAST(max(v) AS DOUBLE), 6) AS max FROM lg")
def overall_argmax(spark, sf):
    r = TS.argmax_all(emb(spark, sf), "vec_id", "embedding", 64)
    return r.select("idx", F.round("max", 6).alias("max"))


@register("reduce_all", LONG + "SELECT round(sum(CAST(v AS DOUBLE)), 6) AS sum, round(avg(CAST(v AS DOUBLE)), 6) AS mean, "
          "round(stddev_samp(CAST(v AS DOUBLE)), 6) AS std, count(v) AS numel FROM lg")
def reduce_all(spark, sf):
    r = TS.reduce_all(TS.to_long(emb(spark, sf), "vec_id", "embedding"))
    return r.select(*[F.round(c, 6).alias(c) for c in ("sum", "mean", "std")], "numel")


@register("column_reduce", LONG + "SELECT pos, round(sum(CAST(v AS DOUBLE)), 6) AS sum, round(max(CAST(v AS DOUBLE)), 6) AS max, "
          "round(avg(CAST(v AS DOUBLE)), 6) AS mean, round(stddev_samp(CAST(v AS DOUBLE)), 6) AS std FROM lg GROUP BY pos")
def column_reduce(spark, sf):
    r = TS.reduce_columns(emb(spark, sf), "embedding")
    return r.select("pos", *[F.round(c, 6).alias(c) for c in ("sum", "max", "mean", "std")])


@register("column_argmax", LONG + "SELECT pos, round(CAST(max(v) AS DOUBLE), 6) AS max, "
          "arg_max(vec_id, {'v': v, 'i': -vec_id}) AS row FROM lg GROUP BY pos")
def column_argmax(spark, sf):
    r = TS.column_argmax(emb(spark, sf), "vec_id", "embedding")
    return r.select("pos", F.round("max", 6).alias("max"), "row")


@register("row_reduce", "SELECT vec_id, round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS sum FROM embeddings")
def row_reduce(spark, sf):
    r = TS.reduce_rows(emb(spark, sf).select("vec_id", "embedding"), "embedding")
    return r.select("vec_id", F.round("sum", 6).alias("sum"))


@register("label_bincount", """
SELECT CAST(g.value AS INTEGER) AS value, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM (SELECT unnest(range(0, (SELECT max(label) FROM embeddings) + 1)) AS value) g
LEFT JOIN (SELECT label, count(*) AS n FROM embeddings GROUP BY label) c ON c.label = g.value""")
def label_bincount(spark, sf):
    return M.bincount(emb(spark, sf), "label")


_F50 = "((({c} * {c} * 31 + {c} * (b + 1) * 7919 + b * b * 17) % 1000003 - 500001) / CAST(1000003 AS DOUBLE))"


@register("context_mean", "WITH " + CORPUS + """,
win AS (SELECT doc_id, line_no, pos,
          CAST(coalesce(lag(word_id, 2) OVER w, 0) AS BIGINT) AS c1, CAST(coalesce(lag(word_id, 1) OVER w, 0) AS BIGINT) AS c2,
          CAST(coalesce(lead(word_id, 1) OVER w, 0) AS BIGINT) AS c3, CAST(coalesce(lead(word_id, 2) OVER w, 0) AS BIGINT) AS c4
        FROM encoded WINDOW w AS (PARTITION BY doc_id, line_no ORDER BY pos)),
m AS (SELECT doc_id, line_no, pos, list_transform(range(50), lambda b: (((F1 + F2) + F3) + F4) / 4.0) AS mean FROM win)
SELECT doc_id, line_no, pos, round(list_sum(mean), 6) AS msum, round(sqrt(list_dot_product(mean, mean)), 6) AS mnorm
FROM m""".replace("F1", _F50.format(c="c1")).replace("F2", _F50.format(c="c2")).replace("F3", _F50.format(c="c3")).replace("F4", _F50.format(c="c4")))
def context_mean(spark, sf):
    vocab, enc = C.vocab_and_encoded(spark, sf)
    win = W.cbow_windows(enc, w=2)
    ids = vocab.select("word_id").unionByName(spark.range(1).select(F.lit(0).cast("int").alias("word_id")))
    vecs = E.formula_vectors(ids, "word_id", {"F_50": 50})
    m = TS.context_mean(win, vecs, ["c1", "c2", "c3", "c4"], ["doc_id", "line_no", "pos"], digest=True)
    return m.select("doc_id", "line_no", "pos", F.round("msum", 6).alias("msum"), F.round("mnorm", 6).alias("mnorm"))


_CLASSES, _DIM = 61, 16


@register("cbow_loss", "WITH " + CORPUS + f""",
win AS (SELECT word_id AS target,
          CAST(coalesce(lag(word_id, 2) OVER w, 0) AS BIGINT) AS c1, CAST(coalesce(lag(word_id, 1) OVER w, 0) AS BIGINT) AS c2,
          CAST(coalesce(lead(word_id, 1) OVER w, 0) AS BIGINT) AS c3, CAST(coalesce(lead(word_id, 2) OVER w, 0) AS BIGINT) AS c4
        FROM encoded WINDOW w AS (PARTITION BY doc_id, line_no ORDER BY pos)),
h AS (SELECT row_number() OVER () AS r, target, list_transform(range({_DIM}), lambda b: (((F1 + F2) + F3) + F4) / 4.0) AS h FROM win),
cls AS (SELECT id % {_CLASSES} AS c, count(*) AS n FROM (SELECT word_id AS id FROM vocab UNION ALL SELECT 0) GROUP BY ALL),
w AS (SELECT c, n, {formula_sql('c + 200', _DIM)} AS w, ({formula_sql('c + 300', 1)})[1] AS b FROM cls),
s AS (SELECT r, c, n, target, list_dot_product(h, w) + b AS s FROM h CROSS JOIN w),
l AS (SELECT r, max(s) AS m, any_value(target) AS target FROM s GROUP BY r),
e AS (SELECT s.r, any_value(l.m) + ln(sum(s.n * exp(s.s - l.m))) - any_value(s.s) FILTER (WHERE s.c = l.target % {_CLASSES}) AS loss
      FROM s JOIN l USING (r) GROUP BY s.r)
SELECT round(avg(loss), 6) AS loss, round(sum(loss), 3) AS loss_sum, count(*) AS n FROM e""".replace(
    "F1", _F50.format(c="c1")).replace("F2", _F50.format(c="c2")).replace("F3", _F50.format(c="c3")).replace("F4", _F50.format(c="c4")))
def cbow_loss(spark, sf):
    """Mean cross-entropy of every CBOW window over the whole vocabulary. The output weights of a word follow from its
    id modulo 61, which only the SQL makes use of."""
    vocab, enc = C.vocab_and_encoded(spark, sf)
    win = W.cbow_windows(enc, w=2)
    ids = vocab.select("word_id").unionByName(spark.range(1).select(F.lit(0).cast("int").alias("word_id")))
    vecs = E.formula_vectors(ids, "word_id", {"F_16": _DIM})
    hidden = TS.context_mean(win, vecs, ["c1", "c2", "c3", "c4"], ["target"])
    c = F.col("word_id") % _CLASSES
    weights = ids.select("word_id", V.formula_vec(c + 200, _DIM).alias("vec"), V.formula_vec(c + 300, 1)[0].alias("bias"))
    losses = SM.softmax_loss(hidden, weights, keep=["target"], vec="mean")
    return losses.agg(F.round(F.avg("loss"), 6).alias("loss"), F.round(F.sum("loss"), 3).alias("loss_sum"), F.count("loss").alias("n"))
