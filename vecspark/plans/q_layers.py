"""Registered layer and scoring queries over ``embeddings`` (1x8x8 images, labels 0-9):
O45-O50, O52."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import layers as L
from ..operators import tensor as TS
from ..operators import tiles as TI
from . import nets as N
from .q_embed import EMB_SQL, emb_sets
from .registry import register


def emb(spark, sf):
    return spark.read.parquet(f"{sf}/embeddings.parquet")


def params(spark, spec):
    p = L.collect_params(L.formula_params(spark, spec))
    return {k: v + N.VARIANCE if k.endswith("running_var") else v for k, v in p.items()}


def score(spark, sf, net: str):
    layers, spec = (N.MLP_LAYERS, N.MLP_SPEC) if net == "mlp" else (N.CNN_LAYERS, N.CNN_SPEC)
    images = emb(spark, sf).select("vec_id", "label", N.image("embedding").alias("image"))
    return L.apply_network(images, "image", layers, params(spark, spec), ["vec_id", "label"])


def _scores_long(df):
    return df.select("vec_id", F.posexplode("scores").alias("k", "score")) \
        .select("vec_id", "k", F.round("score", 6).alias("score"))


@register("score_mlp", "WITH " + N.MLP_SQL + "\nSELECT vec_id, k, round(score, 6) AS score FROM mlp")
def score_mlp(spark, sf):
    return _scores_long(score(spark, sf, "mlp"))


@register("score_cnn", "WITH " + N.CNN_SQL + "\nSELECT vec_id, k, round(score, 6) AS score FROM cnn")
def score_cnn(spark, sf):
    return _scores_long(score(spark, sf, "cnn"))


LINEAR_SPEC = {"fc1.weight": (16, 64, 1), "fc1.bias": (1, 16, 17)}


@register("linear_layer", f"""
WITH x AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
w1 AS (SELECT r, {N.f('1 + r', 64)} AS w FROM range(16) t(r)),
b1 AS (SELECT {N.f('17', 16)} AS b)
SELECT x.vec_id, CAST(w1.r AS INTEGER) AS row, round(list_dot_product(x.x, w1.w) + b1.b[w1.r + 1], 6) AS y
FROM x CROSS JOIN w1 CROSS JOIN b1""")
def linear_layer(spark, sf):
    p = params(spark, LINEAR_SPEC)
    y = L.linear(emb(spark, sf), "embedding", p["fc1.weight"], p["fc1.bias"], ["vec_id"])
    return y.select("vec_id", F.posexplode("y").alias("row", "y")).withColumn("y", F.round("y", 6))


@register("relu", f"""
WITH x AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
w1 AS (SELECT r, {N.f('1 + r', 64)} AS w FROM range(16) t(r)),
b1 AS (SELECT {N.f('17', 16)} AS b)
SELECT x.vec_id, CAST(w1.r AS INTEGER) AS row, round(greatest(list_dot_product(x.x, w1.w) + b1.b[w1.r + 1], 0.0), 6) AS y
FROM x CROSS JOIN w1 CROSS JOIN b1""")
def relu(spark, sf):
    p = params(spark, LINEAR_SPEC)
    y = L.linear(emb(spark, sf), "embedding", p["fc1.weight"], p["fc1.bias"], ["vec_id"])
    y = L.relu(y, "y")
    return y.select("vec_id", F.posexplode("y").alias("row", "y")).withColumn("y", F.round("y", 6))


def _conv1(spark, sf, *layers):
    """First convolution of the small images and what follows, inside the row; ``side`` is the output's edge."""
    out = L.apply_network(emb(spark, sf), "embedding", [("reshape", (1, 8, 8)), ("conv", "conv1", 3), *layers], params(spark, N.CONV_SPEC), ["vec_id"], with_pred=False)
    side = 3 if layers else 6
    return out.select(F.col("vec_id").alias("id"), F.posexplode("scores").alias("p", "v")).select(
        "id", F.expr(f"cast(p div {side * side} as int)").alias("ch"), F.expr(f"cast((p div {side}) % {side} as int)").alias("y"),
        F.expr(f"cast(p % {side} as int)").alias("x"), F.round("v", 6).alias("v"))


CONV_SQL_HEAD = "WITH " + N.CONV_SQL + "\n"


@register("conv2d", CONV_SQL_HEAD + """
SELECT c1.vec_id AS id, CAST(c1.ch AS INTEGER) AS ch, CAST(c1.y AS INTEGER) AS y, CAST(c1.x AS INTEGER) AS x, round(c1.s + bb1.b, 6) AS v
FROM c1 JOIN bb1 ON bb1.o = c1.ch""")
def conv2d(spark, sf):
    return _conv1(spark, sf)


@register("max_pool", CONV_SQL_HEAD + """
SELECT vec_id AS id, CAST(ch AS INTEGER) AS ch, CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS x, round(v, 6) AS v FROM p1""")
def max_pool(spark, sf):
    return _conv1(spark, sf, ("relu",), ("pool", 2))


#: The whole table as one image, a pixel row a vector: taller than any row of a table.
TALL_SQL = f"""WITH px AS (SELECT vec_id AS y, generate_subscripts(embedding, 1) - 1 AS x, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
k1 AS (SELECT o, j // 3 AS ky, j % 3 AS kx, w FROM (
         SELECT r AS o, unnest(range(9)) AS j, unnest({N.f('1 + r', 9)}) AS w FROM range(3) t(r))),
bb AS (SELECT generate_subscripts(b, 1) - 1 AS o, unnest(b) AS b FROM (SELECT {N.f('5', 3)} AS b)),
size AS (SELECT max(y) + 1 AS h FROM px),
c AS (SELECT k.o AS ch, p.y - k.ky AS y, p.x - k.kx AS x, sum(p.v * k.w) + any_value(bb.b) AS v
      FROM px p CROSS JOIN k1 k JOIN bb ON bb.o = k.o CROSS JOIN size WHERE p.y - k.ky BETWEEN 0 AND h - 3 AND p.x - k.kx BETWEEN 0 AND 61
      GROUP BY ALL)
"""
TALL_SPEC = {"w.weight": (3, 9, 1), "w.bias": (1, 3, 5)}


def _tall(spark, sf):
    return emb(spark, sf).select(F.lit(0).cast("long").alias("id"), F.lit(0).alias("ch"), F.col("vec_id").cast("int").alias("y"), F.lit(0).alias("x0"),
                                 F.col("embedding").cast("array<double>").alias("vec"))


def _tall_conv(spark, sf, **more):
    p = L.collect_params(L.formula_params(spark, TALL_SPEC))
    return TI.conv2d_tiles(_tall(spark, sf), p["w.weight"].reshape(3, 1, 3, 3), p["w.bias"], tile=32, **more)


@register("conv2d_tiled", TALL_SQL + "SELECT CAST(ch AS INTEGER) AS ch, CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS x, round(v, 6) AS v FROM c")
def conv2d_tiled(spark, sf):
    return TI.pixels(_tall_conv(spark, sf)).select("ch", "y", "x", F.round("v", 6).alias("v"))


@register("max_pool_tiled", TALL_SQL + """SELECT CAST(ch AS INTEGER) AS ch, CAST(y // 2 AS INTEGER) AS y, CAST(x // 2 AS INTEGER) AS x, round(max(greatest(v, 0.0)), 6) AS v
FROM c CROSS JOIN size WHERE y < (h - 2) // 2 * 2 GROUP BY ch, y // 2, x // 2""")
def max_pool_tiled(spark, sf):
    return TI.pixels(_tall_conv(spark, sf, relu=True, pool=2)).select("ch", "y", "x", F.round("v", 6).alias("v"))


@register("batch_norm", """
WITH lg AS (SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
                   CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
st AS (SELECT pos, avg(v) AS mean, var_pop(v) AS var FROM lg GROUP BY pos),
gb AS (SELECT generate_subscripts(g, 1) - 1 AS pos, unnest(g) AS gamma, unnest(b) AS beta
       FROM (SELECT """ + N.f('50', 64) + " AS g, " + N.f('51', 64) + """ AS b))
SELECT lg.vec_id, lg.pos, round((lg.v - st.mean) / sqrt(st.var + 1e-5) * gb.gamma + gb.beta, 6) AS v
FROM lg JOIN st USING (pos) JOIN gb USING (pos)""")
def batch_norm(spark, sf):
    lg = TS.to_long(emb(spark, sf), "vec_id", "embedding")
    gb = L.formula_params(spark, {"g": (1, 64, 50)}).select(F.posexplode("vec").alias("pos", "gamma")) \
        .join(L.formula_params(spark, {"b": (1, 64, 51)}).select(F.posexplode("vec").alias("pos", "beta")), "pos")
    stats = L.feature_stats(lg).join(F.broadcast(gb), "pos")
    return L.batch_norm_long(lg, stats).withColumn("v", F.round("v", 6))


@register("param_shapes", "WITH " + EMB_SQL + """
SELECT model || '.weight' AS name, max(word_id) + 1 AS rows, CAST(max(len(vec)) AS BIGINT) AS cols
FROM sets GROUP BY model""")
def param_shapes(spark, sf):
    params = emb_sets(spark, sf).select(F.concat(F.col("model"), F.lit(".weight")).alias("name"),
                                        F.col("word_id").alias("row"), "vec")
    return L.param_shapes(params)
