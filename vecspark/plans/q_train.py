"""Registered query of the least-squares operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import train as TR
from .registry import register


@register("linear_regression", "SELECT round(regr_slope(l_extendedprice, l_quantity), 6) AS slope, "
          "round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept, "
          "round(regr_r2(l_extendedprice, l_quantity), 12) AS r2, CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n "
          "FROM lineitem")
def linear_regression(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    r = TR.fit_ols(li, ["l_quantity"], "l_extendedprice")
    return r.select(F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"),
                    F.round("r2", 12).alias("r2"), F.col("n").cast("long").alias("n"))


@register("linear_regression_many", """
WITH t AS (SELECT CAST(l_quantity AS DOUBLE) AS a, CAST(nullif(l_discount, 0.05) AS DOUBLE) AS b, CAST(nullif(l_tax, 0.03) AS DOUBLE) AS c,
                  CAST(l_extendedprice AS DOUBLE) AS y FROM lineitem),
r AS (SELECT * FROM t WHERE a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL AND y IS NOT NULL),
m AS (SELECT count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, avg(y) AS my, var_pop(a) AS aa, var_pop(b) AS bb, var_pop(c) AS cc,
             covar_pop(a, b) AS ab, covar_pop(a, c) AS ac, covar_pop(b, c) AS bc, covar_pop(a, y) AS ay, covar_pop(b, y) AS by_, covar_pop(c, y) AS cy,
             var_pop(y) AS yy FROM r),
d AS (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det FROM m),
k AS (SELECT *, (ay * (bb * cc - bc * bc) - ab * (by_ * cc - bc * cy) + ac * (by_ * bc - bb * cy)) / det AS ka,
             (aa * (by_ * cc - bc * cy) - ay * (ab * cc - bc * ac) + ac * (ab * cy - by_ * ac)) / det AS kb,
             (aa * (bb * cy - by_ * bc) - ab * (ab * cy - by_ * ac) + ay * (ab * bc - bb * ac)) / det AS kc FROM d),
o AS (SELECT unnest(['intercept', 'quantity', 'discount', 'tax', 'r2', 'n']) AS term,
             unnest([my - ka * ma - kb * mb - kc * mc, ka, kb, kc, (ka * ay + kb * by_ + kc * cy) / yy, CAST(n AS DOUBLE)]) AS coef FROM k)
SELECT term, round(coef, 5) AS coef FROM o""")
def linear_regression_many(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    rows = li.select(F.col("l_quantity").alias("quantity"), F.expr("nullif(l_discount, 0.05)").alias("discount"),
                     F.expr("nullif(l_tax, 0.03)").alias("tax"), "l_extendedprice")
    return TR.fit_ols(rows, ["quantity", "discount", "tax"], "l_extendedprice").withColumn("coef", F.round("coef", 5))
