"""Formula-made networks of the reference's sizes (weights identical in Spark, NumPy and SQL).

Both read images of 28 x 28 pixels, made of a vector's 64 values repeated: 784-256-128-10 with ReLU, batch norm and (at
inference idle) dropout, and 6 and 12 channels of 5 x 5 kernels, each pooled by 2, then 120-60-10."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.vec import formula_sql

SIDE = 28
PIXELS = SIDE * SIDE
#: Added to the formula's values (about -0.5 to 0.5) to make variances.
VARIANCE = 0.75

# name -> (rows, dim, a0): row r of the parameter holds formula_vec(a0 + r, dim)
MLP_SPEC = {"fc1.weight": (256, PIXELS, 1), "fc1.bias": (1, 256, 257),
            "bn1.weight": (1, 256, 258), "bn1.bias": (1, 256, 259), "bn1.running_mean": (1, 256, 260), "bn1.running_var": (1, 256, 261),
            "fc2.weight": (128, 256, 262), "fc2.bias": (1, 128, 390),
            "bn2.weight": (1, 128, 391), "bn2.bias": (1, 128, 392), "bn2.running_mean": (1, 128, 393), "bn2.running_var": (1, 128, 394),
            "out.weight": (10, 128, 395), "out.bias": (1, 10, 405)}
MLP_LAYERS = [("linear", "fc1"), ("relu",), ("bn", "bn1"), ("dropout", 0.2), ("linear", "fc2"), ("relu",), ("bn", "bn2"), ("dropout", 0.2), ("linear", "out")]

CNN_SPEC = {"conv1.weight": (6, 25, 1), "conv1.bias": (1, 6, 7),
            "conv2.weight": (12, 150, 10), "conv2.bias": (1, 12, 22),
            "fc1.weight": (120, 192, 30), "fc1.bias": (1, 120, 150),
            "fc2.weight": (60, 120, 160), "fc2.bias": (1, 60, 220),
            "out.weight": (10, 60, 230), "out.bias": (1, 10, 240)}
CNN_LAYERS = [("reshape", (1, SIDE, SIDE)), ("conv", "conv1", 5), ("relu",), ("pool", 2), ("conv", "conv2", 5), ("relu",), ("pool", 2), ("flatten",),
              ("linear", "fc1"), ("relu",), ("linear", "fc2"), ("relu",), ("linear", "out")]

# the first layer of a small network on 8 x 8 images: 4 kernels of 3 x 3
CONV_SPEC = {"conv1.weight": (4, 9, 1), "conv1.bias": (1, 4, 5)}


def image(vec: str) -> Column:
    """The 784 pixels of a vector of 64 values."""
    return F.slice(F.flatten(F.array_repeat(F.col(vec).cast("array<double>"), -(-PIXELS // 64))), 1, PIXELS)


def f(a: str, dim: int) -> str:
    return formula_sql(a, dim)


IMAGE_SQL = f"""
x AS (SELECT vec_id, label, flatten(list_transform(range({-(-PIXELS // 64)}), lambda i: CAST(embedding AS DOUBLE[])))[1:{PIXELS}] AS x FROM embeddings)"""


def _dense(name: str, source: str, spec: dict, weight: str, bias: str, act: str) -> str:
    """A linear layer and its activation over <vec_id, x> as <vec_id, x>."""
    rows, dim, a0 = spec[weight]
    return f"""
{name}_w AS (SELECT r, {f(f'{a0} + r', dim)} AS w FROM range({rows}) t(r)),
{name}_b AS (SELECT {f(str(spec[bias][2]), rows)} AS b),
{name}_l AS (SELECT s.vec_id, w.r, list_dot_product(s.x, w.w) + b.b[w.r + 1] AS v FROM {source} s CROSS JOIN {name}_w w CROSS JOIN {name}_b b),
{name} AS (SELECT vec_id, list({act} ORDER BY r) AS x FROM {name}_l{f', {name}_p' if 'p.' in act else ''} GROUP BY vec_id)"""


def _norm(name: str, bn: str) -> tuple[str, str]:
    """(table of batch norm's parameters, activation: ReLU, then batch norm)."""
    dim = MLP_SPEC[f"{bn}.weight"][1]
    cols = ", ".join(f"{f(str(MLP_SPEC[f'{bn}.{k}'][2]), dim)} AS {c}" for k, c in (("weight", "g"), ("bias", "b"), ("running_mean", "m"), ("running_var", "v")))
    act = f"(greatest({name}_l.v, 0.0) - {name}_p.m[r + 1]) / sqrt({name}_p.v[r + 1] + {VARIANCE} + 1e-5) * {name}_p.g[r + 1] + {name}_p.b[r + 1]"
    return f"\n{name}_p AS (SELECT {cols})", act


def _scores(name: str, source: str, spec: dict) -> str:
    rows, dim, a0 = spec["out.weight"]
    return f"""
{name}_w AS (SELECT r, {f(f'{a0} + r', dim)} AS w FROM range({rows}) t(r)),
{name}_b AS (SELECT {f(str(spec['out.bias'][2]), rows)} AS b),
{name} AS (SELECT s.vec_id, CAST(w.r AS INTEGER) AS k, list_dot_product(s.x, w.w) + b.b[w.r + 1] AS score
        FROM {source} s CROSS JOIN {name}_w w CROSS JOIN {name}_b b)"""


_P1, _A1 = _norm("h1", "bn1")
_P2, _A2 = _norm("h2", "bn2")
MLP_SQL = ",".join([IMAGE_SQL, _P1, _dense("h1", "x", MLP_SPEC, "fc1.weight", "fc1.bias", _A1),
                    _P2, _dense("h2", "h1", MLP_SPEC, "fc2.weight", "fc2.bias", _A2), _scores("mlp", "h2", MLP_SPEC)])


def _conv(name: str, source: str, channels: int, side: int, weight: str, bias: str) -> str:
    """Convolution by 5 x 5 kernels of <vec_id, x> (x: channels, rows, columns), ReLU and 2 x 2 pooling, as <vec_id, x>."""
    out, dim, a0 = CNN_SPEC[weight]
    n = side - 4
    patch = (f"flatten(list_transform(range({channels}), lambda c: flatten(list_transform(range(5), lambda r: "
             f"s.x[(c * {side * side} + (p.y + r) * {side} + p.x + 1):(c * {side * side} + (p.y + r) * {side} + p.x + 5)]))))")
    return f"""
{name}_w AS (SELECT o, {f(f'{a0} + o', dim)} AS w FROM range({out}) t(o)),
{name}_b AS (SELECT {f(str(CNN_SPEC[bias][2]), out)} AS b),
{name}_p AS (SELECT s.vec_id, p.y, p.x, {patch} AS patch FROM {source} s CROSS JOIN (SELECT i // {n} AS y, i % {n} AS x FROM range({n * n}) t(i)) p),
{name}_m AS (SELECT p.vec_id, w.o, p.y // 2 AS y, p.x // 2 AS x, max(greatest(list_dot_product(p.patch, w.w) + b.b[w.o + 1], 0.0)) AS v
      FROM {name}_p p CROSS JOIN {name}_w w CROSS JOIN {name}_b b GROUP BY ALL),
{name} AS (SELECT vec_id, list(v ORDER BY o, y, x) AS x FROM {name}_m GROUP BY vec_id)"""


_RELU = "greatest({}_l.v, 0.0)"
CNN_SQL = ",".join([IMAGE_SQL.replace("x AS", "cx AS", 1), _conv("c1", "cx", 1, 28, "conv1.weight", "conv1.bias"), _conv("c2", "c1", 6, 12, "conv2.weight", "conv2.bias"),
                    _dense("d1", "c2", CNN_SPEC, "fc1.weight", "fc1.bias", _RELU.format("d1")), _dense("d2", "d1", CNN_SPEC, "fc2.weight", "fc2.bias", _RELU.format("d2")),
                    _scores("cnn", "d2", CNN_SPEC)])

CONV_SQL = f"""
px AS (SELECT vec_id, CAST(pos // 8 AS INTEGER) AS y, CAST(pos % 8 AS INTEGER) AS x, CAST(v AS DOUBLE) AS v
       FROM (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos, unnest(embedding) AS v FROM embeddings)),
k1 AS (SELECT o, j // 3 AS ky, j % 3 AS kx, w FROM (
         SELECT r AS o, unnest(range(9)) AS j, unnest({f('1 + r', 9)}) AS w FROM range(4) t(r))),
bb1 AS (SELECT generate_subscripts(b, 1) - 1 AS o, unnest(b) AS b FROM (SELECT {f('5', 4)} AS b)),
c1 AS (SELECT p.vec_id, k.o AS ch, p.y - k.ky AS y, p.x - k.kx AS x, sum(p.v * k.w) AS s
       FROM px p CROSS JOIN k1 k WHERE p.y - k.ky BETWEEN 0 AND 5 AND p.x - k.kx BETWEEN 0 AND 5
       GROUP BY p.vec_id, k.o, p.y - k.ky, p.x - k.kx),
r1 AS (SELECT c1.vec_id, c1.ch, c1.y, c1.x, greatest(c1.s + bb1.b, 0.0) AS v FROM c1 JOIN bb1 ON bb1.o = c1.ch),
p1 AS (SELECT vec_id, ch, y // 2 AS y, x // 2 AS x, max(v) AS v FROM r1 GROUP BY vec_id, ch, y // 2, x // 2)"""


def preds_sql(scores_cte: str) -> str:
    return (f"SELECT s.vec_id, e.label, CAST(arg_max(s.k, {{'s': s.score, 'i': -s.k}}) AS INTEGER) AS pred "
            f"FROM {scores_cte} s JOIN embeddings e USING (vec_id) GROUP BY s.vec_id, e.label")
