"""Convolution and pooling of images that may be larger than a row.

An image is a table of row segments ``<id, ch, y, x0, vec>``: ``vec`` holds the pixels of image ``id``, channel ``ch``, row ``y``
from column ``x0`` on. Segments are cut and gathered into tiles of ``tile`` x ``tile`` pixels, each with a border (halo)
of its right and lower neighbours' pixels, in one exchange; every tile is then convolved and pooled on
its own and gives row segments again, so layers follow one another with one exchange each. A group holds
one tile with its halo, whatever the image's size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import nn

SEGMENT = "id long, ch int, y int, x0 int, vec array<double>"


def gather_tiles(segments: DataFrame, tile: int, halo: int = 0) -> DataFrame:
    """``<id, ty, tx, pieces>``: the segments of each tile and its halo, cut to it. One exchange."""
    n = F.size("vec")
    rows = segments.where(n > 0).withColumn("ty", F.explode(F.sequence(F.greatest(F.expr(f"floor((y - {halo}) / {tile})"), F.lit(0)).cast("int"), F.expr(f"cast(y div {tile} as int)"))))
    first = F.greatest(F.expr(f"floor((x0 - {halo}) / {tile})"), F.lit(0)).cast("int")
    rows = rows.withColumn("tx", F.explode(F.sequence(first, F.expr(f"cast((x0 + size(vec) - 1) div {tile} as int)"))))
    start, end = F.greatest("x0", F.col("tx") * tile), F.least(F.col("x0") + n, (F.col("tx") + 1) * tile + halo)
    rows = rows.select("id", "ty", "tx", F.struct("ch", "y", start.alias("x0"), F.slice("vec", start - F.col("x0") + 1, end - start).alias("vec")).alias("piece"))
    return rows.groupBy("id", "ty", "tx").agg(F.collect_list("piece").alias("pieces"))


def _assemble(pieces: list, y0: int, x0: int) -> np.ndarray:
    """(channels, height, width) of a tile; a gap fails the task."""
    c = 1 + max(p["ch"] for p in pieces)
    h, w = 1 + max(p["y"] for p in pieces) - y0, max(p["x0"] + len(p["vec"]) for p in pieces) - x0
    out = np.full((c, h, w), np.nan)
    seen = np.zeros((c, h, w), bool)
    for p in pieces:
        at = p["ch"], p["y"] - y0, slice(p["x0"] - x0, p["x0"] - x0 + len(p["vec"]))
        out[at], seen[at] = p["vec"], True
    if not seen.all():
        raise ValueError(f"the image has no pixels for part of the tile at ({y0}, {x0})")
    return out


def _each_tile(tiles: DataFrame, tile: int, layer, shrink: int = 1) -> DataFrame:
    """``layer``: (channels, h, w) -> (channels, h, w) over every tile, as row segments."""
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                image, ty, tx, pieces = (b.column(c)[i].as_py() for c in ("id", "ty", "tx", "pieces"))
                out = layer(_assemble(pieces, ty * tile, tx * tile))
                c, h, w = out.shape
                if not out.size:
                    continue
                ch, y = (a.ravel().astype(np.int32) for a in np.indices((c, h)))
                y0, x0 = ty * tile // shrink, tx * tile // shrink
                vec = pa.ListArray.from_arrays(pa.array(np.arange(c * h + 1, dtype=np.int32) * w), pa.array(out.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array([image] * (c * h), pa.int64()), pa.array(ch), pa.array(y + np.int32(y0)),
                                                  pa.array([x0] * (c * h), pa.int32()), vec], names=["id", "ch", "y", "x0", "vec"])
    return tiles.mapInArrow(run, SEGMENT)


def conv2d_tiles(segments: DataFrame, weight: np.ndarray, bias: np.ndarray, tile: int = 256, relu: bool = False, pool: int = 1) -> DataFrame:
    """Valid convolution, stride 1, of images of any size; ``weight`` (out, in, k, k), ``bias`` (out). With ``relu`` and ``pool`` the
    tile is rectified and max-pooled on the spot (``tile`` must be a multiple of ``pool``). One exchange."""
    if tile % pool:
        raise ValueError("the tile must be a multiple of the pooling size")
    k = weight.shape[2]

    def layer(x):
        if min(x.shape[1:]) < k:
            return np.zeros((len(weight), 0, 0))
        out = nn.conv2d(x[None], weight, bias)[:, :, :tile, :tile]
        out = np.maximum(out, 0.0) if relu else out
        return nn.max_pool(out, pool)[0]
    return _each_tile(gather_tiles(segments, tile, k - 1), tile, layer, pool)


def max_pool_tiles(segments: DataFrame, k: int = 2, tile: int = 256) -> DataFrame:
    """K x k max pooling, stride k, odd edges dropped, of images of any size. One exchange."""
    if tile % k:
        raise ValueError("the tile must be a multiple of the pooling size")
    return _each_tile(gather_tiles(segments, tile), tile, lambda x: nn.max_pool(x[None], k)[0], k)


def pixels(segments: DataFrame) -> DataFrame:
    """``<id, ch, y, x, v>``, a row a pixel."""
    return segments.select("id", "ch", "y", F.posexplode("vec").alias("p", "v"), "x0").select("id", "ch", "y", (F.col("x0") + F.col("p")).alias("x"), "v")
