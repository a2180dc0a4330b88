"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

A rotation is learned on a bounded sample (centred, principal axes, then alternating sign codes and
orthogonal Procrustes), so that the signs of the rotated coordinates lose little. The code itself is
cut from the vectors as they are, not centred: the angle that sizes the tables is then the pair's
own, wherever the mean of the corpus lies. A common mean makes buckets fuller. Codes of several learned rotations are cut into substrings, one hash table each: a pair
whose codes differ in fewer bits than there are tables agrees in one of them for certain, any
other pair with the probability the number of tables is chosen by (``misses``). Every vector is
in every table. Rows that share a bucket are reranked with their original vectors in double
precision; a pair counts in the first table that has it, so nothing is counted twice.

Equal vectors are one class. A bucket of more than ``TILE`` classes is dealt as tiles, pairs of its
chunks, to many tasks. Tasks return link counts and a spanning star of each linked group, never
the pairs.

Defined results: a vector that is null, empty, zero, or has a null or non-finite component (or another
length than most) links with nothing and is its own component. Rows with equal id and equal
vector are separate vectors that link. Vectors without id come last as component names. Extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions
from .components import components
from .shared import LAST

#: Classes of a bucket compared in one piece.
TILE = 1024


def learn(x: np.ndarray, seed: int, rounds: int = 50) -> np.ndarray:
    """Projection (dim, bits) whose signs are the code: principal axes, then a learned rotation."""
    bits = x.shape[1]
    _, _, axes = np.linalg.svd(x, full_matrices=False) if len(x) >= bits else (None, None, np.eye(bits))
    v = x @ axes.T
    turn = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))[0]
    for _ in range(rounds):
        code = np.where(v @ turn >= 0, 1.0, -1.0)
        a, _, b = np.linalg.svd(code.T @ v)
        turn = (a @ b).T
    return axes.T @ turn


@dataclass(frozen=True)
class Tables:
    """``bits`` of each of ``count`` tables; ``planes``, through the origin, make the code."""
    planes: np.ndarray
    bits: int
    count: int

    def keys(self, x: np.ndarray) -> np.ndarray:
        """(rows, tables) substrings of the codes of unit vectors."""
        code = (x @ self.planes >= 0)[:, :self.bits * self.count]
        return code.reshape(len(x), self.count, self.bits) @ (1 << np.arange(self.bits, dtype=np.int64))


def layout(n: int, cosine: float, misses: float) -> tuple[int, int]:
    """(bits of a table, number of tables): about 32 vectors of ``n`` fall in a bucket if spread
    evenly, and a pair at the threshold shares none with probability ``misses``."""
    bits = int(np.clip(np.ceil(np.log2(max(n, 1) / 32 + 1)), 6, 24))
    agree = (1 - np.arccos(cosine) / np.pi) ** bits
    return bits, int(np.ceil(np.log(misses) / np.log1p(-agree)))


def fit(sample: np.ndarray, n: int, cosine: float = 0.95, misses: float = 0.005, seed: int = 7) -> Tables:
    """Tables for ``n`` vectors, learned from unit vectors ``sample``."""
    bits, count = layout(n, cosine, misses)
    mean = sample.mean(axis=0)
    turns = -(-bits * count // sample.shape[1])
    return Tables(np.concatenate([learn(sample - mean, seed + i) for i in range(turns)], axis=1), bits, count)


def _parse(col: pa.Array, dim: int) -> list[np.ndarray | None]:
    out = []
    for v in col.to_pylist():
        ok = v is not None and len(v) == dim and dim and None not in v
        x = np.array(v, dtype=np.float64) if ok else None
        out.append(x if ok and np.isfinite(x).all() and x.any() else None)
    return out


def _prepare(dim):
    def run(batches):
        for b in batches:
            xs = _parse(b.column(1), dim)
            data = [None if x is None else (x + 0.0).tobytes() for x in xs]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([d and hashlib.blake2b(d, digest_size=16).digest() for d in data], pa.binary()),
                                              pa.array(data, pa.binary())], names=["id", "node", "vec"])
    return run


def _unit(data: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(data), np.float64).reshape(len(data), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow of the squares
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _entries(tables: Tables):
    """A class in every table: (bucket, node, copies, vector, keys)."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                keys = tables.keys(_unit(b.column(2).to_pylist())).astype(np.int32)
                rep = np.repeat(np.arange(b.num_rows), tables.count)
                bucket = (keys.astype(np.int64) + (np.arange(tables.count, dtype=np.int64) << 32)).ravel()
                own = pa.array([k.tobytes() for k in keys], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(bucket), b.column(0).take(rep), b.column(1).take(rep), b.column(2).take(rep),
                                                  own.take(rep)], names=["bucket", "node", "copies", "vec", "keys"])
    return run


def _links(cosine: float):
    """All buckets (or tiles of buckets) that fell into one group of rows."""
    def run(key, t):
        t = t.sort_by([("bucket", "ascending"), ("tile", "ascending"), ("chunk", "ascending"), ("node", "ascending")])
        node, root, count = [], [], []
        if t.num_rows:
            bucket, tile, chunk = (t.column(c).to_numpy() for c in ("bucket", "tile", "chunk"))
            names, copies = t.column("node").to_pylist(), t.column("copies").to_numpy()
            cut = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (tile[1:] != tile[:-1]), True])
            for a, z in zip(cut[:-1], cut[1:]):
                if z - a < 2:
                    continue
                x = _unit(t.column("vec").slice(a, z - a).to_pylist())
                keys = np.frombuffer(b"".join(t.column("keys").slice(a, z - a).to_pylist()), np.int32).reshape(z - a, -1)
                near = x @ x.T >= cosine
                np.fill_diagonal(near, False)
                for k in range(int(bucket[a] >> 32)):  # counted in an earlier table
                    near &= keys[:, k][:, None] != keys[:, k][None]
                c = chunk[a:z]
                if c[0] != c[-1]:  # a tile of two chunks: pairs inside a chunk are another tile's
                    near &= c[:, None] != c[None]
                has = np.flatnonzero(near.any(axis=1))
                if not len(has):
                    continue
                near = near[np.ix_(has, has)]
                label = np.arange(len(has))
                while True:
                    low = np.minimum(label, np.where(near, label[None], len(has)).min(axis=1))
                    low = low[low]
                    if (low == label).all():
                        break
                    label = low
                node += [names[a + i] for i in has]
                root += [names[a + has[i]] for i in label]
                count += (near @ copies[a:z][has]).tolist()
        return pa.Table.from_arrays([pa.array(node, pa.binary()), pa.array(root, pa.binary()), pa.array(count, pa.int64())],
                                    names=["node", "root", "links"])
    return run


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = 0.95,
                    misses: float = 0.005, sample: int = 20_000) -> DataFrame:
    """One row per vector: id, n_links (other vectors at cosine ``cosine`` or more), component_id (smallest
    id reachable) and kept (id = component_id). The tables are learned from the ``sample`` classes
    with the smallest hash, a bound at every input size; every class is indexed."""
    spark = df.sparkSession
    raw = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(int(LAST))).alias("id"), F.col(vec_col).alias("v"))
    sizes = raw.where("size(v) > 0").groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dim = sizes["d"] if sizes else 0
    rows = raw.mapInArrow(_prepare(dim), "id long, node binary, vec binary")
    classes = rows.where("node is not null").groupBy("node").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("vec").alias("vec"))
    classes = classes.checkpoint()
    n = classes.count()
    ids = classes.select("node", "id", "copies")
    if n > 1:
        few = classes.select("node", "vec").orderBy("node").limit(sample).collect()  # node is a hash
        tables = fit(_unit([bytes(r["vec"]) for r in few]), n, cosine, misses)
        bins = 4 * shuffle_partitions(spark)
        entries = classes.select("node", "copies", "vec").mapInArrow(_entries(tables), "bucket long, node binary, copies long, vec binary, keys binary")
        big = entries.groupBy("bucket").agg(F.count("*").alias("k")).where(F.col("k") > TILE)
        parts = F.coalesce(F.ceil(F.col("k") / TILE), F.lit(1)).cast("int")
        at = entries.join(big, "bucket", "left").withColumn("parts", parts)
        at = at.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        # chunk c is in the tiles of all pairs of chunks that have it
        pair = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.least("chunk", o) * F.col("parts") + F.greatest("chunk", o))
        at = at.withColumn("tile", F.explode(pair))
        spread = at.withColumn("bin", F.pmod(F.xxhash64("bucket", "tile"), F.lit(bins)).cast("int"))
        found = spread.select("bin", "bucket", "tile", "chunk", "node", "copies", "vec", "keys").groupBy("bin").applyInArrow(
            _links(cosine), "node binary, root binary, links long").checkpoint()
        root = components(found, "node", "root")
        counts = found.groupBy("node").agg(F.sum("links").alias("links"))
        ids = ids.join(root, "node", "left").join(counts, "node", "left").withColumn("root", F.coalesce("root", "node"))
        least = ids.groupBy("root").agg(F.min("id").alias("component"))
        ids = ids.join(least, "root").select("node", "component", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    else:
        ids = ids.select("node", F.col("id").alias("component"), (F.col("copies") - 1).alias("links"))
    out = rows.select("id", "node").join(ids, "node", "left").withColumn("component", F.coalesce("component", "id"))
    back = lambda c: F.when(F.col(c) != int(LAST), F.col(c))
    return out.select(back("id").alias(id_col), F.coalesce("links", F.lit(0)).alias("n_links"), back("component").alias("component_id"),
                      (F.col("id") == F.col("component")).alias("kept"))
