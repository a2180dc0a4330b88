"""Exact nearest-neighbour join of a query table with a vector table (O39, O40), both of any size.

Vectors are dealt to pivots, learned by farthest-first choice on a bounded sample of each model; a pivot's cell is
known by its row count and covering radius. For a query at distance d of a pivot with radius u every row
of the cell lies between d - u and d + u (triangle inequality), so a query first visits its nearest
cell, takes the k-th best there as its limit, and then only the cells whose near side is within it.

Cells travel in groups of neighbours of at most ``GROUP`` bytes of vectors (a larger cell is cut over several). A part is a
group's rows followed by a share of the queries that visit it: the rows are held as one matrix and the queries stream past it in
Arrow batches. A query is sent once to a group however many of its cells it visits, so what is moved grows with queries x groups and
not with queries x cells; a task never holds more than one group.

Cosine is searched in Euclidean space on unit vectors; a zero vector (cosine 0 to everything) is at distance
sqrt(2) of all others through a coordinate of its own. Distances only choose candidates: the scores returned
are computed vector by vector, so equal vectors have equal scores wherever they lie, and ties go to the lower id.

A part's distances are single precision matrix products of at most ``RUN`` rows and ``TILE`` numbers, which stay in a core's cache, with a bound of
their error; what the bound leaves open is computed again in double precision, so the rows returned do not depend on it.

Null vectors are no candidates, queries with a null vector return nothing, and a query meets its own model's vectors only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrow import to_matrix
from ..session import ensure_checkpoint_dir

#: Rows of a cell, queries scored at a time, rows pivots are learned from and most pivots (a model).
CELL, VISITORS, SAMPLE, PIVOTS = 4096, 1024, 2048, 256
#: Bytes of vectors of a group, of the queries that stream past it in a task; scores made at a time, of so many rows.
GROUP, STREAM, TILE, RUN = 128 << 20, 512 << 20, 1 << 19, 2048
#: Candidates of a query beyond which the worse are dropped; bytes of vectors scored pair by pair at a time.
KEPT, PAIRS = 64, 8 << 20


def scores(X: np.ndarray, q: np.ndarray, metric: str) -> np.ndarray:
    """Cosine (0 with a zero vector) or Euclidean distance of every row to ``q``, row by row: a matrix
    product's last bits depend on the row's place, which breaks ties."""
    if metric == "cosine":
        den = np.sqrt(np.einsum("ij,ij->i", X, X)) * np.sqrt(np.einsum("i,i->", q, q))
        return np.where(den == 0, 0.0, np.einsum("ij,j->i", X, q) / np.where(den == 0, 1.0, den))
    d = X - q
    return np.sqrt(np.einsum("ij,ij->i", d, d))


def space(X: np.ndarray, metric: str, own: int = 0) -> np.ndarray:
    """The rows where Euclidean distance orders as ``metric`` does. ``own``: which of two extra coordinates
    zero vectors of this side (0: vectors, 1: queries) get."""
    if metric != "cosine":
        return X
    n = np.sqrt(np.einsum("ij,ij->i", X, X))
    out = np.zeros((len(X), X.shape[1] + 2))
    out[:, :-2] = X / np.where(n == 0, 1.0, n)[:, None]
    out[n == 0, X.shape[1] + own] = 1.0
    return out


def _squares(A: np.ndarray, B: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared distances by a matrix product, and a bound of their rounding errors."""
    a, b = np.einsum("ij,ij->i", A, A), np.einsum("ij,ij->i", B, B)
    slack = 1e-12 * A.shape[1] * (a.max(initial=0) + b.max(initial=0)) + 1e-300
    return np.maximum(a[:, None] + b[None] - 2 * (A @ B.T), 0.0), slack


def _best(ids: np.ndarray, X: np.ndarray, near: np.ndarray, slack: float, q: np.ndarray, k: int, metric: str, exclude) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the first ``k`` of the rows, whose squared distances are ``near`` up to ``slack``, ties to the lower id."""
    if exclude is not None and len(exclude):
        near = np.where(np.isin(ids, np.asarray(exclude, dtype=np.int64)), np.inf, near)
    at = np.flatnonzero(np.isfinite(near))
    if len(at) > k:
        at = np.flatnonzero(near <= np.partition(near, k - 1)[k - 1] + 2 * slack)
    s = scores(X[at], q, metric)
    put = np.lexsort((ids[at], -s if metric == "cosine" else s))[:k]
    return ids[at][put], s[put]


def block_top(ids: np.ndarray, X: np.ndarray, Q: np.ndarray, k: int, metric: str, exclude: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, id, score) of the first ``k`` of the rows for each query, ties to the lower id."""
    who, what, score = [], [], []
    mapped = space(X, metric)
    step = int(np.clip(TILE // max(1, len(ids)), 1, 256))
    for a in range(0, len(Q), step):
        near, slack = _squares(space(Q[a:a + step], metric, 1), mapped)
        for j, row in enumerate(near):
            best, s = _best(ids, X, row, slack, Q[a + j], k, metric, exclude[a + j])
            who.append(np.full(len(best), a + j))
            what.append(best)
            score.append(s)
    cat = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return cat(who, np.int64), cat(what, np.int64), cat(score, np.float64)


def _farthest_first(Y: np.ndarray, most: int) -> np.ndarray:
    picks = [0]
    gap = _squares(Y[:1], Y)[0][0]
    while len(picks) < most and gap.max() > 0:
        picks.append(int(gap.argmax()))
        gap = np.minimum(gap, _squares(Y[picks[-1:]], Y)[0][0])
    return Y[picks]


@dataclass
class Pivots:
    """Per model: points, covering radii and row counts of its cells (at most ``PIVOTS``), and ``held``: (cells, groups), whether a group
    has rows of a cell."""
    metric: str
    points: dict[str, np.ndarray]
    radius: dict[str, np.ndarray]
    count: dict[str, np.ndarray]
    held: dict[str, np.ndarray]

    def sides(self, model: str, Q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Squared distances to the pivots, and the near and far sides of their cells; an empty cell is at infinity."""
        sq, slack = _squares(space(Q, self.metric, 1), self.points[model])
        none = self.count[model] == 0
        lo, hi = np.sqrt(np.maximum(sq - slack, 0)) - self.radius[model] - 1e-9, np.sqrt(sq + slack) + self.radius[model] + 1e-9
        return tuple(np.where(none, np.inf, x) for x in (sq, lo, hi))


def _groups(points: np.ndarray, count: np.ndarray, most: int) -> list[tuple[int, int]]:
    """(first group, number of groups) of each cell: neighbouring cells share a group of at most ``most`` rows, a larger cell has several."""
    out: list = [(0, 1)] * len(points)
    left, at, group, room = set(np.flatnonzero(count)), 0, -1, 0
    while left:
        near = _squares(points[at:at + 1], points)[0][0]
        at = min(left, key=lambda c: (near[c], c))
        left.remove(at)
        if count[at] > room:
            need = -(-int(count[at]) // most)
            out[at], group = (group + 1, need), group + need
            room = most - int(count[at]) if need == 1 else 0
        else:
            out[at], room = (group, 1), room - int(count[at])
    return out


class Cells:
    """``vectors`` <model, word_id, vec> dealt to cells: ``rows`` is the staged table, ``pivots`` the cells."""

    def __init__(self, vectors: DataFrame, metric: str):
        ensure_checkpoint_dir(vectors.sparkSession)
        plain = vectors.where("vec is not null").select("model", F.col("word_id").cast("long").alias("word_id"), F.col("vec").cast("array<double>").alias("vec"))
        sizes = {r["model"]: r["n"] for r in plain.groupBy("model").agg(F.count("*").alias("n")).collect()}
        # about 2 * SAMPLE rows a model by a hash of their ids, of these the first SAMPLE: only the sample is sorted
        share = F.lit(0.0)
        for m, n in sizes.items():
            share = F.when(F.col("model") == m, F.lit(2.0 * SAMPLE / n)).otherwise(share)
        first = Window.partitionBy("model").orderBy(F.xxhash64("word_id"), "word_id")
        few = plain.where(F.pmod(F.xxhash64("word_id"), F.lit(1 << 30)) <= share * (1 << 30))
        few = few.withColumn("i", F.row_number().over(first)).where(F.col("i") <= SAMPLE).orderBy("model", "i").select("model", "vec").toPandas()
        points = {m: _farthest_first(space(np.stack(g["vec"]), metric), int(np.clip(sizes[m] // CELL, 1, PIVOTS))) for m, g in few.groupby("model")}

        def deal(batches):
            for b in batches:
                for model, rows, X in _by_model(b, "vec"):
                    if model not in points:  # none of its ids is in the sample
                        points[model] = space(np.zeros((1, X.shape[1])), metric)
                    near, slack = _squares(space(X, metric), points[model])
                    cell = near.argmin(axis=1)
                    away = np.sqrt(near[np.arange(len(X)), cell] + slack)
                    yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(away), *(c.take(rows) for c in b.columns)],
                                                     names=["cell", "away", *b.schema.names])
        self.rows = plain.mapInArrow(deal, "cell int, away double, model string, word_id long, vec array<double>").checkpoint()
        facts = self.rows.groupBy("model", "cell").agg(F.max("away").alias("radius"), F.count("*").alias("n"), F.max(F.size("vec")).alias("d")).collect()
        width = {r["model"]: r["d"] for r in facts}
        for m in width.keys() - points.keys():
            points[m] = space(np.zeros((1, width[m])), metric)
        self.pivots = Pivots(metric, points, *({m: np.zeros(len(p), kind) for m, p in points.items()} for kind in (np.float64, np.int64)), {})
        for r in facts:
            self.pivots.radius[r["model"]][r["cell"]], self.pivots.count[r["model"]][r["cell"]] = r["radius"], r["n"]
        self.place, self.bytes = {}, {m: 8 * max(1, width.get(m, 1)) for m in points}
        weight = {m: int(self.pivots.count[m].sum()) * self.bytes[m] for m in points}
        tasks = 2 * vectors.sparkSession.sparkContext.defaultParallelism
        for m in points:
            # as many groups as shares of the queries, where bytes allow: rows x shares + queries x groups is least so
            even = max(1, round(np.sqrt(tasks * weight[m] / max(1, sum(weight.values())))))
            most = max(1, min(GROUP // self.bytes[m], -(-int(self.pivots.count[m].sum()) // even)))
            self.place[m] = _groups(points[m], self.pivots.count[m], most)
            self.pivots.held[m] = np.zeros((len(points[m]), max(a + n for a, n in self.place[m])), bool)
            for c, (a, n) in enumerate(self.place[m]):
                self.pivots.held[m][c, a:a + n] = self.pivots.count[m][c] > 0

    def parts(self, asked: dict[str, int], everywhere: bool) -> list[tuple[str, int, int]]:
        """(model, first part of its groups, shares into which a group's visitors are dealt): shares by the model's part of the work, and
        so many that a part's visitors (all ``asked`` queries if they go ``everywhere``) are of bounded bytes."""
        held, start, out = self.pivots.held, 0, []
        work = {m: asked.get(m, 0) * self.bytes[m] * (int(self.pivots.count[m].sum()) if everywhere else 1) for m in held}
        tasks = (2 if everywhere else 1) * self.rows.sparkSession.sparkContext.defaultParallelism
        shares = {}
        for m in held:
            groups = held[m].shape[1]
            stream = asked.get(m, 0) * self.bytes[m] / (1 if everywhere else groups)
            shares[m] = max(1, int(np.ceil(tasks * work[m] / max(1, sum(work.values())) / groups)), int(np.ceil(stream / STREAM)))
        # the parts with most work come first, so that no long one is left at the end
        for m in sorted(held, key=lambda m: (-work[m] / (shares[m] * held[m].shape[1]), m)):
            out.append((m, start, shares[m]))
            start += shares[m] * held[m].shape[1]
        return out

    def meet(self, visits: DataFrame, dealt: list[tuple[str, int, int]], use, schema: str) -> DataFrame:
        """``use(matrix rows, visitors)`` over each group and the batches of the queries that visit it: ``visits`` has a row for each query and
        group ("cell")."""
        spark = self.rows.sparkSession
        deal = spark.createDataFrame(dealt, "model string, start int, salts int")
        place = [(m, c, a, n) for m, cells in self.place.items() for c, (a, n) in enumerate(cells)]
        place = spark.createDataFrame(place, "model string, cell int, first int, chunks int").join(deal, "model")
        salt = F.explode(F.sequence(F.lit(0), F.col("salts") - 1))
        group = F.col("first") + F.pmod(F.xxhash64("word_id"), F.col("chunks"))
        here = self.rows.join(F.broadcast(place), ["model", "cell"]).select(
            "model", F.col("word_id").alias("id"), "vec", "cell", salt.alias("salt"), (F.col("start") + group * F.col("salts")).alias("part"), F.lit(0).alias("side"))
        here = here.withColumn("part", (F.col("part") + F.col("salt")).cast("int")).drop("salt")
        part = F.col("start") + F.col("cell") * F.col("salts") + F.pmod(F.xxhash64("qid"), F.col("salts"))
        there = visits.join(F.broadcast(deal), "model").select("*", part.cast("int").alias("part"), F.lit(1).alias("side")).drop("start", "salts", "cell")
        there = there.withColumnRenamed("qid", "id").withColumnRenamed("qvec", "vec")
        model, start, salts = dealt[-1]
        parts = start + salts * self.pivots.held[model].shape[1]
        both = here.unionByName(there, allowMissingColumns=True).repartitionById(parts, "part").sortWithinPartitions("part", "side")
        metric = self.pivots.metric

        def stream(batches):
            at, block, held = None, None, []
            for b in batches:
                part, side = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("part", "side"))
                cuts = [0, *(np.flatnonzero(np.diff(2 * part + side)) + 1), b.num_rows]
                for i, j in zip(cuts, cuts[1:]):
                    if i == j:
                        continue
                    if part[i] != at:
                        at, block, held = part[i], None, []
                    piece = b.slice(i, j - i)
                    if side[i] == 0:
                        held.append((piece.column("id").to_numpy(), piece.column("cell").to_numpy(zero_copy_only=False), to_matrix(piece.column("vec"))[0]))
                        continue
                    for a in range(0, piece.num_rows, VISITORS):
                        some = piece.slice(a, VISITORS)
                        Q = to_matrix(some.column("vec"))[0]
                        if block is None:
                            block, held = Block.of(held, Q.shape[1], metric), []
                        yield from use(block, some, Q)
        return both.mapInArrow(stream, schema)


@dataclass
class Block:
    """A group's rows, a cell after the other: ids, vectors, the runs (begin, end) of at most ``RUN`` of them with the numbers of their cells, and
    ``low``: -2 x and x . x of the rows x in the searched space, less ``centre`` and times ``scale``."""
    ids: np.ndarray
    X: np.ndarray
    runs: list[tuple[int, int, np.ndarray]]
    low: np.ndarray
    centre: np.ndarray
    scale: float
    most: float
    metric: str

    @classmethod
    def of(cls, held: list, dim: int, metric: str) -> Block:
        cell = np.concatenate([p[1] for p in held]) if held else np.zeros(0, np.int64)
        put, at = np.empty(len(cell), np.int64), 0
        put[np.argsort(cell, kind="stable")] = np.arange(len(cell))
        ids, X = np.empty(len(cell), np.int64), np.empty((len(cell), held[0][2].shape[1] if held else dim))
        while held:  # a piece is let go once it is copied
            some, _, x = held.pop()
            to = put[len(put) - at - len(some):len(put) - at]
            ids[to], X[to], at = some, x, at + len(some)
        cell = np.sort(cell)
        runs, begin = [], 0
        while begin < len(cell):
            end = min(begin + RUN, len(cell))
            if end < len(cell) and cell[end - 1] == cell[end] and cell[begin] != cell[end]:
                end = int(np.searchsorted(cell, cell[end]))  # a cell is cut only if it is larger than a run
            runs.append((begin, end, np.unique(cell[begin:end])))
            begin = end
        return cls(ids, X, runs, *_lowered(X, metric, np.float32), metric)

    def tiles(self, Q: np.ndarray, wanted: np.ndarray):
        """(own, bound, scale, tiles): a query's squared distance to a row, times the square of ``scale``, lies within its ``bound`` of ``near`` + its ``own``.
        ``tiles`` are (queries, begin, end, near), some of the queries that want a run and its rows; ``wanted``: (queries, runs)."""
        low, centre, scale, most = self.low, self.centre, self.scale, self.most
        Y, own = _aside(Q, self.metric, centre, scale)
        if not own.max(initial=0) + most < 1e30:  # no single precision number, or no number at all
            low, centre, scale, most = _lowered(self.X, self.metric, np.float64)
            Y, own = _aside(Q, self.metric, centre, scale)
        unit = 2 * scale * scale if self.metric == "cosine" else 0.0  # unit vectors are rounded before the centre is taken off
        bound = 1.1 * (low.shape[1] + 8) * np.finfo(low.dtype).eps * (own + most) + 1e-12 * low.shape[1] * (own + most + unit) + 1e-30
        Y = np.concatenate([Y, np.ones((len(Y), 1))], axis=1).astype(low.dtype)

        def run():
            made = np.empty(max(TILE, RUN), low.dtype)
            for n, (a, z, _) in enumerate(self.runs):
                who = np.flatnonzero(wanted[:, n])
                step = max(1, TILE // (z - a))
                for i in range(0, len(who), step):
                    some = who[i:i + step]
                    yield some, a, z, np.matmul(Y[some], low[a:z].T, out=made[:len(some) * (z - a)].reshape(len(some), z - a))
        return own, bound, scale, run()


def _lowered(X: np.ndarray, metric: str, kind) -> tuple[np.ndarray, np.ndarray, float, float]:
    """``low``, ``centre``, ``scale`` and the largest x . x of a block."""
    dim = X.shape[1] + 2 * (metric == "cosine")
    centre, scale, most = np.zeros(dim), 1.0, 0.0
    pieces = [(a, min(a + RUN, len(X))) for a in range(0, len(X), RUN)]
    if kind == np.float32:
        with np.errstate(all="ignore"):
            for a, z in pieces:
                centre += space(X[a:z], metric).sum(axis=0) / len(X)
            top = max((np.abs(space(X[a:z], metric) - centre).max(initial=0) for a, z in pieces), default=0.0)
        if not (np.isfinite(top) and np.isfinite(centre).all()):
            return np.zeros((len(X), dim + 1), kind), np.zeros(dim), 1.0, np.inf
        scale = float(np.exp2(-np.ceil(np.log2(top)))) if 1e-300 < top < 1e300 else 1.0
    low = np.empty((len(X), dim + 1), kind)
    with np.errstate(over="ignore", invalid="ignore"):
        for a, z in pieces:
            x = (space(X[a:z], metric) - centre) * scale
            sq = np.einsum("ij,ij->i", x, x)
            low[a:z, :-1], low[a:z, -1], most = -2 * x, sq, max(most, sq.max(initial=0))
    return low, centre, scale, float(most)


def _aside(Q: np.ndarray, metric: str, centre: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore", invalid="ignore"):
        Y = (space(Q, metric, 1) - centre) * scale
        return Y, np.einsum("ij,ij->i", Y, Y)


def _threshold(x: np.ndarray, kind, up: bool) -> np.ndarray:
    """A column of numbers of the given precision that are not below (``up``) or not above ``x``."""
    with np.errstate(over="ignore"):
        return np.nextafter(x.astype(kind), kind.type(np.inf if up else -np.inf))[:, None]


def _hits(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the few cells that are true: eight are looked at together."""
    flat = mask.reshape(-1)
    if flat.size % 8:
        at = np.flatnonzero(flat)
    else:
        words = np.flatnonzero(flat.view(np.uint64))
        at = np.flatnonzero(flat.reshape(-1, 8)[words])
        at = words[at >> 3] * 8 + (at & 7)
    return np.divmod(at, mask.shape[1])


def _pair_scores(X: np.ndarray, at: np.ndarray, Q: np.ndarray, q: np.ndarray, metric: str) -> np.ndarray:
    """``scores`` of row ``at[i]`` and query ``q[i]``, for some pairs at a time."""
    out, step = np.empty(len(at)), max(1, PAIRS // (8 * max(1, X.shape[1])))
    for i in range(0, len(at), step):
        x, y = X[at[i:i + step]], Q[q[i:i + step]]
        if metric == "cosine":
            den = np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y))
            out[i:i + step] = np.where(den == 0, 0.0, np.einsum("ij,ij->i", x, y) / np.where(den == 0, 1.0, den))
        else:
            x -= y
            out[i:i + step] = np.sqrt(np.einsum("ij,ij->i", x, x))
    return out


def _first(q: np.ndarray, ids: np.ndarray, score: np.ndarray, least: np.ndarray, metric: str) -> np.ndarray:
    """Places of the first ``least`` of each query, in order; ties to the lower id."""
    put = np.lexsort((ids, -score if metric == "cosine" else score, q))
    q = q[put]
    return put[np.arange(len(q)) - np.searchsorted(q, q) < least[q]]


class Best:
    """Candidates of some queries: those that may be among the first ``need`` of the rows seen, by distances with a bound of error."""

    def __init__(self, block: Block, Q: np.ndarray, need: np.ndarray, bound: np.ndarray, within: np.ndarray):
        self.block, self.Q, self.need, self.bound, self.within = block, Q, need, bound, within
        self.held: list = []
        self.n, self.cap = 0, KEPT * len(Q)

    def add(self, q: np.ndarray, at: np.ndarray, near: np.ndarray) -> None:
        if len(q):
            self.held.append((q, at, near))
            self.n += len(q)
        if self.n > self.cap:
            q, at, near = self.shrink()
            self.held, self.n, self.cap = [(q, at, near)], len(q), 2 * len(q) + KEPT * len(self.Q)

    def shrink(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.held:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        q, at, near = (np.concatenate(c) for c in zip(*self.held))
        put = np.lexsort((near, q))
        q, at, near = q[put], at[put], near[put]
        count = np.bincount(q, minlength=len(self.Q))
        last = np.cumsum(count) - count + self.need - 1
        full = count >= self.need
        kth = np.full(len(self.Q), np.inf)
        kth[full] = near[last[full]]
        self.within = np.minimum(self.within, kth + self.bound)
        keep = near <= (kth + 2 * self.bound)[q]
        q, at, near = q[keep], at[keep], near[keep]
        if len(q) > KEPT * len(self.Q) + 2 * int(self.need.sum()):  # many as near as another: told apart by their scores
            metric = self.block.metric
            keep = np.sort(_first(q, self.block.ids[at], _pair_scores(self.block.X, at, self.Q, q, metric), self.need, metric))
            q, at, near = q[keep], at[keep], near[keep]
        return q, at, near


def _by_model(b: pa.RecordBatch, vec: str):
    """(model, rows, matrix) of each model in a batch."""
    models = b.column("model").to_numpy(zero_copy_only=False)
    for m in dict.fromkeys(models):
        rows = np.flatnonzero(models == m)
        yield m, pa.array(rows), to_matrix(b.column(vec).take(pa.array(rows)))[0]


def _visits(pivots: Pivots, k: int, groups: bool = False):
    """Each query with the cells that may hold one of its first ``k``: ``turn`` 0 for the nearest, ``near`` the cell's near side.
    With ``groups`` the groups that have such cells, "cell" being the group's number; the query's ``limit``, if known, counts too."""
    def run(batches):
        for b in batches:
            for model, rows, Q in _by_model(b, "qvec"):
                if model not in pivots.points:
                    continue
                sq, lo, hi = pivots.sides(model, Q)
                nearest, count = sq.argmin(axis=1), pivots.count[model]
                want = np.array([k + len(x or ()) for x in b.column("exclude").take(rows).to_pylist()])
                order = np.argsort(hi, axis=1)
                filled = np.cumsum(count[order], axis=1) >= want[:, None]
                limit = np.where(filled.any(axis=1), np.take_along_axis(hi, order, axis=1)[np.arange(len(Q)), filled.argmax(axis=1)], np.inf)
                if "limit" in b.schema.names:
                    limit = np.fmin(limit, b.column("limit").take(rows).fill_null(np.inf).to_numpy(zero_copy_only=False))
                home = np.arange(sq.shape[1])[None] == nearest[:, None]
                going = (lo <= limit[:, None]) & np.isfinite(lo) | home
                near = lo
                if groups:
                    home, going = home @ pivots.held[model], going @ pivots.held[model]
                    near = np.zeros(going.shape)
                i, j = np.nonzero(going)
                for a in range(0, len(i), 4096):
                    at, cell = i[a:a + 4096], j[a:a + 4096]
                    cols = [c.take(rows.take(pa.array(at))) for c in b.columns]
                    yield pa.RecordBatch.from_arrays([*cols, pa.array(cell.astype(np.int32)), pa.array(np.maximum(near[at, cell], 0.0)), pa.array((~home[at, cell]).astype(np.int32))],
                                                     names=[*b.schema.names, "cell", "near", "turn"])
    return run


def _home(pivots: Pivots):
    """Each query with the first group of its nearest cell, as "cell"."""
    def run(batches):
        for b in batches:
            for model, rows, Q in _by_model(b, "qvec"):
                if model in pivots.points:
                    group = pivots.held[model].argmax(axis=1)[pivots.sides(model, Q)[0].argmin(axis=1)]
                    yield pa.RecordBatch.from_arrays([*(c.take(rows) for c in b.columns), pa.array(group.astype(np.int32))], names=[*b.schema.names, "cell"])
    return run


def _excluded(t: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(number of excluded ids of each query, the ids one after the other); null ids exclude nothing."""
    lists = [[x for x in ids or () if x is not None] for ids in t.column("exclude").to_pylist()]
    return np.array([len(x) for x in lists], dtype=np.int64), np.array([x for ids in lists for x in ids], dtype=np.int64)


def _limits(pivots: Pivots, k: int):
    """The visitors again with ``limit``: a distance in the searched space within which some rows here of the run of their nearest cell, and so the
    whole table, have ``k``; null if there are fewer. It decides what is looked at, not what is returned."""
    def use(block: Block, t: pa.RecordBatch, Q: np.ndarray):
        model = t.column("model")[0].as_py()
        cell, need = pivots.sides(model, Q)[0].argmin(axis=1), k + _excluded(t)[0]
        wanted = np.zeros((len(Q), len(block.runs)), bool)
        for n, (_, _, cells) in enumerate(block.runs):
            wanted[:, n] = np.isin(cell, cells)
        wanted &= np.cumsum(wanted, axis=1) <= 2  # two runs tell enough
        own, bound, scale, tiles = block.tiles(Q, wanted)
        least = np.full(len(Q), np.inf)
        for some, a, z, near in tiles:
            for n in np.unique(need[some]):
                if n <= z - a:
                    who = np.flatnonzero(need[some] == n)
                    kth = np.partition(near[who], n - 1, axis=1)[:, n - 1].astype(np.float64)
                    least[some[who]] = np.fmin(least[some[who]], kth)
        limit = np.sqrt(np.maximum(least + own + bound, 0)) / scale * (1 + 1e-9) + 1e-6
        yield pa.RecordBatch.from_arrays([t.column("id"), t.column("model"), t.column("vec"), t.column("exclude"), pa.array(limit, mask=~np.isfinite(limit))],
                                         names=["qid", "model", "qvec", "exclude", "limit"])
    return use


def _top(pivots: Pivots, k: int):
    """The first ``k`` of a group's rows within each visitor's limit."""
    def use(block: Block, t: pa.RecordBatch, Q: np.ndarray):
        model, metric = t.column("model")[0].as_py(), pivots.metric
        limit = t.column("limit").fill_null(np.inf).to_numpy(zero_copy_only=False)
        many, ids = _excluded(t)
        near_side = pivots.sides(model, Q)[1] <= limit[:, None]
        own, bound, scale, tiles = block.tiles(Q, np.array([near_side[:, cells].any(axis=1) for _, _, cells in block.runs], dtype=bool).reshape(len(block.runs), len(Q)).T)
        best = Best(block, Q, k + many, bound, (limit * scale) ** 2)
        for some, a, z, near in tiles:
            i, j = _hits(near <= _threshold((best.within + bound - own)[some], near.dtype, True))
            best.add(some[i], a + j, near[i, j].astype(np.float64) + own[some[i]])
        q, at, _ = best.shrink()
        if len(ids) and len(q):
            known, code = np.unique(np.concatenate([block.ids[at], ids]), return_inverse=True)
            stay = ~np.isin(q * len(known) + code[:len(q)], np.repeat(np.arange(len(Q)), many) * len(known) + code[len(q):])
            q, at = q[stay], at[stay]
        if len(q):
            score = _pair_scores(block.X, at, Q, q, metric)
            put = _first(q, block.ids[at], score, np.full(len(Q), k), metric)
            who = pa.array(q[put])
            yield pa.RecordBatch.from_arrays([t.column("id").take(who), t.column("model").take(who), pa.array(block.ids[at[put]]), pa.array(score[put])],
                                             names=["qid", "model", "word_id", "score"])
    return use


def _plain(queries: DataFrame, exclude_col: str | None) -> DataFrame:
    excl = F.col(exclude_col).cast("array<long>") if exclude_col else F.lit(None).cast("array<long>")
    return queries.where("qvec is not null").select(F.col("qid").cast("long").alias("qid"), "model", F.col("qvec").cast("array<double>").alias("qvec"), excl.alias("exclude"))


def _asked(queries: DataFrame) -> dict[str, int]:
    return {r["model"]: r["n"] for r in queries.groupBy("model").agg(F.count("*").alias("n")).collect()}


def knn_join(vectors: DataFrame, queries: DataFrame, k: int, metric: str = "euclidean", exclude_col: str | None = None) -> DataFrame:
    """``<qid, model, word_id, score, rank>``: the first ``k`` vectors of each query's model by ``metric`` (``euclidean``: least
    distance, ``cosine``: largest), without the ids in its array ``exclude_col``. vectors: ``<model, word_id, vec>``;
    queries: ``<qid, model, qvec>``, (qid, model) unique."""
    cells = Cells(vectors, metric)
    pivots = cells.pivots
    plain = _plain(queries, exclude_col)
    fields = "qid long, model string, qvec array<double>, exclude array<long>"
    if not pivots.points:
        return plain.where("false").select("qid", "model", F.lit(0).cast("long").alias("word_id"), F.lit(0.0).alias("score"), F.lit(0).alias("rank"))
    asked = _asked(plain)
    limited = cells.meet(plain.mapInArrow(_home(pivots), f"{fields}, cell int"), cells.parts(asked, False), _limits(pivots, k), f"{fields}, limit double")
    visits = limited.mapInArrow(_visits(pivots, k, True), f"{fields}, limit double, cell int, near double, turn int").drop("near", "turn")
    found = cells.meet(visits, cells.parts(asked, True), _top(pivots, k), "qid long, model string, word_id long, score double")
    order = F.col("score").desc() if metric == "cosine" else F.col("score")
    ranked = Window.partitionBy("qid", "model").orderBy(order, "word_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def _count_closer(pivots: Pivots):
    """The visitors' keys with the rows of the group that are closer than the target, and those of the groups that need no visit."""
    def use(block: Block, t: pa.RecordBatch, Q: np.ndarray):
        model, n = t.column("model")[0].as_py(), t.column("sure").to_numpy().copy()
        dist, target = t.column("dist").to_numpy(), t.column("target").to_numpy()
        _, lo, hi = pivots.sides(model, Q)
        shape = (len(block.runs), len(Q))
        within = np.array([(hi[:, cells] < dist[:, None]).all(axis=1) for _, _, cells in block.runs], dtype=bool).reshape(shape).T
        reach = np.array([(lo[:, cells] <= dist[:, None]).any(axis=1) for _, _, cells in block.runs], dtype=bool).reshape(shape).T
        n += (within * np.array([e - b for b, e, _ in block.runs], dtype=np.int64)[None]).sum(axis=1)
        own, bound, scale, tiles = block.tiles(Q, reach & ~within)
        cut = (dist * scale) ** 2
        for some, a, z, near in tiles:
            at = (cut - own)[some]
            closer = near < _threshold(at - bound[some], near.dtype, False)
            open_ = near <= _threshold(at + bound[some], near.dtype, True)
            n[some] += np.add.reduce(closer.view(np.uint8), axis=1, dtype=np.uint32)
            i, j = _hits(np.logical_xor(closer, open_, out=open_))  # too close to tell
            if len(i):
                q, row = some[i], a + j
                d, ids = _pair_scores(block.X, row, Q, q, "euclidean"), block.ids[row]
                n += np.bincount(q[((d < dist[q]) | ((d == dist[q]) & (ids < target[q]))) & (ids != target[q])], minlength=len(n))
        yield pa.RecordBatch.from_arrays([t.column("id"), t.column("model"), t.column("target"), t.column("dist"), pa.array(n)], names=["qid", "model", "target", "dist", "n"])
    return use


def rank_join(vectors: DataFrame, queries: DataFrame, target_col: str = "target") -> DataFrame:
    """``<qid, model, target, dist, rank>``: rank of each query's target by Euclidean distance, 1 + the vectors that are closer (or
    as close with a lower id). Groups wholly closer count by their size, groups wholly farther not at all;
    only those that the target's distance cuts are visited. Queries whose target has no vector return nothing."""
    cells = Cells(vectors, "euclidean")
    pivots = cells.pivots
    q = queries.where("qvec is not null").select(F.col("qid").cast("long").alias("qid"), "model", F.col("qvec").cast("array<double>").alias("qvec"),
                                                 F.col(target_col).cast("long").alias("target"))
    if not pivots.points:
        return q.where("false").select("qid", "model", F.col("target").alias(target_col), F.lit(0.0).alias("dist"), F.lit(1).cast("long").alias("rank"))
    own = cells.rows.select("model", F.col("word_id").alias("target"), F.col("vec").alias("tvec"))

    def distance(batches):
        for b in batches:
            for _, rows, Q in _by_model(b, "qvec"):
                keep = b.select(["qid", "model", "qvec", "target"]).take(rows)
                every = np.arange(len(Q))
                d = _pair_scores(to_matrix(b.column("tvec").take(rows))[0], every, Q, every, "euclidean")
                yield pa.RecordBatch.from_arrays([*keep.columns, pa.array(d, pa.float64())], names=[*keep.schema.names, "dist"])

    def route(batches):
        for b in batches:
            for model, rows, Q in _by_model(b, "qvec"):
                _, lo, hi = pivots.sides(model, Q)
                t, count, held = b.column("dist").take(rows).to_numpy()[:, None], pivots.count[model], pivots.held[model]
                there = count[None] > 0
                sure = ~(((hi >= t) & there) @ held)  # groups of which no cell reaches to the target's distance
                cut = (((lo <= t) & there) @ held) & ~sure
                total = sure[:, held.argmax(axis=1)] @ count  # the groups of a cell cut over several have no other cell
                i, j = np.nonzero(cut)
                lead = np.r_[True, i[1:] != i[:-1]] if len(i) else np.zeros(0, bool)  # the target's own group is always cut
                for a in range(0, len(i), 4096):
                    at = i[a:a + 4096]
                    cols = [c.take(rows.take(pa.array(at))) for c in b.columns]
                    yield pa.RecordBatch.from_arrays([*cols, pa.array(j[a:a + 4096].astype(np.int32)), pa.array(np.where(lead[a:a + 4096], total[at], 0).astype(np.int64))],
                                                     names=[*b.schema.names, "cell", "sure"])

    fields = "qid long, model string, qvec array<double>, target long, dist double"
    known = q.join(own, ["model", "target"]).select("qid", "model", "qvec", "target", "tvec").mapInArrow(distance, fields)
    visits = known.mapInArrow(route, f"{fields}, cell int, sure long")
    counts = cells.meet(visits, cells.parts(_asked(q), True), _count_closer(pivots), "qid long, model string, target long, dist double, n long")
    return counts.groupBy("qid", "model", "target", "dist").agg(F.sum("n").alias("n")).select("qid", "model", F.col("target").alias(target_col), "dist", (F.col("n") + 1).alias("rank"))
