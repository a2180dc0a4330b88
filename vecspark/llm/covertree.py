"""Hard negatives by exact inner-product search in cover trees.

Components become the integers floor(scale * x). Every row is augmented by one coordinate that lifts it to
the largest norm of the table, so all rows lie on one sphere and a covering radius r around a centre c
bounds the inner product with an anchor a: a.c - |a| r <= a.x <= a.c + |a| r. The top levels of the tree are
pivots, learned by farthest-first choice on a bounded sample, and chunks: Spark deals every row to its
nearest pivot, range-sorts by (pivot, label, id) and cuts runs of at most ``CHUNK`` rows, so a hot pivot or a
third of all rows with one vector are many chunks. A task builds the lower levels of each chunk's tree
(fan-out ``FAN``, leaves of about ``LEAF`` rows), all with true covering radii, label ranges and smallest ids.

A search is a table of queries (anchor, label, window of scores). They descend level by level: pivots, chunk
roots, nodes; what lies wholly below the k-th best score, or outside the window, is left out. Chunks are
visited best bound first, in two rounds: the two best give each query a k-th best, then all others whose
bound still passes. In a chunk leaves are taken in order of their bounds, in waves that double, and scored
exactly. The first search finds the positives, the second the negatives of each positive's window.

Defined results: rows with a null label, a null, empty vector or null or non-finite component, of another length
than most, or with a scaled component beyond 2^25 (64-bit scores could overflow) take no part. A null id is
no anchor, comes last among ties and may be returned. Rows with one id are rows of their own; a repeated
anchor returns its rows repeatedly, and an anchor's copies are rows like others. Rows without a positive
or without a negative in a window return nothing. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions

#: Rows of a chunk and of a leaf, children of a node, queries scored against a chunk in one piece.
CHUNK, LEAF, FAN, BLOCK = 4096, 24, 12, 512
#: Most pivots, rows they are learned from, bytes of a range partition.
PIVOTS, SAMPLE, PART_BYTES = 256, 4096, 64 << 20
#: Chunks of the first round.
FIRST = 2
#: Stands for no id; comes last.
LAST = (1 << 63) - 1
LOWEST = -(1 << 62)


def _lift(x: np.ndarray, top: float) -> np.ndarray:
    """Rows with the coordinate that lifts them to squared norm ``top``."""
    rest = np.sqrt(np.maximum(top - np.einsum("ij,ij->i", x, x), 0.0))
    return np.concatenate([x, rest[:, None]], axis=1)


def _far(y: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.sqrt(((y - c) ** 2).sum(axis=1))


def net(y: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` rows of ``y``, each the farthest from those before; fewer when all rows are met."""
    picks, gap = [0], _far(y, y[0])
    while len(picks) < most and gap.max() > 0:
        picks.append(int(gap.argmax()))
        gap = np.minimum(gap, _far(y, y[picks[-1]]))
    return np.array(picks)


def _radius(y: np.ndarray, c: np.ndarray) -> float:
    """Covering radius, rounded up beyond any rounding error."""
    return float(_far(y, c).max() * (1 + 1e-9) + 1e-6)


class Tree:
    """The nodes of one chunk. ``order`` sorts its rows so that a node is a run; ``level`` are runs of nodes."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray, top: float):
        y = _lift(x, top)
        nodes, levels, leaves = [], [], []
        order = np.arange(len(x))
        front = [(0, len(x), -1)]
        while front:
            levels.append((len(nodes), len(nodes) + len(front)))
            after = []
            for a, z, up in front:
                rows = order[a:z]
                c = rows[net(y[rows], 1)[0]]
                r = _radius(y[rows], y[c])
                own = labels[rows]
                nodes.append((c, r, ids[rows].min(), own.min(), own.max(), up, a, z))
                if z - a <= LEAF or _far(y[rows], y[c]).max() == 0:
                    leaves.append(len(nodes) - 1)
                    continue
                seeds = y[rows[net(y[rows], FAN)]]
                near = np.stack([_far(y[rows], s) for s in seeds]).argmin(axis=0)
                put = np.argsort(near, kind="stable")
                order[a:z] = rows[put]
                cut = np.flatnonzero(np.r_[True, near[put][1:] != near[put][:-1], True]) + a
                after += [(int(i), int(j), len(nodes) - 1) for i, j in zip(cut[:-1], cut[1:])]
            front = after
        self.x, self.ids, self.labels, self.order = x, ids, labels, order
        self.centre, self.radius, self.least, self.low, self.high, self.up, self.start, self.end = (np.array(c) for c in zip(*nodes))
        self.levels, self.leaves = levels, np.array(leaves)


def _passes(ub, lb, least, q) -> np.ndarray:
    """Whether scores within [lb, ub] can still enter a query's list: inside its window, and before its last."""
    return (lb <= q["hi"]) & (ub >= q["lo"]) & ((ub > q["last"]) | ((ub == q["last"]) & (least < q["last_id"])))


def _right_label(q, low, high) -> np.ndarray:
    return np.where(q["same"], (low <= q["label"]) & (q["label"] <= high), (low != high) | (low != q["label"]))


def _bounds(ip: np.ndarray, norm: np.ndarray, radius) -> tuple[np.ndarray, np.ndarray]:
    slack = norm * radius
    return np.floor(ip + slack + 1e-3), np.ceil(ip - slack - 1e-3)


def _best(hits: list[np.ndarray], k: int) -> np.ndarray:
    """Rows (query, score, id) among the first ``k`` of each query."""
    h = np.concatenate(hits, axis=1)
    h = h[:, np.lexsort((h[2], -h[1], h[0]))]
    first = np.flatnonzero(np.r_[True, h[0, 1:] != h[0, :-1]]) if h.shape[1] else np.zeros(0, int)
    rank = np.arange(h.shape[1]) - np.repeat(first, np.diff(np.r_[first, h.shape[1]]))
    return h[:, rank < k]


def search(tree: Tree, uids: np.ndarray, v: np.ndarray, q: dict[str, np.ndarray], k: int) -> np.ndarray:
    """(3, hits) of query, score and id: what may be among the first ``k`` of each query. ``v`` holds the
    queries' vectors in float64 when every score is exact there, else in 64-bit integers."""
    n = len(v)
    norm = np.sqrt((v.astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-12)
    x = tree.x.astype(v.dtype)
    last, last_id = q["last"].copy(), q["last_id"].copy()
    view = lambda rows: {c: q[c][rows] for c in ("lo", "hi", "label", "same")} | {"last": last[rows], "last_id": last_id[rows]}
    need = np.zeros((n, len(tree.centre)), bool)
    bound = np.zeros((n, len(tree.centre)))
    every = {c: d[:, None] for c, d in view(slice(None)).items()}
    for a, z in tree.levels:
        cols = np.arange(a, z)
        if a:
            cols = cols[need[:, tree.up[a:z]].any(axis=0)]
        if not len(cols):
            break
        ub, lb = _bounds((v @ x[tree.centre[cols]].T).astype(np.float64), norm[:, None], tree.radius[cols][None])
        ok = _passes(ub, lb, tree.least[cols][None], every) & _right_label(every, tree.low[cols][None], tree.high[cols][None])
        if a:
            ok &= need[:, tree.up[cols]]
        need[:, cols], bound[:, cols] = ok, np.minimum(ub, q["hi"][:, None])
    rank = np.where(need[:, tree.leaves], bound[:, tree.leaves], -np.inf)
    order = np.argsort(-rank, axis=1, kind="stable")
    open_ = need[:, tree.leaves].sum(axis=1)
    found, at, wave = np.zeros((3, 0), np.int64), 0, 2
    while at < len(tree.leaves) and (open_ > at).any():
        width = min(wave, len(tree.leaves) - at)
        qs, steps = np.nonzero(np.arange(at, at + width)[None] < open_[:, None])
        leaf = order[qs, steps + at]
        node = tree.leaves[leaf]
        top = bound[qs, node]
        ok = (top > last[qs]) | ((top == last[qs]) & (tree.least[node] < last_id[qs]))
        qs, node = qs[ok], node[ok]
        put = np.argsort(node, kind="stable")
        qs, node = qs[put], node[put]
        cut = np.flatnonzero(np.r_[True, node[1:] != node[:-1], True]) if len(node) else [0]
        new = [found]
        for a, z in zip(cut[:-1], cut[1:]):
            rows, own = tree.order[tree.start[node[a]]:tree.end[node[a]]], qs[a:z]
            s = (v[own] @ x[rows].T).astype(np.int64)
            w = {c: d[:, None] for c, d in view(own).items()}
            ids, labels = tree.ids[rows][None], tree.labels[rows][None]
            hit = _passes(s, s, ids, w) & (w["same"] == (labels == w["label"])) & (uids[rows][None] != q["uid"][own][:, None])
            i, j = np.nonzero(hit)
            new.append(np.stack([own[i], s[i, j], tree.ids[rows[j]]]))
        found = _best(new, k)
        # the k-th of a full list is what a later hit has to come before
        full, counts = np.unique(found[0], return_counts=True)
        ends = np.cumsum(counts) - 1
        full, ends = full[counts == k], ends[counts == k]
        last[full], last_id[full] = found[1, ends], found[2, ends]
        at, wave = at + width, wave * 2
    return found


def _matrix(col: pa.Array, rows: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _nearest(pivots: np.ndarray, top: float):
    def run(batches):
        for b in batches:
            if b.num_rows:
                y = _lift(_matrix(b.column("v"), b.num_rows).astype(np.float64), top)
                gap = (pivots ** 2).sum(axis=1)[None] - 2 * y @ pivots.T
                at = gap.argmin(axis=1)
                away = np.sqrt(((y - pivots[at]) ** 2).sum(axis=1)) * (1 + 1e-9) + 1e-6
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(away), *b.columns], names=["pivot", "away", *b.schema.names])
    return run


CHUNK_SCHEMA = "pivot int, chunk long, uids binary, ids binary, labels binary, vecs binary, centre array<int>, radius double, least long, low long, high long"


def _chunks(top: float, dim: int):
    """Runs of one pivot, cut at ``CHUNK`` rows; the chunk's name is its first row's."""
    def pack(pivot, cols):
        uid, ids, labels = (np.concatenate([c[i] for c in cols]) for i in range(3))
        x = np.concatenate([c[3] for c in cols])
        y = _lift(x.astype(np.float64), top)
        c = int(_far(y, y.mean(axis=0)).argmin())
        data = [int(pivot), int(uid[0]), *(a.astype(np.int64).tobytes() for a in (uid, ids, labels)), x.astype(np.int32).tobytes(), x[c].tolist(),
                _radius(y, y[c]), int(ids.min()), int(labels.min()), int(labels.max())]
        kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4, pa.list_(pa.int32()), pa.float64(), *[pa.int64()] * 3]
        names = [c.split()[0] for c in CHUNK_SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([d], k) for d, k in zip(data, kinds)], names=names)

    def run(batches):
        held, of, rows = [], None, 0
        for b in batches:
            if not b.num_rows:
                continue
            pivot = b.column("pivot").to_numpy()
            cols = [b.column(c).to_numpy() for c in ("uid", "id", "label")] + [_matrix(b.column("v"), b.num_rows)]
            cut = np.flatnonzero(np.r_[True, pivot[1:] != pivot[:-1], True])
            for a, z in zip(cut[:-1], cut[1:]):
                while a < z:
                    if held and (pivot[a] != of or rows == CHUNK):
                        yield pack(of, held)
                        held, rows = [], 0
                    take = min(z - a, CHUNK - rows)
                    held.append([c[a:a + take] for c in cols])
                    of, rows, a = pivot[a], rows + take, a + take
        if held:
            yield pack(of, held)
    return run


QUERY = ("qid", "uid", "label", "same", "lo", "hi", "last", "last_id")


def _queries(t: pa.RecordBatch | pa.StructArray, get) -> dict[str, np.ndarray]:
    q = {c: get(c).to_numpy(zero_copy_only=False) for c in QUERY}
    return q | {"same": q["same"].astype(bool)}


def _route_pivots(pivots: np.ndarray, radius: np.ndarray, least: np.ndarray):
    """A row for each pivot whose covering radius lets a query's window through."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            v = _matrix(b.column("v"), b.num_rows).astype(np.float64)
            q = {c: d[:, None] for c, d in _queries(b, b.column).items()}
            norm = np.sqrt((v ** 2).sum(axis=1))[:, None]
            ub, lb = _bounds(v @ pivots[:, :-1].T, norm, radius[None])
            i, j = np.nonzero(_passes(ub, lb, least[None], q))
            for a in range(0, len(i), 4096):
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(i[a:a + 4096])) for c in b.columns), pa.array(j[a:a + 4096].astype(np.int32))],
                                                 names=[*b.schema.names, "pivot"])
    return run


def _route_chunks(batches):
    """The queries' bounds at each chunk's root; rows whose window lies outside go."""
    for b in batches:
        if not b.num_rows:
            continue
        v, c = (_matrix(b.column(x), b.num_rows).astype(np.float64) for x in ("v", "centre"))
        q = _queries(b, b.column)
        get = lambda x: b.column(x).to_numpy()
        ub, lb = _bounds(np.einsum("ij,ij->i", v, c), np.sqrt((v ** 2).sum(axis=1)), get("radius"))
        ok = _passes(ub, lb, get("least"), q) & _right_label(q, get("low"), get("high"))
        bound = np.minimum(ub, q["hi"]).astype(np.int64)
        keep = b.select([*QUERY, "v", "chunk", "least"])
        yield pa.RecordBatch.from_arrays([*keep.columns, pa.array(bound)], names=[*keep.schema.names, "bound"]).filter(pa.array(ok))


def _visit(k: int, top: float):
    """Each row is a chunk and the queries that visit it."""
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                uid, ids, labels = (np.frombuffer(b.column(c)[i].as_py(), np.int64) for c in ("uids", "ids", "labels"))
                x = np.frombuffer(b.column("vecs")[i].as_py(), np.int32).reshape(len(uid), -1)
                t = b.column("queries")[i].values
                kind = np.float64 if top < 2 ** 52 else np.int64
                q = _queries(t, t.field)
                got = search(Tree(x.astype(np.float64), ids, labels, top), uid, _matrix(t.field("v"), len(t)).astype(kind), q, k)
                yield pa.RecordBatch.from_arrays([pa.array(q["qid"][got[0]]), pa.array(got[1]), pa.array(got[2])], names=["qid", "score", "id"])
    return run


class Index:
    """Chunks of all rows of ``staged`` (uid, id, label, v), under pivots."""

    def __init__(self, staged: DataFrame, n: int, top: float, dim: int):
        self.top = top
        few = staged.select("v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE).collect()
        y = _lift(np.array([r["v"] for r in few], dtype=np.float64), top)
        self.pivots = y[net(y, int(np.clip(n // CHUNK, 1, PIVOTS)))]
        spark = staged.sparkSession
        dealt = staged.mapInArrow(_nearest(self.pivots, top), "pivot int, away double, uid long, id long, label long, v array<int>").checkpoint()
        facts = dealt.groupBy("pivot").agg(F.max("away").alias("away"), F.min("id").alias("least")).collect()  # a row a pivot
        self.radius, self.least = np.full(len(self.pivots), -np.inf), np.full(len(self.pivots), LAST)
        for r in facts:
            self.radius[r["pivot"]], self.least[r["pivot"]] = r["away"], r["least"]
        parts = max(-(-n * dim * 4 // PART_BYTES), min(shuffle_partitions(spark), -(-n // CHUNK)))
        runs = dealt.drop("away").repartitionByRange(int(parts), "pivot", "label", "id", "uid").sortWithinPartitions("pivot", "label", "id", "uid")
        self.chunks = runs.mapInArrow(_chunks(top, dim), CHUNK_SCHEMA).checkpoint()

    def _scores(self, visits: DataFrame, k: int) -> DataFrame:
        """Hits of the visits, queries of one chunk in blocks of about ``BLOCK``."""
        sizes = visits.groupBy("chunk").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        work = visits.join(sizes, "chunk").withColumn("block", F.pmod(F.xxhash64("qid"), F.col("blocks")))
        work = work.groupBy("chunk", "block").agg(F.collect_list(F.struct(*QUERY, "v")).alias("queries"))
        data = self.chunks.select("chunk", "uids", "ids", "labels", "vecs")
        return work.join(data, "chunk").mapInArrow(_visit(k, self.top), "qid long, score long, id long")

    def first(self, queries: DataFrame, k: int) -> DataFrame:
        """(qid, score, id, rank) of the first ``k`` rows of each query of ``queries`` (qid, uid, label, same, lo, hi, v)."""
        queries = queries.withColumn("last", F.lit(LOWEST)).withColumn("last_id", F.lit(LAST)).select(*QUERY, "v")
        fields = "qid long, uid long, label long, same boolean, lo long, hi long, last long, last_id long, v array<int>"
        to = queries.mapInArrow(_route_pivots(self.pivots, self.radius, self.least), f"{fields}, pivot int")
        roots = self.chunks.select("pivot", "chunk", "centre", "radius", "least", "low", "high")
        visits = to.join(roots, "pivot").mapInArrow(_route_chunks, f"{fields}, chunk long, least long, bound long")
        order = Window.partitionBy("qid").orderBy(F.desc("bound"), "least", "chunk")
        visits = visits.withColumn("turn", F.row_number().over(order)).checkpoint()
        ranked = Window.partitionBy("qid").orderBy(F.desc("score"), "id")
        best = self._scores(visits.where(F.col("turn") <= FIRST), k)
        best = best.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).checkpoint()
        last = best.where(F.col("rank") == k).select("qid", F.col("score").alias("l"), F.col("id").alias("l_id"))
        rest = visits.where(F.col("turn") > FIRST).join(last, "qid", "left")
        rest = rest.where("l is null or bound > l or (bound = l and least < l_id)")
        rest = rest.withColumn("last", F.coalesce("l", "last")).withColumn("last_id", F.coalesce("l_id", "last_id"))
        both = best.drop("rank").unionByName(self._scores(rest, k))
        return both.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def whole(v: Column, scale: int) -> Column:
    """floor(scale * x) of every component."""
    return F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("int"))


def hard_negatives(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", every: int = 100,
                   scale: int = 256, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """For each anchor (id divisible by ``every``) and each of its first ``positives`` other rows of its label, the first
    ``negatives`` rows of other labels whose score is ``low`` to ``high`` percent of the positive's."""
    raw = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).alias("e"))
    fine = F.forall("e", lambda x: x.isNotNull() & (F.abs(x.cast("double") * scale) <= float(1 << 25)))
    raw = raw.where(F.col("label").isNotNull() & (F.size("e") > 0) & F.coalesce(fine, F.lit(False)))
    sizes = raw.groupBy(F.size("e").alias("d")).count().orderBy(F.desc("count"), "d").first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if sizes is None:
        return df.sparkSession.createDataFrame([], schema)
    staged = raw.where(F.size("e") == sizes["d"]).select(F.monotonically_increasing_id().alias("uid"), "id", "label", whole(F.col("e"), scale).alias("v"))
    staged = staged.checkpoint()
    square = F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x.cast("long") * x.cast("long"))
    top = staged.agg(F.max(square)).first()[0]
    index = Index(staged, sizes["count"], float(top), sizes["d"])
    anchors = staged.where((F.col("id") != LAST) & (F.col("id") % every == 0))
    ask = anchors.select(F.col("uid").alias("qid"), "uid", "label", F.lit(True).alias("same"), F.lit(LOWEST).alias("lo"), F.lit(-LOWEST).alias("hi"), "v")
    of = index.first(ask, positives).select(F.col("qid").alias("uid"), F.col("score").alias("positive_score"), F.col("id").alias("positive_id"), F.col("rank").alias("place"))
    down = lambda p: f"({p} * positive_score - pmod({p} * positive_score, 100L)) div 100L"
    windows = of.withColumn("lo", F.expr("-(" + down(f"(-{low}L)") + ")")).withColumn("hi", F.expr(down(f"{high}L"))).where("lo <= hi")
    windows = windows.join(anchors.select("uid", F.col("id").alias("anchor_id"), "label", "v"), "uid")
    windows = windows.withColumn("qid", F.monotonically_increasing_id()).checkpoint()
    got = index.first(windows.select("qid", "uid", "label", F.lit(False).alias("same"), "lo", "hi", "v"), negatives)
    back = lambda c: F.when(F.col(c) != LAST, F.col(c)).alias(c)
    out = got.select("qid", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return out.join(windows.select("qid", "anchor_id", "positive_id", "positive_score"), "qid").select(
        "anchor_id", back("positive_id"), "rank", back("negative_id"), "positive_score", "negative_score")
