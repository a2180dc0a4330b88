"""Near-duplicate documents by SetSketch registers over word shingles.

A document's sketch has M registers. Register i is the exponentially spaced, truncated rank of the
smallest exponential variate that hash i gives to the document's shingles:
``clip(floor(1 - log_B(x)), 0, Q + 1)``. Registers of a union are the larger of both, so sketches
merge, and two registers agree with about the probability of the Jaccard similarity. Bands of
ROWS registers are looked up; documents that share a band value are candidates.

Documents with equal shingle sets are one class. In a round every band value has one *hub*, the class with
most company in its bands (every other round: of smallest hash), and a class is compared with the
few foremost hubs of its bands, not with all others; what that links is one component. Later rounds compare only classes of different components, with new hubs, as long as
that halves the pairs left, or until these are few against the table. Then all pairs left in bands of at most
CROWD classes are compared. The classes left in fuller bands (many texts just less alike than the threshold, or
about half alike) are dealt to blocks of bounded size; every two blocks of a band meet in one group, which
compares its classes in memory and returns one link for each two components it joins, never its pairs. That
is the one case whose work grows with the square of a group, at some microseconds a pair. A pair is compared
only if its set sizes allow the similarity: first by the joint likelihood of its registers, given both set
sizes, and dropped if the estimate lies five standard errors below the threshold; then by the intersection of the full sets.

At similarity 0.8 a pair shares no band with probability (1 - 0.8^6)^36 < 2e-5, at 0.85 < 1e-7; at 0.3 it
shares one with probability 0.03.

Defined results: a document without words (or null text) has an empty set, is linked with nothing and is
its own component. Documents with fewer words than a shingle have one shingle, the whole
sequence. Rows with one id are one document, which any of their sets may link; equal rows give equal
rows. Rows without id link with nothing, have no component and are not kept. Extra columns are
ignored. Very long texts take their set of 8-byte names in memory, one document at a time.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecspark.session import ensure_checkpoint_dir

from .common import GOLD, mix64, small_batches
from .components import components
from .words import sequence_names, word_names

M, ROWS = 216, 6
B, A, Q = 1.001, 20.0, (1 << 16) - 2
#: Odd multipliers, one per register.
FACTORS = mix64(np.arange(1, M + 1, dtype=np.uint64) * GOLD) | np.uint64(1)
HUBS = 3
#: Bands of up to so many classes have their pairs compared as rows; fuller ones in blocks.
CROWD = 8
#: A block of a fuller band holds about so many names, and classes, at most.
BLOCK_NAMES, BLOCK_CLASSES = 1 << 17, 1024
#: Classes of a partition, about: a table of fewer than its partitions would hold lies in fewer of them.
PART = 2000
#: Ids broadcast to find the candidates' texts, at most; beyond that the texts are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Pairs left are all compared once there are at most so many per band row: before any round of hubs, which finds
#: large groups, and after one. A round costs a shuffle of the band rows, a block some microseconds a pair.
REST = (0.5, 12)


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct names of the shingles; of the whole sequence if it is shorter."""
    if not len(words):
        return np.zeros(0, np.uint64)
    n = min(size, len(words))
    return np.unique(mix64(sequence_names(words, n) + np.uint64(n)))


def registers(s: np.ndarray, factors: np.ndarray = FACTORS) -> np.ndarray:
    """SetSketch registers of a set of uniform 64-bit names, one for each factor."""
    low = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    step = (1 << 19) // len(factors)
    for i in range(0, len(s), step):
        np.minimum(low, (s[i:i + step, None] * factors).min(axis=0), out=low)
    x = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0 ** 64) / A
    return np.clip(np.floor(1 - np.log(x) / np.log(B)), 0, Q + 1).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def likely_jaccard(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """Most likely similarity of pairs: rows of ``x`` and ``y`` are registers, ``nx``, ``ny`` set sizes.
    Larger, smaller and equal registers are counted and their joint likelihood is maximised over
    a grid of 201 similarities up to the ratio of the sizes."""
    more, less = (x > y).sum(axis=1), (x < y).sum(axis=1)
    u = (nx / (nx + ny))[:, None]
    v = 1 - u
    j = np.linspace(0, 1, 201)[None] * np.minimum(u / v, v / u)
    p = lambda t: -np.log1p(-np.clip(t, 0, 1) * (B - 1) / B) / np.log(B)
    up, down = p(u - v * j), p(v - u * j)
    safe = lambda t: np.log(np.maximum(t, 1e-12))
    like = more[:, None] * safe(up) + less[:, None] * safe(down) + (M - more - less)[:, None] * safe(1 - up - down)
    return np.take_along_axis(j, like.argmax(axis=1)[:, None], axis=1)[:, 0]


def _sets(batches, shingle, lower):
    """(batch, its sets)."""
    for b in small_batches(batches, 128):
        yield b, [shingle_set(w, shingle) for w in word_names(b.column(b.num_columns - 1).to_pylist(), lower)]


def _fingerprint(s: np.ndarray) -> bytes:
    """16 bytes by the content of a set."""
    return np.array([np.bitwise_xor.reduce(mix64(s.copy())), (s * GOLD).sum(dtype=np.uint64) ^ np.uint64(len(s))], dtype=">u8").tobytes()


def _sketch(shingle, lower):
    def run(batches):
        for b, sets in _sets(batches, shingle, lower):
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_fingerprint(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([registers(s).tobytes() if len(s) else None for s in sets], pa.binary())],
                names=["doc", "n", "print", "regs"])
    return run


def _bands(batches):
    """The columns before the registers, repeated for each band value."""
    for b in batches:
        if b.num_rows:
            k = np.frombuffer(b"".join(b.column(b.num_columns - 1).to_pylist()), np.uint16).reshape(-1, M // ROWS, ROWS).astype(np.uint64)
            h = np.broadcast_to(np.arange(1, k.shape[1] + 1, dtype=np.uint64) * GOLD, k.shape[:2]).copy()
            for i in range(ROWS):
                h = mix64(h + k[:, :, i])
            each = pa.array(np.repeat(np.arange(len(k)), k.shape[1]))
            yield pa.RecordBatch.from_arrays([*[b.column(i).take(each) for i in range(b.num_columns - 1)], pa.array(h.ravel().view(np.int64))],
                                             names=[*b.schema.names[:-1], "band"])


def _likely(threshold: float):
    floor = threshold - 5 * np.sqrt(threshold * (1 - threshold) / M)

    def run(batches):
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint16).reshape(-1, M) for i in (4, 6))
                est = likely_jaccard(x, y, *(b.column(i).to_numpy(zero_copy_only=False).astype(float) for i in (5, 7)))
                b = b.filter(pa.array(est >= floor))
            yield b.select([0, 1, 2, 3])
    return run


def _verify(percent: int):
    def run(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                x, y = (np.frombuffer(s, np.uint64) for s in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True)) if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)) else 0
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield b.filter(pa.array(keep, pa.bool_())).select([0, 1])
    return run


def likely_at_least(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray, floor: float) -> np.ndarray:
    """Whether the most likely similarity of each row of ``x`` with each of ``y`` is ``floor`` or more, for sizes
    whose ratio is above it: whether the joint likelihood, which has one peak, still rises there."""
    more, less = np.empty((len(x), len(y))), np.empty((len(x), len(y)))
    step = max(1, (1 << 21) // (M * len(y)))
    for i in range(0, len(x), step):
        more[i:i + step] = np.count_nonzero(x[i:i + step, None] > y[None], axis=2)
        less[i:i + step] = np.count_nonzero(x[i:i + step, None] < y[None], axis=2)
    u = nx[:, None] / (nx[:, None] + ny)
    v, c = 1 - u, (B - 1) / B
    p = lambda t: -np.log1p(-c * t) / np.log(B)
    slope = lambda t: c / (1 - c * t) / np.log(B)
    a, b = np.maximum(u - v * floor, 1e-9), np.maximum(v - u * floor, 1e-9)
    da, db = -v * slope(a), -u * slope(b)
    return more * da / p(a) + less * db / p(b) - (M - more - less) * (da + db) / (1 - p(a) - p(b)) >= 0


def common(xs: list[np.ndarray], ys: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of each set of ``xs`` with each of ``ys``, by products of 0-1 matrices
    over ``width`` of the names that occur on both sides."""
    x, y = np.concatenate(xs), np.concatenate(ys)
    shared = np.intersect1d(x, y)
    both = np.zeros((len(xs), len(ys)), np.int64)
    if not len(shared):
        return both
    sides = []
    for names, sets in ((x, xs), (y, ys)):
        col = np.minimum(np.searchsorted(shared, names), len(shared) - 1)
        of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        has = shared[col] == names
        col, of = col[has], of[has]
        order = np.argsort(col, kind="stable")
        sides.append((col[order], of[order], len(sets)))
    for at in range(0, len(shared), width):
        ones = []
        for col, of, size in sides:
            i, j = np.searchsorted(col, (at, at + width))
            m = np.zeros((size, min(width, len(shared) - at)), np.float32)
            m[of[i:j], col[i:j] - at] = 1
            ones.append(m)
        both += (ones[0] @ ones[1].T).astype(np.int64)
    return both


def _joined(percent: int):
    """Links between the two blocks of a group (or within its one block), one for each two components they join."""
    floor = percent / 100 - 5 * np.sqrt(percent / 100 * (1 - percent / 100) / M)

    def run(t: pa.Table) -> pa.Table:
        node, root, block, n = (t[c].to_numpy() for c in ("node", "root", "block", "n"))
        regs = np.frombuffer(b"".join(t["regs"].to_pylist()), np.uint16).reshape(-1, M)
        x, y = np.flatnonzero(block == t["lo"][0].as_py()), np.flatnonzero(block == t["hi"][0].as_py())
        links = []
        if len(x) and len(y):
            able = root[x][:, None] != root[y]
            able &= 100 * np.minimum(n[x][:, None], n[y]) >= percent * np.maximum(n[x][:, None], n[y])
            able &= likely_at_least(regs[x], regs[y], n[x].astype(float), n[y].astype(float), floor)
            rows, cols = able.any(axis=1), able.any(axis=0)
            if rows.any():
                x, y, able = x[rows], y[cols], able[np.ix_(rows, cols)]
                sets = t["set"]
                both = common(*([np.frombuffer(sets[int(i)].as_py(), np.uint64) for i in side] for side in (x, y)))
                able &= 100 * both >= percent * (n[x][:, None] + n[y] - both)
                top: dict[int, int] = {}

                def of(r):
                    while r in top:
                        r = top[r]
                    return r
                for i, j in zip(*np.nonzero(able)):
                    a, b = of(root[x[i]]), of(root[y[j]])
                    if a != b:
                        top[max(a, b)] = min(a, b)
                        links.append(sorted((node[x[i]], node[y[j]])))
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 80, lower: bool = True) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (smallest id reachable by links of
    ``100 * intersection >= percent * union``) and kept (id = component_id)."""
    spark = docs.sparkSession
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sketches-{uuid.uuid4().hex}"
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    rows.mapInArrow(_sketch(shingle, lower), "doc long, n long, print binary, regs binary").write.parquet(base)
    sketches = spark.read.parquet(base)
    # a class is known by the smallest id that has its set
    able = sketches.where("print is not null and doc is not null")
    classes = able.groupBy("print").agg(F.min("doc").alias("node"))
    first = able.withColumnRenamed("doc", "node").join(classes, ["node", "print"]).dropDuplicates(["node", "print"])
    bands = first.select("node", "regs").mapInArrow(_bands, "node long, band long")
    crowded = bands.groupBy("band").agg(F.count("*").alias("k")).where("k > 1")
    # how many share its bands: the text the others were made from has most
    weight = bands.join(crowded, "band").groupBy("node").agg(F.sum("k").alias("weight"))
    near = first.join(weight, "node").select("node", "print", "n", "weight", "regs").checkpoint()
    count = near.count()
    total, parts = (M // ROWS) * count, 1 + count // PART
    near = near.coalesce(parts)
    # full sets of the classes that have a candidate at all
    wanted = near.select(F.col("node").alias("doc")).distinct()
    one = rows.join(F.broadcast(wanted) if count <= BROADCAST_IDS else wanted, "doc")

    def full(batches):
        for b, sets in _sets(batches, shingle, lower):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([_fingerprint(s) if len(s) else None for s in sets], pa.binary()),
                                              pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "print", "set"])
    sets = one.select("doc", "text").mapInArrow(full, "node long, print binary, set binary")
    sets = sets.join(near.select("node", "print"), ["node", "print"]).dropDuplicates(["node", "print"]).coalesce(parts).checkpoint()

    def confirm(pairs: DataFrame) -> DataFrame:
        x, y = (near.select(*[F.col(c).alias(c + e) for c in ("node", "print", "regs", "n")]) for e in "ab")
        likely = pairs.join(x, pairs.a == x.nodea).join(y, pairs.b == y.nodeb)
        likely = likely.select("a", "b", "printa", "printb", "regsa", "na", "regsb", "nb").mapInArrow(
            _likely(percent / 100), "a long, b long, printa binary, printb binary")
        x, y = (sets.select(F.col("node").alias(e), F.col("print").alias("print" + e), F.col("set").alias("set" + e)) for e in "ab")
        likely = likely.join(x, ["a", "printa"]).join(y, ["b", "printb"]).select("a", "b", "seta", "setb")
        return likely.mapInArrow(_verify(percent), "a long, b long").distinct()

    ordered = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))

    def within(bands: DataFrame) -> DataFrame:
        """Pairs of one band, of different components, whose sizes allow a link."""
        x, y = (bands.select("band", *[F.col(c).alias(c + e) for c in ("node", "root", "n")]) for e in "ab")
        able = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
        met = x.join(y, (x.band == y.band) & (x.nodea < y.nodeb) & (x.roota != y.rootb) & able)
        return met.select(F.col("nodea").alias("a"), F.col("nodeb").alias("b")).distinct()

    def between_blocks(bands: DataFrame) -> DataFrame:
        """Links of the classes of each band, which has its number of ``blocks``: every two blocks meet in a group."""
        dealt = bands.withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
        dealt = dealt.select("band", "node", "root", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        dealt = dealt.select("band", "node", "root", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
        load = near.select("node", "print", "n", "regs").join(sets, ["node", "print"]).drop("print")
        return dealt.join(load, "node").groupBy("band", "lo", "hi").applyInArrow(_joined(percent), "a long, b long").distinct()

    def with_hubs(left: DataFrame, mixed: DataFrame, rounds: int) -> DataFrame:
        """Pairs of a class and the foremost hubs of its bands."""
        left = left.join(mixed.select("band"), "band")
        order = F.struct((-F.col("weight") if rounds % 2 == 0 else F.lit(0)).alias("w"), F.xxhash64(F.lit(rounds), "node").alias("h"))
        best = left.groupBy("band").agg(F.min(F.struct(order.alias("h"), F.col("node").alias("hub"), F.col("root").alias("hub_root"))).alias("b"))
        # of the hubs of all its bands a class meets the few of smallest hash, so groups meet at the same ones
        met = left.join(best, "band").where("root != b.hub_root").groupBy("node").agg(
            F.slice(F.array_sort(F.collect_set(F.struct("b.h", "b.hub"))), 1, HUBS).alias("hubs"))
        return met.select("node", F.explode("hubs.hub").alias("hub")).select(*ordered("node", "hub")).distinct()

    def rest(left: DataFrame, mixed: DataFrame) -> DataFrame:
        """Links of all that is still apart."""
        blocks = F.ceil(F.greatest(F.col("names") / BLOCK_NAMES, F.col("s") / BLOCK_CLASSES))
        left = left.join(mixed.select("band", "s", blocks.alias("blocks")), "band")
        few = confirm(within(left.where(F.col("s") <= CROWD)))
        return few.unionByName(between_blocks(left.where(F.col("s") > CROWD))).distinct()

    links, root, rounds, before, last = None, None, 0, None, False
    root_of = near.withColumn("root", F.col("node"))
    while not last:
        left = root_of.select("node", "root", "n", "weight", "regs").mapInArrow(
            _bands, "node long, root long, n long, weight long, band long")
        # classes still apart from others of their band, and how many pairs that leaves
        sizes = left.groupBy("band", "root").agg(F.count("*").alias("s"), F.sum("n").alias("names"))
        mixed = sizes.groupBy("band").agg(F.sum("s").alias("s"), F.sum("names").alias("names"),
                                          F.sum(F.col("s") * F.col("s")).alias("q"), F.count("*").alias("c")).where("c > 1").coalesce(parts).checkpoint()
        pairs_left = mixed.agg(F.sum((F.col("s") * F.col("s") - F.col("q")) / 2)).first()[0] or 0
        if not pairs_left:
            break
        last = pairs_left <= REST[min(rounds, 1)] * total or before is not None and 2 * pairs_left > before
        before = pairs_left
        found = None if last else confirm(with_hubs(left, mixed, rounds)).coalesce(parts).checkpoint()
        if last or found.isEmpty():  # another round would leave as many pairs
            last, found = True, rest(left, mixed).coalesce(parts).checkpoint()
        if not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            root = components(links, "a", "b").checkpoint()
        rounds += 1
        if not last:
            root_of = near.join(root, "node", "left").withColumn("root", F.coalesce("root", "node")).coalesce(parts).checkpoint()

    ids = classes.withColumn("component", F.col("node"))
    if root is not None:
        ids = classes.join(root, "node", "left").select("print", F.coalesce("root", "node").alias("component"))
    out = sketches.select("doc", "n", "print").join(ids.select("print", "component"), "print", "left")
    own = F.when(F.col("doc").isNotNull(), F.coalesce("component", "doc"))
    return out.select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"),
                      F.coalesce(F.col("doc") == own, F.lit(False)).alias("kept"))
