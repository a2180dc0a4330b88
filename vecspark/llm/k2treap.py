"""Ranked lexical search by K2-treaps over term-document grids.

The corpus is a grid of terms by documents whose cells hold impacts (what a term adds to a document's score).
Spark range-sorts the documents' postings by id and cuts them into document ranges of at most ``COLUMNS`` documents
and ``CELLS`` postings; each range is one quadtree, compressed to a 4-bit child mask and the largest impact
of every non-empty cell, level by level (children are found by rank in the masks, no coordinates are kept).

An item descends with the paths of all its term rows at once: a state is a range of documents with one
cell for each term that occurs in it, and the cells' maxima add up to a bound of the score of any of its
documents. Ranges of ``STEP`` documents are taken best bound first, in waves that double, and go
down to single cells, where the bound is the exact score; ranges that cannot enter the item's list of the
best so far are left out. A task carries its items' lists from one document range to the next and returns
only them; lists are merged in two steps, so no task reads more than about the root of all tasks' lists.

The grid's rows are the terms of the items (other terms cannot score). Items are worked on in blocks of
about ``ITEM_BYTES`` of text, usually one; what a task gets of the items is bounded by that.

Defined results: null, empty and wordless texts count for nothing and are never returned; an item without a
term returns no rows. Rows are ranked each on its own: repeated items repeat their rows, documents that
share an id are separate documents, a null document id comes last among equal scores. Extra columns are
ignored; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, small_batches, utf8_values

COLUMNS, CELLS = 16_384, 1 << 21
#: Documents of a range taken in one step, as a power of two.
STEP = 6
ITEM_BYTES = 8 << 20
PART_BYTES = 48 << 20
LAST = (1 << 63) - 1
_WORD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_ONES = np.array([bin(i).count("1") for i in range(16)], np.int64)


def words(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of other than ASCII characters, only A-Z lower-cased."""
    return text.translate(_WORD).split()


class Treap:
    """``mask``: which quadrants (row bit, column bit) of a cell are not empty. ``top``: the largest impact in
    a cell. Levels follow each other from the root; the last level's cells are single postings."""

    def __init__(self, bits: int, counts: np.ndarray, mask: np.ndarray, top: np.ndarray):
        self.bits, self.counts, self.mask, self.top = bits, counts, mask, top
        ones = _ONES[mask]
        self.child = np.r_[0, np.cumsum(ones)[:-1]] + 1  # children of all cells, in order, follow the root

    @classmethod
    def build(cls, row: np.ndarray, col: np.ndarray, impact: np.ndarray, rows: int, cols: int) -> Treap:
        bits = max(1, (max(rows, cols) - 1).bit_length())
        z = np.zeros(len(row), np.int64)
        for i in range(bits):
            z |= ((col >> i) & 1) << (2 * i) | ((row >> i) & 1) << (2 * i + 1)
        put = np.argsort(z, kind="stable")
        z, top = z[put], impact[put]
        levels = [(np.zeros(len(z), np.uint8), top)]
        for _ in range(bits):
            cut = np.flatnonzero(np.r_[True, z[1:] >> 2 != z[:-1] >> 2])
            mask = np.bitwise_or.reduceat((1 << (z & 3)).astype(np.uint8), cut)
            z, top = z[cut] >> 2, np.maximum.reduceat(top, cut)
            levels.append((mask, top))
        levels.reverse()
        return cls(bits, np.array([len(m) for m, _ in levels]), *(np.concatenate(c) for c in zip(*levels)))

    def pack(self) -> bytes:
        return np.r_[self.bits, self.counts].astype(np.int64).tobytes() + self.top.astype(np.int64).tobytes() + self.mask.tobytes()

    @classmethod
    def unpack(cls, data: bytes) -> Treap:
        bits = int(np.frombuffer(data, np.int64, 1)[0])
        counts = np.frombuffer(data, np.int64, bits + 1, 8)
        n = int(counts.sum())
        at = 8 * (bits + 2)
        return cls(bits, counts, np.frombuffer(data, np.uint8, n, at + 8 * n), np.frombuffer(data, np.int64, n, at))

    def down(self, level: int, prefix, rng, cell, term, passes):
        """One level down: the halves of the ranges ``prefix``, with the cells of those that ``passes`` lets through.
        ``rng`` names each cell's range by its place in ``prefix``."""
        mask, high = self.mask[cell].astype(np.int64), (term >> (level - 1) & 1) << 1
        subs, into, terms = [], [], []
        for half in (0, 1):
            q = high | half
            has = np.flatnonzero(mask >> q & 1)
            subs.append(self.child[cell[has]] + _ONES[mask[has] & ((1 << q[has]) - 1)])
            into.append(2 * rng[has] + half)
            terms.append(term[has])
        sub, into, term = np.concatenate(subs), np.concatenate(into), np.concatenate(terms)
        bound = np.bincount(into, weights=self.top[sub], minlength=2 * len(prefix)).astype(np.int64)  # exact below 2^53
        halves = np.repeat(prefix * 2, 2) + np.tile([0, 1], len(prefix))
        keep = (bound > 0) & passes(bound, halves << (level - 1))
        own = keep[into]
        return halves[keep], bound[keep], (np.cumsum(keep) - 1)[into[own]], sub[own], term[own]


class Best:
    """The first ``k`` of one item so far."""

    def __init__(self, k: int):
        self.k, self.score, self.id = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.r_[self.score, score], np.r_[self.id, ids]
        put = np.lexsort((ids, -score))[:self.k]
        self.score, self.id = score[put], ids[put]

    def passes(self, bound: np.ndarray, least: np.ndarray) -> np.ndarray:
        if len(self.score) < self.k:
            return np.ones(len(bound), bool)
        return (bound > self.score[-1]) | ((bound == self.score[-1]) & (least < self.id[-1]))


def search(treap: Treap, ids: np.ndarray, terms: np.ndarray, best: Best) -> None:
    """Adds the documents of one tree to an item's list. ``ids`` are the columns' ids in ascending order."""
    passes = lambda bound, first: best.passes(bound, ids[np.minimum(first, len(ids) - 1)])
    level = treap.bits
    state = np.zeros(1, np.int64), treap.top[:1] * len(terms), np.zeros(len(terms), np.int64), np.zeros(len(terms), np.int64), terms
    if not passes(state[1], state[0])[0]:
        return
    while level > STEP and len(state[0]):
        state = treap.down(level, state[0], *state[2:], passes)
        level -= 1
    prefix, bound, rng, cell, term = state
    put = np.argsort(rng, kind="stable")
    rng, cell, term = rng[put], cell[put], term[put]
    start = np.searchsorted(rng, np.arange(len(prefix) + 1))
    order, at, wave = np.argsort(-bound, kind="stable"), 0, 4
    while at < len(order):
        take = order[at:at + wave]
        at, wave = at + wave, wave * 2
        take = take[passes(bound[take], prefix[take] << level)]
        if not len(take):
            continue  # bounds fall, but equal ones may have smaller ids
        size = start[take + 1] - start[take]
        rows = np.repeat(start[take] - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
        own = prefix[take], bound[take], np.repeat(np.arange(len(take)), size), cell[rows], term[rows]
        for below in range(level, 0, -1):
            own = treap.down(below, own[0], *own[2:], passes)
        best.add(own[1], ids[own[0]])


def _postings(known: dict[bytes, int]):
    """(id, n, rows, tfs) of every text with a term."""
    def run(batches):
        for b in small_batches(batches):
            out = [], [], [], []
            for i, text in zip(b.column(0).to_pylist(), utf8_values(b.column(1))):
                own = words(text)
                if own:
                    held = [(known[w], c) for w, c in Counter(own).items() if w in known]
                    for c, v in zip(out, (i, len(own), [t for t, _ in held], [c for _, c in held])):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())))],
                                             names=["id", "n", "rows", "tfs"])
    return run


def _trees(weight: np.ndarray, docs: int, length: int):
    """Postings in order of ids, cut into document ranges: (ids, tree)."""
    def pack(held):
        ids, n = (np.concatenate([h[i] for h in held]) for i in (0, 1))
        size, row, tf = (np.concatenate([h[i] for h in held]).astype(np.int64) for i in (2, 3, 4))
        m = np.array([50 + 50 * int(x) * docs // length for x in n.tolist()], np.int64)  # 100 - 50 + ...
        col = np.repeat(np.arange(len(ids)), size)
        impact = weight[row] * (1_000_000_000 * tf // (1000 * tf + 20 * m[col]))
        some = impact > 0
        if some.any():
            tree = Treap.build(row[some], col[some], impact[some], len(weight), len(ids))
            yield pa.RecordBatch.from_arrays([pa.array([ids.tobytes()], pa.binary()), pa.array([tree.pack()], pa.binary())], names=["ids", "tree"])

    def run(batches):
        held, docs_held, cells = [], 0, 0
        for b in small_batches(batches, 1024):
            size = np.diff(b.column("rows").offsets.to_numpy())
            flat = [b.column(c).flatten().to_numpy() for c in ("rows", "tfs")]
            if held and (docs_held + b.num_rows > COLUMNS or cells + size.sum() > CELLS):
                yield from pack(held)
                held, docs_held, cells = [], 0, 0
            held.append((b.column("id").to_numpy(), b.column("n").to_numpy(), size, *flat))
            docs_held, cells = docs_held + b.num_rows, cells + int(size.sum())
        if held:
            yield from pack(held)
    return run


def _search(items: list[tuple[int, np.ndarray]], k: int):
    def run(batches):
        lists = [Best(k) for _ in items]
        for b in batches:
            for ids, tree in zip(b.column(0), b.column(1)):
                ids, treap = np.frombuffer(ids.as_buffer(), np.int64), Treap.unpack(tree.as_py())
                for (_, terms), best in zip(items, lists):
                    search(treap, ids, terms, best)
        for (item, _), best in zip(items, lists):
            if len(best.id):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(best.id), item)), pa.array(best.id), pa.array(best.score)], names=["item", "id", "score"])
    return run


def _block(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """(item, id, score): the first ``k`` documents of each row of ``items`` (item, text), a bounded block."""
    texts = [(r["item"], sorted(set(words(r["text"].encode())))) for r in items.where("text is not null").collect()]
    known = {w: i for i, w in enumerate(sorted({w for _, ws in texts for w in ws}))}
    asked = [(i, np.array([known[w] for w in ws], np.int64)) for i, ws in texts if ws]
    postings = docs.mapInArrow(_postings(known), "id long, n long, rows array<int>, tfs array<int>")
    postings = postings.withColumn("uid", F.monotonically_increasing_id()).checkpoint()
    n, length, cells = postings.agg(F.count("*"), F.sum("n"), F.sum(F.size("rows"))).first()
    df = np.zeros(len(known), np.int64)
    for r in postings.select(F.explode("rows").alias("row")).groupBy("row").count().collect():  # a row a term of the block
        df[r["row"]] = r["count"]
    weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    spark = docs.sparkSession
    parts = max(-(-(8 * (cells or 0) + 32 * n) // PART_BYTES), min(shuffle_partitions(spark), -(-n // 1024)), 1)
    dealt = postings.repartitionByRange(parts, "id", "uid").sortWithinPartitions("id", "uid").drop("uid")
    found = dealt.mapInArrow(_trees(weight, n, length or 1), "ids binary, tree binary").mapInArrow(_search(asked, k), "item long, id long, score long")
    some = F.pmod(F.spark_partition_id(), F.lit(max(1, math.isqrt(parts))))
    for key in (("item", "some"), ("item",)):
        first = Window.partitionBy(*key).orderBy(F.desc("score"), "id")
        found = found.withColumn("some", some) if "some" in key else found
        found = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return found.select("item", "id", "score", "rank")


def rank(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text: str = "text") -> DataFrame:
    """Each item's ``k`` documents of the highest score above 0: item id, rank, document id, score."""
    asked = items.select(F.monotonically_increasing_id().alias("item"), F.col(item_col).alias("name"), F.col(item_text).alias("text")).checkpoint()
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // ITEM_BYTES
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("id"), F.col(text_col).alias("text"))
    one = lambda i: asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == i).select("item", "text")
    found = reduce(DataFrame.unionByName, [_block(texts, one(i), k) for i in range(blocks)])
    return found.join(asked.select("item", "name"), "item").select(
        F.col("name").alias(item_col), F.col("rank").cast("int").alias("rank"), F.when(F.col("id") != LAST, F.col("id")).alias(id_col), "score")
