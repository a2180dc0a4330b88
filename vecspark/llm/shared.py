"""Finding long repeats across documents: the part of the work that both substring operators share.

A document is a sequence of units (bytes, words), a window a fixed number of consecutive units.
Documents are dealt into *parts* by id hash. Names of sampled places go from parts to *buckets*,
ranges of names, as sorted arrays: one record per part and bucket, each name once per part, so
a passage held by a third of all documents is one entry per part. A bucket sorts its names and
tells each part which of them other documents have too. Windows in a row that share their sample
are a *chunk*; chunk names travel beside the samples with the part's smallest document, and
all windows of a chunk that an earlier document has are settled at once. Only windows with a shared
sample that are still open - first occurrences and the ends of repeats - are named one by one
and travel the same way; the bucket tells of names that start in an earlier document elsewhere.

Everything is one lineage over one exchange of the texts (Spark reuses it); nothing is collected,
no pairs are made, and neither parts nor buckets grow with the corpus (their number does).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import GOLD, MIX1, mix64, shuffle_partitions

#: Order of a document without id: after all others.
LAST = np.iinfo(np.int64).max
#: Units handled at a time.
BLOCK = 1 << 18
#: Copies whose ids are broadcast, at most; beyond that they are joined by a shuffle.
BROADCAST_COPIES = 1_000_000
MESSAGE = "bucket int, part int, names binary, extra binary"
_MESSAGE = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("names", pa.binary()), ("extra", pa.binary())])
REPLY, NOTE, CHUNK = -1, -2, -3


@dataclass(frozen=True)
class Method:
    """What differs between operators.

    ``window``: units of a window. ``units``: texts to one array of units each. ``state``: whatever the
    rest needs of a run of units. ``anchors(state)``: for every window start the sampled place that
    stands for it, which equal windows choose alike, or -1 for a window to look at in any case.
    ``sample_names`` and ``window_names``: 64-bit names by content at given places of a state.
    ``finish(text, units, covered)``: output values of a document, ``covered`` marking its units to
    remove (None for none)."""
    window: int
    units: Callable[[list[bytes]], list[np.ndarray]]
    state: Callable[[np.ndarray], object]
    anchors: Callable[[object], np.ndarray]
    sample_names: Callable[[object, np.ndarray], np.ndarray]
    window_names: Callable[[object, np.ndarray], np.ndarray]
    finish: Callable[[bytes, np.ndarray, np.ndarray | None], tuple]
    columns: tuple[tuple[str, str, pa.DataType], ...]


@dataclass
class Block:
    """Pieces of documents in one array: piece j is ``units[start[j]:end[j]]`` of row ``row[j]``, from
    that row's unit ``offset[j]`` on."""
    units: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    offset: np.ndarray

    def windows(self, window: int) -> np.ndarray:
        """Starts of all windows inside pieces."""
        n = self.end - self.start - window + 1
        return np.repeat(self.start - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())

    def piece(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.start, at, "right") - 1


def blocks(units: list[np.ndarray], window: int, size: int = BLOCK) -> Iterator[Block]:
    """All windows of all rows once, in blocks of about ``size`` units; pieces of a long row overlap by
    a window less one unit."""
    held: list[tuple[int, int, np.ndarray]] = []
    n = 0

    def block():
        lens = np.array([len(u) for _, _, u in held])
        end = np.cumsum(lens)
        return Block(np.concatenate([u for _, _, u in held]), end - lens, end,
                     np.array([r for r, _, _ in held]), np.array([o for _, o, _ in held]))
    for r, u in enumerate(units):
        for o in range(0, max(0, len(u) - window + 1), size):
            held.append((r, o, u[o:o + size + window - 1]))
            n += len(held[-1][2])
            if n >= size:
                yield block()
                held, n = [], 0
    if held:
        yield block()


def _planes(a: np.ndarray) -> bytes:
    planes = a.astype("<u8").view(np.uint8).reshape(-1, 8).T
    used = planes.any(axis=1)
    return bytes([int(np.packbits(used, bitorder="little")[0])]) + planes[used].tobytes()


def _unplanes(b: bytes) -> np.ndarray:
    used = np.flatnonzero(np.unpackbits(np.frombuffer(b, np.uint8, 1), bitorder="little"))
    if not len(used):
        raise ValueError("empty message")
    planes = np.frombuffer(b, np.uint8, offset=1).reshape(len(used), -1)
    d = np.zeros((planes.shape[1], 8), np.uint8)
    d[:, used] = planes.T
    return d.view("<u8").ravel()


def plain(a: np.ndarray) -> bytes:
    """Unsigned integers as byte planes, without planes that are all zero."""
    return _planes(np.r_[a, np.uint64(1 << 63)].astype(np.uint64))


def unplain(b: bytes) -> np.ndarray:
    return _unplanes(b)[:-1]


def pack(a: np.ndarray) -> bytes:
    """Sorted unsigned integers as byte planes of their differences, which are mostly small."""
    return plain(np.diff(a, prepend=np.uint64(0)))


def unpack(b: bytes) -> np.ndarray:
    return np.cumsum(unplain(b), dtype=np.uint64)


def send(names: np.ndarray, extra: np.ndarray, part: int, buckets: int, first_bucket: int = 0) -> pa.Table:
    """Sorted names with a number each, as one message per bucket; buckets are ranges of names."""
    place = ((names >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    cuts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(place) else np.zeros(0, int)
    ends = np.r_[cuts[1:], len(place)] if len(cuts) else cuts
    return pa.Table.from_arrays([
        pa.array(place[cuts] + first_bucket, pa.int32()), pa.array(np.full(len(cuts), part), pa.int32()),
        pa.array([pack(names[a:z]) for a, z in zip(cuts, ends)], pa.binary()),
        pa.array([plain(extra[a:z]) for a, z in zip(cuts, ends)], pa.binary())], schema=_MESSAGE)


def received(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names, their numbers, and the row of ``t`` each comes from."""
    names = [unpack(b) for b in t.column("names").to_pylist()]
    extra = [unplain(b) for b in t.column("extra").to_pylist()]
    row = np.repeat(np.arange(len(names)), [len(n) for n in names])
    return (np.concatenate(names) if names else np.zeros(0, np.uint64),
            np.concatenate(extra) if extra else np.zeros(0, np.uint64), row)


def replies(t: pa.Table, names: np.ndarray, extra: np.ndarray, row: np.ndarray, yes: np.ndarray,
            kind: int = REPLY) -> pa.Table:
    """To each part, those of its names that ``yes`` marks, sorted."""
    part = np.asarray(t.column("part"))
    out = []
    at, ns, ex = row[yes], names[yes], extra[yes]
    order = np.lexsort((ns, at))
    at, ns, ex = at[order], ns[order], ex[order]
    cuts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.zeros(0, int)
    for a, z in zip(cuts, np.r_[cuts[1:], len(at)] if len(cuts) else cuts):
        out.append({"bucket": kind, "part": int(part[at[a]]), "names": pack(ns[a:z]), "extra": plain(ex[a:z])})
    return pa.Table.from_pylist(out, schema=_MESSAGE)


def _groups(names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order that sorts the names, first place of each distinct name in it, copies of each)."""
    order = np.argsort(names, kind="stable")
    s = names[order]
    first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
    return order, first, np.diff(np.r_[first, len(s)])


def _shared(t: pa.Table) -> pa.Table:
    """Sampled names, extra 1 if one part alone has the name in several documents: to every part the
    names that are not of one document alone."""
    names, many, row = received(t)
    order, first, size = _groups(names)
    yes = np.zeros(len(names), bool)
    yes[order] = np.repeat((size > 1) | (many[order][first] > 0), size)
    return replies(t, names, many, row, yes)


def _earlier(t: pa.Table, kind: int) -> pa.Table:
    """Names, extra the smallest document of the part: to every part the names that a smaller document
    of another part has, with the smallest of all."""
    names, least, row = received(t)
    order, first, size = _groups(names)
    low = np.empty_like(least)
    low[order] = np.repeat(np.minimum.reduceat(least[order], first), size)
    return replies(t, names, low, row, low < least, kind)


def _answer_samples(buckets: int):
    def run(key, t):
        return _shared(t) if key[0].as_py() < buckets else _earlier(t, CHUNK)
    return run


def _answer_windows(key, t):
    """Notes of a part to itself just go on."""
    if key[0].as_py() < 0:
        return t.set_column(0, "bucket", pa.array(np.full(t.num_rows, NOTE), pa.int32()))
    return _earlier(t, REPLY)


def copies_of(docs: DataFrame) -> DataFrame:
    """Documents whose whole text a document with a smaller id has: (doc, h1). Texts are compared by
    two 64-bit hashes and length; only those leave the scan."""
    h = docs.select("doc", "h1", F.xxhash64(F.lit(1), "text").alias("h2"), F.length("text").alias("n"))
    least = h.groupBy("h1", "h2", "n").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("most > least")
    return h.join(least, ["h1", "h2", "n"]).where("doc > least").select("doc", "h1").distinct()


def _rows(t: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    """Orders (unsigned) and texts of a part's documents, in an order that does not depend on arrival."""
    rows = sorted(zip(t.column("doc").to_pylist(), t.column("text").to_pylist()))
    doc = np.array([d for d, _ in rows], dtype=np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return doc, [x for _, x in rows]


def _least(names: list[np.ndarray], docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct names sorted, smallest document, largest document of each)."""
    n, d = np.concatenate(names), np.concatenate(docs)
    if not len(n):
        return n, d, d
    order, first, _ = _groups(n)
    return n[order][first], np.minimum.reduceat(d[order], first), np.maximum.reduceat(d[order], first)


def _find(table: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index in the sorted table, found or not)."""
    if not len(table):
        return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    i = np.minimum(np.searchsorted(table, x), len(table) - 1)
    return i, table[i] == x


class Sampled:
    """A block's windows ``at`` with the number of each one's sample (or -1), the places of the samples,
    and chunks: windows ``at[first[i]:first[i] + size[i]]`` share a sample, ``named[i]`` if they have one."""

    def __init__(self, m: Method, b: Block):
        self.m, self.b, self.state, self.at = m, b, m.state(b.units), b.windows(m.window)
        anchor = m.anchors(self.state)[self.at]
        used = np.zeros(len(b.units), bool)
        used[anchor[anchor >= 0]] = True
        self.number = np.where(anchor >= 0, (np.cumsum(used) - 1)[anchor], -1)
        self.places = np.flatnonzero(used)
        self.first = np.flatnonzero(np.r_[True, (np.diff(self.at) != 1) | (np.diff(anchor) != 0)])
        self.size = np.diff(np.r_[self.first, len(self.at)])
        self.named = anchor[self.first] >= 0

    def sample_names(self) -> np.ndarray:
        return self.m.sample_names(self.state, self.places)

    def chunk_names(self) -> np.ndarray:
        """Of the named chunks. Their windows overlap, so first and last name all of their content."""
        f, n = self.first[self.named], self.size[self.named]
        a, z = (self.m.window_names(self.state, self.at[i]) for i in (f, f + n - 1))
        return mix64(a * GOLD + z + n.astype(np.uint64) * MIX1)

    def owner(self, at: np.ndarray, doc: np.ndarray) -> np.ndarray:
        return doc[self.b.row[self.b.piece(at)]]


def _runs(k: int, at: np.ndarray, kind: int) -> np.ndarray:
    """Runs of consecutive windows of block ``k`` as numbers (kind, block, first, length)."""
    first = np.flatnonzero(np.r_[True, np.diff(at) != 1]) if len(at) else np.zeros(0, int)
    return np.stack([np.full(len(first), kind), np.full(len(first), k), at[first], np.diff(np.r_[first, len(at)])], axis=1).ravel()


def _windows(runs: np.ndarray) -> np.ndarray:
    first, n = runs[:, 2], runs[:, 3]
    return np.repeat(first - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())


def _ask_samples(m: Method, buckets: int):
    def run(key, t):
        doc, texts = _rows(t)
        names, whose, chunks, owner = [], [], [], []
        for b in blocks(m.units(texts), m.window):
            s = Sampled(m, b)
            names.append(s.sample_names())
            whose.append(s.owner(s.places, doc))
            chunks.append(s.chunk_names())
            owner.append(s.owner(s.at[s.first[s.named]], doc))
        if not names or not sum(map(len, names)):
            return _MESSAGE.empty_table()
        part = key[0].as_py()
        n, low, high = _least(names, whose)
        c, least, _ = _least(chunks, owner)
        return pa.concat_tables([send(n, (low != high).astype(np.uint64), part, buckets), send(c, least, part, buckets, buckets)])
    return run


def _kind(t: pa.Table, kind: int) -> pa.Table:
    return t.filter(pa.array(np.asarray(t.column("bucket")) == kind, pa.bool_()))


def _told(t: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted names, numbers) of the messages of one kind."""
    names, extra, _ = received(_kind(t, kind))
    order = np.argsort(names)
    return names[order], extra[order]


def _ask_windows(m: Method, buckets: int):
    """Names of all open windows that may be repeats, with the part's smallest document each, and a note
    to the part itself: runs of settled (1) and of open windows (0)."""
    def run(key, t, answers):
        part = key[0].as_py()
        shared, _ = _told(answers, REPLY)
        chunk, chunk_low = _told(answers, CHUNK)
        doc, texts = _rows(t)
        cut = list(blocks(m.units(texts), m.window))
        mine = []  # chunk names of candidates with their documents: what the part knows by itself
        for b in cut:
            s = Sampled(m, b)
            hit = np.r_[_find(shared, s.sample_names())[1], True][s.number] if len(s.at) else np.zeros(0, bool)
            c = hit[s.first] & s.named
            mine.append((hit, c, s.chunk_names()[c[s.named]], s.owner(s.at[s.first[c]], doc)))
        if not mine:
            return _MESSAGE.empty_table()
        n, least, _ = _least([x[2] for x in mine], [x[3] for x in mine])
        i, yes = _find(chunk, n)
        if len(chunk):
            least[yes] = np.minimum(least[yes], chunk_low[i[yes]])
        names, whose, notes = [], [], []
        for k, (b, (hit, c, cn, d)) in enumerate(zip(cut, mine)):
            if not hit.any():
                continue
            s = Sampled(m, b)
            settled = np.zeros(len(s.first), bool)
            settled[c] = least[_find(n, cn)[0]] < d if len(cn) else False
            done = np.repeat(settled, s.size)
            notes.append(_runs(k, s.at[done], 1))
            at = s.at[hit & ~done]
            if len(at):
                notes.append(_runs(k, at, 0))
                names.append(m.window_names(s.state, at))
                whose.append(s.owner(at, doc))
        if not notes:
            return _MESSAGE.empty_table()
        note = pa.Table.from_pylist([{"bucket": -1 - part, "part": part, "names": plain(np.concatenate(notes).astype(np.uint64)),
                                      "extra": plain(np.zeros(0, np.uint64))}], schema=_MESSAGE)
        if not names:
            return note
        w, low, _ = _least(names, whose)
        return pa.concat_tables([send(w, low, part, buckets), note])
    return run


def _remove(m: Method):
    def run(key, t, answers):
        doc, texts = _rows(t)
        units = m.units(texts)
        covered: dict[int, np.ndarray] = {}

        def cover(b: Block, at: np.ndarray):
            j = b.piece(at)
            cuts = np.flatnonzero(np.r_[True, j[1:] != j[:-1]]) if len(j) else []
            for a, z in zip(cuts, [*cuts[1:], len(j)]):
                p = j[a]
                r = int(b.row[p])
                if r not in covered:
                    covered[r] = np.zeros(len(units[r]) + 1, np.int32)
                w = at[a:z] - b.start[p] + b.offset[p]
                covered[r][w] += 1
                covered[r][w + m.window] -= 1

        note = _kind(answers, NOTE)
        if note.num_rows:
            told, low = _told(answers, REPLY)
            runs = unplain(note.column("names")[0].as_py()).astype(np.int64).reshape(-1, 4)
            found = []  # (block, windows, names, documents) of open windows
            for k, b in enumerate(blocks(units, m.window)):
                here = runs[runs[:, 1] == k]
                cover(b, _windows(here[here[:, 0] == 1]))
                at = _windows(here[here[:, 0] == 0])
                if len(at):
                    found.append((b, at, m.window_names(m.state(b.units), at), doc[b.row[b.piece(at)]]))
            if found:
                n, own, _ = _least([f[2] for f in found], [f[3] for f in found])
                i, yes = _find(told, n)
                own[yes] = low[i[yes]]
                for b, at, name, d in found:
                    cover(b, at[own[_find(n, name)[0]] < d])
        out = [m.finish(x, u, np.cumsum(covered[r][:-1]) > 0 if r in covered else None)
               for r, (x, u) in enumerate(zip(texts, units))]
        ids = (doc ^ np.uint64(1 << 63)).view(np.int64)
        return pa.Table.from_arrays([pa.array(ids)] + [pa.array([o[i] for o in out], c[2]) for i, c in enumerate(m.columns)],
                                    names=["doc", *[c[0] for c in m.columns]])
    return run


def _whole(m: Method):
    """Copies of whole texts: all is removed if there is a window at all."""
    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            out = [m.finish(x, u, np.ones(len(u), bool) if len(u) >= m.window else None) for x, u in zip(texts, m.units(texts))]
            yield pa.RecordBatch.from_arrays([b.column(0)] + [pa.array([o[i] for o in out], c[2]) for i, c in enumerate(m.columns)],
                                             names=["doc", *[c[0] for c in m.columns]])
    return run


def remove_repeats(docs: DataFrame, method: Method, id_col: str, text_col: str) -> DataFrame:
    """One row per row of ``docs``: ``id_col`` and the method's columns."""
    spark = docs.sparkSession
    n = shuffle_partitions(spark)
    parts, buckets = 2 * n, n
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(int(LAST))).alias("doc"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("doc", "text", F.xxhash64("text").alias("h1"))
    copies = copies_of(rows).checkpoint()
    if copies.count() <= BROADCAST_COPIES:
        copies = F.broadcast(copies)
    binary = ["doc", F.col("text").cast("binary").alias("text")]
    part = F.pmod(F.xxhash64("doc"), F.lit(parts)).cast("int").alias("part")
    firsts = rows.join(copies, ["doc", "h1"], "left_anti").select(part, *binary)
    again = rows.join(copies, ["doc", "h1"], "left_semi").select(*binary)

    dealt = firsts.groupBy("part")
    samples = dealt.applyInArrow(_ask_samples(method, buckets), MESSAGE)
    shared = samples.groupBy("bucket").applyInArrow(_answer_samples(buckets), MESSAGE)
    windows = dealt.cogroup(shared.groupBy("part")).applyInArrow(_ask_windows(method, buckets), MESSAGE)
    earlier = windows.groupBy("bucket").applyInArrow(_answer_windows, MESSAGE)
    ddl = "doc long, " + ", ".join(f"{c[0]} {c[1]}" for c in method.columns)
    out = dealt.cogroup(earlier.groupBy("part")).applyInArrow(_remove(method), ddl)
    out = out.unionByName(again.mapInArrow(_whole(method), ddl))
    back = F.when(F.col("doc") != int(LAST), F.col("doc")).alias(id_col)
    return out.select(back, *[c[0] for c in method.columns])
