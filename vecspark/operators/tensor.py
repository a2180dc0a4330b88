"""Tensor-table operators over packed (``array`` column) and long (``<id, pos, v>``) forms.

O3 tensor_table (see sources.literals), O15 elementwise, O16 cast_vec, O17 reshape,
O18 shape_of, O19 image_layout, O20 stack_columns / stack_rows, O24 argmax,
O27 reduce_all, O28 reduce_columns, O29 column_argmax, O30 reduce_rows / context_mean.

Axis 0 is the table's row axis. Reductions over axis 0 fold each task's rows into one row of
partial vectors and merge these in a tree; reductions over axis 1 stay inside the row (no shuffle).
"""

from __future__ import annotations

from functools import reduce
from math import prod

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vec as V
from ..functions.arrow import from_matrix, to_matrix



def to_long(df: DataFrame, id_col: str, vec_col: str, value: str = "v") -> DataFrame:
    """Packed -> long: ``<id, pos, v>`` with 0-based ``pos``."""
    return df.select(id_col, F.posexplode(vec_col).alias("pos", value))


def to_packed(long_df: DataFrame, id_col: str, value: str = "v", vec_col: str = "vec") -> DataFrame:
    """Long -> packed. Groups are single rows of a tensor, bounded by its row length."""
    return (long_df.groupBy(id_col)
            .agg(F.sort_array(F.collect_list(F.struct("pos", value))).alias("_s"))
            .select(id_col, F.col(f"_s.{value}").alias(vec_col)))


def elementwise(df: DataFrame, col: str, ops: list[tuple[str, float]], out: str | None = None) -> DataFrame:
    """Apply a chain of scalar ops (``add``, ``sub``, ``mul``, ``div``) to every element."""
    fns = {"add": lambda x, k: x + k, "sub": lambda x, k: x - k,
           "mul": lambda x, k: x * k, "div": lambda x, k: x / k}

    def step(c, op):
        name, k = op
        f = fns[name]
        return F.transform(c, lambda x: f(x, F.lit(k)))

    return df.withColumn(out or col, reduce(step, ops, F.col(col)))


def cast_vec(df: DataFrame, col: str, elem_type: str, out: str | None = None) -> DataFrame:
    """Change the element type of an array column (e.g. ``double``, ``float``, ``int``)."""
    return df.withColumn(out or col, F.col(col).cast(f"array<{elem_type}>"))


def infer_shape(shape: list[int], numel: int) -> list[int]:
    """Resolve one ``-1`` axis from the element count, as ``reshape``/``view`` do."""
    known = prod(s for s in shape if s != -1)
    if shape.count(-1) > 1:
        raise ValueError("only one axis may be -1")
    if -1 in shape:
        if numel % known:
            raise ValueError(f"cannot reshape {numel} elements into {shape}")
        shape = [numel // known if s == -1 else s for s in shape]
    if prod(shape) != numel:
        raise ValueError(f"cannot reshape {numel} elements into {shape}")
    return shape


def reshape(long_df: DataFrame, shape: list[int], numel: int, pos: str = "pos",
            names: list[str] | None = None) -> DataFrame:
    """Give each row-major position its indices in ``shape`` (flatten/view/squeeze/unsqueeze
    are all re-indexing; the data does not move). Adds ``i0..ik`` (or ``names``)."""
    shape = infer_shape(list(shape), numel)
    names = names or [f"i{k}" for k in range(len(shape))]
    strides = [prod(shape[k + 1:]) for k in range(len(shape))]
    idx = [F.expr(f"cast(({pos} div {st}) % {n} as int)").alias(nm)
           for nm, st, n in zip(names, strides, shape)]
    return long_df.select("*", *idx)


def shape_of(df: DataFrame, vec_col: str) -> DataFrame:
    """Rows, row length (checked equal for all rows), rank and element count."""
    s = F.size(vec_col)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.max(s).alias("n_cols"),
                  F.min(s).alias("min_cols"), F.sum(s).alias("numel")) \
        .select("n_rows", "n_cols", F.lit(2).alias("rank"), "numel",
                (F.col("min_cols") == F.col("n_cols")).alias("uniform"))


def image_layout(long_df: DataFrame, h: int, w: int, c: int, mode: str = "reshape") -> DataFrame:
    """(N, H, W, C) -> (N, C, H, W) per row of the long form.

    ``reshape`` keeps the flat order and only re-reads it as (C, H, W) -- the reference's
    behaviour, which scrambles pixels; ``transpose`` moves the channel axis first.
    Adds ``ch, y, x`` and ``new_pos`` (position in the (C, H, W) layout)."""
    p = F.col("pos")
    if mode == "reshape":
        return long_df.select("*", F.expr(f"cast(pos div {h * w} as int)").alias("ch"),
                              F.expr(f"cast((pos div {w}) % {h} as int)").alias("y"),
                              F.expr(f"cast(pos % {w} as int)").alias("x"),
                              p.alias("new_pos"))
    if mode == "transpose":
        return long_df.select("*", F.expr(f"cast(pos % {c} as int)").alias("ch"),
                              F.expr(f"cast(pos div {w * c} as int)").alias("y"),
                              F.expr(f"cast((pos div {c}) % {w} as int)").alias("x")) \
            .withColumn("new_pos", (F.col("ch") * (h * w) + F.col("y") * w + F.col("x")).cast("int"))
    raise ValueError(mode)


def stack_columns(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Place two columns side by side (equi-join on the row key)."""
    return a.join(b, key, "inner")


def stack_rows(dfs: list[DataFrame], axis_name: str = "k") -> DataFrame:
    """Stack tables along a new leading axis (union all + literal axis index)."""
    return reduce(lambda x, y: x.unionByName(y),
                  [d.withColumn(axis_name, F.lit(i)) for i, d in enumerate(dfs)])


def argmax(df: DataFrame, vec_col: str, out: str = "idx") -> DataFrame:
    """O24 over axis 1 (per row) on the packed form; ties -> lowest index. No shuffle."""
    return df.withColumn(out, V.argmax(vec_col))


def argmax_all(df: DataFrame, id_col: str, vec_col: str, n_cols: int) -> DataFrame:
    """O24 over the whole tensor: flat row-major index ``id * n_cols + pos`` of the largest
    element (ties -> lowest flat index) and its value. ``id`` is the dense 0-based row index.
    One partially aggregated row -- no task sees more than its own split."""
    lg = df.select(F.col(id_col).cast("long").alias("_id"), F.posexplode(vec_col).alias("pos", "v"))
    flat = F.col("_id") * F.lit(n_cols) + F.col("pos")
    return lg.agg(F.max_by(flat, F.struct(F.col("v"), -flat)).alias("idx"), F.max("v").cast("double").alias("max"))


def reduce_all(long_df: DataFrame, value: str = "v") -> DataFrame:
    """Whole-tensor sum, mean, sample standard deviation and element count (double sums)."""
    v = F.col(value).cast("double")
    return long_df.agg(F.sum(v).alias("sum"), F.avg(v).alias("mean"),
                       F.stddev_samp(v).alias("std"), F.count(v).alias("numel"))


def _columns(vec: pa.Array):
    """(rows, matrix) of the vectors of each length in a batch; null vectors left out, null elements NaN in ``matrix``
    and False in ``there``: (rows, matrix, there)."""
    if isinstance(vec, pa.ChunkedArray):
        vec = vec.combine_chunks()
    offs = vec.offsets.to_numpy()
    lens, valid = np.diff(offs), ~vec.is_null().to_numpy(zero_copy_only=False)
    there = ~vec.values.is_null().to_numpy(zero_copy_only=False)
    flat = vec.values.to_numpy(zero_copy_only=False).astype(np.float64)
    for d in np.unique(lens[valid]):
        rows = np.flatnonzero(valid & (lens == d))
        at = offs[rows][:, None] + np.arange(d)
        yield rows, flat[at], there[at]


def _widen(state: dict, d: int) -> dict:
    """The state of the first ``d`` columns or more; columns not seen yet count no value."""
    grow = d - len(state["n"])
    if grow <= 0:
        return state
    fill = {"n": 0, "sum": 0.0, "m2": 0.0, "max": -np.inf, "row": _NO_ROW}
    return {k: np.concatenate([v, np.full(grow, fill[k], dtype=v.dtype)]) for k, v in state.items()}


#: Stands for no row; larger than any id.
_NO_ROW = np.iinfo(np.int64).max


def _merge_moments(a: dict, b: dict) -> dict:
    a, b = _widen(a, len(b["n"])), _widen(b, len(a["n"]))
    n = a["n"] + b["n"]
    safe = np.maximum(n, 1)
    gap = np.where((a["n"] > 0) & (b["n"] > 0), b["sum"] / np.maximum(b["n"], 1) - a["sum"] / np.maximum(a["n"], 1), 0.0)
    return {"n": n, "sum": a["sum"] + b["sum"], "m2": a["m2"] + b["m2"] + gap ** 2 * a["n"] * b["n"] / safe,
            "max": np.where(b["n"] == 0, a["max"], np.where(a["n"] == 0, b["max"], np.maximum(a["max"], b["max"])))}


def _moments(state, b):
    for _, x, there in _columns(b.column(0)):
        n = there.sum(axis=0)
        zero = np.where(there, x, 0.0)
        total = zero.sum(axis=0)
        off = np.where(there, x - total / np.maximum(n, 1), 0.0)
        one = {"n": n, "sum": total, "m2": (off ** 2).sum(axis=0), "max": np.where(there, x, -np.inf).max(axis=0)}
        state = one if state is None else _merge_moments(state, one)
    return state


def reduce_columns(df: DataFrame, vec_col: str) -> DataFrame:
    """Reduce over axis 0 -- sum, max, mean, sample std per position (null elements and vectors are left out).

    Each task folds its batches into vectors of counts, sums, maxima and squared deviations; one row
    a task is shuffled and merged in a tree. Vectors may differ in length."""
    from .partials import merged_state, rows_of_state

    def rows(s):
        n = s["n"]
        some = n > 0
        mean = np.divide(s["sum"], n, out=np.zeros(len(n)), where=some)
        std = np.sqrt(np.divide(s["m2"], n - 1, out=np.zeros(len(n)), where=n > 1))
        cols = [pa.array(np.arange(len(n), dtype=np.int32)), *(pa.array(c, mask=~some) for c in (s["sum"], s["max"], mean)), pa.array(std, mask=n < 2)]
        return pa.RecordBatch.from_arrays(cols, names=["pos", "sum", "max", "mean", "std"])
    states = merged_state(df.select(vec_col), _moments, _merge_moments)
    return rows_of_state(states, rows, "pos int, sum double, max double, mean double, std double")


def _merge_arg(a: dict, b: dict) -> dict:
    a, b = _widen(a, len(b["n"])), _widen(b, len(a["n"]))
    # NaN counts as the largest value, as in Spark
    same = (a["max"] == b["max"]) | (np.isnan(a["max"]) & np.isnan(b["max"]))
    later = (b["max"] > a["max"]) | (np.isnan(b["max"]) & ~np.isnan(a["max"]))
    return {"n": a["n"] + b["n"], "max": np.where(later, b["max"], a["max"]),
            "row": np.where(same, np.minimum(a["row"], b["row"]), np.where(later, b["row"], a["row"]))}


def _arg(state, b):
    ids = b.column(0).to_numpy(zero_copy_only=False)
    for rows, x, there in _columns(b.column(1)):
        x = np.where(there, x, -np.inf)
        top = x.max(axis=0)
        hit = there & ((x == top) | (np.isnan(x) & np.isnan(top)))
        one = {"n": there.sum(axis=0), "max": top, "row": np.where(hit, ids[rows][:, None], _NO_ROW).min(axis=0)}
        state = one if state is None else _merge_arg(state, one)
    return state


def column_argmax(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Per position, the largest value over the rows and the row id holding it (ties -> lowest id), by the
    same tree of per-task vectors as :func:`reduce_columns`. Ids are integers; rows without id are left out."""
    from .partials import merged_state, rows_of_state

    def rows(s):
        none = s["n"] == 0
        cols = [pa.array(np.arange(len(none), dtype=np.int32)), pa.array(s["max"], mask=none), pa.array(s["row"], mask=none)]
        return pa.RecordBatch.from_arrays(cols, names=["pos", "max", "row"])
    ids = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("_id"), vec_col)
    return rows_of_state(merged_state(ids, _arg, _merge_arg), rows, "pos int, max double, row long")


def reduce_rows(df: DataFrame, vec_col: str, out: str = "sum") -> DataFrame:
    """Reduce over axis 1 -- sum per row, inside the row (no shuffle)."""
    return df.withColumn(out, V.vsum(vec_col))


def _sliced_mean(windows: DataFrame, vecs: DataFrame, ctx_cols: list[str], key: list[str], d: int, width: int, group: int, digest: bool, schema: str) -> DataFrame:
    """:func:`context_mean` over slices of ``width`` of the vectors' ``d`` columns. The vectors are staged once, a column for each place, so that a
    slice reads its own columns only; each slice is collected, broadcast and let go by the driver before the next, its rows as the scan has them. A task
    loads the slices one after the other for each ``group`` bytes of its windows."""
    from ..session import scratch_path

    spark, n = windows.sparkSession, len(ctx_cols)
    path = scratch_path(spark, "vector-columns")
    vecs.where("vec is not null and word_id is not null").select("word_id", *[F.col("vec")[i].alias(f"v{i}") for i in range(d)]).write.parquet(path)
    columns = spark.read.schema("word_id long, " + ", ".join(f"v{i} double" for i in range(d))).parquet(path)
    low, high = columns.agg(F.min("word_id"), F.max("word_id")).first()
    base = low if high - low < 1 << 62 else 0
    short = (F.col("word_id") - F.lit(base)).cast("int" if high - low < 1 << 31 else "long").alias("i")
    first, known, slices = None, None, []
    for a in range(0, d, width):
        part = columns.select(short, *[f"v{i}" for i in range(a, min(d, a + width))]).toArrow()
        ids = part.column("i").to_numpy()
        E = np.empty((len(ids), part.num_columns - 1))
        for i in range(E.shape[1]):
            E[:, i] = part.column(i + 1).to_numpy()
        del part
        if known is None:
            put = np.argsort(ids, kind="stable")
            sorted_ids = ids[put]
            dense = len(ids) == high - low + 1 and (np.diff(sorted_ids) == 1).all()
            known = spark.sparkContext.broadcast((None if dense else sorted_ids, put.astype(np.int32 if len(ids) < 1 << 31 else np.int64)))
            first = ids
            del put, sorted_ids
        elif not np.array_equal(ids, first):  # rows of another order than the first slice's
            E[np.argsort(first, kind="stable")] = E[np.argsort(ids, kind="stable")]
        slices.append((a, spark.sparkContext.broadcast(E)))
        del E, ids
    del first
    names = key + (["msum", "mnorm"] if digest else ["mean"])

    def places(b):
        """(row of the matrix, whether there is one) of each context id."""
        ctx = np.stack([b.column(c).fill_null(_NO_ROW).to_numpy(zero_copy_only=False) for c in ctx_cols], axis=1).astype(np.int64)
        ids, put = known.value
        there = (ctx >= low) & (ctx <= high)
        at = np.where(there, ctx - base, 0)
        if ids is not None:
            off = at.astype(ids.dtype)
            at = np.minimum(np.searchsorted(ids, off), len(ids) - 1)
            there &= ids[at] == off
            at = np.where(there, at, 0)
        return put[at], there.all(axis=1)

    def let_go(bc):
        bc.__dict__.pop("_value", None)  # a worker keeps what it has loaded, and lives on; it can load it again

    def flush(held):
        at, there = (np.concatenate(x) for x in zip(*(places(b) for b in held)))
        let_go(known)
        out = np.zeros((len(at), 2 if digest else d))
        for a, bc in slices:
            E = bc.value
            for i in range(0, len(at), 4096):
                rows = at[i:i + 4096]
                acc = E.take(rows[:, 0], axis=0)
                for k in range(1, n):
                    acc += E.take(rows[:, k], axis=0)
                acc /= float(n)
                if digest:
                    out[i:i + 4096, 0] += acc.sum(axis=1)
                    out[i:i + 4096, 1] += np.einsum("ij,ij->i", acc, acc)
                else:
                    out[i:i + 4096, a:a + E.shape[1]] = acc
            del E
            let_go(bc)
        begin = 0
        for b in held:
            mean, ok = out[begin:begin + b.num_rows], there[begin:begin + b.num_rows]
            begin += b.num_rows
            made = [pa.array(c, mask=~ok) for c in (mean[:, 0], np.sqrt(mean[:, 1]))] if digest else [from_matrix(mean, ok)]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in key] + made, names=names)

    def kernel(batches):
        held, size = [], 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                size += b.nbytes + b.num_rows * (8 * n + (16 if digest else 8 * d))
            if size > group:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)

    more = [c for c in ctx_cols if c not in key]
    return windows.select(*key, *[F.col(c).cast("long").alias(c) for c in more]).mapInArrow(kernel, schema)


def context_mean(windows: DataFrame, vectors: DataFrame, ctx_cols: list[str], key: list[str],
                 broadcast_bytes: int | None = None, digest: bool = False, sliced_bytes: int | None = None) -> DataFrame:
    """Mean of the context words' vectors per window (padding id 0 included), one row per window; null where a
    context id has no vector.

    A vector table within the measured broadcast bound is collected once (Arrow) into a NumPy matrix and broadcast, and every Arrow batch of
    windows gathers and averages its rows -- no shuffle. A larger one, up to ``sliced_bytes`` (the session's bound; none if only ``broadcast_bytes`` is
    given), is broadcast in slices of some of its columns: a mean's columns do not depend on each other, so a task holds a group of windows
    and one slice at a time (:func:`_sliced_mean`), and neither windows nor vectors are shuffled.

    Of a table beyond that as much of the vector table as fits the measured broadcast bound, lowest ids first (a vocabulary's most frequent words), is
    broadcast. Only windows with an id beyond it are shuffled: one row for each such id
    meets ``<word_id, vec>`` (hot ids are salted), and a window's rows, brought together again, are summed with
    the broadcast vectors of its other ids. Equal windows travel as one with their number. With ``digest`` only the mean's sum and norm (``msum``, ``mnorm``)
    leave the kernel, 16 bytes a window instead of the vector.
    """
    from .ranking import estimated_bytes, python_broadcast_limit, sliced_broadcast_limit

    n = len(ctx_cols)
    spark = windows.sparkSession
    limit = broadcast_bytes if broadcast_bytes is not None else python_broadcast_limit(spark)
    vecs = vectors.select(F.col("word_id").cast("long").alias("word_id"), V.to_double("vec").alias("vec"))
    kept = ", ".join(f"{c} {windows.schema[c].dataType.simpleString()}" for c in key)
    schema = kept + (", msum double, mnorm double" if digest else ", mean array<double>")
    names = key + (["msum", "mnorm"] if digest else ["mean"])

    def emit(cols, mean, there):
        if digest:
            made = [pa.array(c, mask=~there) for c in (mean.sum(axis=1), np.sqrt(np.einsum("ij,ij->i", mean, mean)))]
        else:
            made = [from_matrix(mean, there)]
        return pa.RecordBatch.from_arrays(cols + made, names=names)

    width = F.coalesce(F.size("vec"), F.lit(0)) * 8 + 8
    size, near, last = estimated_bytes(vecs, width), vecs, None
    if sliced_bytes is None:
        sliced_bytes = sliced_broadcast_limit(spark) if broadcast_bytes is None else 0
    if size > limit:
        least, d, rows = vecs.agg(F.min(F.size("vec")), F.max(F.size("vec")), F.count("vec")).first()
        if rows and least != d:
            raise ValueError("vectors of different lengths in one column")
        again = spark.sparkContext.getConf().get("spark.io.encryption.enabled", "false") != "true"  # else a worker gets all slices at once
        if rows and d and again and rows * (d + 1) * 8 <= sliced_bytes and rows * 16 <= limit:
            return _sliced_mean(windows, vecs, ctx_cols, key, d, max(1, limit // 8 // (8 * rows)), limit // 2, digest, schema)
        last = int(0.9 * limit / size * vecs.count())
        near = vecs.where(F.col("word_id") <= last)
        if last <= 0 or estimated_bytes(near, width) > limit:
            near, last = vecs.where("false"), -1 << 63
    tbl = near.toArrow()
    ids = tbl.column("word_id").to_numpy()
    M, _ = to_matrix(tbl.column("vec"))
    del tbl
    if (np.diff(ids) < 0).any():
        order = np.argsort(ids, kind="stable")
        M, ids = M[order], ids[order]
    bc = spark.sparkContext.broadcast((M, ids))  # addressed by search, whatever the largest id
    del M, ids

    def context(b):
        return np.stack([b.column(c).fill_null(_NO_ROW).to_numpy(zero_copy_only=False) for c in ctx_cols], axis=1).astype(np.int64)

    def gather(ctx):
        """(row of the matrix, whether there is one) of each context id."""
        known = bc.value[1]
        at = np.minimum(np.searchsorted(known, ctx), max(len(known) - 1, 0))
        there = known[at] == ctx if len(known) else np.zeros(ctx.shape, bool)
        return np.where(there, at, 0), there

    def kernel(batches):
        E = bc.value[0]
        for b in batches:
            at, there = gather(context(b))
            there = there.all(axis=1)
            at = np.where(there[:, None], at, 0)
            acc = E[at[:, 0]] if len(E) else np.zeros((len(at), 0))
            for k in range(1, n if len(E) else 1):
                acc = acc + E[at[:, k]]
            yield emit([b.column(c) for c in key], acc / float(n), there)

    more = [c for c in ctx_cols if c not in key]
    wide = windows.select(*key, *[F.col(c).cast("long").alias(c) for c in more])
    if last is None:
        return wide.mapInArrow(kernel, schema)

    beyond = F.coalesce(F.greatest(*[F.col(c).cast("long") for c in ctx_cols], F.lit(None).cast("long")) > last, F.lit(False))
    columns = [*key, *more]
    rare = wide.where(beyond).groupBy(*columns).agg(F.count(F.lit(1)).alias("_same"))
    slots = rare.withColumn("_c", F.explode(F.array(*[F.struct(F.lit(i).alias("slot"), F.col(c).cast("long").alias("word_id")) for i, c in enumerate(ctx_cols)])))
    slots = slots.where(F.col("_c.word_id") > last).select(*columns, "_same", F.col("_c.slot").alias("_slot"), F.col("_c.word_id").alias("word_id"))
    from .joins import hot_keys, salted_join
    hot = hot_keys(slots.groupBy("word_id").agg(F.count(F.lit(1)).alias("n")), "word_id", "n")
    j = (salted_join(slots, vecs.where(F.col("word_id") > last), "word_id", hot, [*columns, "_slot"], "left")
         .repartition(*[F.col(c) for c in columns]).sortWithinPartitions(*columns, "_slot"))

    def rest(batches):
        # the rows of a window are adjacent, one for each of its ids beyond the broadcast ones; a window may straddle two Arrow batches
        carry = None
        for b in batches:
            if carry is not None and carry.num_rows:
                b = pa.Table.from_batches([carry, b]).combine_chunks().to_batches()[0]
            ctx, slot = context(b), b.column("_slot").to_numpy()
            far = (ctx > last) & np.stack([b.column(c).is_valid().to_numpy(zero_copy_only=False) for c in ctx_cols], axis=1)
            first = np.flatnonzero(far.argmax(axis=1) == slot)
            whole = b.num_rows
            if len(first) and first[-1] + far[first[-1]].sum() > whole:
                whole, first = first[-1], first[:-1]
            carry = b.slice(whole)
            if not len(first):
                continue
            b, of = b.slice(0, whole), np.searchsorted(first, np.arange(whole), side="right") - 1
            at, there = gather(ctx[first])
            X, valid = to_matrix(b.column("vec"))
            E = bc.value[0]
            d = max(X.shape[1], E.shape[1])
            X = X if X.shape[1] else np.zeros((whole, d))
            V_ = E[at] if len(E) else np.zeros((*at.shape, d))
            V_[of, slot[:whole]] = X
            there[of, slot[:whole]] = valid
            acc = V_[:, 0]
            for k in range(1, n):
                acc = acc + V_[:, k]
            copies = np.repeat(np.arange(len(first)), b.column("_same").to_numpy()[first])
            yield emit([b.column(c).take(pa.array(first[copies])) for c in key], (acc / float(n))[copies], there.all(axis=1)[copies])

    return wide.where(~beyond).mapInArrow(kernel, schema).unionByName(j.select(*columns, "_same", "_slot", "vec").mapInArrow(rest, schema))
