"""Embedding operators: look-up, vector arithmetic, cosine, nearest, distance ranking, analogies.

O21 format_task, O22 filter_correct, O35 evaluate_analogies, O36 embed, O37 vector_combine,
O38 cosine, O39 nearest, O40 rank_by_distance / rank_of.

Look-ups broadcast the (small) set of requested keys and stream the big table through
an inner join, then left-join back, so unknown words stay visible as nulls and the
vocabulary / vector tables are never shuffled. A few queries against all vectors run as
``mapInArrow`` over the vector table with the query set broadcast (its size checked); each task
emits only its best ``k`` rows per query, and a final ranking over those partial results
gives the exact answer. Many queries are joined by pivots (:mod:`.knn`).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vec as V
from ..functions.arrow import from_matrix, to_matrix
from . import knn
from .ranking import estimated_bytes, fits_broadcast

MAX_QUERY_BYTES = 16 << 20    # query vectors broadcast to a scan; more are joined by pivots
PIECE = 1024    # vectors made or scored at a time in a Python worker, whatever the Arrow batch

# --- fixed values: the analogy task sentence of the report ---------------------
TASK_FORMAT = " '%s' is to '%s' as '%s' is to ?"
# -----------------------------------------------------------------------------


def lookup_small(keys: DataFrame, big: DataFrame, on: list[str]) -> DataFrame:
    """Left join a small key table to a big table without shuffling the big one.

    The distinct keys are broadcast (their bytes are measured) into an inner join that
    streams ``big``; the few matching rows are then left-joined back onto ``keys``.
    """
    k = keys.select(*on).distinct()
    width = [F.coalesce(F.length(c), F.lit(0)) if t == "string" else F.lit(8) for c, t in k.dtypes]
    if not fits_broadcast(k, sum(width[1:], width[0])):
        return keys.join(big, on, "left")
    hits = big.join(F.broadcast(k), on, "inner")
    return keys.join(hits, on, "left")


def materialize_small(df: DataFrame) -> DataFrame:
    """Write a small, bounded intermediate (query vectors, winners) to the shared checkpoint
    folder so later actions read it instead of recomputing its lineage."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def embed(words: DataFrame, vocab: DataFrame | None, emb: DataFrame, models: list[str]) -> DataFrame:
    """``words`` (with a ``word`` column) -> + ``word_id``, ``model``, ``vec``.

    One output row per input row and model; unknown words keep ``word_id``/``vec`` null. Without ``vocab`` the ids are
    there already.
    """
    w = words if vocab is None else lookup_small(words, vocab.select("word", "word_id"), ["word"])
    w = w.withColumn("model", F.explode(F.array(*[F.lit(m) for m in models])))
    return lookup_small(w, emb.select("model", F.col("word_id").cast(w.schema["word_id"].dataType)
                                      .alias("word_id"), "vec"), ["model", "word_id"])


def vector_combine(cols: list, weights: list[float]) -> Column:
    """Weighted sum of vector columns (``b - a + c`` = weights 1, -1, 1)."""
    return V.combine(cols, weights)


def cosine(a, b) -> Column:
    """O38 for one pair of vector columns; zero vector -> 0."""
    return V.cosine(a, b)


def format_task(a, b, c) -> Column:
    """The analogy sentence."""
    return F.format_string(TASK_FORMAT, a, b, c)


def filter_correct(report: DataFrame) -> DataFrame:
    """Keep report rows whose prediction is correct."""
    return report.where(F.col("correct"))


# ---------------------------------------------------------------- scans

def _collect_queries(queries: DataFrame, target_col: str | None = None) -> dict[str, dict] | None:
    """The queries by model, or None where they take more than ``MAX_QUERY_BYTES``."""
    excl = F.coalesce(F.size("exclude"), F.lit(0))
    if estimated_bytes(queries, (F.coalesce(F.size("qvec"), F.lit(0)) + excl) * 8) > MAX_QUERY_BYTES:
        return None
    pdf = queries.toPandas()
    plan: dict[str, dict] = {}
    for model, g in pdf.groupby("model", sort=False):
        plan[model] = {"qid": g["qid"].to_numpy(np.int64), "Q": np.stack([np.asarray(v, dtype=np.float64) for v in g["qvec"]]), "exclude": list(g["exclude"])}
        if target_col:
            plan[model] |= {"target": g[target_col].to_numpy(np.int64), "dist": g["dist"].to_numpy(np.float64)}
    return plan


def _scanned(vectors: DataFrame, plan: dict, rows, schema: str, fold=None) -> DataFrame:
    """The results ``rows(ids, matrix, the model's queries)`` yields over pieces of ``PIECE`` vectors, with the bounded queries broadcast; with
    ``fold`` they are folded to one result a task and model."""
    bc = vectors.sparkSession.sparkContext.broadcast(plan)
    names = [c.split()[0] for c in schema.split(", ")]

    def batch(model, who, *cols):
        return pa.RecordBatch.from_arrays([pa.array(bc.value[model]["qid"][who]), pa.array([model] * len(who), pa.string()), *map(pa.array, cols)], names=names)

    def kernel(batches):
        state: dict[str, tuple] = {}
        for whole in batches:
            for i in range(0, whole.num_rows, PIECE):
                b = whole.slice(i, PIECE)
                models = b.column("model")
                for model in pc.unique(models).to_pylist():
                    p = bc.value.get(model)
                    if p is None:
                        continue
                    g = b.filter(pc.equal(models, model))
                    X, valid = to_matrix(g.column("vec"))
                    ids = g.column("word_id").to_numpy(zero_copy_only=False).astype(np.int64)
                    for found in rows(ids[valid], X[valid], p):
                        if fold is not None:
                            state[model] = fold(state[model], found) if model in state else found
                        elif len(found[0]):
                            yield batch(model, *found)
        for model, found in state.items():
            if len(found[0]):
                yield batch(model, *found)
    return vectors.select("model", "word_id", "vec").mapInArrow(kernel, schema)


def similarity_scan(vectors: DataFrame, queries: DataFrame, metric: str = "cosine", k: int | None = 1, exclude_col: str | None = None) -> DataFrame:
    """The exact top ``k`` vectors of each query among those of the same model, with a ``rank`` column, ties
    broken by the lower ``word_id``; with ``k`` None the score of every vector, without a rank.

    vectors: ``<model, word_id, vec>``; queries: ``<qid, model, qvec[, exclude]>``.
    ``metric``: ``cosine`` (higher is better) or ``euclidean`` (lower is better). Queries of up to
    ``MAX_QUERY_BYTES`` are broadcast to one scan of the vectors; more are joined by pivots (:mod:`.knn`).
    """
    plain = knn._plain(queries, exclude_col)
    plan = _collect_queries(plain)
    fields = "qid long, model string, word_id long, score double"
    if k is None:
        if plan is None:
            score = V.cosine("qvec", "vec") if metric == "cosine" else V.norm(V.combine(["qvec", "vec"], [1.0, -1.0]))
            met = vectors.where("vec is not null").select("model", F.col("word_id").cast("long").alias("word_id"), "vec").join(plain, "model")
            met = met.where("exclude is null or not array_contains(exclude, word_id)")
            return met.select("qid", "model", "word_id", score.alias("score"))

        def every(ids, X, p):
            for j, excl in enumerate(p["exclude"]):
                keep = ~np.isin(ids, np.asarray(excl, dtype=np.int64)) if excl is not None and len(excl) else np.ones(len(ids), bool)
                yield np.full(int(keep.sum()), j), ids[keep], knn.scores(X[keep], p["Q"][j], metric)
        return _scanned(vectors, plan, every, fields)
    if plan is None:
        return knn.knn_join(vectors, plain, k, metric, "exclude")

    def rows(ids, X, p):
        yield knn.block_top(ids, X, p["Q"], k, metric, p["exclude"])

    def better(a, b):
        who, what, score = (np.concatenate(c) for c in zip(a, b))
        put = np.lexsort((what, -score if metric == "cosine" else score, who))
        who, what, score = who[put], what[put], score[put]
        keep = np.arange(len(who)) - np.searchsorted(who, who) < k
        return who[keep], what[keep], score[keep]
    scored = _scanned(vectors, plan, rows, fields, better)
    order = F.col("score").desc() if metric == "cosine" else F.col("score").asc()
    # groups hold at most (#tasks x k) partial winners, never a whole table
    w = Window.partitionBy("qid", "model").orderBy(order, F.col("word_id").asc())
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def nearest(vectors: DataFrame, queries: DataFrame, exclude_col: str | None = None) -> DataFrame:
    """Most similar vector (cosine) per query, excluding ``exclude_col`` ids; ties -> lower id."""
    top = similarity_scan(vectors, queries, "cosine", k=1, exclude_col=exclude_col)
    return top.select("qid", "model", "word_id", F.col("score").alias("sim"))


def rank_by_distance(vectors: DataFrame, queries: DataFrame, k: int = 100) -> DataFrame:
    """``k`` nearest vectors by Euclidean distance with ``rank`` 1..k (question words kept)."""
    return similarity_scan(vectors, queries, "euclidean", k=k).withColumnRenamed("score", "dist")


def rank_of(vectors: DataFrame, queries: DataFrame, target_col: str = "target") -> DataFrame:
    """Rank of a target word by Euclidean distance = 1 + number of strictly closer rows
    (equal distance and lower id counts as closer). Each task emits one count per query; queries beyond
    ``MAX_QUERY_BYTES`` are joined by pivots."""
    plain = queries.where("qvec is not null").select(F.col("qid").cast("long").alias("qid"), "model", F.col("qvec").cast("array<double>").alias("qvec"),
                                                     F.col(target_col).cast("long").alias(target_col))
    tv = lookup_small(plain.withColumnRenamed(target_col, "word_id"), vectors.select("model", F.col("word_id").cast("long").alias("word_id"), F.col("vec").alias("tvec")),
                      ["model", "word_id"]).where(F.col("tvec").isNotNull())

    def distance(batches):
        for b in batches:
            d = [float(knn.scores(np.array([t], dtype=np.float64), np.array(q), "euclidean")[0]) for t, q in zip(b.column("tvec").to_pylist(), b.column("qvec").to_pylist())]
            keep = b.select(["qid", "model", "qvec", target_col])
            yield pa.RecordBatch.from_arrays([*keep.columns, pa.array(d, pa.float64())], names=[*keep.schema.names, "dist"])
    fields = f"qid long, model string, qvec array<double>, {target_col} long, dist double"
    known = materialize_small(tv.withColumnRenamed("word_id", target_col).mapInArrow(distance, fields))
    plan = _collect_queries(known.withColumn("exclude", F.lit(None).cast("array<long>")), target_col)
    if plan is None:
        return knn.rank_join(vectors, known, target_col)

    def rows(ids, X, p):
        n = []
        for j in range(len(p["qid"])):
            d, t = knn.scores(X, p["Q"][j], "euclidean"), p["dist"][j]
            n.append(int((((d < t) | ((d == t) & (ids < p["target"][j]))) & (ids != p["target"][j])).sum()))
        yield np.arange(len(n)), np.array(n, np.int64)
    counts = _scanned(vectors, plan, rows, "qid long, model string, n long", lambda a, b: (a[0], a[1] + b[1])).groupBy("qid", "model").agg(F.sum("n").alias("n"))
    return known.join(counts, ["qid", "model"], "left").select("qid", "model", target_col, "dist", (F.coalesce(F.col("n"), F.lit(0)) + 1).alias("rank"))


def cosine_pairs(pairs: DataFrame, vectors: DataFrame, left: str = "qvec") -> DataFrame:
    """O38 for named pairs: each row of ``pairs`` (model, word_id and a vector column ``left``) with ``sim``, its cosine to
    that word's vector; null where the word has none."""
    met = lookup_small(pairs, vectors.select("model", "word_id", "vec"), ["model", "word_id"])
    return met.withColumn("sim", V.cosine(left, "vec")).drop("vec")


# ---------------------------------------------------------------- analogies

def analogy_predictions(questions: DataFrame, vocab: DataFrame, emb: DataFrame,
                        models: list[str]) -> DataFrame:
    """Per (qid, model): ids of a, b, c, d, the prediction ``b - a + c`` and sim1 = cos(d, prediction)."""
    roles = questions.select("qid", F.explode(F.array(*[
        F.struct(F.lit(r).alias("role"), F.col(r).alias("word")) for r in "abcd"])).alias("_r")) \
        .select("qid", "_r.role", "_r.word")
    looked = embed(roles, vocab, emb, models)
    piv = looked.groupBy("qid", "model").agg(
        *[F.first(F.when(F.col("role") == r, F.col("word_id")), ignorenulls=True).alias(f"id_{r}") for r in "abcd"],
        *[F.first(F.when(F.col("role") == r, F.col("vec")), ignorenulls=True).alias(f"v_{r}") for r in "abcd"])
    pred = V.combine(["v_b", "v_a", "v_c"], [1.0, -1.0, 1.0])
    return piv.select("qid", "model", *[f"id_{r}" for r in "abcd"],
                      pred.alias("qvec"), V.cosine("v_d", pred).alias("sim1"),
                      F.array_compact(F.array("id_a", "id_b", "id_c")).alias("exclude"))


def evaluate_analogies(questions: DataFrame, vocab: DataFrame, emb: DataFrame,
                       models: list[str]) -> DataFrame:
    """The analogy report, one row per (question, model).

    questions: ``<qid, relationship, a, b, c, d>`` (words); vocab: ``<word, word_id>``;
    emb: ``<model, word_id, vec>``. The search excludes the three question words.
    """
    preds = materialize_small(analogy_predictions(questions, vocab, emb, models))
    near = materialize_small(nearest(emb, preds, exclude_col="exclude"))
    named = lookup_small(near.select("qid", "model", F.col("word_id").cast(vocab.schema["word_id"].dataType)
                                     .alias("word_id"), "sim"),
                         vocab.select("word", "word_id"), ["word_id"])
    rep = (questions.select("qid", "relationship", "a", "b", "c", "d")
           .join(preds.select("qid", "model", "sim1"), "qid")
           .join(named.select("qid", "model", F.col("word").alias("predicted_word"), F.col("sim").alias("sim2")),
                 ["qid", "model"], "left"))
    return rep.select(
        F.col("relationship"), format_task("a", "b", "c").alias("task"), F.col("d").alias("true_word"),
        F.round("sim1", 6).alias("sim1"), "predicted_word", F.round("sim2", 6).alias("sim2"),
        F.col("model").alias("embedding"),
        F.coalesce(F.col("predicted_word") == F.col("d"), F.lit(False)).alias("correct"))


def formula_vectors(ids: DataFrame, id_col: str, dims: dict[str, int], pairs: int | None = None) -> DataFrame:
    """Formula-made vector sets ``<model, word_id, vec>``, one set per ``{model: dim}``,
    generated ``PIECE`` rows at a time with NumPy (identical doubles to the SQL formula). With ``pairs`` the ids 2i and 2i + 1 get the formula's
    vector of i, the odd one shifted by that of ``pairs``: analogies between pairs hold."""
    out = None
    for model, dim in dims.items():
        def gen(batches, dim=dim, model=model):
            for a in (b.column(0).slice(i, PIECE).to_numpy(zero_copy_only=False).astype(np.int64) for b in batches for i in range(0, b.num_rows, PIECE)):
                M = V.formula_matrix_np(a if pairs is None else a // 2, dim)
                if pairs is not None:
                    M = M + (a % 2)[:, None] * V.formula_matrix_np(np.array([pairs]), dim)
                yield pa.RecordBatch.from_arrays([pa.array([model] * len(a), pa.string()), pa.array(a), from_matrix(M)],
                                                 names=["model", "word_id", "vec"])
        part = ids.select(F.col(id_col).cast("long").alias(id_col)).mapInArrow(
            gen, "model string, word_id long, vec array<double>")
        out = part if out is None else out.unionByName(part)
    return out
