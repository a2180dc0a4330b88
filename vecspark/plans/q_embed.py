"""Registered embedding queries: O6-O8, O22, O35-O40.

Two inputs are used. (1) The ``embeddings`` table as three vector sets of different
dimension -- ``EMB_64`` (the table's vectors) and formula-made ``F_50`` / ``F_300`` for the
same ids -- with the fixture questions ``i -> (3i, 3i+1, 3i+2 ; 3i+3)``. (2) The corpus
vocabulary with formula-made sets ``F_50 / F_150 / F_300`` and the reference's nine word
analogies (most of whose words the synthetic corpus lacks, exercising unknown words).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vec as V
from ..functions.vec import formula_sql
from ..operators import embed as E
from ..operators import knn as K
from ..session import scratch_path
from ..sources import embeddings_io as IO
from . import corpus as C
from .oracle_parts import CORPUS
from .registry import register

# --- fixed values: the reference's analogy questions (a, b, c -> d, relationship) ---------
WORD_ANALOGIES = [
    ("mouse", "mice", "lobster", "lobsters", "Plural nouns"),
    ("girl", "boy", "queen", "king", "Woman-man"),
    ("look", "looking", "watch", "watching", "Present participle"),
    ("is", "are", "was", "were", "Plural verbs"),
    ("sit", "stand", "stay", "go", "Opposite"),
    ("happy", "sad", "joys", "sorrows", "Opposite"),
    ("say", "said", "think", "thought", "Past tense"),
    ("is", "was", "are", "were", "Past tense"),
    ("small", "smaller", "large", "larger", "Comparative"),
]
# -----------------------------------------------------------------------------------------

EMB_SETS = {"EMB_64": None, "F_50": 50, "F_300": 300}
WORD_SETS = {"F_50": 50, "F_150": 150, "F_300": 300}


def emb_table(spark, sf):
    return spark.read.parquet(f"{sf}/embeddings.parquet")


def emb_sets(spark, sf):
    e = emb_table(spark, sf)
    table = e.select(F.lit("EMB_64").alias("model"), F.col("vec_id").alias("word_id"),
                     F.col("embedding").cast("array<double>").alias("vec"))
    formula = E.formula_vectors(e.select("vec_id"), "vec_id", {k: v for k, v in EMB_SETS.items() if v})
    return table.unionByName(formula)


def emb_vocab(spark, sf):
    return emb_table(spark, sf).select(F.col("vec_id").cast("string").alias("word"),
                                      F.col("vec_id").alias("word_id"))


def fixture_questions(spark):
    rows = [(i, WORD_ANALOGIES[i][4], str(3 * i), str(3 * i + 1), str(3 * i + 2), str(3 * i + 3))
            for i in range(9)]
    return spark.createDataFrame(rows, "qid int, relationship string, a string, b string, c string, d string")


def word_questions(spark):
    rows = [(i, q[4], q[0], q[1], q[2], q[3]) for i, q in enumerate(WORD_ANALOGIES)]
    return spark.createDataFrame(rows, "qid int, relationship string, a string, b string, c string, d string")


def word_sets(spark, sf):
    vocab = C.staged_vocab(spark, sf)[2]
    return vocab, E.formula_vectors(vocab.select("word_id"), "word_id", WORD_SETS)


# ------------------------------------------------------------------ SQL pieces

def _sql_values_questions(fixture: bool) -> str:
    rows = []
    for i, q in enumerate(WORD_ANALOGIES):
        a, b, c, d = (str(3 * i), str(3 * i + 1), str(3 * i + 2), str(3 * i + 3)) if fixture else q[:4]
        rows.append(f"({i}, '{q[4]}', '{a}', '{b}', '{c}', '{d}')")
    return ("questions AS (SELECT * FROM (VALUES " + ", ".join(rows) +
            ") q(qid, relationship, a, b, c, d))")


EMB_SQL = ",\n".join([
    "sets AS (SELECT 'EMB_64' AS model, vec_id AS word_id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings "
    "UNION ALL SELECT 'F_50', vec_id, " + formula_sql("vec_id", 50) + " FROM embeddings "
    "UNION ALL SELECT 'F_300', vec_id, " + formula_sql("vec_id", 300) + " FROM embeddings)",
    "wv AS (SELECT CAST(vec_id AS VARCHAR) AS word, vec_id AS word_id FROM embeddings)",
    _sql_values_questions(True),
])

WORD_SQL = ",\n".join([
    CORPUS,
    "sets AS (" + " UNION ALL ".join(
        f"SELECT '{m}' AS model, word_id, {formula_sql('word_id', d)} AS vec FROM vocab"
        for m, d in WORD_SETS.items()) + ")",
    "wv AS (SELECT word, word_id FROM vocab)",
    _sql_values_questions(False),
])

ANALOGY_CORE = """,
roles AS (SELECT qid, unnest(['a','b','c','d']) AS role, unnest([a, b, c, d]) AS word FROM questions),
models AS (SELECT DISTINCT model FROM sets),
looked AS (SELECT r.qid, r.role, r.word, w.word_id, m.model, s.vec
           FROM roles r CROSS JOIN models m LEFT JOIN wv w ON r.word = w.word
           LEFT JOIN sets s ON s.model = m.model AND s.word_id = w.word_id),
piv AS (SELECT qid, model,
          max(word_id) FILTER (WHERE role = 'a') AS id_a, max(word_id) FILTER (WHERE role = 'b') AS id_b,
          max(word_id) FILTER (WHERE role = 'c') AS id_c, max(word_id) FILTER (WHERE role = 'd') AS id_d,
          first(vec) FILTER (WHERE role = 'a') AS v_a, first(vec) FILTER (WHERE role = 'b') AS v_b,
          first(vec) FILTER (WHERE role = 'c') AS v_c, first(vec) FILTER (WHERE role = 'd') AS v_d
        FROM looked GROUP BY qid, model),
preds AS (SELECT *, CASE WHEN v_a IS NULL OR v_b IS NULL OR v_c IS NULL THEN NULL
                   ELSE list_transform(list_zip(v_b, v_a, v_c), lambda t: t[1] - t[2] + t[3]) END AS p FROM piv),
pred2 AS (SELECT *, CASE WHEN v_d IS NULL OR p IS NULL THEN NULL
                         WHEN list_dot_product(v_d, v_d) = 0 OR list_dot_product(p, p) = 0 THEN 0.0
                         ELSE list_dot_product(v_d, p) / (sqrt(list_dot_product(v_d, v_d)) * sqrt(list_dot_product(p, p)))
                    END AS sim1 FROM preds),
scored AS (SELECT q.qid, q.model, s.word_id,
             CASE WHEN list_dot_product(s.vec, s.vec) = 0 OR list_dot_product(q.p, q.p) = 0 THEN 0.0
                  ELSE list_dot_product(s.vec, q.p) / (sqrt(list_dot_product(s.vec, s.vec)) * sqrt(list_dot_product(q.p, q.p)))
             END AS sim
           FROM pred2 q JOIN sets s ON s.model = q.model WHERE q.p IS NOT NULL),
near AS (SELECT qid, model, word_id, sim FROM (
           SELECT sc.*, row_number() OVER (PARTITION BY sc.qid, sc.model ORDER BY sim DESC, word_id) AS rk
           FROM scored sc JOIN pred2 q ON q.qid = sc.qid AND q.model = sc.model
           WHERE sc.word_id IS DISTINCT FROM q.id_a AND sc.word_id IS DISTINCT FROM q.id_b
             AND sc.word_id IS DISTINCT FROM q.id_c) WHERE rk = 1),
report AS (
  SELECT q.relationship, format(' ''{}'' is to ''{}'' as ''{}'' is to ?', q.a, q.b, q.c) AS task,
         q.d AS true_word, round(p.sim1, 6) AS sim1, w.word AS predicted_word, round(n.sim, 6) AS sim2,
         p.model AS embedding, coalesce(w.word = q.d, false) AS correct
  FROM questions q JOIN pred2 p ON p.qid = q.qid
  LEFT JOIN near n ON n.qid = p.qid AND n.model = p.model
  LEFT JOIN wv w ON w.word_id = n.word_id)
"""


def _emb_with(body: str) -> str:
    return "WITH " + EMB_SQL + ANALOGY_CORE + body


def _word_with(body: str) -> str:
    return "WITH " + WORD_SQL + ANALOGY_CORE + body


def _fixture_preds(spark, sf):
    sets = emb_sets(spark, sf)
    preds = E.analogy_predictions(fixture_questions(spark), emb_vocab(spark, sf), sets, list(EMB_SETS))
    return sets, E.materialize_small(preds)


# ------------------------------------------------------------------ queries

@register("analogy_report", _emb_with("SELECT * FROM report"))
def analogy_report(spark, sf):
    return E.evaluate_analogies(fixture_questions(spark), emb_vocab(spark, sf), emb_sets(spark, sf),
                                list(EMB_SETS))


@register("analogy_report_words", _word_with("SELECT * FROM report"))
def analogy_report_words(spark, sf):
    vocab, sets = word_sets(spark, sf)
    return E.evaluate_analogies(word_questions(spark), vocab, sets, list(WORD_SETS))


#: Questions on the most frequent words: the pair (2i, 2i + 1) of ids to the pair (2i + 18, 2i + 19), i from 1 to 9.
PAIR_SETS = {"PAIRS_50": 50, "F_50": 50}
_SHIFT = 77


PAIR_SQL = ",\n".join([
    CORPUS,
    f"""sets AS (SELECT 'PAIRS_50' AS model, word_id, list_transform(list_zip({formula_sql('word_id // 2', 50)}, {formula_sql(str(_SHIFT), 50)}),
                         lambda t: t[1] + (word_id % 2) * t[2]) AS vec FROM vocab
        UNION ALL SELECT 'F_50', word_id, {formula_sql('word_id', 50)} FROM vocab)""",
    "wv AS (SELECT word, word_id FROM vocab)",
    """questions AS (SELECT CAST(i AS INTEGER) AS qid, 'pair ' || i AS relationship, a.word AS a, b.word AS b, c.word AS c, d.word AS d
        FROM range(1, 10) t(i) JOIN vocab a ON a.word_id = 2 * i JOIN vocab b ON b.word_id = 2 * i + 1
        JOIN vocab c ON c.word_id = 2 * i + 18 JOIN vocab d ON d.word_id = 2 * i + 19)""",
])


def pair_report(spark, sf):
    vocab = C.staged_vocab(spark, sf)[2]
    word = {r["word_id"]: r["word"] for r in vocab.where("word_id < 40").collect()}
    rows = [(i, f"pair {i}", *(word[2 * i + k] for k in (0, 1, 18, 19))) for i in range(1, 10)]
    questions = spark.createDataFrame(rows, "qid int, relationship string, a string, b string, c string, d string")
    sets = E.formula_vectors(vocab.select("word_id"), "word_id", {"PAIRS_50": 50}, pairs=_SHIFT).unionByName(
        E.formula_vectors(vocab.select("word_id"), "word_id", {"F_50": 50}))
    return E.evaluate_analogies(questions, vocab, sets, list(PAIR_SETS))


@register("analogy_report_pairs", "WITH " + PAIR_SQL + ANALOGY_CORE + "SELECT * FROM report")
def analogy_report_pairs(spark, sf):
    """Analogies that hold in one set of vectors and not in the other."""
    return pair_report(spark, sf)


@register("analogy_correct_only", "WITH " + PAIR_SQL + ANALOGY_CORE + "SELECT * FROM report WHERE correct")
def analogy_correct_only(spark, sf):
    return E.filter_correct(pair_report(spark, sf))


@register("embedding_lookup", _word_with("""
SELECT qid, role, word, word_id, model, CAST(len(vec) AS INTEGER) AS dim, round(list_sum(vec), 6) AS vsum,
       round(sqrt(list_dot_product(vec, vec)), 6) AS norm
FROM looked"""))
def embedding_lookup(spark, sf):
    """Ids are looked up first; vectors are made for the found ids alone."""
    vocab = C.staged_vocab(spark, sf)[2]
    roles = word_questions(spark).select("qid", F.explode(F.array(*[
        F.struct(F.lit(r).alias("role"), F.col(r).alias("word")) for r in "abcd"])).alias("_r")) \
        .select("qid", "_r.role", "_r.word")
    known = E.materialize_small(E.lookup_small(roles, vocab.select("word", "word_id"), ["word"]))
    sets = E.formula_vectors(known.where("word_id is not null").select("word_id").distinct(), "word_id", WORD_SETS)
    out = E.embed(known, None, sets, list(WORD_SETS))
    return out.select("qid", "role", "word", "word_id", "model", F.size("vec").alias("dim"),
                      F.round(V.vsum("vec"), 6).alias("vsum"), F.round(V.norm("vec"), 6).alias("norm")) \
        .withColumn("dim", F.when(F.col("dim") >= 0, F.col("dim")))  # size(null) is -1


@register("vector_arithmetic", _emb_with("""
SELECT qid, model, CAST(generate_subscripts(p, 1) - 1 AS INTEGER) AS pos, round(unnest(p), 6) AS v
FROM preds WHERE p IS NOT NULL"""))
def vector_arithmetic(spark, sf):
    _, preds = _fixture_preds(spark, sf)
    return preds.select("qid", "model", F.posexplode("qvec").alias("pos", "v")) \
        .select("qid", "model", "pos", F.round("v", 6).alias("v"))


@register("cosine_pairs", _emb_with("SELECT qid, model, word_id, round(sim, 6) AS sim FROM scored"))
def cosine_pairs(spark, sf):
    """Every prediction against every vector of its set."""
    sets, preds = _fixture_preds(spark, sf)
    s = E.similarity_scan(sets, preds, "cosine", k=None)
    return s.select(F.col("qid").cast("int").alias("qid"), "model", "word_id", F.round("score", 6).alias("sim"))


def _self_join_sql(score: str, order: str, k: int) -> str:
    return "WITH " + EMB_SQL + f"""
SELECT qid, model, word_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT a.word_id AS qid, a.model, b.word_id, {score} AS score,
         row_number() OVER (PARTITION BY a.model, a.word_id ORDER BY {score} {order}, b.word_id) AS rank
  FROM sets a JOIN sets b ON a.model = b.model AND a.word_id <> b.word_id) WHERE rank <= {k}"""


def _self_join(spark, sf, k, metric):
    """Every vector of every set against all others of its set."""
    sets = emb_sets(spark, sf)
    queries = sets.select(F.col("word_id").alias("qid"), "model", F.col("vec").alias("qvec"), F.array("word_id").alias("own"))
    got = K.knn_join(sets, queries, k, metric, exclude_col="own")
    return got.select("qid", "model", "word_id", F.round("score", 6).alias("score"), F.col("rank").cast("int").alias("rank"))


@register("knn_join", _self_join_sql("list_distance(a.vec, b.vec)", "", 10))
def knn_join(spark, sf):
    return _self_join(spark, sf, 10, "euclidean")


@register("knn_join_cosine", _self_join_sql("list_dot_product(a.vec, b.vec) / (sqrt(list_dot_product(a.vec, a.vec)) * sqrt(list_dot_product(b.vec, b.vec)))", "DESC", 5))
def knn_join_cosine(spark, sf):
    return _self_join(spark, sf, 5, "cosine")


@register("rank_join", "WITH " + EMB_SQL + """
, d AS (SELECT a.word_id AS qid, a.model, b.word_id, list_distance(a.vec, b.vec) AS dist FROM sets a JOIN sets b ON a.model = b.model),
n AS (SELECT count(*) AS n FROM embeddings),
r AS (SELECT *, row_number() OVER (PARTITION BY model, qid ORDER BY dist, word_id) AS rank FROM d)
SELECT qid, model, word_id AS target, round(dist, 6) AS dist, rank FROM r, n WHERE word_id = (qid + 17) % n.n""")
def rank_join(spark, sf):
    """For every vector, the rank of the vector seventeen ids on."""
    sets = emb_sets(spark, sf)
    n = emb_table(spark, sf).count()
    queries = sets.select(F.col("word_id").alias("qid"), "model", F.col("vec").alias("qvec"), ((F.col("word_id") + 17) % n).alias("target"))
    return K.rank_join(sets, queries).select("qid", "model", "target", F.round("dist", 6).alias("dist"), "rank")


@register("nearest_excluding", _emb_with("SELECT qid, model, word_id, round(sim, 6) AS sim FROM near"))
def nearest_excluding(spark, sf):
    sets, preds = _fixture_preds(spark, sf)
    n = E.nearest(sets, preds, exclude_col="exclude")
    return n.select(F.col("qid").cast("int").alias("qid"), "model", "word_id", F.round("sim", 6).alias("sim"))


DIST_SQL = """,
dist AS (SELECT q.qid, q.model, s.word_id, list_distance(s.vec, q.p) AS dist, q.id_d
         FROM pred2 q JOIN sets s ON s.model = q.model WHERE q.p IS NOT NULL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid, model ORDER BY dist, word_id) AS rk FROM dist)
"""


@register("distance_topk", _emb_with(DIST_SQL + """
SELECT qid, model, word_id, round(dist, 6) AS dist, CAST(rk AS INTEGER) AS rank FROM ranked WHERE rk <= 100"""))
def distance_topk(spark, sf):
    sets, preds = _fixture_preds(spark, sf)
    r = E.rank_by_distance(sets, preds, k=100)
    return r.select(F.col("qid").cast("int").alias("qid"), "model", "word_id",
                    F.round("dist", 6).alias("dist"), F.col("rank").cast("int").alias("rank"))


@register("rank_of_target", _emb_with(DIST_SQL + """
SELECT qid, model, word_id AS target, round(dist, 6) AS dist, rk AS rank FROM ranked WHERE word_id = id_d"""))
def rank_of_target(spark, sf):
    sets, preds = _fixture_preds(spark, sf)
    q = preds.select("qid", "model", "qvec", F.col("id_d").alias("target")).where(F.col("target").isNotNull())
    r = E.rank_of(sets, q, "target")
    return r.select(F.col("qid").cast("int").alias("qid"), "model", "target",
                    F.round("dist", 6).alias("dist"), F.col("rank").cast("long").alias("rank"))


_SET_SUMMARY_SQL = ("SELECT model, word_id, CAST(len(vec) AS INTEGER) AS dim, round(list_sum(vec), 6) AS vsum, "
                    "round(sqrt(list_dot_product(vec, vec)), 6) AS norm FROM sets")


def _set_summary(df):
    return df.select("model", "word_id", F.size("vec").alias("dim"), F.round(V.vsum("vec"), 6).alias("vsum"),
                     F.round(V.norm("vec"), 6).alias("norm"))


def _saved_sets(spark, sf):
    path = scratch_path(spark, "embedding-sets")
    IO.save_embeddings(emb_sets(spark, sf), path)
    return path


@register("embeddings_roundtrip", "WITH " + EMB_SQL + "\n" + _SET_SUMMARY_SQL)
def embeddings_roundtrip(spark, sf):
    return _set_summary(IO.load_embeddings(spark, _saved_sets(spark, sf)))


@register("embeddings_by_model", "WITH " + EMB_SQL + "\n" + _SET_SUMMARY_SQL + " WHERE model IN ('EMB_64', 'F_300')")
def embeddings_by_model(spark, sf):
    return _set_summary(IO.load_embeddings(spark, _saved_sets(spark, sf), ["EMB_64", "F_300"]))


_BUCKET = 64


@register("saved_lookup", "WITH " + EMB_SQL + """
, k AS (SELECT DISTINCT q.qid, r.role, r.word FROM questions q, unnest([{'role': 'a', 'word': a}, {'role': 'b', 'word': b}, {'role': 'c', 'word': c}, {'role': 'd', 'word': d}]) AS u(r)
        UNION ALL SELECT 99, 'x', '-5')
SELECT k.qid, k.role, CAST(k.word AS BIGINT) AS word_id, s.model, CAST(len(s.vec) AS INTEGER) AS dim, round(list_sum(s.vec), 6) AS vsum
FROM (SELECT * FROM k CROSS JOIN (SELECT unnest(['EMB_64', 'F_300']) AS m)) k
LEFT JOIN sets s ON s.word_id = CAST(k.word AS BIGINT) AND s.model = k.m""".replace("r.role, r.word", "u.r.role, u.r.word").replace("s.model, CAST(len", "k.m AS model, CAST(len"))
def saved_lookup(spark, sf):
    """The questions' vectors from a saved set, of which only the buckets that hold them are read."""
    path = scratch_path(spark, "embedding-buckets")
    IO.save_embeddings(emb_sets(spark, sf), path, bucket=_BUCKET)
    roles = fixture_questions(spark).select("qid", F.explode(F.array(*[
        F.struct(F.lit(r).alias("role"), F.col(r).cast("long").alias("word_id")) for r in "abcd"])).alias("_r")).select("qid", "_r.role", "_r.word_id")
    roles = roles.unionByName(spark.createDataFrame([(99, "x", -5)], "qid int, role string, word_id long"))
    keys = roles.withColumn("model", F.explode(F.array(F.lit("EMB_64"), F.lit("F_300"))))
    out = IO.lookup_embeddings(spark, path, keys, bucket=_BUCKET)
    return out.select("qid", "role", "word_id", "model", F.when(F.col("vec").isNotNull(), F.size("vec")).alias("dim"), F.round(V.vsum("vec"), 6).alias("vsum"))


@register("ranking_report", _emb_with(DIST_SQL + """
SELECT qid, model, word_id, round(dist, 6) AS dist, CAST(rk AS INTEGER) AS rank FROM ranked WHERE rk <= 100"""))
def ranking_report(spark, sf):
    path = scratch_path(spark, "ranking-report")
    IO.write_report(distance_topk(spark, sf), path, "csv")
    return IO.read_report(spark, path, "qid int, model string, word_id long, dist double, rank int")
