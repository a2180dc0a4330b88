"""The registered queries of this subpackage and, where SQL can express one, its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


def held_out(doc_id: str = "doc_id"):
    """Whether crc32 of the id's decimal text is a multiple of 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op1_language_id")
def language_id(spark, sf_dir):
    from . import langid
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang").withColumn("held_out", held_out())
    model = langid.train(docs.where(~F.col("held_out")))
    return langid.identify(docs, model, keep=("doc_id", "held_out"))


URL_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def _url_sql() -> str:
    from .urlfilter import PATTERN_RULES
    matched = " OR ".join(f"regexp_matches(concat(host, path), '{r.pattern}')" for r in PATTERN_RULES)
    return f"""
WITH r AS (SELECT page_id, coalesce(CASE WHEN position('://' IN url) > 0 THEN
               regexp_extract(substr(url, position('://' IN url) + 3), '^([^?#]*)', 1) END, '') AS hp FROM pages),
p AS (SELECT page_id, regexp_extract(hp, '^([^/]*)', 1) AS h, hp FROM r),
u AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             substr(hp, length(h) + 1) AS path FROM p),
m AS (SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM u)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN {matched} THEN 'block' ELSE 'allow' END AS verdict FROM m"""


@query("op3_url_filter", _url_sql())
def url_filter(spark, sf_dir):
    from . import urlfilter
    rules = [urlfilter.host_rule(r, v) for r, v in URL_RULES]
    got = urlfilter.judge(table(spark, sf_dir, "pages", "page_id", "url"), [*rules, *urlfilter.PATTERN_RULES], keep=("page_id",))
    mine = [r for r, _ in URL_RULES]
    return got.withColumn("rule", F.when(F.col("rule").isin(mine), F.col("rule")))


@query("op4_sentencepiece")
def sentencepiece(spark, sf_dir):
    from . import piece
    with open(tokenizer_file("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    return piece.encode(table(spark, sf_dir, "documents", "doc_id", "text"), model, keep=("doc_id",),
                        outputs=("n_tokens", "ids_sha256", "decoded_sha256", "n_covered"))


@query("op5_token_files")
def token_files(spark, sf_dir):
    from . import tokenfile
    with open(tokenizer_file("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = f.read()
    path = tokenfile.write(table(spark, sf_dir, "documents", "doc_id", "text"), spec, end_id=1)
    return tokenfile.read(spark, path, digest=True).select(F.col("doc").alias("doc_id"), "start", "n_tokens",
                                                           F.col("ids").alias("ids_crc32"))


@query("op7_recompression", r"""
WITH w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
d AS (SELECT row_number() OVER () AS r, doc_id, ws FROM w),
s AS (SELECT r, doc_id, unnest(range(0, greatest(0, len(ws) - 12))) AS i, ws FROM d),
n AS (SELECT r, doc_id, i, array_to_string(ws[i + 1:i + 13], ' ') AS win FROM s),
e AS (SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY win) AS m FROM n) WHERE m < doc_id),
c AS (SELECT DISTINCT r, i + k AS j FROM e, (SELECT unnest(range(0, 13)) AS k)),
g AS (SELECT r, list(j) AS js FROM c GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(len(js), 0)::BIGINT AS n_removed,
    sha256(array_to_string(list_filter(ws, lambda x, k: NOT list_contains(coalesce(js, []), k - 1)), ' ')) AS kept_sha256
FROM d LEFT JOIN g USING (r)""")
def recompression(spark, sf_dir):
    from . import recompress
    return recompress.dedup(table(spark, sf_dir, "documents", "doc_id", "text")).drop("kept_text")


@query("op8_decontamination", r"""
WITH dw AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
d AS (SELECT row_number() OVER () AS r, doc_id, ws FROM dw),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, ws[i + 1:i + 10] AS win FROM (SELECT item_id, ws, unnest(range(0, greatest(1, len(ws) - 9))) AS i FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT len(win) AS n FROM bw),
dwin AS (SELECT r, i, n, ws[i + 1:i + n] AS win FROM (SELECT r, n, ws, unnest(range(0, greatest(0, len(ws) - n + 1))) AS i FROM d, sizes)),
hits AS (SELECT r, i, n, item_id FROM dwin JOIN bw USING (win)),
cov AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM (SELECT DISTINCT r, i, n FROM hits)) GROUP BY r),
its AS (SELECT r, list_sort(list(DISTINCT item_id::VARCHAR)) AS items FROM hits GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
    sha256(array_to_string(coalesce(items, []), ',')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (r) LEFT JOIN its USING (r)""")
def decontamination(spark, sf_dir):
    from . import decontam
    got = decontam.contamination(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


@query("op10_suffixes", r"""
WITH h AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS t FROM documents),
n AS (SELECT r, doc_id, t, octet_length(t) AS n FROM h),
s AS (SELECT r, doc_id, t, unnest(range(1, greatest(1, n - 48))) AS i FROM n),
k AS (SELECT r, doc_id, i, md5_number(array_slice(t, i, i + 49)) AS win FROM s),
e AS (SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY win) AS m FROM k) WHERE m < doc_id),
o AS (SELECT r, i, coalesce(i > lag(i) OVER w + 50, true) AS fresh FROM e WINDOW w AS (PARTITION BY r ORDER BY i)),
q AS (SELECT r, i, sum(fresh::INT) OVER (PARTITION BY r ORDER BY i) AS run FROM o),
g AS (SELECT r, run, min(i) AS a, max(i) + 49 AS z FROM q GROUP BY r, run),
u AS (SELECT r, a, z, coalesce(lag(z) OVER w, 0) AS last, lead(a) OVER w IS NULL AS final FROM g WINDOW w AS (PARTITION BY r ORDER BY a)),
f AS (SELECT u.r, sum(z - a + 1) AS n_removed, count(*) AS n_spans,
    string_agg(hex(array_slice(t, last + 1, a - 1)) || CASE WHEN final THEN hex(array_slice(t, z + 1, n)) ELSE '' END, '' ORDER BY a) AS kept
    FROM u JOIN n ON n.r = u.r GROUP BY u.r)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
    sha256(CASE WHEN f.r IS NULL THEN t ELSE unhex(kept) END) AS kept_sha256 FROM n LEFT JOIN f USING (r)""")
def suffixes_query(spark, sf_dir):
    from . import suffixes
    return suffixes.dedup(table(spark, sf_dir, "documents", "doc_id", "text")).drop("kept")


@query("op9_setsketch", r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
d AS (SELECT row_number() OVER () AS r, doc_id, ws FROM w),
p AS (SELECT r, unnest(range(0, greatest(1, len(ws) - 3))) AS i, ws FROM d WHERE len(ws) > 0),
s AS (SELECT DISTINCT r, array_to_string(ws[i + 1:i + 4], ' ') AS sh FROM p),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
o AS (SELECT a.r AS x, b.r AS y, count(*) AS k FROM s a JOIN s b USING (sh) WHERE a.r <> b.r GROUP BY ALL),
l AS (SELECT x, y FROM o JOIN n a ON a.r = x JOIN n b ON b.r = y WHERE 100 * k >= 80 * (a.n + b.n - k)),
reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, l.y FROM reach JOIN l ON l.x = reach.b),
c AS (SELECT a AS r, min(doc_id) AS component_id FROM reach JOIN d ON d.r = reach.b GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM d JOIN c USING (r) LEFT JOIN n USING (r)""")
def setsketch(spark, sf_dir):
    from . import setsketch
    return setsketch.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), shingle=4)


@query("op2_itq", r"""
WITH RECURSIVE e AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
ok AS MATERIALIZED (SELECT r, v FROM e WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
l AS (SELECT a.r AS x, b.r AS y FROM ok a JOIN ok b ON a.r <> b.r AND list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (SELECT r AS a, r AS b FROM e UNION SELECT reach.a, l.y FROM reach JOIN l ON l.x = reach.b),
c AS (SELECT a AS r, min(vec_id) AS component_id FROM reach JOIN e ON e.r = reach.b GROUP BY a),
n AS (SELECT x AS r, count(*) AS n_links FROM l GROUP BY x)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM e JOIN c USING (r) LEFT JOIN n USING (r)""")
def itq_query(spark, sf_dir):
    from . import itq
    return itq.near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


@query("op6_pii")
def pii_query(spark, sf_dir):
    from . import pii
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return pii.find(docs, pii.train(docs), keep=("doc_id",))


@query("op11_cover_tree", """
WITH e AS (SELECT row_number() OVER () AS r, vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r, a.id AS a_id, b.id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
    FROM e a JOIN e b ON a.id % 100 = 0 AND a.r <> b.r),
p AS (SELECT r, a_id, id AS p_id, score AS p_score, row_number() OVER (PARTITION BY r ORDER BY score DESC, id) AS p FROM s WHERE same QUALIFY p <= 5)
SELECT p.a_id AS anchor_id, p_id AS positive_id, row_number() OVER (PARTITION BY p.r, p ORDER BY score DESC, id)::INTEGER AS rank,
    id AS negative_id, p_score AS positive_score, score AS negative_score
FROM p JOIN s ON s.r = p.r AND NOT same AND 30 * p_score <= 100 * score AND 100 * score <= 90 * p_score QUALIFY rank <= 10""")
def cover_tree(spark, sf_dir):
    from . import covertree
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return covertree.hard_negatives(rows.withColumn("label", moved))


@query("op12_k2_treap", r"""
WITH dt AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
d AS (SELECT r, doc_id, len(ws) AS n, ws FROM dt WHERE len(ws) > 0),
f AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS l FROM d),
t AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM t, f GROUP BY term),
b AS (SELECT row_number() OVER () AS i, item_id, list_distinct(list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS ws FROM benchmark),
q AS (SELECT i, item_id, unnest(ws) AS term FROM b),
m AS (SELECT r, doc_id, 100 - 50 + ((50 * n * big_n) // l) AS m FROM d, f),
s AS (SELECT i, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
    FROM q JOIN t USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0 QUALIFY rank <= 50""")
def k2_treap(spark, sf_dir):
    from . import k2treap
    return k2treap.rank(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


@query("op13_quality")
def quality(spark, sf_dir):
    from . import mil
    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("held_out", held_out())
    net = mil.train(docs.where(~F.col("held_out")), table(spark, sf_dir, "labels", "doc_id", "quality"))
    return mil.score(docs, net, keep=("doc_id", "held_out"))


@query("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
