"""Every operator over odd tables: nulls in any column, empty and very long texts, repeated rows, ties, no rows,
and extra columns whose names clash with those the operators use. Extra columns never change a result."""

import functools

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecspark.llm import covertree, decontam, itq, k2treap, langid, mil, piece, pii, recompress, setsketch, suffixes, tokenfile, urlfilter
from vecspark.llm.queries import URL_RULES, tokenizer_file

NAMES = """id node key n word words th doc bucket root component component_id kept l i pos item items item_id score rank term ids spans start
masked host path rule verdict tile chunk links n_links r k v vec x __text bin held_out rejected lang_pred url url_id token keys copies tf df w m
label anchor_id positive_id negative_id n_words n_hit n_tokens n_removed n_bytes n_spans n_shingles part block text_id quality predicted""".split()
SCHEMA = "doc_id long, text string, lang string"


@functools.cache
def texts():
    rng = np.random.default_rng(1)
    word = lambda base: " ".join(rng.choice([f"{base}{i}" for i in range(60)], 40))
    rows = [(i, f"{word('the')} and {word('of')}", "en") for i in range(12)] + [(20 + i, f"{word('der')} und {word('das')}", "de") for i in range(12)]
    rows += [rows[0], rows[0], (50, rows[0][1], "en"), (51, rows[1][1] + " tail", None)]
    rows += [(60, None, None), (61, "", "en"), (62, " \n\t ", "de"), (63, "12345 67890", "en"), (64, "7", None), (64, "other text", "de")]
    rows += [(None, rows[2][1], "en"), (None, None, None), (None, "mail a.b@c.org or +49 30 1234567", "de")]
    rows += [(70, "x" * 300_000, "en"), (71, "long words " * 30_000, "en"), (72, "Grüße 你好 🎉 \u0000 \u2028 ﬁ", "de")]
    return rows


def clash(df, free=()):
    """The same rows with a column of another type under every name of ``NAMES`` that the table does not have."""
    return df.select("*", *[F.array(F.lit(n)).alias(n) for n in NAMES if n not in df.columns and n not in free])


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def blob(name, mode="rb"):
    with open(tokenizer_file(name), mode) as f:
        return f.read()


def language(spark, docs, items):
    return langid.identify(docs, langid.train(docs), keep=("doc_id",))


def token_files(spark, docs, items):
    path = tokenfile.write(docs, blob("word_bpe_49k.json", "r"), end_id=1)
    return tokenfile.read(spark, path, digest=True)


def quality(spark, docs, items):
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(None, 1), (3, None)], "doc_id long, quality int")
    return mil.score(docs, mil.train(docs, labels), keep=("doc_id",))


DOCUMENTS = {
    "language": language,
    "pieces": lambda spark, docs, items: piece.encode(docs, blob("piece_bpe_32k.model"), keep=("doc_id",), outputs=("n_tokens", "ids_sha256", "decoded_sha256")),
    "token_files": token_files,
    "personal_data": lambda spark, docs, items: pii.find(docs, pii.train(docs), keep=("doc_id",), masked=True),
    "words": lambda spark, docs, items: recompress.dedup(docs),
    "decontamination": lambda spark, docs, items: decontam.contamination(docs, items),
    "near_copies": lambda spark, docs, items: setsketch.near_duplicates(docs),
    "bytes": lambda spark, docs, items: suffixes.dedup(docs),
    "ranked_search": lambda spark, docs, items: k2treap.rank(docs, items),
    "quality": quality,
}


def benchmark(spark):
    rows = texts()
    return [("a", " ".join(rows[3][1].split(" ")[5:30])), ("b", None), ("c", ""), ("d", "nowhere at all"), ("a", "the1"), (None, rows[5][1])]


@pytest.mark.parametrize("name", sorted(DOCUMENTS))
def test_documents(spark, name):
    run, items = DOCUMENTS[name], spark.createDataFrame(benchmark(spark), "item_id string, text string")
    docs = spark.createDataFrame(texts(), SCHEMA)
    plain = rows_of(run(spark, docs, items))
    if name != "ranked_search":
        assert len(plain) == len(texts())  # a row each, repeated rows too
    assert rows_of(run(spark, clash(docs), clash(items, free=("text",)))) == plain
    none = spark.createDataFrame([], SCHEMA)
    assert rows_of(run(spark, none, items)) == []
    if name in ("decontamination", "ranked_search"):
        got = run(spark, docs, spark.createDataFrame([], "item_id string, text string")).collect()
        assert got == [] if name == "ranked_search" else all(r["n_hit"] == 0 for r in got) and len(got) == len(texts())


def test_urls(spark):
    rows = [(1, "http://a.example.net/en/x"), (2, None), (3, ""), (4, "no scheme"), (5, "http://"), (6, "http://NET/?q"), (None, "http://x.org/fr/"),
            (7, "http://h.com/" + "ab-" * 100_000), (1, "http://a.example.net/en/x"), (8, "x://y.example.com/de/#f")]
    rules = [*[urlfilter.host_rule(r, v) for r, v in URL_RULES], *urlfilter.PATTERN_RULES]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    plain = urlfilter.judge(pages, rules, keep=("page_id",))
    got = rows_of(plain)
    assert len(got) == len(rows)
    assert rows_of(urlfilter.judge(clash(pages), rules, keep=("page_id",))) == got
    by = {r["page_id"]: r for r in plain.collect()}
    assert (by[1]["rule"], by[1]["verdict"]) == ("example.net/en/", "allow")
    assert (by[8]["rule"], by[8]["verdict"], by[2]["host"], by[2]["path"], by[6]["host"]) == ("example.com/de/", "block", "", "", "net")
    assert by[7]["path"] == "/" + "ab-" * 100_000
    assert rows_of(urlfilter.judge(spark.createDataFrame([], "page_id long, url string"), rules, keep=("page_id",))) == []


VECTORS = "vec_id long, embedding array<double>, label int"


def vectors():
    rng = np.random.default_rng(2)
    rows = [(i * 10, rng.random(8).tolist(), i % 3) for i in range(60)]
    rows += [rows[0], rows[0], (5, rows[1][1], 1), (7, None, 1), (8, [0.0] * 8, 2), (9, [None] + [1.0] * 7, 0), (11, [float("nan")] * 8, 0), (12, rows[2][1], None),
             (None, rows[3][1], 1), (13, [], 1)]
    return rows


@pytest.mark.parametrize("name", ["links", "negatives"])
def test_vectors(spark, name):
    run = itq.near_duplicates if name == "links" else covertree.hard_negatives
    table = spark.createDataFrame(vectors(), VECTORS)
    plain = rows_of(run(table))
    assert len(plain) == len(vectors()) if name == "links" else plain
    assert rows_of(run(clash(table))) == plain
    assert rows_of(run(spark.createDataFrame([], VECTORS))) == []


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as P
    spark.createDataFrame(benchmark(spark), "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(i, t, g, None, None if t is None else len(t)) for i, t, g in texts()]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in P.STAGES:
        got = stage(spark, docs, str(tmp_path))
        out = got.collect()
        if name in ("pii", "sentencepiece"):
            assert len(out) == len(rows)
        if name != "sentencepiece":
            assert tuple(got.columns) == P.COLUMNS
        if name in ("language_id", "near_dedup", "decontamination"):
            assert {tuple(r) for r in out} <= set(rows)
        if name == "near_dedup":
            assert len(out) == len(set(map(tuple, out)))
        if name == "pii":
            masked = {r["doc_id"]: r["text"] for r in out if r["text"] and "[" in r["text"]}
            assert masked == {None: "mail [EMAIL] or [PHONE]"}
        assert stage(spark, spark.createDataFrame([], schema), str(tmp_path)).collect() == []
