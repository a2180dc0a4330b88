"""Registered text-path queries: O1, O9-O14, O23, O25, O41, O42."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import text as T
from ..operators import windows as W
from ..session import scratch_path
from ..sources.corpus import read_lines, write_text_files
from . import corpus as C
from .oracle_parts import with_corpus
from .registry import register


@register("corpus_lines", with_corpus("SELECT doc_id, line_no, line FROM lines"))
def corpus_lines(spark, sf):
    return C.lines(spark, sf)


@register("text_file_lines", """
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id, text) AS r, string_split(text, chr(10)) AS s FROM documents WHERE text IS NOT NULL),
l AS (SELECT r, generate_subscripts(s, 1) AS i, unnest(s) AS line FROM d)
SELECT row_number() OVER (ORDER BY r, i) - 1 AS line_id, line FROM l""")
def text_file_lines(spark, sf):
    path = scratch_path(spark, "text-files")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    write_text_files(docs, path)
    return read_lines(spark, path, numbered=True).select("line_id", "line")


@register("sentence_filter", with_corpus("SELECT doc_id, line_no, line FROM sentences"))
def sentence_filter(spark, sf):
    return C.sentences(spark, sf)


@register("tokens", with_corpus("SELECT doc_id, line_no, pos, word FROM tokens"))
def tokens(spark, sf):
    return C.tokens(spark, sf)


@register("vocabulary", with_corpus("SELECT word, word_id, n FROM vocab"))
def vocabulary(spark, sf):
    return C.staged_vocab(spark, sf)[2]


@register("encoded_tokens", with_corpus("SELECT doc_id, line_no, pos, word_id FROM encoded"))
def encoded_tokens(spark, sf):
    return C.vocab_and_encoded(spark, sf)[1]


@register("decoded_tokens", with_corpus("SELECT doc_id, line_no, pos, word FROM tokens"))
def decoded_tokens(spark, sf):
    vocab, enc = C.vocab_and_encoded(spark, sf)
    return T.decode(enc, vocab).select("doc_id", "line_no", "pos", "word")


@register("corpus_stats", with_corpus(
    "SELECT (SELECT count(*) FROM tokens) AS n_samples, (SELECT count(*) + 1 FROM vocab) AS V"))
def corpus_stats(spark, sf):
    _, toks, vocab = C.staged_vocab(spark, sf)
    return T.corpus_stats(toks, vocab)


@register("peek_rows", with_corpus(
    "SELECT doc_id, line_no, line FROM sentences ORDER BY doc_id, line_no LIMIT 5"))
def peek_rows(spark, sf):
    return T.peek(C.sentences(spark, sf), 5, ["doc_id", "line_no"])


@register("padded_sequences", with_corpus("""
SELECT doc_id, line_no, CAST(pos + 2 AS INTEGER) AS pos, word_id FROM encoded
UNION ALL
SELECT doc_id, line_no, CAST(p AS INTEGER) AS pos, 0 AS word_id
FROM (SELECT doc_id, line_no, unnest([0, 1, n + 2, n + 3]) AS p
      FROM (SELECT s.doc_id, s.line_no, count(e.pos) AS n
            FROM sentences s LEFT JOIN encoded e ON e.doc_id = s.doc_id AND e.line_no = s.line_no
            GROUP BY s.doc_id, s.line_no))
"""))
def padded_sequences(spark, sf):
    words, toks, vocab = C.staged_vocab(spark, sf)
    lengths = words.select("doc_id", "line_no", F.size("words").alias("n"))
    return W.pad_long(T.encode(toks, vocab), w=2, lines=lengths)


@register("cbow_windows", with_corpus("""
SELECT doc_id, line_no, pos,
  CAST(lag(word_id, 2, 0) OVER w AS INTEGER) AS c1, CAST(lag(word_id, 1, 0) OVER w AS INTEGER) AS c2,
  CAST(lead(word_id, 1, 0) OVER w AS INTEGER) AS c3, CAST(lead(word_id, 2, 0) OVER w AS INTEGER) AS c4,
  word_id AS target
FROM encoded WINDOW w AS (PARTITION BY doc_id, line_no ORDER BY pos)
"""))
def cbow_windows(spark, sf):
    return W.cbow_windows(C.vocab_and_encoded(spark, sf)[1], w=2)


@register("skipgram_pairs", with_corpus("""
SELECT * FROM (
  SELECT doc_id, line_no, pos, o.offset AS offset, word_id AS center, o.context AS context
  FROM (SELECT doc_id, line_no, pos, word_id,
          [{'offset': -2, 'context': lag(word_id, 2) OVER w}, {'offset': -1, 'context': lag(word_id, 1) OVER w},
           {'offset': 1, 'context': lead(word_id, 1) OVER w}, {'offset': 2, 'context': lead(word_id, 2) OVER w}] AS cs
        FROM encoded WINDOW w AS (PARTITION BY doc_id, line_no ORDER BY pos)) t,
       unnest(cs) AS u(o)
) WHERE context IS NOT NULL
"""))
def skipgram_pairs(spark, sf):
    return W.skipgram_pairs(C.vocab_and_encoded(spark, sf)[1], w=2)


@register("one_hot", with_corpus(
    "SELECT doc_id, line_no, pos, word_id AS \"index\", CAST(1 AS INTEGER) AS value FROM encoded"))
def one_hot(spark, sf):
    vocab, enc = C.vocab_and_encoded(spark, sf)
    size = vocab.count() + 1                     # V: ids 0..V-1, 0 = padding
    return T.one_hot(enc, "word_id", size=size, row_cols=["doc_id", "line_no", "pos"])
