"""Shared corpus pipeline used by the text queries (Spark side)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import text as T
from ..sources.corpus import lines_of, read_documents


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return lines_of(read_documents(spark, sf))


def sentences(spark: SparkSession, sf: str) -> DataFrame:
    return T.filter_sentences(lines(spark, sf))


def word_lines(spark: SparkSession, sf: str) -> DataFrame:
    return T.word_lines(sentences(spark, sf))


def tokens(spark: SparkSession, sf: str) -> DataFrame:
    return T.tokens_of(word_lines(spark, sf))


def staged_vocab(spark: SparkSession, sf: str):
    """(staged word lines, tokens, vocabulary): the text is read and split once."""
    words = T.stage_words(word_lines(spark, sf))
    toks = T.tokens_of(words)
    return words, toks, T.fit_vocab(toks, words)


def vocab_and_encoded(spark: SparkSession, sf: str):
    _, toks, vocab = staged_vocab(spark, sf)
    return vocab, T.encode(toks, vocab)
