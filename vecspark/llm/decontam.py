"""Benchmark decontamination with a distributed positional inverted index, DataFrame functions only.

The index holds the training postings (document, term, position) of every word of the test items, written
once to the shared folder while the texts are read; each document also has one row of its own (term ``NONE``).
Term frequencies are counted on the index. Each test window is looked up from its rarest term: the postings of
that term, less its offset in the window, are possible starts; they are intersected with the postings of the
next rarest terms, again offset-adjusted, rarest first (``STEPS`` of them), and what is left with all
others. These are exact phrase matches (``phrase_matches``). For ``proximity_matches`` the other terms count
wherever they stand in a span around the rarest one.

Only postings, starts and window numbers are shuffled; no word array is, and no list of a document's places is made.
Tables are broadcast when their measured bytes allow, and joined by shuffle beyond.

Words: A-Z lower-cased, maximal runs of ASCII letters, digits and characters from U+0080 up.

Defined results: a null or wordless text has no words and no hits; a test item without words has
no window, one with fewer words than the window is one window; a null item id counts for hits, not as an item.
Every document row is a document of its own, also rows that share an id, a text or both, and rows without id; ``th`` (MD5 of
the text) tells texts under one id apart. Extra columns are ignored; empty tables give no rows, or rows without hits. A very long
text is one array in the task that reads it; its postings are rows of their own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecspark.session import ensure_checkpoint_dir

from .common import delete_at_exit, lower_ascii

NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: A table is broadcast when its measured size is at most so many bytes.
BROADCAST_BYTES = 32 << 20
#: Terms of a window, after the rarest, that are intersected one at a time.
STEPS = 2
#: Stands in place of a term in a document's own row; the word for it is no word of any text.
NONE, NO_WORD = -1, "\0"


def words_of(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != "")


def text_hash(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def stage_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, th, words) of all documents."""
    return docs.select(F.col(id_col).alias("doc"), text_hash(F.col(text_col)).alias("th"),
                       words_of(F.col(text_col)).alias("words"))


def windows_of(items: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = 10) -> DataFrame:
    """Windows of the test items: (win, words, item), one row for each item that has the window; ``win`` numbers the
    different windows."""
    ensure_checkpoint_dir(items.sparkSession)
    w = items.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("w") - size))
    held = w.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i + 1, size))).alias("words")).distinct().checkpoint()
    numbered = held.select("words").distinct().withColumn("win", F.monotonically_increasing_id()).checkpoint()
    return held.join(_small(numbered), "words").select("win", "words", "item").checkpoint()


def _bytes(df: DataFrame) -> Column:
    """Bytes of a row, about: all columns counted."""
    kinds = df.dtypes
    of = {"string": lambda c: F.octet_length(c), "array<string>": lambda c: F.octet_length(F.array_join(c, "")) + 24 * F.size(c)}
    return sum((F.coalesce(of[t](F.col(c)), F.lit(0)) if t in of else F.lit(8) for c, t in kinds), F.lit(48))


def _small(df: DataFrame) -> DataFrame:
    """``df``, to be broadcast if its measured bytes allow."""
    return F.broadcast(df) if (df.agg(F.sum(_bytes(df))).first()[0] or 0) <= BROADCAST_BYTES else df


def join_documents(left: DataFrame, right: DataFrame, how: str = "inner", id_col: str = "doc") -> DataFrame:
    """``left`` and ``right`` joined on (``id_col``, th); a null id equals a null id."""
    right = right.withColumnsRenamed({id_col: "__id", "th": "__th"})
    return left.join(right, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("th") == F.col("__th")), how).drop("__id", "__th")


class Index:
    """Postings of the windows' words over all documents: ``postings`` (uid, term, pos), ``documents`` (uid, doc, th, n_words) and
    ``terms`` (win, place, term, off, len): a window's terms from the rarest (place 0) on; windows with a word
    that no document has are left out."""

    def __init__(self, staged: DataFrame, windows: DataFrame):
        spark = staged.sparkSession
        each = windows.select("win", "words").distinct()
        vocabulary = each.select(F.explode("words").alias("word")).distinct().withColumn("term", F.monotonically_increasing_id()).checkpoint()
        none = spark.range(0, 1, 1, 1).select(F.lit(NO_WORD).alias("word"), F.lit(NONE).cast("long").alias("term"))
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/postings-{uuid.uuid4().hex}"
        rows = staged.withColumn("uid", F.monotonically_increasing_id()).select(
            "uid", "doc", "th", F.size("words").cast("long").alias("n_words"), F.posexplode(F.concat(F.array(F.lit(NO_WORD)), "words")).alias("pos", "word"))
        own = lambda c: F.when(F.col("term") == NONE, F.col(c)).alias(c)
        rows = rows.join(_small(vocabulary.unionByName(none)), "word")
        rows.select("uid", own("doc"), own("th"), own("n_words"), "term", (F.col("pos") - 1).alias("pos")).write.option("compression", "zstd").parquet(path)
        delete_at_exit(spark, path)
        index = spark.read.parquet(path)
        self.documents = index.where(F.col("term") == NONE).select("uid", "doc", "th", "n_words")
        self.postings = index.where(F.col("term") != NONE).select("uid", "term", "pos")
        counts = self.postings.groupBy("term").agg(F.count("*").alias("n"))
        at = each.select("win", F.size("words").alias("len"), F.posexplode("words").alias("off", "word")).join(_small(vocabulary), "word")
        at = at.join(_small(counts.checkpoint()), "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
        order = Window.partitionBy("win").orderBy("n", "off")
        at = at.withColumn("place", F.row_number().over(order) - 1).withColumn("least", F.min("n").over(Window.partitionBy("win")))
        self.terms = at.where("least > 0").select("win", "place", "term", "off", "len").checkpoint()

    def _of(self, terms: DataFrame) -> DataFrame:
        """Postings of the terms named."""
        return self.postings.join(_small(terms.select("term").distinct()), "term", "left_semi")

    def rarest(self) -> DataFrame:
        """Where the rarest term of a window occurs: (uid, win, len, off, pos)."""
        first = self.terms.where("place = 0")
        return self._of(first).join(_small(first.drop("place")), "term").select("uid", "win", "len", "off", "pos")

    def starts(self) -> DataFrame:
        """Exact occurrences: (uid, win, len, start)."""
        ensure_checkpoint_dir(self.postings.sparkSession)
        left = self.rarest().select("uid", "win", "len", (F.col("pos") - F.col("off")).alias("start")).where("start >= 0").checkpoint()
        done = []
        for place in range(1, STEPS + 1):
            step = self.terms.where(F.col("place") == place).drop("place", "len")
            done.append(left.where(F.col("len") == place))
            asked = left.join(_small(step), "win").select("uid", "win", "len", "start", "term", (F.col("start") + F.col("off")).alias("pos"))
            left = asked.join(self._of(step), ["uid", "term", "pos"], "left_semi").select("uid", "win", "len", "start").checkpoint()
        rest = self.terms.where(F.col("place") > STEPS)
        done.append(left.where(F.col("len") == STEPS + 1))
        asked = left.join(_small(rest.drop("len", "place")), "win").select("uid", "win", "len", "start", "term", (F.col("start") + F.col("off")).alias("pos"))
        held = self._of(rest).join(_small(left.select("uid").distinct()), "uid", "left_semi")
        seen = asked.join(held, ["uid", "term", "pos"], "left_semi").groupBy("uid", "win", "len", "start").agg(F.count("*").alias("n"))
        found = seen.where(F.col("n") == F.col("len") - STEPS - 1).drop("n")
        for d in done:
            found = found.unionByName(d)
        return found


def phrase_matches(staged: DataFrame, windows: DataFrame, index: Index | None = None) -> DataFrame:
    """Exact occurrences of windows: (doc, th, win, start, len), for each row of the documents."""
    index = index or Index(staged, windows)
    return index.starts().join(index.documents.drop("n_words"), "uid").select("doc", "th", "win", "start", "len")


def proximity_matches(staged: DataFrame, windows: DataFrame, slack: int = 5, index: Index | None = None) -> DataFrame:
    """Places where all words of a window, in any order, lie fewer than ``len + slack`` words from an
    occurrence of its rarest word: (doc, th, win, start, len), one row per such occurrence. Positions meet in
    cells of ``len + slack`` words, each occurrence asking its own cell and both neighbours."""
    index = index or Index(staged, windows)
    span = F.col("len") + slack
    others = index.terms.where("place > 0").select("win", "term", "len")
    wanted = others.select("win", "term").distinct().groupBy("win").agg(F.count("*").alias("wanted"))
    near = index.rarest().withColumnRenamed("pos", "at")
    asked = near.join(_small(others.select("win", "term").distinct()), "win")
    asked = asked.withColumn("cell", F.explode(F.sequence(F.floor((F.col("at") - span + 1) / span).cast("long"), F.floor((F.col("at") + span - 1) / span).cast("long"))))
    sizes = others.select("term", "len").distinct()
    cells = index._of(others).join(_small(sizes), "term").select("uid", "term", "len", "pos", F.floor(F.col("pos") / span).cast("long").alias("cell"))
    met = asked.join(cells, ["uid", "term", "len", "cell"]).where(F.abs(F.col("pos") - F.col("at")) < span)
    seen = met.select("uid", "win", "len", "at", "term").distinct().groupBy("uid", "win", "len", "at").agg(F.count("*").alias("n"))
    whole = seen.join(_small(wanted), "win").where("n = wanted").select("uid", "win", "len", "at")
    alone = near.join(_small(wanted), "win", "left_anti").select("uid", "win", "len", "at")
    found = whole.unionByName(alone).distinct()
    return found.join(index.documents.drop("n_words"), "uid").select("doc", "th", "win", F.col("at").alias("start"), "len")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", size: int = 10) -> DataFrame:
    """One row per document row: ``id_col``, th (text hash), n_words, n_hit (words inside an
    occurrence of a window), items (sorted distinct ids, as strings)."""
    windows = windows_of(items, item_id, item_text, size)
    index = Index(stage_words(docs, id_col, text_col), windows)
    found = index.starts().checkpoint()
    # words covered: each occurrence adds what lies beyond everything that started before it
    order = Window.partitionBy("uid").orderBy("start", "len", "win")
    end = F.col("start") + F.col("len")
    before = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    added = F.greatest(F.lit(0), end - F.greatest("start", F.coalesce(before, F.lit(0))))
    hits = found.select("uid", added.cast("long").alias("added")).groupBy("uid").agg(F.sum("added").alias("n_hit"))
    named = found.select("uid", "win").distinct().join(_small(windows.select("win", "item")), "win").select("uid", "item").distinct()
    named = named.groupBy("uid").agg(F.array_sort(F.collect_set("item")).alias("items"))
    out = index.documents.join(hits.join(named, "uid"), "uid", "left")
    return out.select(F.col("doc").alias(id_col), "th", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"))
