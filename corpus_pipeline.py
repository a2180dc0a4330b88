"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Every stage works on all documents its predecessor kept. The first four return the columns of
``documents``; the last returns the tokenized documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecspark.llm import decontam, langid, pii, piece, setsketch
from vecspark.llm.queries import held_out, tokenizer_file
from vecspark.session import ensure_checkpoint_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
COLUMNS_BUT_TEXT = tuple(c for c in COLUMNS if c != "text")


#: Rows of an Arrow batch: texts are long, and a Python worker stays alive, with its memory, for a minute after its stage.
BATCH_ROWS = 2000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepare(spark: SparkSession) -> str:
    """The shared folder; smaller Arrow batches unless the session asks for smaller ones yet."""
    if not 0 < int(spark.conf.get(BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
    return ensure_checkpoint_dir(spark)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is not told apart (null, letterless, or by too narrow a margin: ties among them).
    Learns from the labelled documents that are not held out. Repeated rows are judged alike, very long texts whole; an empty
    table, or one without labels, gives no rows."""
    prepare(spark)
    model = langid.train(docs.where(~held_out()))
    return langid.identify(docs, model, keep=COLUMNS).where(~F.col("rejected")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays, that of the smallest id (no id comes last). Shingles of
    five words, similarity 0.8. A document is an id and a text, told by their 64-bit hash, and a null id is a value like any
    other: of repeated rows, also wordless ones, one stays; texts that only share an id are apart."""
    prepare(spark)
    keyed = docs.withColumn("key", F.xxhash64("doc_id", "text"))
    names = keyed.groupBy("key").agg(F.min("doc_id").alias("id"), F.count("*").alias("n"))
    found = setsketch.near_duplicates(keyed, "key", shingle=5, percent=80).select("key", "component_id").distinct()
    found = found.join(names, "key").checkpoint()
    least = F.min(F.struct(F.col("id").isNull().alias("without"), "id", "key")).alias("least")
    stays = found.groupBy("component_id").agg(least).select("least.key", F.lit(True).alias("stays"))
    # documents that go, or of which one row of many stays
    marked = found.join(stays, "key", "left").where("stays is null or n > 1").select("key", "stays").checkpoint()
    marked = F.broadcast(marked) if marked.count() <= setsketch.BROADCAST_IDS else marked
    once = keyed.join(marked, "key", "left_anti").select(*COLUMNS)
    repeated = keyed.join(marked.where("stays"), "key", "left_semi").groupBy("key").agg(F.min(F.struct(*COLUMNS)).alias("row"))
    return once.unionByName(repeated.select("row.*"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a word inside a benchmark passage of ten words go; rows are judged one by one, wherever in a long text the
    passage lies. Without benchmark items all stay."""
    prepare(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    hit = decontam.contamination(docs, items).where("n_hit > 0").select("doc_id", "th").distinct()
    return decontam.join_documents(docs.withColumn("th", decontam.text_hash(F.col("text"))), hit, "left_anti", "doc_id").select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked by its kind; all documents stay, repeated rows and null texts (as empty ones are masked: not at all)
    among them."""
    prepare(spark)
    out = pii.find(docs, pii.train(docs), keep=COLUMNS_BUT_TEXT, masked=True)
    return out.withColumn("text", F.col("masked")).withColumn(
        "n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long"))).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of the whole text, their digests, and the decoded text's."""
    prepare(spark)
    with open(tokenizer_file("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    return piece.encode(docs, model, keep=("doc_id",), outputs=("n_tokens", "ids", "ids_sha256", "decoded_sha256"))


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("pii", personal_data), ("sentencepiece", tokens)]

#: SQL can't express the stages that learn from the corpus (language, personal data) or tokenize.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each stage's rows are a table in the shared folder."""
    base = f"{prepare(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
