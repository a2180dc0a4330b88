"""Language identification by compression.

A raw-content zstandard dictionary is filled per language with sample text; a document is
cut into blocks and every block is compressed once against each dictionary. The language
whose dictionary gives the fewest bytes over the whole document wins; a document whose margin
over the runner-up is narrow is rejected.

Defined results: a null text, or one without any letter, is ``und``, score 0, rejected. Ties go
to the language with more labelled rows, rejected. Without training rows
every document is ``und``; a language whose texts are all too long for its bytes has an empty dictionary. Rows are judged one by
one, so repeated rows get repeated results; extra columns of the input are ignored, an empty table gives no rows. Very long
texts cost memory for one block at a time.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import schema_of

#: Hash ranges of the sample's first ranking.
RANGES = 64
LETTER = regex.compile(r"\p{L}")
SPACES = re.compile(rb"  +")
ASCII_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def letters(s: str) -> bytes:
    """What is compressed: the lower-cased text, ASCII other than letters as single spaces."""
    return SPACES.sub(b" ", s.lower().encode().translate(ASCII_LETTERS))


@dataclass(frozen=True)
class LanguageModel:
    """``dictionaries``: raw bytes by language, most frequent language first. ``block``: bytes
    compressed at a time at ``level``. ``min_margin``: smallest share of the best size by which the runner-up must be larger."""
    dictionaries: dict[str, bytes]
    block: int = 2048
    level: int = 5
    min_margin: float = 0.002


def train(rows: DataFrame, text: str = "text", lang: str = "lang", docs_per_lang: int = 256,
          bytes_per_lang: int = 1 << 18, **options) -> LanguageModel:
    """Fill one dictionary per language from a bounded sample of the labelled rows.

    The sample is, of the ``docs_per_lang`` distinct texts of each language with the smallest text hash, those that together
    take at most ``bytes_per_lang``, whole, in that order (a text too long for what is left is passed over): the bound holds at every
    input size. Copies are merged by their hash; the smallest hashes are ranked in two steps, per language and
    hash range, then per language, so a language that most rows have is ranked by many tasks. Only chosen texts are read again.
    """
    t = rows.select(F.col(text).alias("t"), F.col(lang).alias("l")).where("l is not null and length(t) > 0").withColumn("h", F.xxhash64("t"))
    top = t.groupBy("l", "h").agg(F.max(F.octet_length("t")).alias("size")).withColumn("part", F.pmod("h", F.lit(RANGES)))
    for keys in (("l", "part"), ("l",)):
        w = Window.partitionBy(*keys).orderBy("h")
        top = top.withColumn("k", F.row_number().over(w)).where(F.col("k") <= docs_per_lang)
    chosen, left = [], {}
    for r in top.select("l", "h", "size").orderBy("l", "h").collect():
        if r["size"] <= left.setdefault(r["l"], bytes_per_lang):
            left[r["l"]] -= r["size"]
            chosen.append((r["l"], r["h"]))
    counts = {r["l"]: r["n"] for r in t.groupBy("l").agg(F.count("*").alias("n")).collect()}
    sample: dict[str, list[tuple[int, bytes]]] = {k: [] for k in counts}
    if chosen:
        # an Arrow table goes to Spark without Python workers, which a list of rows would leave on the executors
        langs, hashes = zip(*chosen)
        wanted = F.broadcast(rows.sparkSession.createDataFrame(pa.table({"l": list(langs), "h": pa.array(hashes, pa.int64())})))
        for r in t.join(wanted, ["l", "h"]).groupBy("l", "h").agg(F.min("t").alias("t")).collect():
            sample[r["l"]].append((r["h"], letters(r["t"])))
    return LanguageModel({k: b"\n".join(t for _, t in sorted(sample[k]))
                          for k in sorted(sample, key=lambda k: (-counts[k], k))}, **options)


def _kernel(model: LanguageModel):
    langs = list(model.dictionaries)

    def coder(name):
        d = zstandard.ZstdCompressionDict(model.dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=model.level)
        return zstandard.ZstdCompressor(level=model.level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress

    def run(batches):
        coders = [coder(name) for name in langs]
        for b in batches:
            pred, score, margin, reject = [], [], [], []
            for text in b.column(b.num_columns - 1):
                s = text.as_py() or ""
                if not langs or not LETTER.search(s):
                    pred.append("und"), score.append(0.0), margin.append(0.0), reject.append(True)
                    continue
                data = letters(s)
                sizes = np.zeros(len(langs))
                for i in range(0, len(data), model.block):
                    block = data[i:i + model.block]
                    sizes += [len(c(block)) for c in coders]
                best = int(sizes.argmin())
                rest = np.delete(sizes, best)
                gap = float((rest.min() - sizes[best]) / sizes[best]) if len(rest) else 1.0
                pred.append(langs[best])
                score.append(float(1 / np.exp2(np.clip(sizes[best] - sizes, -60, 0)).sum()))
                margin.append(gap)
                reject.append(gap < model.min_margin)
            out = [b.column(i) for i in range(b.num_columns - 1)]
            out += [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(margin, pa.float64()),
                    pa.array(reject, pa.bool_())]
            names = b.schema.names[:-1] + ["lang_pred", "score", "margin", "rejected"]
            yield pa.RecordBatch.from_arrays(out, names=names)
    return run


def identify(df: DataFrame, model: LanguageModel, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns plus lang_pred, score (the best language's share of 2^-bytes), margin
    (relative gap to the runner-up) and rejected. The whole text is compressed."""
    out = df.select(*keep, F.col(text).alias("__text"))
    schema = ", ".join(filter(None, [schema_of(df, *keep),
                                     "lang_pred string, score double, margin double, rejected boolean"]))
    return out.mapInArrow(_kernel(model), schema)
