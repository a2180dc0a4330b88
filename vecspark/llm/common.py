"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIX1 = np.uint64(0xBF58476D1CE4E5B9)
MIX2 = np.uint64(0x94D049BB133111EB)
GOLD = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The named columns of one input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased; every other character unchanged."""
    return F.translate(c, UPPER, UPPER.lower())


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Has a scratch table deleted when the application ends."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(conf).deleteOnExit(where)


def schema_of(df: DataFrame, *cols: str) -> str:
    """DDL of the named columns, for the output schema of an Arrow function."""
    t = dict(df.dtypes)
    return ", ".join(f"`{c}` {t[c]}" for c in cols)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising bit mixer on unsigned 64-bit integers; changes ``x`` in place."""
    x ^= x >> np.uint64(30)
    x *= MIX1
    x ^= x >> np.uint64(27)
    x *= MIX2
    x ^= x >> np.uint64(31)
    return x


def utf8_values(col: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        return [b for c in col.chunks for b in utf8_values(c)]
    kind = pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()
    return [b if b is not None else b"" for b in col.cast(kind).to_pylist()]


def small_batches(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``rows``, so that a task holds few texts at a time."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


class Memo:
    """Values of strings by ``fill(list of strings)``, remembered in two generations of at most ``limit`` bytes each, about:
    a full generation becomes the old one, and what is asked for again moves back from it. Strings longer
    than ``longest`` are not remembered beyond the call. ``size`` gives a value's bytes."""

    #: Bytes that a remembered string and its value take besides their own.
    ENTRY = 250

    def __init__(self, fill, size, limit: int = 96 << 20, longest: int = 64):
        self.fill, self.size, self.limit, self.longest = fill, size, limit, longest
        self.known, self.old, self.bytes = {}, {}, 0

    def values(self, keys: list[str]) -> list:
        """The value of each of ``keys`` (different strings)."""
        known, size, entry, longest = self.known, self.size, self.ENTRY, self.longest
        out = list(map(known.get, keys))
        gaps = [i for i, v in enumerate(out) if v is None]
        if self.old and gaps:
            back = [(i, self.old.get(keys[i])) for i in gaps]
            for i, v in back:
                if v is not None:
                    out[i] = known[keys[i]] = v
                    self.bytes += entry + len(keys[i]) + size(v)
            gaps = [i for i, v in back if v is None]
        if gaps:
            new = [keys[i] for i in gaps]
            made = self.fill(new)
            for i, k, v in zip(gaps, new, made):
                out[i] = v
                if len(k) <= longest:
                    known[k] = v
                    self.bytes += entry + len(k) + size(v)
        if self.bytes > self.limit:
            self.old, self.known, self.bytes = known, {}, 0
        return out

    def of(self, keys) -> dict:
        """A dictionary of all of ``keys`` (different strings) and their values."""
        keys = list(keys)
        return dict(zip(keys, self.values(keys)))
