"""Substring dedup in bytes over difference-cover names: long byte strings of earlier documents go.

Triples of bytes are names of the first level; triples of names, three and nine bytes apart, are
named again, so after three levels a name stands for 27 bytes (names are content hashes, equal in all
tasks). Suffixes at sampled places are put in order of these names, ranges of names to tasks, and
neighbours in the order that agree are shared by documents. The remaining suffixes that can
matter, those whose sample is shared, are merged into the order by the names of their first and
last 27 bytes, together the 50-byte prefix, and neighbours that agree there are equal prefixes.

The sampled places are not residues modulo 3 but the smallest 27-byte name of each 50-byte string: equal
strings sample the same place inside, as with a difference cover, from a twelfth of all places
instead of two thirds.

Defined results: a null text is empty; strings shorter than ``length`` never match. Documents without
id come after all others. Rows with one id are one document to each other. Equal rows give equal
rows. Extra columns are ignored. Long texts go through in blocks of 262,144 bytes. Kept bytes may end
inside a character, so they are binary.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import mix64
from .shared import Method, remove_repeats

#: Bytes a name of the third level stands for.
NAMED = 27
_A, _B = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)


def _triple(a: np.ndarray, step: int) -> np.ndarray:
    """Names of names ``step`` apart."""
    n = len(a) - 2 * step
    x = a[:n] * _A
    x += a[step:step + n]
    x *= _B
    x += a[2 * step:]
    x ^= x >> np.uint64(32)
    x *= _A
    x ^= x >> np.uint64(29)
    return x


def names27(data: np.ndarray) -> np.ndarray:
    """The third-level name at every place that has 27 bytes."""
    if len(data) < NAMED:
        return np.zeros(0, np.uint64)
    d = data.astype(np.uint64)
    first = d[:-2] | d[1:-1] << np.uint64(8) | d[2:] << np.uint64(16)
    return _triple(_triple(first + np.uint64(1), 3), 9)


def _smallest(x: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest name among ``width`` from each place on; the first among equals."""
    bits = np.uint64(20)
    key = x >> bits << bits
    key |= np.arange(len(x), dtype=np.uint64)
    n, done, low = len(x) - width + 1, 1, key
    while 2 * done <= width:
        low = np.minimum(low[:-done], low[done:])
        done *= 2
    if done < width:
        low = np.minimum(low[:n], low[width - done:width - done + n])
    return (low[:n] & np.uint64((1 << 20) - 1)).astype(np.int64)


def _method(length: int) -> Method:
    if not NAMED < length <= 2 * NAMED:
        raise ValueError(f"strings have {NAMED + 1} to {2 * NAMED} bytes")
    far = length - NAMED

    def finish(text: bytes, data, covered):
        if covered is None:
            return len(text), 0, 0, text, hashlib.sha256(text).hexdigest()
        kept = data[~covered].tobytes()
        spans = int(np.count_nonzero(np.diff(np.r_[0, covered.astype(np.int8)]) == 1))
        return len(text), int(covered.sum()), spans, kept, hashlib.sha256(kept).hexdigest()

    return Method(
        length, lambda texts: [np.frombuffer(t, np.uint8) for t in texts], names27,
        lambda x: _smallest(x, far + 1), lambda x, at: mix64(x[at]) & np.uint64(0xFFFFFFFFFFFF0000),
        lambda x, at: mix64(x[at] * _B + x[at + far]), finish,
        (("n_bytes", "long", pa.int64()), ("n_removed", "long", pa.int64()), ("n_spans", "long", pa.int64()),
         ("kept", "binary", pa.binary()), ("kept_sha256", "string", pa.string())))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans (maximal removed runs), kept (bytes) and its
    SHA-256. A byte goes if a string of ``length`` bytes that covers it also starts in a document
    with a smaller id."""
    return remove_repeats(docs, _method(length), id_col, text_col)
