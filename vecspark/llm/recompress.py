"""Substring dedup by recompression: words that repeat an earlier document's window are removed.

Words are named by content (equal words have equal names everywhere). A round of recompression names
runs of one symbol and then pairs: each symbol falls on the left or right side by a bit of its
name, and a left symbol with a right one after it becomes one new symbol, named by the two. Names
depend on content alone, so all tasks name alike without a table. Whether two neighbours join
depends on them only; hence inside equal windows, from a few words in, symbols are the same.

After two rounds a window of 13 words has, among its words 3 to 7, the start of a symbol that
every equal window has at the same place; the last such start and the six words from it are the
window's sample. Windows holding a run are always looked at, as a run may go on outside. Shared
samples reveal candidate windows; names of whole windows verify them (module ``shared``).

Defined results: a null text has no words; texts with fewer words than a window, and documents
without id, never remove anything elsewhere, nor is a document without id spared. Rows with one id
are one document to each other (nothing is removed between them). Equal rows give equal rows.
Extra columns are ignored. Long texts go through in blocks of 262,144 words.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import GOLD, mix64
from .shared import Method, remove_repeats
from .words import sequence_names, word_names

#: Words of a sample, and how far into a window the start of its sample may be.
SAMPLE, REACH = 6, 7


def _round(names: np.ndarray, start: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Join each left symbol with a right symbol after it: (names, starts) of the new symbols."""
    side = mix64(names + np.uint64(salt * int(GOLD) % (1 << 64))) >> np.uint64(63)
    joined = np.zeros(len(names), bool)  # symbols that are the second of a pair
    joined[1:] = (side[:-1] == 0) & (side[1:] == 1)
    out = names.copy()
    out[:-1] = np.where(joined[1:], mix64(names[:-1] * GOLD + names[1:]), names[:-1])
    return out[~joined], start[~joined]


def symbol_starts(words: np.ndarray, rounds: int = 2) -> np.ndarray:
    """Places where a symbol starts after so many rounds."""
    start = np.flatnonzero(np.r_[True, words[1:] != words[:-1]]) if len(words) else np.zeros(0, int)
    run = np.diff(np.r_[start, len(words)]).astype(np.uint64)
    names = np.where(run > 1, mix64(words[start] + run * GOLD), words[start])
    for k in range(1, rounds + 1):
        names, start = _round(names, start, k)
    return start


def _method(window: int) -> Method:
    if window < SAMPLE + REACH:
        raise ValueError(f"windows have {SAMPLE + REACH} words at least")

    def anchors(words):
        n = len(words) - window + 1
        flag = np.zeros(len(words), bool)
        flag[symbol_starts(words)] = True
        last = np.maximum.accumulate(np.where(flag, np.arange(len(words)), -1))
        at = last[REACH:REACH + n]
        same = np.r_[0, np.cumsum(words[1:] == words[:-1])]  # equal neighbours up to each word
        runs = same[window - 1:window - 1 + n] - same[:n] > 0
        return np.where(runs | (at < np.arange(n)), -1, at)

    def samples(words, at):
        return sequence_names(words, SAMPLE)[at] & np.uint64(0xFFFFFFFFFFFF0000)

    def finish(text: bytes, words, covered):
        kept = text.split()  # bytes: at exactly the blanks of a word's definition
        if covered is not None:
            kept = [w for w, c in zip(kept, covered.tolist()) if not c]
        kept = b" ".join(kept)
        return len(words), 0 if covered is None else int(covered.sum()), kept.decode(), hashlib.sha256(kept).hexdigest()

    return Method(window, word_names, lambda words: words, anchors, samples,
                  lambda words, at: sequence_names(words, window)[at], finish,
                  (("n_words", "long", pa.int64()), ("n_removed", "long", pa.int64()), ("kept_text", "string", pa.string()),
                   ("kept_sha256", "string", pa.string())))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept_text (kept words joined by one blank) and its
    SHA-256. A word goes if a window of ``window`` words that covers it also starts in a document
    with a smaller id."""
    return remove_repeats(docs, _method(window), id_col, text_col)
