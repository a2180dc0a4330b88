"""SentencePiece encoding with byte offsets, and decoding.

``Normalizer`` applies the model's compiled character map (a double-array trie of source strings, each
with its replacement) by longest prefix, as the library does, and keeps for every normalised byte
the source byte it came from. Pieces then tile the normalised text, so their running lengths,
looked up in that alignment, give every piece's span of the original UTF-8 bytes.

Ids come from the sentencepiece library. Where no piece has the blank mark after another character
and the map leaves the text as it is, ids of a text are those of its blank-led units one after the
other, so units are remembered per worker; otherwise the library gets whole texts.

Defined results: a null or empty text has no pieces. Repeated rows get repeated results; extra
columns are ignored. Texts are handled one at a time; a very long text takes a few times its size.
"""

from __future__ import annotations

import hashlib
import re
import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, schema_of, sha256_hex, small_batches

MARK = "▁"
UNIT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


@dataclass
class Normalizer:
    """The parts of a model's normaliser specification that matter. ``charsmap``: 4 bytes of trie
    size, the trie's units, then zero-ended replacements; empty for none."""
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra: bool = False
    escape: bool = True

    def __post_init__(self):
        size = struct.unpack("<I", self.charsmap[:4])[0] if self.charsmap else 0
        self.trie = struct.unpack(f"<{size // 4}I", self.charsmap[4:4 + size])
        self.repl = self.charsmap[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[bytes, int]:
        """Replacement and source length of the longest mapped prefix of ``data[at:]``; of one
        character that stays as it is when none is mapped."""
        best = None
        if self.trie:
            node = self._child_base(0)
            for i in range(at, len(data)):
                node ^= data[i]
                if node >= len(self.trie) or self.trie[node] & 0x800000FF != data[i]:
                    break
                unit = self.trie[node]
                node = self._child_base(node)
                if unit >> 8 & 1:
                    best = (self.trie[node] & 0x7FFFFFFF, i + 1 - at)
        if best:
            return self.repl[best[0]:self.repl.index(0, best[0])], best[1]
        lead = data[at]
        n = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return data[at:at + n], n

    def _child_base(self, node: int) -> int:
        unit = self.trie[node]
        return node ^ (unit >> 10 << ((unit & 1 << 9) >> 6))

    def apply(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """(normalised bytes, source position of each of them and of the end)."""
        if not data:
            return b"", np.zeros(1, np.int64)
        if not self.trie and not self.remove_extra:
            return self._plain(data)
        chars: list[tuple[bytes, int]] = []  # (bytes, source position) of each output character
        at = 0
        while at < len(data):
            out, n = self.longest(data, at)
            chars += [(c.encode(), at) for c in out.decode("utf-8", "replace")]
            at += n
        end = len(data)
        if self.remove_extra:
            while chars and chars[-1][0] == b" ":
                end = chars.pop()[1]
            chars = [c for i, c in enumerate(chars) if c[0] != b" " or i and chars[i - 1][0] != b" "]
            if chars and chars[0][0] == b" ":
                del chars[0]
        if self.dummy_prefix and chars:
            chars.insert(0, (b" ", chars[0][1]))
        if self.escape:
            chars = [(MARK.encode(), p) if c == b" " else (c, p) for c, p in chars]
        lens = [len(c) for c, _ in chars]
        return b"".join(c for c, _ in chars), np.r_[np.repeat([p for _, p in chars], lens), end].astype(np.int64)

    def _plain(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """No map: every character stays; only blanks are rewritten."""
        mark = MARK.encode() if self.escape else b" "
        lens = np.where(np.frombuffer(data, np.uint8) == 32, len(mark), 1)
        src = np.repeat(np.arange(len(data)), lens)
        out = data.replace(b" ", mark)
        if self.dummy_prefix:
            out, src = mark + out, np.r_[np.zeros(len(mark), src.dtype), src]
        return out, np.r_[src, len(data)]


class PieceCoder:
    """Encoder and decoder of one model."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto
        m = proto.ModelProto()
        m.ParseFromString(model)
        n = m.normalizer_spec
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.norm = Normalizer(n.precompiled_charsmap, n.add_dummy_prefix, n.remove_extra_whitespaces, n.escape_whitespaces)
        kinds = m.SentencePiece
        #: normalised bytes of each piece; an unknown piece's own length has to be looked up in the text
        self.size = np.array([1 if p.type == kinds.BYTE else 0 if p.type in (kinds.CONTROL, kinds.UNKNOWN)
                              else len(p.piece.encode()) for p in m.pieces], dtype=np.int64)
        self.unknown = m.trainer_spec.unk_id
        plain = not n.precompiled_charsmap and n.add_dummy_prefix and not n.remove_extra_whitespaces and n.escape_whitespaces
        self.by_unit = plain and not m.trainer_spec.treat_whitespace_as_suffix and m.trainer_spec.model_type == 2 and not any(
            MARK in p.piece.lstrip(MARK) or p.type == kinds.USER_DEFINED for p in m.pieces)
        #: a line feed that no piece has stays a symbol of its own, so units may also end before it
        self.by_line = self.by_unit and not any("\n" in p.piece for p in m.pieces)
        #: every id as text: only ids are remembered, their text is made from these
        self.names = [str(i) for i in range(self.sp.get_piece_size())]
        #: a worker keeps this for as long as it lives, also through other stages
        self.memo = Memo(self._units, len, limit=24 << 20)

    def _units(self, units: list[str]) -> list[bytes]:
        """Ids of units as 32-bit integers. A unit is given with its first mark, or without it, as
        the library puts one; from a line feed on it has none, so that its piece goes."""
        out = []
        plain = [u[1:].replace(MARK, " ") if u[:1] == MARK else u for u in units]
        for u, p, ids in zip(units, plain, self.sp.encode(plain, num_threads=1)):
            if not p:
                ids = [self.sp.piece_to_id(MARK)]
            elif u[0] == "\n":
                del ids[0]
            out.append(struct.pack(f"<{len(ids)}i", *ids))
        return out

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, str]]:
        """(ids, ids as comma-joined text) of each text, as the library gives them."""
        if not self.by_unit:
            return [(np.array(i, dtype="<i4"), ",".join(map(str, i))) for i in self.sp.encode(texts, num_threads=1)]
        units = []
        for t in texts:
            if not t:
                units.append([])
            elif MARK in t or "  " in t or t[0] == " " or t[-1] == " " or not self.by_line or " \n" in t:
                units.append(UNIT.findall(MARK + t.replace(" ", MARK)))
            else:
                units.append(t.replace("\n", " \n").split(" "))
        known = self.memo.of(set().union(*units))
        got = [np.frombuffer(b"".join([known[u] for u in us]), dtype="<i4") for us in units]
        return [(i, ",".join([self.names[x] for x in i.tolist()])) for i in got]

    def spans(self, text: str, ids: np.ndarray) -> np.ndarray:
        """Bounds of the pieces in the text's UTF-8 bytes: piece i is ``[b[i], b[i + 1])``."""
        data = text.encode()
        norm, src = self.norm.apply(data)
        size = self.size[ids]
        if self.unknown in ids:
            size = size.copy()
            for i, p in enumerate(self.sp.encode(text, out_type=str)):
                if ids[i] == self.unknown:
                    size[i] = len(p.encode())
        ends = np.cumsum(size)
        if (ends[-1] if len(ends) else 0) != len(norm):
            raise ValueError("pieces do not tile the normalised text")
        return np.r_[0 if not len(ends) else src[0], src[ends]] if len(ends) else np.zeros(1, np.int64)


_CODERS: dict[str, PieceCoder] = {}


def coder(model: bytes) -> PieceCoder:
    """The worker's coder of this model; Python workers are used for many tasks."""
    key = sha256_hex(model)
    if key not in _CODERS:
        _CODERS[key] = PieceCoder(model)
    return _CODERS[key]


OUTPUTS = {"ids": "array<int>", "spans": "array<int>", "decoded": "string", "n_tokens": "long",
           "ids_sha256": "string", "decoded_sha256": "string", "n_covered": "long"}
_KINDS = {"array<int>": pa.list_(pa.int32()), "string": pa.string(), "long": pa.int64()}


def encode(df: DataFrame, model: bytes, text: str = "text", keep: tuple[str, ...] = (),
           outputs: tuple[str, ...] = ("ids", "spans", "decoded")) -> DataFrame:
    """``keep`` columns plus the named outputs: ids; spans (n + 1 bounds of the pieces in the original
    UTF-8 bytes); decoded (the library's decode of the ids); n_tokens; SHA-256 digests of the
    comma-joined ids and of the decoded text; n_covered, the original bytes inside pieces."""
    def run(batches):
        c = coder(model)
        for b in small_batches(batches, 256):
            texts = [t or "" for t in b.column(b.num_columns - 1).to_pylist()]
            ids = c.encode(texts)
            got: dict[str, list] = {o: [] for o in outputs}
            for t, (i, joined) in zip(texts, ids):
                bounds, d = c.spans(t, i), c.sp.decode(i.tolist())
                row = {"ids": i, "spans": bounds, "decoded": d, "n_tokens": len(i), "n_covered": int(bounds[-1] - bounds[0])}
                if "ids_sha256" in got:
                    row["ids_sha256"] = sha256_hex(joined.encode())
                if "decoded_sha256" in got:
                    row["decoded_sha256"] = sha256_hex(d.encode())
                for o in outputs:
                    got[o].append(row[o])
            cols = [b.column(i) for i in range(b.num_columns - 1)] + [pa.array(got[o], _KINDS[OUTPUTS[o]]) for o in outputs]
            yield pa.RecordBatch.from_arrays(cols, names=[*b.schema.names[:-1], *outputs])

    ddl = ", ".join(filter(None, [schema_of(df, *keep), *[f"{o} {OUTPUTS[o]}" for o in outputs]]))
    return df.select(*keep, F.col(text).alias("__text")).mapInArrow(run, ddl)
