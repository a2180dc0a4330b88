"""Token-id files: every document one zstandard frame, all frames sharing one trained dictionary.

A file set is a Parquet table of blocks in ascending document order. A block holds the frames of
consecutive documents back to back, an offset index (ids, frame offsets, token counts, and the
number of ids before the block's first document) and the SHA-256 of the dictionary it needs; the
dictionary is a row of its own beside the blocks. Reading a document takes its block and inflates
only its own frame.

Ids are serialised as little-endian unsigned integers of two bytes when the vocabulary allows,
else four. Tokenizing is done by the tokenizers library on blank-separated chunks: the normaliser, the splitter and
the special tokens of the vocabulary never reach across ASCII white space (checked by ``splits_at_spaces``), so
the ids are those of the whole text. A batch of texts is split and dictionary-encoded by Arrow kernels, its
different chunks are looked up in the worker's memory of at most some 200 MB, and the ids are gathered.

Compressed documents are staged once, then range-sorted by (id, text hash), so many rows of one id, or without
id, are as many ranges as their number asks for, and packed into blocks.

The dictionary is trained on at most ``sample`` different texts of together at most ``sample_bytes``, whole texts in order
of their hash (a text too long for what is left of the bytes is passed over). Where zstandard finds too little to
train on, the serialised ids themselves are the dictionary (raw content); without any text it is empty.

Defined results: a null or empty text has only the end id. Equal ids sort by text hash; null ids
come first. An empty table gives an empty file set. Extra columns are ignored. A very long text
is one frame.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vecspark.session import ensure_checkpoint_dir

from .common import Memo, shuffle_partitions, small_batches

SPACE = re.compile(r"[\t-\r ]+")
BAR = "\x01"
BLOCK_BYTES = 4 << 20
_CODERS: dict[str, ChunkCoder] = {}


def splits_at_spaces(spec: dict) -> bool:
    """Whether ids of a text are the ids of its blank-separated chunks, one after the other: white
    space is removed by the splitter and no added token holds or takes in a blank."""
    pre = spec.get("pre_tokenizer") or {}
    first = (pre.get("pretokenizers") or [pre])[0]
    pattern = (first.get("pattern") or {}).get("Regex", "")
    removes = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") and (
        not re.search(r"\\s|\s", pattern.replace(r"[^\s", "[^")))
    free = all(not SPACE.search(a["content"]) and not a["lstrip"] and not a["rstrip"] for a in spec.get("added_tokens", []))
    known = {"NFC", "Lowercase", "Replace"}
    norm = spec.get("normalizer") or {"type": "Sequence", "normalizers": []}
    kinds = {n["type"] for n in norm.get("normalizers", [norm])}
    return bool(removes and free and kinds <= known and not spec.get("post_processor"))


#: Fixed value: the splitter whose pieces inside a chunk are known to ``splits_at_marks``.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SMALL = "a-zß-öø-ÿ"  # small letters that composing and lower-casing leave as they are
_MARKS = "!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"  # ASCII marks but the apostrophe, and "<", with which added tokens begin
_EDGE = "([" + _SMALL + "])([" + re.escape(_MARKS) + "])"
#: Byte-level spelling: printable characters of Latin-1 stand for their own byte, the others, in order, for U+0100 and up.
_SPELT = {c: 256 + i for i, c in enumerate(c for c in range(256) if not (33 <= c <= 126 or 161 <= c <= 172 or 174 <= c <= 255))}


def splits_at_marks(spec: dict) -> bool:
    """Whether the splitter also cuts between a small letter and an ASCII mark, and takes runs of either as they are."""
    pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    last = pre[-1]
    same = len(pre) == 2 and (pre[0].get("pattern") or {}).get("Regex") == WORD_PATTERN
    byte = last.get("type") == "ByteLevel" and not last.get("add_prefix_space") and not last.get("use_regex")
    return splits_at_spaces(spec) and same and byte and all(a["content"][0] not in _MARKS for a in spec.get("added_tokens", []))


class ChunkCoder:
    """Serialised ids of texts, by remembered chunks (or whole texts, if chunks are not exact). ``plain`` matches chunks that are
    runs of small letters or of marks."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_str(spec)
        self.kind = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        parsed = json.loads(spec)
        self.by_chunk = splits_at_spaces(parsed)
        self.added = [a["content"].encode() for a in parsed.get("added_tokens", [])]
        #: the id of a lone control character, which ends up in no other chunk's ids
        bar = self.tok.encode(BAR, add_special_tokens=False).ids
        self.bar = bar[0] if len(bar) == 1 else None
        self.memo = Memo(self._chunk_ids, len)
        self.plain = re.compile(f"[{_SMALL}]+|[{re.escape(_MARKS)}]+") if splits_at_marks(parsed) else None
        if self.plain:
            # such chunks need no normaliser and no splitter but at the blanks between them
            self.plain_tok = Tokenizer.from_str(json.dumps(parsed | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}}))

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=self.kind) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain_ids(self, pieces: list[str]) -> list[bytes]:
        """Many runs of letters or marks, their bytes spelt as the vocabulary spells them, go through the library as one line."""
        out = []
        for i in range(0, len(pieces), 64):
            some = [p if p.isascii() else p.encode().decode("latin-1").translate(_SPELT) for p in pieces[i:i + 64]]
            got = self.plain_tok.encode(" ".join(some), add_special_tokens=False)
            ends = np.searchsorted(np.array(got.word_ids), np.arange(len(some)), "right").tolist()
            data, w = np.array(got.ids, dtype=self.kind).tobytes(), self.kind.itemsize
            out += [data[a * w:z * w] for a, z in zip([0, *ends], ends)]
        return out

    def _joined(self, chunks: list[str]) -> list[bytes]:
        """Many chunks go through the library as one line, a bar after each."""
        out = []
        for i in range(0, len(chunks), 512):
            some = chunks[i:i + 512]
            ids = np.array(self.tok.encode(f" {BAR} ".join(some) + f" {BAR}", add_special_tokens=False).ids, dtype=self.kind)
            ends = np.flatnonzero(ids == self.bar).tolist()
            if len(ends) != len(some):
                raise ValueError("the bar's id occurs in another chunk")
            out += [ids[a:z].tobytes() for a, z in zip([0, *[e + 1 for e in ends]], ends)]
        return out

    def _chunk_ids(self, chunks: list[str]) -> list[bytes]:
        if self.bar is None:
            return [i.tobytes() for i in self._ids(chunks)]
        out: dict[str, bytes] = {}
        if self.plain:
            plain = [c for c in chunks if self.plain.fullmatch(c)]
            out = dict(zip(plain, self._plain_ids(plain)))
        left = [c for c in chunks if c not in out and BAR not in c]
        out |= dict(zip(left, self._joined(left)))
        rest = [c for c in chunks if BAR in c]
        out |= {c: i.tobytes() for c, i in zip(rest, self._ids(rest))}
        return [out[c] for c in chunks]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Serialised ids of each text (null: none)."""
        if not self.by_chunk:
            return [i.tobytes() for i in self._ids([t or "" for t in texts.to_pylist()])]
        parts = pc.split_pattern(self._spaced(pc.fill_null(texts, "")), " ")
        chunks = parts.flatten().dictionary_encode()
        names = chunks.dictionary.to_pylist()
        ids = self.memo.values(names)
        size = np.array([len(i) for i in ids], np.int64) // self.kind.itemsize
        flat, place = np.frombuffer(b"".join(ids), self.kind), chunks.indices.to_numpy()
        n = size[place]
        ends = np.cumsum(n)
        first = (np.cumsum(size) - size)[place]
        out = flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - n), n)]
        bounds = np.r_[0, ends][parts.offsets.to_numpy() - parts.offsets[0].as_py()]
        return [out[a:z].tobytes() for a, z in zip(bounds[:-1], bounds[1:])]

    def _spaced(self, texts: pa.Array) -> pa.Array:
        """The texts with every white space a blank. Where that cannot change their ids (no added token occurs or comes about, and
        both forms are composed already: the tokenizer composes characters before it lower-cases), A-Z are lower-cased
        and small letters parted from marks, for fewer different chunks."""
        texts = texts.cast(pa.string())
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1]
        raw = b"" if data is None else data[int(at[0]):int(at[-1])].to_pybytes()
        low = raw.translate(_LOWER)
        free = not any(a in raw or a in low for a in self.added)
        free = free and unicodedata.is_normalized("NFC", raw.decode()) and unicodedata.is_normalized("NFC", low.decode())
        out = pa.Array.from_buffers(texts.type, len(texts), [None, pa.py_buffer((at - at[0]).tobytes()), pa.py_buffer(low if free else raw.translate(_BLANK))])
        return pc.replace_substring_regex(out, pattern=_EDGE, replacement=r"\1 \2") if free and self.plain else out


_BLANK = bytes(32 if 9 <= c <= 13 else c for c in range(256))
_LOWER = bytes(c + 32 if 65 <= c <= 90 else _BLANK[c] for c in range(256))


def coder(spec: str) -> ChunkCoder:
    """The worker's coder of this vocabulary; Python workers are used for many tasks."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _CODERS:
        _CODERS[key] = ChunkCoder(spec)
    return _CODERS[key]


def _encoded(batches, spec, end_id):
    """Record batches (.., text) -> (batch, bytes of each text's ids, their type), in input order."""
    c = coder(spec)
    end = np.array([end_id], dtype=c.kind).tobytes()
    for b in small_batches(batches, 2048):
        if b.num_rows:
            yield b, [x + end for x in c.encode(b.column(b.num_columns - 1))], c.kind


def train_dictionary(docs: DataFrame, spec: str, end_id: int, text: str = "text", sample: int = 2000,
                     sample_bytes: int = 16 << 20, size: int = 65536) -> bytes:
    """A dictionary for serialised id arrays (see above): a bounded sample at every input size."""
    def run(batches):
        for _, ids, _ in _encoded(batches, spec, end_id):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], names=["ids"])
    named = docs.where(F.col(text).isNotNull()).select(F.xxhash64(text).alias("h"), F.col(text).alias("t"))
    few = named.groupBy("h").agg(F.max(F.octet_length("t")).alias("size")).orderBy("h").limit(sample).collect()
    chosen, left = [], sample_bytes
    for r in few:
        if r["size"] <= left:
            chosen.append((r["h"],))
            left -= r["size"]
    if not chosen:
        return b""
    wanted = F.broadcast(docs.sparkSession.createDataFrame(chosen, "h long"))
    once = named.where(F.col("h") <= chosen[-1][0]).join(wanted, "h", "left_semi").dropDuplicates(["h"])  # copies merged
    rows = sorted(bytes(r["ids"]) for r in once.select("t").mapInArrow(run, "ids binary").collect())
    try:
        return zstandard.train_dictionary(size, rows).as_bytes()
    except zstandard.ZstdError:
        return b"".join(rows)[:size]


def write(docs: DataFrame, spec: str, end_id: int, path: str | None = None, id_col: str = "doc_id",
          text: str = "text", block_bytes: int = BLOCK_BYTES) -> str:
    """Tokenize and write all documents in ascending id order; returns the folder. Every range of ids
    is packed into blocks of about ``block_bytes``."""
    spark = docs.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    dictionary = train_dictionary(docs, spec, end_id, text)
    sha = hashlib.sha256(dictionary).hexdigest()
    width = coder(spec).kind.itemsize
    spark.createDataFrame([(sha, bytearray(dictionary), width)], "dict_sha256 string, dictionary binary, width int") \
        .coalesce(1).write.parquet(f"{path}/dictionary")

    def tokenize(batches):
        d = zstandard.ZstdCompressionDict(dictionary)
        d.precompute_compress(level=3)
        squeeze = zstandard.ZstdCompressor(level=3, dict_data=d).compress
        for b, ids, kind in _encoded(batches, spec, end_id):
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(i) // kind.itemsize for i in ids], pa.int64()),
                 pa.array([squeeze(i) for i in ids], pa.binary())], names=["doc", "th", "n", "frame"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text).alias("th"), F.col(text).alias("t"))
    frames = rows.mapInArrow(tokenize, "doc long, th long, n long, frame binary")
    staged = frames.withColumn("uid", F.monotonically_increasing_id()).checkpoint()

    def pack(batches):
        held: list = []  # (doc, n, frame) of the block being filled
        now, size, seq, start = None, 0, 0, 0

        def block():
            docs_, ns, fr = (list(x) for x in zip(*held))
            offs = np.cumsum([0, *map(len, fr)])[:-1].tolist()
            known = [d for d in docs_ if d is not None]
            return pa.RecordBatch.from_pylist([{
                "range": now, "seq": seq, "start": start, "n_ids": sum(ns), "first_doc": min(known, default=None),
                "last_doc": max(known, default=None), "dict_sha256": sha, "docs": docs_, "offsets": offs,
                "counts": ns, "frames": b"".join(fr)}], schema=BLOCK)

        for b in batches:
            for r, doc_, n_, frame in zip(*(b.column(i).to_pylist() for i in (2, 0, 3, 4))):
                if held and (size >= block_bytes or r != now):
                    yield block()
                    seq, start = (seq + 1, start + sum(h[1] for h in held)) if r == now else (0, 0)
                    held, size = [], 0
                now = r
                held.append((doc_, n_, frame))
                size += len(frame)
        if held:
            yield block()

    key = ("doc", "th", "n", "uid")
    dealt = staged.repartitionByRange(shuffle_partitions(spark), *key).sortWithinPartitions(*key)
    packed = dealt.select("doc", "th", F.spark_partition_id().alias("range"), "n", "frame").mapInArrow(pack, BLOCK_DDL)
    packed.write.option("compression", "none").parquet(f"{path}/blocks")
    return path


BLOCK = pa.schema([
    ("range", pa.int32()), ("seq", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()), ("first_doc", pa.int64()),
    ("last_doc", pa.int64()), ("dict_sha256", pa.string()), ("docs", pa.list_(pa.int64())),
    ("offsets", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("frames", pa.binary())])
BLOCK_DDL = ("range int, seq int, start long, n_ids long, first_doc long, last_doc long, dict_sha256 string, "
             "docs array<long>, offsets array<long>, counts array<long>, frames binary")


def _dictionary(spark: SparkSession, path: str) -> tuple[str, bytes, np.dtype]:
    r = spark.read.parquet(f"{path}/dictionary").first()
    d = bytes(r["dictionary"])
    if hashlib.sha256(d).hexdigest() != r["dict_sha256"]:
        raise ValueError("token file: the dictionary does not match its hash")
    return r["dict_sha256"], d, np.dtype(f"<u{r['width']}")


def read(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """All documents of a file set: doc, start (ids of all documents before it), n_tokens and ids,
    or with ``digest`` the unsigned CRC-32 of the ids as 32-bit integers instead of them."""
    sha, dictionary, kind = _dictionary(spark, path)
    blocks = spark.read.parquet(f"{path}/blocks")
    # ids before each range: one row per range, as many as the job had shuffle partitions
    total = blocks.groupBy("range").agg(F.sum("n_ids").alias("n"))
    before = total.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("base"))

    def run(batches):
        inflate = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)).decompress
        for b in batches:
            for r in range(b.num_rows):
                start, want, docs, offs, ns, frames = (b.column(i)[r].as_py() for i in range(6))
                if want != sha:
                    raise ValueError("token file: block written with another dictionary")
                ids = [np.frombuffer(inflate(frames[a:z]), dtype=kind) for a, z in zip(offs, [*offs[1:], len(frames)])]
                if [len(i) for i in ids] != ns:
                    raise ValueError("token file: a block does not hold the ids its index names")
                begin = start + np.cumsum([0, *ns])[:-1]
                last = pa.array([zlib.crc32(i.astype("<u4").tobytes()) for i in ids], pa.int64()) if digest else \
                    pa.array([i.astype(np.int64) for i in ids], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64()), pa.array(begin, pa.int64()), pa.array(ns, pa.int64()), last],
                    names=["doc", "start", "n_tokens", "ids"])

    rows = blocks.join(F.broadcast(before), "range").select(
        (F.col("start") + F.col("base")).alias("start"), "dict_sha256", "docs", "offsets", "counts", "frames")
    return rows.mapInArrow(run, f"doc long, start long, n_tokens long, ids {'long' if digest else 'array<long>'}")


def read_document(spark: SparkSession, path: str, doc: int) -> list[list[int]]:
    """Ids of one document (a list per row with that id): its blocks are found by the first and last
    id in the Parquet statistics, and only its own frames leave them and are inflated."""
    _, dictionary, kind = _dictionary(spark, path)
    inflate = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)).decompress
    hit = spark.read.parquet(f"{path}/blocks").where((F.col("first_doc") <= doc) & (F.col("last_doc") >= doc))
    ends = F.concat(F.slice("offsets", F.lit(2), F.size("offsets")), F.array(F.length("frames").cast("long")))
    one = hit.select("offsets", ends.alias("ends"), "frames", F.posexplode("docs").alias("i", "d")).where(F.col("d") == doc)
    a, z = (F.element_at(c, F.col("i") + 1).cast("int") for c in ("offsets", "ends"))
    return [np.frombuffer(inflate(bytes(r["f"])), dtype=kind).tolist()
            for r in one.select(F.col("frames").substr(a + 1, z - a).alias("f")).collect()]
