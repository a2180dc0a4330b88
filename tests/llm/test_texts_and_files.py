"""Language ID, URL rules, pieces, token files, decontamination and the pipeline on small tables."""

import zlib

import numpy as np
import pytest

from vecspark.llm import decontam, langid, piece, tokenfile, urlfilter
from vecspark.llm.queries import tokenizer_file

TEXTS = ["", None, " ", "a  b", "Hello world\nnext 12", "é́ 🎉 <|endoftext|> x", "the cat " * 3000, "dup", "dup"]


def test_language_id(spark):
    rows = [(i, "the cat sat on the mat with the other cats and dogs", "en") for i in range(5)]
    rows += [(i, "der Hund und die Katze sitzen auf dem Teppich nicht", "de") for i in range(5, 8)]
    rows += [(10, None, "en"), (11, "123 !!", "en"), (12, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.identify(df, langid.train(df), keep=("doc_id",)).collect()}
    assert got[0].lang_pred == "en" and got[6].lang_pred == "de" and not got[6].rejected
    assert all(got[i].lang_pred == "und" and got[i].rejected and got[i].score == 0 for i in (10, 11, 12))
    none = langid.identify(df, langid.train(df.where("lang = 'xx'")), keep=("doc_id",)).collect()
    assert {r.lang_pred for r in none} == {"und"}


def test_language_sizes_against_brute_force(spark):
    """Every size, score and margin recomputed block by block with zstandard itself, on whole texts."""
    import zstandard
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    model = langid.train(docs, bytes_per_lang=40_000)
    langs = list(model.dictionaries)
    assert all(0 < len(d) <= 41_000 for d in model.dictionaries.values())
    make = lambda d: zstandard.ZstdCompressor(level=model.level, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                                              write_content_size=False, write_checksum=False, write_dict_id=False)
    coders = [make(d) for d in model.dictionaries.values()]
    texts = {r.doc_id: r.text for r in docs.collect()}
    seen = 0
    for r in langid.identify(docs, model, keep=("doc_id",)).collect():
        text = texts[r.doc_id] or ""
        if not any(c.isalpha() for c in text):
            assert r.lang_pred == "und"
            continue
        data = langid.letters(text)
        sizes = [sum(len(c.compress(data[i:i + 2048])) for i in range(0, len(data), 2048)) for c in coders]
        best = min(sizes)
        rest = sorted(sizes)[1]
        assert r.lang_pred == langs[sizes.index(best)] and abs(r.margin - (rest - best) / best) < 1e-12
        assert abs(r.score - 1 / sum(2.0 ** max(best - s, -60) for s in sizes)) < 1e-12 and r.rejected == ((rest - best) / best < 0.002)
        seen += 1
    assert seen > 100
    empty = docs.limit(0)
    assert langid.identify(empty, model, keep=("doc_id",)).collect() == [] and langid.train(empty).dictionaries == {}


def test_language_sample_merges_copies_first(spark):
    texts = [f"text number {i}" for i in range(40)]
    hashes = {r.t: r.h for r in spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("t", "xxhash64(t) h").collect()}
    texts.sort(key=hashes.get)
    rows = [(texts[0], "en")] * 1000 + [(t, "en") for t in texts[1:]]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string").repartition(3), docs_per_lang=30)
    assert model.dictionaries["en"] == b"\n".join(langid.letters(t) for t in texts[:30])


def test_url_rules(spark):
    rules = [urlfilter.host_rule(r, v) for r, v in (("net/", "block"), ("example.net/en/", "allow"), ("org/fr/", "allow"))]
    urls = ["http://A.Example.NET/en/x?q", "https://x.net", "https://x.net/", "http://internet/", "http://a.org/fr", "http://a.org/fr/1#t",
            "http://cheap-pills.com/", "nourl", None, "http://x.net/", "http://net:80/"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(df, [*rules, *urlfilter.PATTERN_RULES], keep=("page_id",)).collect()}
    assert got[0] == ("a.example.net", "/en/x", "example.net/en/", "allow") and got[1] == ("x.net", "", None, "allow")
    assert got[2][2:] == ("net/", "block") == got[9][2:] and got[3][2] is None and got[4][2] is None
    assert got[5] == ("a.org", "/fr/1", "org/fr/", "allow") and got[6][2:] == ("subject:pills", "block")
    assert got[7] == ("", "", None, "allow") == got[8] and got[10][2] is None


def test_wildcard_rules_are_filed_under_their_rarest_token(spark):
    r = urlfilter.wildcard_rule("^free^*/get/crack*b-c^", "block")
    assert r.tokens == ("free", "get", "c")
    rules = [urlfilter.wildcard_rule("^free^*^bonus^", "block"), urlfilter.wildcard_rule("^www^*bets", "allow", 1), *urlfilter.PATTERN_RULES]
    urls = ["http://free.a.org/x/bonus", "http://free.a.org/x/bonuses", "http://freeway.org/bonus", "http://www.my-bets.org/free/bonus/", "http://a.org/" + "free/" * 5000 + "bonus",
            "http://free-bets.org", "http://free-betsy.org", "http://www.org/" + "w" * 50_000, None]
    df = spark.createDataFrame([(i, u, "h", "p", "t") for i, u in enumerate(urls)], "page_id long, url string, host string, path string, token string")
    got = {x.page_id: (x.rule, x.verdict) for x in urlfilter.judge(df, rules, keep=("page_id",)).collect()}
    hit = ("wild:^free^*^bonus^", "block")
    assert got == {0: hit, 1: (None, "allow"), 2: (None, "allow"), 3: ("wild:^www^*bets", "allow"), 4: hit, 5: ("wild:^free^bets^", "block"),
                   6: (None, "allow"), 7: (None, "allow"), 8: (None, "allow")}
    tokens = spark.createDataFrame([("free",)] * 9 + [("bonus",)] * 2, "token string")
    index = {x.rule: x.token for x in urlfilter._index(spark, rules, tokens).collect()}
    assert index["wild:^free^*^bonus^"] == "bonus" and index["wild:^free^bets^"] == "bets"
    assert urlfilter.judge(df.limit(0), rules, keep=("page_id",)).collect() == []


def test_pieces(spark):
    model = open(tokenizer_file("piece_bpe_32k.model"), "rb").read()
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    sp = piece.coder(model).sp
    for r in piece.encode(df, model, keep=("doc_id",), outputs=("ids", "spans", "decoded", "n_tokens")).collect():
        t = TEXTS[r.doc_id] or ""
        assert r.ids == sp.encode(t) and r.decoded == sp.decode(r.ids) and r.n_tokens == len(r.ids) == len(r.spans) - 1
        assert r.spans == sorted(r.spans) and (not t or (r.spans[0], r.spans[-1]) == (0, len(t.encode())))


def test_normaliser_follows_its_map():
    # a hand-made trie: "a" -> "b", "ab" -> "xyz"
    def unit(label, leaf=False, base=0, value=None):
        return value if value is not None else label | (256 if leaf else 0) | base << 10
    trie = [0] * 512
    trie[0] = unit(0, base=256)                      # children of the root at 256 ^ label
    a = 256 ^ ord("a")
    trie[a] = unit(ord("a"), True, base=0x80)
    leaf = a ^ 0x80
    trie[leaf] = 0 | 1 << 31
    b = leaf ^ ord("b")
    trie[b] = unit(ord("b"), True, base=0x11)
    trie[b ^ 0x11] = 2 | 1 << 31
    import struct
    blob = struct.pack(f"<{len(trie)}I", *trie)
    n = piece.Normalizer(struct.pack("<I", len(blob)) + blob + b"b\0xyz\0", dummy_prefix=False)
    out, src = n.apply("abac é".encode())
    assert out == "xyzbc▁é".encode() and src.tolist() == [0, 0, 0, 2, 3, 4, 4, 4, 5, 5, 7]


def test_token_files(spark):
    spec = open(tokenizer_file("word_bpe_49k.json"), encoding="utf-8").read()
    ids = [30, 2, 40, 1, 7, 50, 3, 8, 9]
    df = spark.createDataFrame(list(zip(ids, TEXTS)), "doc_id long, text string")
    path = tokenfile.write(df, spec, end_id=1, block_bytes=200)
    tok = tokenfile.coder(spec).tok
    want, start = {}, 0
    for d, t in sorted(zip(ids, TEXTS), key=lambda x: x[0]):
        i = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        want[d] = (start, len(i), zlib.crc32(np.array(i, "<u4").tobytes()), i)
        start += len(i)
    assert {r.doc: (r.start, r.n_tokens, r.ids) for r in tokenfile.read(spark, path, digest=True).collect()} == {d: w[:3] for d, w in want.items()}
    assert {r.doc: r.ids for r in tokenfile.read(spark, path).collect()} == {d: w[3] for d, w in want.items()}
    assert tokenfile.read_document(spark, path, 7) == [want[7][3]] and tokenfile.read_document(spark, path, 999) == []
    empty = tokenfile.write(df.where("doc_id < 0"), spec, end_id=1)
    assert tokenfile.read(spark, empty, digest=True).collect() == []


def test_decontamination(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven"), (2, "Short Item"), (3, None), (4, "!!")],
                                  "item_id long, text string")
    docs = [(1, "x ONE two, three four five six seven eight nine ten y"), (2, "a short item"), (3, None), (4, "short, other item"), (5, "item short"),
            (6, "two three four five six seven eight nine ten eleven"), (2, "a short item")]
    df = spark.createDataFrame([(*d, "one two", 9, 9, "t") for d in docs], "doc_id long, text string, words string, uid long, term int, th string")
    items = items.selectExpr("*", "1 AS win", "'x' AS words", "2 AS item")
    got = sorted((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in decontam.contamination(df, items).collect())
    assert got == [(1, 12, 10, ["1"]), (2, 3, 2, ["2"]), (2, 3, 2, ["2"]), (3, 0, 0, []), (4, 3, 0, []), (5, 2, 0, []), (6, 10, 10, ["1"])]
    staged, win = decontam.stage_words(df), decontam.windows_of(items)
    near = {r.doc for r in decontam.proximity_matches(staged, win, slack=1).collect()}
    assert {2, 4, 5} <= near
    assert decontam.contamination(df.where("doc_id < 0"), items).collect() == []


def test_chunk_ids_are_the_librarys(spark):
    """Odd characters, marks next to letters, special tokens, characters that compose; slices of batches; nulls."""
    import pyarrow as pa
    c = tokenfile.coder(open(tokenizer_file("word_bpe_49k.json"), encoding="utf-8").read())
    assert c.by_chunk and c.plain
    odd = ["a", "Z", "é", "É", "ß", "ÿ", "÷", "'s", "'", "\u0301", "H\u0331", "İ", "Σ", "漢", "1", "٣", ".", "%%", "<|endoftext|>", "<|ENDOFTEXT|>", "<", "|", ">",
           " ", "  ", "\t", "\n", " ", " ", "\x01", "\x85", "ﬁ", "Ⅷ", "😀", "\u200d", "_", "-", "\x00", "\x1c"]
    r = np.random.default_rng(2)
    texts = ["".join(r.choice(odd, int(r.integers(0, 25)))) for _ in range(3000)] + ["word, and (more) words: it's... don't!"] * 3 + [None, ""]
    held = pa.array(texts)
    for step in (1, 7, 500):
        for i in range(0, len(texts), step) if step > 1 else range(0, 400):
            part = held.slice(i, step)
            assert [np.frombuffer(x, c.kind).tolist() for x in c.encode(part)] == [c.tok.encode(t or "", add_special_tokens=False).ids for t in part.to_pylist()]
    clean = pa.array(["Plain Text, with (marks); and words.", "Weiß, Größe: é."] * 50)
    assert [np.frombuffer(x, c.kind).tolist() for x in c.encode(clean)] == [c.tok.encode(t, add_special_tokens=False).ids for t in clean.to_pylist()]


def test_long_units_are_not_remembered():
    from vecspark.llm.common import Memo
    asked = []
    memo = Memo(lambda ks: asked.extend(ks) or [k.encode() for k in ks], len, limit=100_000)
    for i in range(300):
        keys = [f"{i}-{j}" + "x" * 10_000 for j in range(10)] + ["often", f"once {i}"]
        assert memo.values(keys) == [k.encode() for k in keys] and (i % 7 or memo.of(keys[-2:]) == {k: k.encode() for k in keys[-2:]})
        assert sum(map(len, memo.known)) + sum(map(len, memo.old)) < 400_000
    assert asked.count("often") == 1
    for i in range(3000):   # generations change; what is asked for stays
        assert memo.of([f"k{i}", "often"])["often"] == b"often"
    assert asked.count("often") == 1 and len(memo.known) + len(memo.old) < 1000


def test_many_long_units_stay_within_memory():
    import resource
    import subprocess
    import sys
    code = """
import resource, sys, random
import pyarrow as pa
from vecspark.llm import tokenfile, piece
from vecspark.llm.queries import tokenizer_file
random.seed(1)
c = tokenfile.coder(open(tokenizer_file("word_bpe_49k.json"), encoding="utf-8").read())
p = piece.coder(open(tokenizer_file("piece_bpe_32k.model"), "rb").read())
c.encode(pa.array(["warm up"])), p.encode(["warm up"])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
for i in range(60):
    units = [("%x" % random.getrandbits(40_000)) for _ in range(20)]
    c.encode(pa.array(units)), p.encode(units)
print("GREW", (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=tokenfile.__file__.split("/vecspark/")[0])
    assert int(out.stdout.split("GREW")[1]) < 120, out.stdout + out.stderr[-500:]


def test_remembered_pieces_stay_small():
    import subprocess
    import sys
    code = """
import sys
from vecspark.llm import piece
from vecspark.llm.queries import tokenizer_file
p = piece.coder(open(tokenizer_file("piece_bpe_32k.model"), "rb").read())
texts = [" ".join("w%d" % (1_000_000 + i) for i in range(at, at + 2000)) for at in range(0, 600_000, 2000)]
for t in texts:
    p.encode([t])
size = lambda v: sys.getsizeof(v) + (sum(map(size, v)) if isinstance(v, tuple) else 0)
print("KEPT", sum(size(d) + sum(size(k) + size(v) for k, v in d.items()) for d in (p.memo.known, p.memo.old)) >> 20)
for t in [*texts[:2], *texts[-2:], "", "a  b", "x\\ny \\n z"]:
    (ids, joined), = p.encode([t])
    assert ids.tolist() == p.sp.encode(t) and joined == ",".join(map(str, ids.tolist()))
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=tokenfile.__file__.split("/vecspark/")[0])
    assert not out.returncode and int(out.stdout.split("KEPT")[1]) < 64, out.stdout + out.stderr[-500:]


def test_small_tables_need_no_python_workers(spark, monkeypatch):
    """A list of rows given to Spark is read by Python workers of their own, which stay in an executor's memory."""
    docs = spark.createDataFrame([(i, f"the {i} cats and dogs", "en") for i in range(20)]
                                 + [(i, f"der {i} hund und die katze", "de") for i in range(20, 50)], "doc_id long, text string, lang string").cache()
    items = spark.createDataFrame([("a", "12 cats and dogs")], "item_id string, text string").cache()
    assert docs.count() == 50 and items.count() == 1
    monkeypatch.setattr(type(spark.sparkContext), "parallelize", lambda *a, **b: pytest.fail("rows through Python workers"))
    model = langid.train(docs)
    assert list(model.dictionaries) == ["de", "en"] and all(b"".join(d.split()) for d in model.dictionaries.values())
    got = decontam.contamination(docs, items, size=4).where("n_hit > 0").collect()
    assert [(r.doc_id, r.n_hit, r["items"]) for r in got] == [(12, 4, ["a"])]


def test_token_files_of_null_and_repeated_ids(spark):
    spec = open(tokenizer_file("word_bpe_49k.json"), encoding="utf-8").read()
    rows = [(None, f"text {i}", 1, 2) for i in range(30)] + [(4, "same", 1, 2)] * 20 + [(i, f"number {i} " * 40, 1, 2) for i in range(100, 130)]
    df = spark.createDataFrame(rows, "doc_id long, text string, frame int, uid int").repartition(3)
    got = tokenfile.read(spark, tokenfile.write(df, spec, end_id=1, block_bytes=300)).orderBy("start").collect()
    assert [r.doc for r in got] == [None] * 30 + [4] * 20 + list(range(100, 130))
    starts = np.cumsum([0, *[r.n_tokens for r in got]])
    assert [r.start for r in got] == starts[:-1].tolist()
    tok = tokenfile.coder(spec).tok
    assert sorted(map(tuple, (r.ids for r in got))) == sorted((*tok.encode(t, add_special_tokens=False).ids, 1) for _, t, _, _ in rows)


def brute_contamination(docs, items, size=10):
    import re
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in t or ""))
    wins = {}
    for item, t in items:
        w = words(t)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            wins.setdefault(tuple(w[i:i + size]), set()).add(item)
    out = []
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for win, own in wins.items():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i:i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    found |= own
        out.append((d, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return sorted(out, key=repr)


def test_decontamination_against_brute_force(spark, monkeypatch):
    r = np.random.default_rng(12)
    text = lambda n: " ".join(r.choice(["a", "b", "c", "dd", "Ee", "é", "漢"], n))
    items = [(i, text(int(r.integers(1, 16)))) for i in range(25)] + [(3, "a b"), (None, text(12)), (90, "a a a"), (91, "same passage here"), (92, "same passage here")]
    hot = "x same passage here y " + items[5][1]
    docs = [(i, text(int(r.integers(0, 60)))) for i in range(60)] + [(100 + i, hot) for i in range(40)] + [(7, items[2][1]), (7, items[4][1]), (None, hot)]
    docs += [(200, " ".join(["a"] * 4000)), (201, text(9000) + " " + items[8][1])]
    a = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    want = brute_contamination(docs, items)
    for limit in (decontam.BROADCAST_BYTES, 0):   # broadcast, and joined by shuffle
        monkeypatch.setattr(decontam, "BROADCAST_BYTES", limit)
        assert sorted(((x.doc_id, x.n_words, x.n_hit, x["items"]) for x in decontam.contamination(a, b).collect()), key=repr) == want
    assert [x["items"] for x in decontam.contamination(a.limit(3), b.limit(0)).collect()] == [[]] * 3


def test_proximity_against_brute_force(spark):
    r = np.random.default_rng(13)
    docs = [(i, " ".join(r.choice(list("abcdefgh"), int(r.integers(1, 40))))) for i in range(40)]
    items = [(i, " ".join(r.choice(list("abcdefghi"), 4))) for i in range(12)] + [(50, "a"), (51, "b b")]
    staged = decontam.stage_words(spark.createDataFrame(docs, "doc_id long, text string"))
    windows = decontam.windows_of(spark.createDataFrame(items, "item_id long, text string"))
    index = decontam.Index(staged, windows)
    got = {(x.doc, x.win, x.start) for x in decontam.proximity_matches(staged, windows, 2, index).collect()}
    first = {x.win: x.term for x in index.terms.where("place = 0").collect()}
    names = {x.win: x.words for x in windows.collect()}
    rarest = {w: names[w][x] for w, x in {x.win: x.off for x in index.terms.where("place = 0").collect()}.items()}
    want = set()
    for d, t in docs:
        w = t.split()
        for win in first:
            span = len(names[win]) + 2
            want |= {(d, win, p) for p, x in enumerate(w) if x == rarest[win] and set(names[win]) <= set(w[max(0, p - span + 1):p + span])}
    assert got == want and want


def test_decontamination_of_rows_without_id(spark, tmp_path):
    import corpus_pipeline as P
    passage = "one two three four five six seven eight nine ten"
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, f"x {passage} y"), (None, f"x {passage} y"), (None, "clean"), (None, None), (1, passage), (2, "clean")]
    df = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in decontam.contamination(df, items).collect()), key=repr)
    assert got == sorted([(None, 12, 10, ["1"])] * 2 + [(None, 1, 0, []), (None, 0, 0, []), (1, 10, 10, ["1"]), (2, 1, 0, [])], key=repr)
    near = decontam.proximity_matches(decontam.stage_words(df), decontam.windows_of(items)).collect()
    assert {r.doc for r in near} == {None, 1}
    kept = P.decontamination(spark, df, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == sorted([(None, "clean"), (None, None), (2, "clean")], key=repr)


def test_near_dedup_keeps_one_row_of_each_group(spark):
    import corpus_pipeline as P
    text = lambda name, end="": " ".join(f"{name}{i}" for i in range(80)) + end
    rows = [(5, text("a")), (5, text("a")), (3, text("a", " x")), (None, text("a", " y")),     # id 3 stays
            (7, text("b")), (7, text("c")), (6, text("c", " x")),                              # 7 of b and 6 stay
            (None, text("d")), (None, text("d", " x")), (None, text("d")),                     # one of the three
            (9, text("e")), (9, text("e")), (None, text("f")), (8, ""), (10, None)]
    df = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = P.near_dedup(spark, df.repartition(3), "")
    assert got.columns == list(P.COLUMNS)
    got = sorted(((r.doc_id, (r.text or "-")[:1]) for r in got.collect()), key=repr)
    assert got == sorted([(3, "a"), (7, "b"), (6, "c"), (None, "d"), (9, "e"), (None, "f"), (8, "-"), (10, "-")], key=repr)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_pipeline(spark, sf):
    import corpus_pipeline as P
    rows = P.run(spark, sf).select("doc_id", "n_tokens").collect()
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert 0.5 * n < len(rows) < n and len({r.doc_id for r in rows}) == len(rows)
