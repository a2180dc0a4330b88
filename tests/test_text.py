"""Text path: hand cases from the survey (Q1, Q4, one-word line, unknown word) and invariants."""

import random

from pyspark.sql import functions as F

from vecspark.operators import text as T
from vecspark.operators import windows as W
from vecspark.operators.ranking import global_row_number
from vecspark.sources.corpus import lines_of


def _docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def _cbow_ref(seqs, w):
    """Plain-Python CBOW by position (the contract: the bag around each target)."""
    out = []
    for key, ids in seqs.items():
        padded = [0] * w + ids + [0] * w
        for p in range(len(ids)):
            win = padded[p:p + 2 * w + 1]
            out.append((key, p, tuple(win[:w] + win[w + 1:]), win[w]))
    return sorted(out)


def test_filter_tokenize_and_punctuation_line(spark):
    docs = _docs(spark, ["Hello, World! it's  fine\n-- -- --\none\nA b\nx y z"])
    sent = T.filter_sentences(lines_of(docs))
    assert [r.line for r in sent.orderBy("line_no").collect()] == ["Hello, World! it's  fine", "-- -- --", "x y z"]
    toks = T.tokenize(sent).orderBy("line_no", "pos").collect()
    # the punctuation-only line is kept by the filter but yields no tokens (Q4)
    assert [(r.line_no, r.word) for r in toks] == [(0, "hello"), (0, "world"), (0, "it"), (0, "s"), (0, "fine"),
                                                  (4, "x"), (4, "y"), (4, "z")]


def test_vocab_order_ties_by_first_appearance(spark):
    docs = _docs(spark, ["b a c a b d", "d c e"])
    toks = T.tokenize(T.filter_sentences(lines_of(docs)))
    v = {r.word: (r.word_id, r.n) for r in T.fit_vocab(toks).collect()}
    # counts: a2 b2 c2 d2 e1 ; first appearance b < a < c < d
    assert v == {"b": (1, 2), "a": (2, 2), "c": (3, 2), "d": (4, 2), "e": (5, 1)}


def test_vocab_keys_of_any_width_agree(spark):
    """A long key where the measured ranges fit, a decimal one for ids of full width; both order by first appearance."""
    texts = ["b a c a b d", "d c e f g", "g h i j"]
    for ids in ([0, 1, 2], [-5, 10, 11], [-(1 << 62), 5, 1 << 62]):
        docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(3)
        words = T.stage_words(T.word_lines(T.filter_sentences(lines_of(docs))))
        toks = T.tokens_of(words)
        staged, plain = (sorted(map(tuple, v.collect())) for v in (T.fit_vocab(toks, words), T.fit_vocab(toks)))
        assert staged == plain and [r[0] for r in sorted(staged, key=lambda r: r[1])][:5] == ["b", "a", "c", "d", "g"]
    empty = words.limit(0)
    assert T.fit_vocab(T.tokens_of(empty), empty).collect() == []


def test_global_row_number_matches_single_task(spark):
    random.seed(3)
    rows = [(random.randint(0, 50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "n int, k int").repartition(7)
    got = {r.k: r.rid for r in global_row_number(df, [F.col("n").desc(), F.col("k")], "rid").collect()}
    exp = {k: i + 1 for i, (n, k) in enumerate(sorted(rows, key=lambda t: (-t[0], t[1])))}
    assert got == exp


def test_unknown_words_dropped_and_renumbered(spark):
    docs = _docs(spark, ["a b c d a b", "c c x y"])
    toks = T.tokenize(T.filter_sentences(lines_of(docs)))
    vocab = spark.createDataFrame([("a", 1, 2), ("c", 2, 3)], "word string, word_id int, n long")
    enc = T.encode(toks, vocab, renumber=True).orderBy("doc_id", "pos").collect()
    assert [(r.doc_id, r.pos, r.word_id) for r in enc] == [(0, 0, 1), (0, 1, 2), (0, 2, 1), (1, 0, 2), (1, 1, 2)]
    dec = T.decode(T.encode(toks, vocab), vocab).select("doc_id", "line_no", "pos", "word")
    salted = T.decode(T.encode(toks, vocab), vocab, broadcast_bytes=0).select("doc_id", "line_no", "pos", "word")
    assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, dec.collect()))
    assert sorted(map(tuple, dec.collect())) == sorted(
        tuple(r) for r in toks.where(F.col("word").isin("a", "c")).collect())


def test_cbow_windows_repeated_target_and_chunk_halo(spark):
    random.seed(1)
    seqs = {(0, 0): [5, 3, 5, 5, 2], (0, 1): [7], (1, 0): [random.randint(1, 9) for _ in range(57)]}
    rows = [(d, l, p, i) for (d, l), ids in seqs.items() for p, i in enumerate(ids)]
    enc = spark.createDataFrame(rows, "doc_id long, line_no int, pos int, word_id int")
    exp = _cbow_ref(seqs, 2)
    for chunk in (5, 8, 1 << 16):   # tiny chunks exercise the halo copies
        got = sorted(((r.doc_id, r.line_no), r.pos, (r.c1, r.c2, r.c3, r.c4), r.target)
                     for r in W.cbow_windows(enc, 2, chunk=chunk).collect())
        assert got == exp
    # one-word line: all context is padding
    assert ((0, 1), 0, (0, 0, 0, 0), 7) in exp


def test_skipgram_pair_count_law_and_chunks(spark):
    random.seed(2)
    lens = [1, 2, 3, 10, 33]
    rows = [(0, i, p, random.randint(1, 5)) for i, L in enumerate(lens) for p in range(L)]
    enc = spark.createDataFrame(rows, "doc_id long, line_no int, pos int, word_id int")
    law = sum(2 * max(L - d, 0) for L in lens for d in (1, 2))
    base = sorted(map(tuple, W.skipgram_pairs(enc, 2).collect()))
    assert len(base) == law
    assert sorted(map(tuple, W.skipgram_pairs(enc, 2, chunk=6).collect())) == base


def test_pad_long_and_dense_positions(spark):
    rows = [(0, 0, p, p + 1) for p in range(3)]
    enc = spark.createDataFrame(rows, "doc_id long, line_no int, pos int, word_id int")
    got = sorted((r.pos, r.word_id) for r in W.pad_long(enc, 2).collect())
    assert got == [(0, 0), (1, 0), (2, 1), (3, 2), (4, 3), (5, 0), (6, 0)]
    lines = spark.createDataFrame([(0, 0, 3), (0, 1, 0)], "doc_id long, line_no int, n int")   # line 1 has no tokens
    empty = sorted((r.pos, r.word_id) for r in W.pad_long(enc, 2, lines=lines).collect() if r.line_no == 1)
    assert empty == [(0, 0), (1, 0), (2, 0), (3, 0)]
    sparse = spark.createDataFrame([(0, 0, p, p) for p in (3, 9, 10, 40)], "doc_id long, line_no int, pos int, word_id int")
    assert sorted((r.pos, r.word_id) for r in T.dense_positions(sparse, chunk=4).collect()) == \
        [(0, 3), (1, 9), (2, 10), (3, 40)]


def test_corpus_invariants_sf0001(spark):
    from vecspark.plans import corpus as C
    sf = "/root/testdata/sf0.001"
    vocab, enc = C.vocab_and_encoded(spark, sf)
    n_tok = C.tokens(spark, sf).count()
    win = W.cbow_windows(enc, 2)
    assert win.count() == n_tok == enc.count()
    lens = enc.groupBy("doc_id", "line_no").count().collect()
    law = sum(2 * max(r["count"] - d, 0) for r in lens for d in (1, 2))
    assert W.skipgram_pairs(enc, 2).count() == law
    stats = T.corpus_stats(C.tokens(spark, sf), vocab).first()
    assert stats.n_samples == n_tok and stats.V == vocab.count() + 1


def test_one_hot_roundtrip(spark):
    df = spark.createDataFrame([(0, 3), (1, 0), (2, 9)], "r long, id int")
    sp = T.one_hot(df, "id", 10, ["r"])
    assert sorted(map(tuple, T.one_hot_argmax(sp, ["r"]).collect())) == [(0, 3), (1, 0), (2, 9)]


def test_encode_salted_fallback_matches_broadcast(spark):
    from vecspark.plans import corpus as C
    sf = "/root/testdata/sf0.001"
    toks = C.tokens(spark, sf)
    vocab = T.fit_vocab(toks)
    a = sorted(map(tuple, T.encode(toks, vocab).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "64")     # makes several words "hot"
    try:
        b = sorted(map(tuple, T.encode(toks, vocab, broadcast_bytes=0).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert a == b and len(a) == toks.count()


def test_salted_join_spreads_hot_key(spark):
    from vecspark.operators.joins import hot_keys, salted_join
    big = spark.range(20000).select((F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50)).alias("k"),
                                    F.col("id"))
    small = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    hot = hot_keys(big.groupBy("k").count(), "k", "count")
    assert [r.k for r in hot.collect()] == [7]
    # a key with a third of the rows gets a third of the partitions, at any number of them
    spark.conf.set("spark.sql.shuffle.partitions", "1000")
    try:
        assert [r.salts for r in hot_keys(big.groupBy("k").count(), "k", "count").where("k = 7").collect()][0] > 333
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    j = salted_join(big, small, "k", hot, ["id"])
    assert j.count() == 20000 and j.where("v != k * 10").count() == 0


def test_read_lines_from_text_files(spark, tmp_path):
    from vecspark.sources.corpus import read_lines
    (tmp_path / "a.txt").write_text("first line here\nsecond one\n\n")
    (tmp_path / "b.txt").write_text("only line of b")
    (tmp_path / "c.txt").write_text("")
    lines = read_lines(spark, str(tmp_path), numbered=True)
    got = sorted(map(tuple, lines.collect()))
    assert got == [(0, 0, "first line here", 0), (0, 1, "second one", 1), (0, 2, "", 2), (1, 0, "only line of b", 3)]


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    from vecspark.sources.corpus import read_lines
    text = [f"line {i} " + "x" * (i % 90) + ("\r" if i % 7 == 0 else "") for i in range(20_000)]
    for name, part in (("a", text[:15_000]), ("b", text[15_000:])):
        (tmp_path / f"{name}.txt").write_bytes("\n".join(part).encode() + b"\n")
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("64k", "900k"):  # many splits a file; several splits in one task
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1k")
            raw = spark.read.option("lineSep", "\n").text(str(tmp_path / "a.txt"))
            assert size == "900k" or raw.rdd.getNumPartitions() > 8
            got = sorted(map(tuple, read_lines(spark, str(tmp_path), numbered=True).collect()), key=lambda r: r[3])
            assert [r[2] for r in got] == text and [r[3] for r in got] == list(range(20_000))
            assert [r[:2] for r in got] == [(0, i) for i in range(15_000)] + [(1, i) for i in range(5000)]
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_one_huge_line_is_split_into_bounded_groups(spark):
    # one line holds more than a third of all tokens
    big = spark.range(60000).select(F.lit(7).cast("long").alias("doc_id"), F.lit(0).alias("line_no"),
                                    F.col("id").cast("int").alias("pos"),
                                    (F.col("id") % 97 + 1).cast("int").alias("word_id"))
    small = spark.range(40000).select((F.col("id") % 4000 + 100).alias("doc_id"), F.lit(0).alias("line_no"),
                                      (F.col("id") / 4000).cast("int").alias("pos"),
                                      (F.col("id") % 89 + 1).cast("int").alias("word_id"))
    enc = big.unionByName(small)
    chunk, w = 1000, 2
    staged = W._with_halo(enc, w, chunk)
    biggest = staged.groupBy("doc_id", "line_no", "_chunk").count().agg(F.max("count")).first()[0]
    assert biggest <= chunk + 2 * w
    win = W.cbow_windows(enc, w, chunk=chunk).where("doc_id = 7")
    assert win.count() == 60000
    row = win.where("pos = 5000").first()           # a chunk boundary: neighbours come from the halo
    assert (row.c1, row.c2, row.target, row.c3, row.c4) == tuple(p % 97 + 1 for p in range(4998, 5003))
    edge = win.where("pos = 59999").first()
    assert (edge.c3, edge.c4) == (0, 0)


def test_only_rare_words_travel_when_the_vocabulary_is_large(spark, monkeypatch):
    """Of a vocabulary beyond the broadcast bound the frequent words are broadcast; the shuffle join gets the tokens of the others alone."""
    from vecspark.operators import text as T
    lines = spark.createDataFrame([(d, 0, "the cat and the dog and the bird " * 10 + f"rare{d} word{d}") for d in range(60)], "doc_id long, line_no int, line string")
    toks = T.tokenize(lines)
    vocab = T.fit_vocab(toks).checkpoint()
    want = sorted(map(tuple, T.encode(toks, vocab).collect()))
    met, join = [], T.salted_join
    monkeypatch.setattr(T, "salted_join", lambda big, *a, **k: met.append(big.count()) or join(big, *a, **k))
    got = T.encode(toks, vocab, broadcast_bytes=3000)
    assert sorted(map(tuple, got.collect())) == want
    assert sorted(map(tuple, T.decode(got, vocab, broadcast_bytes=3000).select("doc_id", "line_no", "pos", "word").collect())) == sorted(map(tuple, toks.collect()))
    assert len(met) == 2 and max(met) < 0.03 * len(want)
