"""Physical-plan checks: broadcast vocabulary, TakeOrdered for top-k, one exchange for CBOW
windows, pushed-down filters and pruned columns on the scan."""

from vecspark.plans import corpus as C
from vecspark.operators import text as T
from vecspark.operators import windows as W

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_encode_broadcasts_vocabulary(spark):
    vocab, enc = C.vocab_and_encoded(spark, SF)
    p = _plan(enc)
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_peek_is_take_ordered(spark):
    p = _plan(T.peek(C.sentences(spark, SF), 5, ["doc_id", "line_no"]))
    assert "TakeOrderedAndProject" in p


def test_cbow_windows_single_exchange(spark):
    vocab, enc = C.vocab_and_encoded(spark, SF)
    win = W.cbow_windows(enc, 2)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = _plan(win)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # the token rows are shuffled once, on the (line, chunk) key; the only other exchange
    # feeds the vocabulary's per-partition count table (one row per partition)
    assert p.count("Exchange hashpartitioning(doc_id") == 1, p
    assert p.count("Exchange hashpartitioning(") == 2, p


def test_scan_prunes_columns_and_pushes_filters(spark):
    from vecspark.sources.corpus import read_documents
    p = _plan(read_documents(spark, SF, lang="en"))
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in p
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in p


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["doc_id", "line_no", "pos", "c1", "c2", "c3", "c4", "target"]
    assert df.count() > 0
