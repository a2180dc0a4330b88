"""Regression checks: facts measured at sf0.01 (FIXTURES.md)."""

SF = "/root/testdata/sf0.01"


def test_corpus_facts(spark, registry):
    Q = registry.QUERIES
    assert Q["sentence_filter"](spark, SF).count() == 8707
    st = Q["corpus_stats"](spark, SF).first()
    assert (st.n_samples, st.V) == (384527, 68772)
    first = [(r.word, r.n) for r in Q["vocabulary"](spark, SF).orderBy("word_id").limit(5).collect()]
    assert first == [("the", 15288), ("of", 8381), ("de", 6104), ("and", 5981), ("to", 4665)]
    assert Q["vocabulary"](spark, SF).where("n = 1").count() == 37845
    assert Q["skipgram_pairs"](spark, SF).count() == 1485866


def test_analogy_and_regression_facts(spark, registry):
    Q = registry.QUERIES
    rep = {r.task: (r.predicted_word, r.sim2) for r in
           Q["analogy_report"](spark, SF).where("embedding = 'EMB_64'").collect()}
    assert rep[" '0' is to '1' as '2' is to ?"] == ("13", 0.340587)
    assert rep[" '3' is to '4' as '5' is to ?"] == ("408", 0.352272)
    assert rep[" '6' is to '7' as '8' is to ?"] == ("442", 0.381953)
    ols = Q["linear_regression"](spark, SF).first()
    assert (ols.slope, ols.intercept) == (7.161722, 52872.347339) and abs(ols.r2 - 1.18e-5) < 1e-7


def test_some_analogies_hold_and_some_do_not(spark, registry):
    Q = registry.QUERIES
    rep = Q["analogy_report_pairs"](spark, SF).collect()
    assert {r.embedding for r in rep if r.correct} == {"PAIRS_50"} and sum(r.correct for r in rep) == 9 and len(rep) == 18
    assert Q["analogy_correct_only"](spark, SF).count() == 9
