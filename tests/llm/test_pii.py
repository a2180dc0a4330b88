"""Base spans against the plain patterns; the learned part on a small corpus."""

import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from vecspark.llm import pii

PLAIN = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def plain(text):
    out = []
    for kind, p in PLAIN:
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                  "card": 16 <= len(d) <= 19 and pii.luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, *m.span()))
    return out


@settings(max_examples=3000, deadline=None)
@given(st.text(alphabet="a.@0123459 -+()%_é\n", max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    assert pii.base_spans(text) == plain(text)


def test_card_numbers():
    r = random.Random(0)
    for _ in range(2000):
        text = "".join(r.choice("0123456789 -x") for _ in range(60))
        assert pii.cards(text) == [s for s in plain(text) if s[0] == "card"]
    assert pii.cards("pay 4111 1111 1111 1111 now") == [("card", 4, 23)]


def test_long_runs_are_linear():
    for c in ("a", "1", "1.", "1 ", "+1", "a@", "a@b."):
        pii.base_spans(c * 200_000)


def test_weak_supervision_adds_spans(spark):
    r = random.Random(1)
    word = lambda: r.choice(["lorem", "ipsum", "dolor", "sit", "amet"])
    rows = []
    for i in range(300):
        t = " ".join(word() for _ in range(30))
        if i % 3 == 0:
            t += f" contact ann.{i}@mail.example.com or call +1 (415) 555-{1000 + i} {word()}"
        if i % 5 == 0:
            t += f" write to bob{i} (at) mail (dot) org {word()}"
        if i % 7 == 0:
            t += f" ssn {100 + i}-45-{6789 - i} {word()}"
        rows.append((i, t))
    rows += [(1000, None), (1001, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.train(df)
    got = {x.doc_id: x for x in pii.find(df, model, keep=("doc_id",), masked=True).collect()}
    for i, t in rows:
        base = [s for s in plain(t or "")]
        assert got[i].n_email == sum(s[0] == "email" for s in base) and got[i].n_phone == sum(s[0] == "phone" for s in base)
        assert set(filter(None, pii.joined(base).split(","))) <= set(got[i].spans.split(","))
    assert "identity" in got[7].spans, (got[7], model.score(pii.features(rows[7][1], pii.candidates(rows[7][1])[0])))
    assert "[IDENTITY]" in got[7].masked and got[1000].masked is None and got[1001].masked == ""
    assert "(at)" not in got[5].masked
    assert model.reliability.shape == (pii.LABELERS, 2) and (model.reliability[:, 1] > model.reliability[:, 0]).all()


def test_no_candidates(spark):
    df = spark.createDataFrame([(1, "plain words")], "doc_id long, text string")
    assert pii.find(df, pii.train(df), keep=("doc_id",)).first().spans == ""
    empty = df.where("doc_id > 5")
    assert pii.find(empty, pii.train(empty), keep=("doc_id",)).collect() == []


def test_masking_joins_overlaps():
    assert pii.mask("abcdef", [("email", 1, 4), ("card", 2, 5)]) == "a[EMAIL]f"
