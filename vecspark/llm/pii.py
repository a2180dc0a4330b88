"""Personal data by weak supervision.

Base spans are four fixed patterns (email, ip, card, phone) and always stay. Beyond them, looser
patterns propose candidate spans (masked emails, national phone numbers, identity numbers, bank
accounts, names, credentials). Labelers - pattern, gazetteer and context rules - vote on every
candidate and base span: 1 personal, 0 no opinion, -1 not. Expectation-maximisation over the counted
vote patterns of the whole corpus estimates how reliable each labeler is and how probable each
pattern is; a logistic span classifier is trained on those probabilities from a bounded sample and
decides which candidates become spans. Candidates that overlap base spans or stronger candidates go.

Defined results: a null or empty text has no spans. Without candidates in the corpus there are base
spans only. Spans are [start, end) in code points. Repeated rows get repeated results; extra
columns are ignored. All patterns are linear in the text's length, so very long texts are whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import schema_of, sha256_hex, small_batches

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def emails(text: str) -> list[Span]:
    """A match runs from the start of the local characters before an ``@`` (or the end of the last
    match) to the end of its domain; found from the ``@`` so that long runs cost no more."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        a = at
        while a > last and text[a - 1] in _LOCAL_CHARS:
            a -= 1
        m = _DOMAIN.match(text, at + 1) if a < at else None
        if m:
            out.append(("email", a, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    return out


def ips(text: str) -> list[Span]:
    """Four numbers in a row of a dotted sequence at a time; parts over 255 fail."""
    out = []
    for m in _DOTTED.finditer(text):
        parts = [p.span() for p in re.finditer("[0-9]+", m[0])]
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            if all(len(n) <= 3 and int(n or 0) <= 255 for n in (m[0][a:z].lstrip("0") for a, z in four)):
                out.append(("ip", m.start() + four[0][0], m.start() + four[3][1]))
    return out


def luhn(digits: str) -> bool:
    d = [int(c) for c in reversed(digits)]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def cards(text: str) -> list[Span]:
    out = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 40:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    return out


def phones(text: str) -> list[Span]:
    return [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15] if "+" in text else []


def base_spans(text: str) -> list[Span]:
    return emails(text) + ips(text) + cards(text) + phones(text)


# Word lists of the labelers.
FIRST_NAMES = frozenset("""james mary john patricia robert jennifer michael linda david elizabeth william barbara richard susan
joseph jessica thomas sarah charles karen anna peter hans klaus ursula monika jean marie pierre jacques sophie claire
jose maria carlos carmen luis ana pedro lucia""".split())
TITLES = frozenset("mr mrs ms dr prof herr frau monsieur madame mme señor señora sr sra".split())
DOMAINS = frozenset("com org net edu gov io de fr es uk eu".split())
TRIGGERS = frozenset("""name named call phone tel telephone mobile fax mail email contact address born ssn passport iban account
social security id password secret token key card telefon nom nombre teléfono téléphone adresse""".split())
OTHER_NUMBERS = frozenset("isbn page version order item invoice chapter total price figure table seite página".split())

CANDIDATES = (
    ("email", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}"
                         r"(?: ?(?:\(dot\)|\[dot\]|\.| dot ) ?[A-Za-z0-9-]{2,24}){1,4}"), ("(at)", "[at]", " at ")),
    ("phone", re.compile(r"(?<![0-9+.-])\(?[0-9]{2,5}\)?[ ./-][0-9]{3,4}[ .-][0-9]{3,5}(?![0-9-])"), None),
    ("identity", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"), ("-",)),
    ("account", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"), None),
    ("name", re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sra|Sr)\b\.? [A-ZÀ-Þ][\w'-]{1,30}(?: [A-ZÀ-Þ][\w'-]{1,30})?"), None),
    ("name", re.compile(r"\b(?:" + "|".join(sorted(n.capitalize() for n in FIRST_NAMES)) + r") [A-ZÀ-Þ][\w'-]{1,30}"), None),
    ("credential", re.compile(r"(?i:password|passwd|secret|token|api_?key) ?[:=] ?[\"']?([A-Za-z0-9+/_=-]{12,200})"), ("=", ":")),
)
_WORD = re.compile(r"\w+")


def candidates(text: str) -> list[Span]:
    """Proposed spans beyond the base ones, in order of kind and place."""
    out = []
    for kind, pattern, need in CANDIDATES:
        if need is None or any(n in text for n in need):
            for m in pattern.finditer(text):
                out.append((kind, *m.span(m.lastindex or 0)))
    return out


def _before(text: str, at: int) -> list[str]:
    return [w.lower() for w in _WORD.findall(text[max(0, at - 40):at])][-4:]


def votes(text: str, span: Span, base: bool) -> tuple[int, ...]:
    """One vote per labeler."""
    kind, a, z = span
    own, near = text[a:z], _before(text, a)
    words = [w.lower() for w in _WORD.findall(own)]
    digits = sum(c.isdigit() for c in own)
    spread = len({c for c in own if c.isdigit()})
    return (
        1 if base else 0,                                                            # the strict pattern
        0 if kind not in ("email", "name") else 1 if words and (words[-1] in DOMAINS or words[0] in FIRST_NAMES
                                                                or len(words) > 1 and words[1] in FIRST_NAMES) else -1,  # gazetteer
        1 if kind == "name" and words and words[0] in TITLES else 0,                  # title
        1 if any(w in TRIGGERS for w in near) else 0,                                 # context that speaks for it
        -1 if any(w in OTHER_NUMBERS for w in near) else 0,                           # context that speaks against it
        0 if kind in ("email", "name", "credential") else -1 if spread < 3 else 1 if digits >= 9 else 0,  # digits of a real number
        0 if kind != "credential" else 1 if digits >= 3 and len(own) >= 16 else -1,   # looks random
    )


LABELERS = 7


#: Labelers are taken to be right in this share of their votes, with the weight of this share of them.
RIGHT, TRUST = 0.8, 0.5


def estimate(counts: dict[tuple, int], rounds: int = 100) -> tuple[dict[tuple, float], np.ndarray, float]:
    """Expectation-maximisation for labelers independent given the truth: (probability of each vote
    pattern being personal, chance of a vote for "personal" by labeler and truth when it votes, share of
    personal). No opinion tells nothing. A prior (RIGHT, TRUST) keeps labelers that only ever vote one
    way informative. Spans of the strict pattern are known to be personal."""
    pats = sorted(counts)
    v = np.array(pats, dtype=int).reshape(len(pats), LABELERS)
    n = np.array([counts[p] for p in pats], dtype=float)
    voted, known = v != 0, v[:, 0] == 1
    trust = TRUST * (n[:, None] * voted).sum(axis=0) + 1.0
    chance = np.tile(np.array([1 - RIGHT, RIGHT]), (LABELERS, 1))  # of a 1, by truth
    share, post = 0.5, known.astype(float)
    for _ in range(rounds):
        odds = np.where(v == 1, np.log(chance[:, 1] / chance[:, 0]), np.log((1 - chance[:, 1]) / (1 - chance[:, 0])))
        logit = (odds * voted)[:, 1:].sum(axis=1) + np.log(share / (1 - share))
        post = np.where(known, 1.0, 1 / (1 + np.exp(-np.clip(logit, -500, 500))))
        for t, w in ((0, n * (1 - post)), (1, n * post)):
            prior = RIGHT if t else 1 - RIGHT
            chance[:, t] = (((v == 1) * w[:, None]).sum(axis=0) + trust * prior) / ((voted * w[:, None]).sum(axis=0) + trust)
        open_ = n * ~known
        share = float(np.clip((open_ * post).sum() / max(open_.sum(), 1), 0.05, 0.95)) if open_.sum() else 0.5
    return dict(zip(pats, post.tolist())), chance, share


FEATURES = 512


def features(text: str, span: Span) -> list[int]:
    """Hashed features of a span: its kind, shape, length, words and the words before it."""
    kind, a, z = span
    shape = re.sub(r"(.)\1{2,}", r"\1\1", "".join("9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c for c in text[a:z]))
    own = [w.lower() for w in _WORD.findall(text[a:z])]
    names = [f"kind={kind}", f"shape={kind}:{shape[:24]}", f"length={kind}:{min(z - a, 40) // 4}"]
    names += [f"first={kind}:{w}" for w in own[:1]] + [f"last={kind}:{w}" for w in own[-1:] if not w.isdigit()]
    names += [f"before={w}" for w in _before(text, a)]
    return sorted({zlib.crc32(x.encode()) % FEATURES for x in names})


@dataclass(frozen=True)
class Model:
    """``weights`` of the span classifier (last one constant); ``reliability``: estimated chance of each
    labeler's vote for a span that is not / is personal."""
    weights: np.ndarray = field(default_factory=lambda: np.r_[np.zeros(FEATURES), -10.0])
    reliability: np.ndarray | None = None
    share: float = 0.0

    def score(self, feats: list[int]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[feats].sum() + self.weights[-1], -500, 500))))


def _fit_classifier(rows: list[tuple[list[int], float]], steps: int = 300, rate: float = 0.5, decay: float = 1e-3) -> np.ndarray:
    """Logistic regression on soft labels, full-batch gradient steps."""
    x = np.zeros((len(rows), FEATURES + 1))
    for i, (f, _) in enumerate(rows):
        x[i, f] = 1
    x[:, -1] = 1
    y = np.array([p for _, p in rows])
    w = np.zeros(FEATURES + 1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        w -= rate * (x.T @ (p - y) / len(rows) + decay * w)
    return w


def train(docs: DataFrame, text: str = "text", sample: int = 20_000) -> Model:
    """Votes are counted over all documents (at most 3^7 patterns); the classifier is fitted on the
    ``sample`` voted spans with the smallest hash of their content, a bound at every input size."""
    def run(batches):
        for b in small_batches(batches, 256):
            seen: Counter = Counter()
            first: dict = {}
            for t in b.column(0).to_pylist():
                t = t or ""
                base = base_spans(t)
                for s, is_base in [(s, True) for s in base] + [(s, False) for s in candidates(t)]:
                    f = features(t, s)
                    seen[votes(t, s, is_base), tuple(f)] += 1
            for (v, f), n in seen.items():
                first.setdefault("votes", []).append(list(v))
                first.setdefault("feats", []).append(list(f))
                first.setdefault("n", []).append(n)
            yield pa.RecordBatch.from_arrays([pa.array(first.get("votes", []), pa.list_(pa.int32())), pa.array(first.get("feats", []), pa.list_(pa.int32())),
                                              pa.array(first.get("n", []), pa.int64())], names=["votes", "feats", "n"])
    spans = docs.select(text).mapInArrow(run, "votes array<int>, feats array<int>, n long")
    spans = spans.groupBy("votes", "feats").agg(F.sum("n").alias("n")).checkpoint()
    counts = {tuple(r["votes"]): r["n"] for r in spans.groupBy("votes").agg(F.sum("n").alias("n")).collect()}
    if not counts:
        return Model()
    post, chance, share = estimate(counts)
    few = spans.orderBy(F.xxhash64("votes", "feats"), "votes", "feats").limit(sample).collect()
    return Model(_fit_classifier([(r["feats"], post[tuple(r["votes"])]) for r in few]), chance, share)


def all_spans(text: str, model: Model, cut: float = 0.5) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans). Of overlapping added candidates the likelier one stays."""
    base = base_spans(text)
    taken = sorted((a, z) for _, a, z in base)
    added = []
    found = [(model.score(features(text, s)), s) for s in candidates(text)]
    for p, s in sorted((x for x in found if x[0] >= cut), key=lambda x: (-x[0], x[1][1], x[1])):
        if all(z <= s[1] or a >= s[2] for a, z in taken):
            taken.append((s[1], s[2]))
            added.append(s)
    return base, base + added


def _order(s: Span):
    return (KINDS.index(s[0]) if s[0] in KINDS else len(KINDS), s[0], s[1], s[2])


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{z}" for k, a, z in sorted(spans, key=_order))


def mask(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    out, last = [], 0
    for k, a, z in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= last:
            out += [text[last:a], f"[{k.upper()}]"]
        last = max(last, z)
    return "".join(out) + text[last:]


def find(df: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = (), masked: bool = False) -> DataFrame:
    """``keep`` columns, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all, as
    ``kind:start:end`` by kind and start), and with ``masked`` the masked text (null stays null)."""
    def run(batches):
        for b in small_batches(batches, 256):
            rows = []
            for t in b.column(b.num_columns - 1).to_pylist():
                base, spans = all_spans(t or "", model)
                n = Counter(s[0] for s in base)
                rows.append((*[n[k] for k in KINDS], sha256_hex(joined(base).encode()), joined(spans), t if t is None else mask(t, spans) if masked else None))
            kinds = [pa.int64()] * 4 + [pa.string()] * 3
            cols = [b.column(i) for i in range(b.num_columns - 1)] + [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            names = [*b.schema.names[:-1], *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "masked"]
            yield pa.RecordBatch.from_arrays(cols, names=names).select(names if masked else names[:-1])
    ddl = ", ".join(filter(None, [schema_of(df, *keep), ", ".join(f"n_{k} long" for k in KINDS), "base_sha256 string, spans string", "masked string" if masked else ""]))
    return df.select(*keep, F.col(text).alias("__text")).mapInArrow(run, ddl)
