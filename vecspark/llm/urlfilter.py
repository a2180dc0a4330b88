"""URL filtering by pattern rules, DataFrame functions only.

Every rule is a regular expression over ``host + path`` together with the literal tokens any
matching URL must contain. A rule is filed under the one of its tokens that fewest URLs of
the corpus contain. A URL's distinct tokens fetch candidate rules by an equi-join, and only
candidates run their expression; the matching rule of the highest priority decides.

Defined results: a null URL, or one without ``://``, has empty host and path and matches only
rules without tokens; an empty table gives no rows. A very long URL's different tokens are rows of their own. Repeated rows get repeated results; ties between rules go to the higher
priority, then the longer rule, then the smaller name. Extra columns of the input are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii

NOT_TOKEN = r"[^0-9A-Za-z]+"


@dataclass(frozen=True)
class Rule:
    """``tokens``: maximal alphanumeric runs found in every URL that ``pattern`` matches."""
    name: str
    pattern: str
    tokens: tuple[str, ...]
    verdict: str
    priority: int = 0


def host_rule(rule: str, verdict: str) -> Rule:
    """A ``host/path`` rule: the host, its subdomains, and every path starting with the path."""
    host, slash, path = rule.partition("/")
    path = slash + path
    tokens = [t for t in re.split(NOT_TOKEN, host) if t]
    # the last path token may go on in the URL unless something closes it
    tokens += [t for t in re.split(NOT_TOKEN, path)[:-1] if t]
    return Rule(rule, f"^(?:[^/]*\\.)?{re.escape(host)}{re.escape(path)}", tuple(dict.fromkeys(tokens)), verdict,
                priority=1)


def wildcard_rule(rule: str, verdict: str, priority: int = 0) -> Rule:
    """A rule in which ``*`` stands for any characters and ``^`` for one that is no letter or digit, or the URL's beginning or
    end. Its tokens are the literal runs with a separator on both sides."""
    parts = re.findall(r"[0-9A-Za-z]+|[*^]|[^0-9A-Za-z*^]", rule)
    edge = lambda i: 0 <= i < len(parts) and parts[i] != "*" and not parts[i][0].isalnum()
    tokens = [p for i, p in enumerate(parts) if p.isalnum() and edge(i - 1) and edge(i + 1)]
    pattern = "".join(".*" if p == "*" else "(?:^|[^0-9A-Za-z]|$)" if p == "^" else re.escape(p) for p in parts)
    return Rule(f"wild:{rule}", pattern, tuple(dict.fromkeys(tokens)), verdict, priority)


# The method's own rules: a subject named in a host label or path segment, and combinations of words that are harmless alone.
SUBJECTS = ("casino", "pills", "viagra", "porn", "xxx", "spam", "betting", "torrent", "warez", "phishing")
PATTERN_RULES = tuple(Rule(f"subject:{w}", f"(?:^|[^0-9A-Za-z]){w}(?:$|[^0-9A-Za-z])", (w,), "block") for w in SUBJECTS)
WILD = ("^free^bets^", "^free^*^bonus^", "^cheap^*^online^", "^win^*^prize^", "^download^*/crack*", "^adult^*^video^", "^no^deposit^*", "^earn^*^fast^",
        "^example^*/en/*^page^*^adult^", "^loans^*^approved^")
PATTERN_RULES += tuple(wildcard_rule(w, "block") for w in WILD)


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of the contract: host after the first ``://`` up to ``/ ? #``, A-Z
    lower-cased; path from there up to ``? #``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + F.lit(3), F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(F.regexp_extract(rest, r"^([^?#]*)", 1), F.lit(""))
    host = F.regexp_extract(rest, r"^([^/]*)", 1)
    return lower_ascii(host), rest.substr(F.length(host) + F.lit(1), F.length(rest))


def _index(spark: SparkSession, rules: list[Rule], tokens: DataFrame) -> DataFrame:
    """Rules under their rarest token: (token, rule, pattern, verdict, rank). Token counts cover
    every URL; the rules are configuration, so their number does not follow the data."""
    rank = {r.name: i for i, r in enumerate(sorted(rules, key=lambda r: (r.priority, len(r.name), [-ord(c) for c in r.name])))}
    table = spark.createDataFrame([(r.name, r.pattern, r.verdict, rank[r.name], list(r.tokens)) for r in rules],
                                  "rule string, pattern string, verdict string, rank int, tokens array<string>")
    wanted = table.select(F.explode("tokens").alias("token")).distinct()
    counts = tokens.join(F.broadcast(wanted), "token").groupBy("token").agg(F.count("*").alias("n"))
    rare = (table.select("*", F.explode_outer("tokens").alias("token")).join(counts, "token", "left")
            .groupBy("rule", "pattern", "verdict", "rank")
            .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("t")))
    return rare.select(F.coalesce("t.token", F.lit("")).alias("token"), "rule", "pattern", "verdict", "rank")


def judge(df: DataFrame, rules: list[Rule], url: str = "url", keep: tuple[str, ...] = (),
          default: str = "allow") -> DataFrame:
    """``keep`` columns plus host, path, rule (name or null) and verdict (the winning rule's, else
    ``default``). Shuffles the distinct (host, path) pairs that some rule matches and joins
    them back; a hot URL is one row there, and adaptive execution splits its other side."""
    spark = df.sparkSession
    host, path = url_parts(F.col(url))
    pages = df.select(*keep, host.alias("host"), path.alias("path"))
    # the empty token fetches rules that name no token
    tokens = F.array_distinct(F.concat(F.array(F.lit("")), F.split(F.concat_ws("/", "host", "path"), NOT_TOKEN)))
    found = pages.select("host", "path", F.explode(tokens).alias("token"))
    index = _index(spark, rules, found)
    won = (found.join(F.broadcast(index), "token")  # one row per configured rule
           .where(F.expr("rlike(concat(host, path), pattern)"))
           .groupBy("host", "path").agg(F.max(F.struct("rank", "rule", "verdict")).alias("best")))
    return pages.join(won, ["host", "path"], "left").select(
        *keep, "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
