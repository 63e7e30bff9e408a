"""URL rules indexed by their rarest literal token.

A rule's pattern becomes a regular expression and a list of literal tokens
(runs of a-z and 0-9) that every matching URL holds whole. Spark counts the
rules' tokens over all URLs; each rule is posted under its rarest token. A URL's
tokens fetch the candidate rules, and only those (and the few rules without a
sure token) run their expressions, each compiled when it is first needed. Tokens that no
rule has are dropped before anything is shuffled. Judging is one narrow pass; the index
is as large as the caller's rule list, which every task gets.

Two kinds of rules:

* host rules, ``host/path``: fit the host and its subdomains if the URL's path
  starts with the rule's; the longest fitting rule decides;
* patterns, which decide where no host rule fits: plain text in which ``*``
  stands for anything and ``^`` for a separator (neither letter nor digit) or an
  end, over host, path, query and fragment without regard to A-Z case. The first
  fitting pattern decides; otherwise the URL is allowed.

Defined results: a NULL URL or one without ``://`` has empty host and path, fits
no rule and is allowed. Repeated rows are each judged; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_TOKEN = re.compile(r"[a-z0-9]+")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = str.maketrans(_UPPER, _LOWER)


@dataclass(frozen=True)
class Rule:
    action: str
    text: str
    regex: str
    tokens: tuple[str, ...]
    is_host: bool


def host_rule(action: str, text: str) -> Rule:
    """``org/``, ``example.org/es/``: a host (with its subdomains) and the beginning of a path."""
    host, slash, path = text.partition("/")
    host = host.translate(_FOLD)
    # the last token is open to the right unless something else follows it
    sure = _TOKEN.findall(host) if slash else []
    low = path.translate(_FOLD)
    sure += [m[0] for m in _TOKEN.finditer(low) if m.end() < len(low)]
    ending = "" if slash else r"(?=[/?#]|\Z)"
    return Rule(action, text, r"(?:[^/?#]*\.)?" + re.escape(host + slash + path) + ending, tuple(sure), True)


def pattern_rule(action: str, text: str) -> Rule:
    """Plain text with ``*`` (anything) and ``^`` (separator or end)."""
    low = text.translate(_FOLD)
    regex = "".join({"*": ".*", "^": r"(?:[^a-z0-9]|\A|\Z)"}.get(c, re.escape(c)) for c in low)
    sure = [m[0] for m in _TOKEN.finditer(low)
            if 0 < m.start() and low[m.start() - 1] != "*" and m.end() < len(low) and low[m.end()] != "*"]
    return Rule(action, text, "(?s:.*?)" + regex, tuple(sure), False)


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, what follows the path) of a URL column."""
    start = F.locate("://", url)
    rest = F.coalesce(F.when(start > 0, url.substr(start + 3, F.length(url))), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.regexp_extract(rest, r"(?s)^[^?#]*(.*)", 1)


class RuleIndex:
    """Rules by their rarest token."""

    def __init__(self, rules: list[Rule], counts: dict[str, int]):
        self.by_token: dict[str, list[tuple[int, Rule]]] = {}
        self.always: list[tuple[int, Rule]] = []
        self._compiled: dict[int, re.Pattern] = {}
        for number, rule in enumerate(rules):
            entry = (number, rule)
            if rule.tokens:
                rarest = min(rule.tokens, key=lambda t: (counts.get(t, 0), t))
                self.by_token.setdefault(rarest, []).append(entry)
            else:
                self.always.append(entry)

    def _fits(self, number: int, rule: Rule, text: str) -> bool:
        regex = self._compiled.get(number)
        if regex is None:
            regex = self._compiled[number] = re.compile(rule.regex, re.S)
        return regex.match(text) is not None

    def judge(self, target: str) -> tuple[str | None, str, str | None]:
        """(host rule, verdict, pattern) of host + path + query."""
        low = target.translate(_FOLD)
        fits = list(self.always)
        for token in set(_TOKEN.findall(low)):
            fits += self.by_token.get(token, ())
        fits.sort(key=lambda entry: entry[0])
        best = pattern = None
        for number, rule in fits:
            if rule.is_host:
                if (best is None or len(rule.text) > len(best.text)) and self._fits(number, rule, target):
                    best = rule
            elif pattern is None and self._fits(number, rule, low):
                pattern = rule
        decided = best or pattern
        return (best.text if best else None, decided.action if decided else "allow",
                pattern.text if pattern and not best else None)


def token_counts(spark: SparkSession, urls: DataFrame, tokens: list[str]) -> dict[str, int]:
    """In how many rows of ``urls`` (column ``target``) each of ``tokens`` occurs."""
    if not tokens:
        return {}
    wanted = spark.createDataFrame([(t,) for t in tokens], "token string")
    found = urls.select(F.explode(F.array_distinct(F.split(
        F.translate("target", _UPPER, _LOWER), "[^a-z0-9]+"))).alias("token"))
    # the rules' own tokens go to every task with the rules anyway; a token that most URLs share costs one row per task
    return {r["token"]: r["n"] for r in found.join(F.broadcast(wanted), "token", "left_semi")
            .groupBy("token").agg(F.count("*").alias("n")).collect()}


def judge_urls(spark: SparkSession, pages: DataFrame, rules: list[Rule], id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict and pattern for every row."""
    host, path, tail = url_parts(F.col("url"))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")) \
        .select("page_id", host.alias("host"), path.alias("path"), tail.alias("tail")) \
        .withColumn("target", F.concat("host", "path", "tail"))
    counts = token_counts(spark, rows, sorted({t for r in rules for t in r.tokens}))

    def run(batches):
        index = RuleIndex(rules, counts)
        for batch in batches:
            found = [index.judge(t) for t in batch.column("target").to_pylist()]
            columns = list(zip(*found)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("host"), batch.column("path"),
                 *(pa.array(c, pa.string()) for c in columns)],
                names=["page_id", "host", "path", "rule", "verdict", "pattern"])

    return rows.select("page_id", "host", "path", "target").mapInArrow(
        run, f"page_id {pages.schema[id_col].dataType.simpleString()}, host string, path string, "
             "rule string, verdict string, pattern string")
