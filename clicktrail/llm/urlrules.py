"""URL filter rules found through their rarest literal token."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_TOKEN = re.compile(r"[A-Za-z0-9]+")
ALWAYS = ""  # index key of rules without a literal token


@dataclass(frozen=True)
class Rule:
    """A regular expression over host and path, written one after the other.

    ``literals`` are whole alphanumeric tokens every matching URL holds. A rule
    of higher ``rank`` wins, then the one with the longer name, then block.
    """

    name: str
    verdict: str
    pattern: str
    literals: tuple[str, ...] = ()
    rank: int = 0


def site_rule(verdict: str, host: str, path: str, rank: int = 1) -> Rule:
    """Fits the host and its subdomains where the path starts with ``path``."""
    literals = [*host.split("."), *(m[0] for m in _TOKEN.finditer(path) if m.end() < len(path))]
    literals = tuple(x for x in literals if _TOKEN.fullmatch(x))
    return Rule(host + path, verdict, rf"(?s)^(?:[^/]*\.)?{re.escape(host + path)}", literals, rank)


def with_address(pages: DataFrame) -> DataFrame:
    """``pages`` with host (A-Z lower-cased) and path of url; both empty where it is null or has no ``://``."""
    host = F.translate(F.regexp_extract("url", _URL, 1), _UPPER, _LOWER)
    return pages.withColumns(
        {"host": F.coalesce(host, F.lit("")), "path": F.coalesce(F.regexp_extract("url", _URL, 2), F.lit(""))}
    )


def rule_index(addresses: DataFrame, rules: Sequence[Rule]) -> dict[str, list[Rule]]:
    """Rules by the literal of theirs that the fewest URLs hold, counted over all URLs.

    What reaches the driver is one number per literal of the given rules, and the literals
    are what is sent to the tasks.
    """
    literals = sorted({x for rule in rules for x in rule.literals})
    counts: dict[str, int] = {}
    if literals:
        tokens = F.array_distinct(F.split(F.concat("host", "path"), "[^A-Za-z0-9]+"))
        wanted = addresses.sparkSession.createDataFrame([(x,) for x in literals], "token string")
        held = addresses.select(F.explode(tokens).alias("token")).join(F.broadcast(wanted), "token", "left_semi")
        counts = {r["token"]: r["n"] for r in held.groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()}
    index: dict[str, list[Rule]] = {}
    for rule in rules:
        index.setdefault(min(rule.literals, key=lambda x: (counts.get(x, 0), x), default=ALWAYS), []).append(rule)
    return index


def judged(pages: DataFrame, rules: Sequence[Rule], default: str = "allow") -> DataFrame:
    """``pages`` (url, ...) with host, path, rule (the winning rule's name or null) and verdict.

    Only rules fetched by a token of the URL run their regular expression. Null
    and malformed URLs have an empty host and path, which fit no site rule;
    without a fitting rule the verdict is ``default``. Input columns of the names
    added here are replaced, repeated rows are judged alike, an empty table gives
    an empty result.
    """
    addresses = with_address(pages.drop("host", "path", "rule", "verdict"))
    index = addresses.sparkSession.sparkContext.broadcast(rule_index(addresses, rules))

    @F.pandas_udf("rule string, verdict string")
    def judge(target: pd.Series) -> pd.DataFrame:
        rows = []
        for url in target:
            fetched = [rule for key in {ALWAYS, *_TOKEN.findall(url)} for rule in index.value.get(key, ())]
            fits = [rule for rule in fetched if _compiled(rule.pattern).search(url)]
            best = max(fits, key=lambda r: (r.rank, len(r.name), r.verdict == "block", r.name), default=None)
            rows.append((best.name, best.verdict) if best else (None, default))
        return pd.DataFrame(rows, columns=["rule", "verdict"])

    return addresses.withColumn("_judged", judge(F.concat("host", "path"))).select(
        *addresses.columns, "_judged.rule", "_judged.verdict"
    )


@lru_cache(maxsize=100_000)
def _compiled(pattern: str) -> re.Pattern:
    """A rule's expression, compiled when a URL first fetches it and kept by the worker."""
    return re.compile(pattern)
