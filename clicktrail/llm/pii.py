"""Private data in texts by anchor expansion.

One Aho-Corasick pass finds the anchors: at-signs, schemes, pluses and dots next
to digits, digit pairs and identifier cues. At each anchor a local parser expands
to the boundaries of the item and validates it. Text without anchors costs nothing more.
"""

from __future__ import annotations

import re
from bisect import insort
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Kinds in their order; the first four are the base kinds.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "login", "iban", "secret")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOGIN = re.compile(r"://[^\s/?#@:]+:[^\s/?#@]+@")
_IBAN = re.compile(r"[ :=#]{0,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})")
_SECRET = re.compile(r"[\"']?\s{0,2}[=:]\s{0,2}[\"']?([A-Za-z0-9_+/=-]{16,})")
_CUES = {"iban": ("iban",), "secret": ("token", "password", "secret", "api_key", "apikey")}

Span = tuple[int, str, int]


@lru_cache(maxsize=1)
def _anchors() -> ahocorasick.Automaton:
    """Literal -> kinds whose parser runs there, and the literal's length."""
    literals: dict[str, list[str]] = {"@": ["email"], "://": ["login"]}
    digits = "0123456789"
    for a in digits:
        literals.setdefault(f"{a}.", []).append("ip")
        literals.setdefault(f"+{a}", []).append("phone")
        for b in digits:
            for between in ("", " ", "-"):
                literals.setdefault(a + between + b, []).append("card")
    for kind, cues in _CUES.items():
        for cue in cues:
            for form in {cue, cue.upper(), cue.capitalize()}:
                literals.setdefault(form, []).append(kind)
    automaton = ahocorasick.Automaton()
    for literal, kinds in literals.items():
        automaton.add_word(literal, (kinds, len(literal)))
    automaton.make_automaton()
    return automaton


def spans(text: str) -> list[Span]:
    """(start, kind, end) of all items, by start, then kind; code points, end exclusive.

    Items of one kind do not overlap and are found from left to right; a match
    that is not valid is passed over whole.
    """
    done = dict.fromkeys(KINDS, 0)  # where the last match of a kind ended
    found: list[tuple[int, int, int]] = []
    for last, (kinds, length) in _anchors().iter(text):
        at = last - length + 1
        for kind in kinds:
            if at < done[kind]:
                continue
            start, end, valid = _PARSERS[kind](text, at, length, done[kind])
            if end:
                done[kind] = end
                if valid:
                    insort(found, (start, KINDS.index(kind), end))
    return [(start, KINDS[kind], end) for start, kind, end in found]


def _email(text: str, at: int, length: int, floor: int) -> tuple[int, int, bool]:
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    domain = _DOMAIN.match(text, at + 1) if start < at else None
    return (start, domain.end(), True) if domain else (0, 0, False)


def _run_start(text: str, at: int, floor: int) -> int:
    while at > floor and text[at - 1] in "0123456789":
        at -= 1
    return at


def _ip(text: str, at: int, length: int, floor: int) -> tuple[int, int, bool]:
    start = _run_start(text, at, floor)
    match = _IP.match(text, start)
    if not match:
        return 0, 0, False
    return start, match.end(), all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in match[0].split("."))


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if place % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _card(text: str, at: int, length: int, floor: int) -> tuple[int, int, bool]:
    match = _CARD.match(text, at)  # the first anchor of a chain of digits is at its start
    digits = match[0].replace(" ", "").replace("-", "")
    return at, match.end(), 12 <= len(digits) <= 19 and _luhn(digits)


def _phone(text: str, at: int, length: int, floor: int) -> tuple[int, int, bool]:
    match = _PHONE.match(text, at)
    if not match:
        return 0, 0, False
    return at, match.end(), 9 <= sum(c in "0123456789" for c in match[0]) <= 15


def _login(text: str, at: int, length: int, floor: int) -> tuple[int, int, bool]:
    match = _LOGIN.match(text, at)
    return (at + 3, match.end() - 1, True) if match else (0, 0, False)


def _iban(text: str, at: int, length: int, floor: int) -> tuple[int, int, bool]:
    match = _IBAN.match(text, at + length)
    if not match:
        return 0, 0, False
    # the account may be followed by further words: the longest valid beginning counts
    for end in range(match.end(1), match.start(1) + 14, -1):
        account = text[match.start(1) : end].replace(" ", "")
        if text[end - 1] != " " and len(account) >= 15 and int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1:
            return match.start(1), end, True
    return 0, 0, False


def _secret(text: str, at: int, length: int, floor: int) -> tuple[int, int, bool]:
    match = _SECRET.match(text, at + length)
    return (match.start(1), match.end(1), True) if match else (0, 0, False)


_PARSERS = {"email": _email, "ip": _ip, "card": _card, "phone": _phone, "login": _login, "iban": _iban, "secret": _secret}

SPANS = "array<struct<kind:string,start:long,end:long>>"


def with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` (text, ...) with spans: kind, start and end of every item in the whole text, in order.

    Null and empty texts have no spans. A column named spans is replaced, other
    columns are kept, repeated rows have equal spans, an empty table stays empty.
    """

    @F.arrow_udf(SPANS)
    def find(texts: pa.Array) -> pa.Array:
        rows = [[{"kind": k, "start": s, "end": e} for s, k, e in spans(x.as_py() or "")] for x in texts]
        return pa.array(rows, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))

    return docs.drop("spans").withColumn("spans", find(F.col("text").cast("string")))


def redacted_text(text: str) -> str:
    """``text`` with each item replaced by its kind; overlapping items become one, named after the first."""
    parts, done = [], 0
    merged: list[list] = []
    for start, kind, end in spans(text):
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([start, kind, end])
    for start, kind, end in merged:
        parts += [text[done:start], f"[{kind.upper()}]"]
        done = end
    return "".join([*parts, text[done:]])


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with the items in text replaced by their kinds, as in ``[EMAIL]``; null stays null, other columns stay."""

    @F.arrow_udf("string")
    def replace(texts: pa.Array) -> pa.Array:
        return pa.array([None if x is None else redacted_text(x) for x in (y.as_py() for y in texts)], pa.string())

    return docs.withColumn("text", replace(F.col("text").cast("string")))
