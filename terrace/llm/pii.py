"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds the anchors: at-signs, plus signs, digits,
URL schemes and identifier cues (iban, account, ssn).  At each anchor a local parser
reads outwards, decides the boundaries and validates what it read.  A parser never
looks further than the run of characters its kind allows, so a text costs time in
proportion to its length.

Base kinds follow these patterns, leftmost and non-overlapping within a kind; a match
that fails its check is dropped, and the search goes on after it:
email, ip (parts at most 255), card (16 to 19 digits, Luhn), phone (8 to 15 digits).
Added kinds: iban (mod 97), account and ssn (a number right after its cue),
login (user information before the host of a URL).

Defined cases: null or empty text has no spans; offsets are code points; equal rows give
equal results; an empty table gives no rows; columns other than the text (and doc_id) are
passed through or ignored.
"""

from __future__ import annotations

import re
import string

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from terrace.llm.common import small_batches, struct_type

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("iban", "account", "ssn", "login")
#: Words that announce an identifier, whatever their case.
CUES = {"iban": "iban", "account": "account", "acct": "account", "konto": "account", "ssn": "ssn",
        "social security": "ssn"}
SCHEME = "://"

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_QUAD = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_DIGITS = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"[ :#.]{0,6}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{1,4}){3,8})(?![A-Za-z0-9])")
_ACCOUNT = re.compile(r"(?:[ ]?(?:number|no|nr|num))?[ :#.]{1,6}([0-9](?:[ -]?[0-9]){5,16})(?![A-Za-z0-9])", re.I)
_SSN = re.compile(r"(?:[ ]?(?:number|no))?[ :#.]{1,6}((?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4})(?![0-9])", re.I)
_USERINFO = re.compile(r"[^\s/@:\"'<>]+(?::[^\s/@\"'<>]*)?(?=@)")


def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    a.add_word("@", ("email", 1))
    a.add_word("+", ("phone", 1))
    a.add_word(SCHEME, ("login", len(SCHEME)))
    for d in "0123456789":
        a.add_word(d, ("digit", 1))
    for word, kind in CUES.items():
        a.add_word(word, (kind, len(word)))
    a.make_automaton()
    return a


_ANCHORS = _automaton()
#: Cues are found in a copy of the text with A-Z in lower case, which keeps all offsets.
_ASCII_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def _lowered(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(_ASCII_LOWER)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    s = text.replace(" ", "")
    if not 15 <= len(s) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """All spans of a text as (kind, start, end), by kind in the order of KINDS, then start."""
    found: dict[str, list[tuple[int, int]]] = {}
    done = dict.fromkeys(KINDS, 0)  # where the search of a kind goes on
    digits_to = 0                   # end of the digit run that was last tried as an address
    for last, (what, size) in _ANCHORS.iter(_lowered(text)):
        at = last + 1 - size
        if what == "digit":
            if at >= done["card"] and (m := _CARD.match(text, at)):
                done["card"] = m.end()
                number = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(number) <= 19 and luhn(number):
                    found.setdefault("card", []).append(m.span())
            if at >= done["ip"] and at >= digits_to:
                if m := _QUAD.match(text, at):
                    done["ip"] = m.end()
                    if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")):
                        found.setdefault("ip", []).append(m.span())
                else:
                    digits_to = _DIGITS.match(text, at).end()
        elif what == "email":
            start = at
            while start > done["email"] and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                done["email"] = m.end()
                found.setdefault("email", []).append((start, m.end()))
        elif what == "phone":
            if at >= done["phone"] and (m := _PHONE.match(text, at)):
                done["phone"] = m.end()
                if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    found.setdefault("phone", []).append(m.span())
        elif what == "login":
            if m := _USERINFO.match(text, last + 1):
                found.setdefault("login", []).append(m.span())
        else:
            if at and text[at - 1].isalnum():
                continue  # inside another word
            m = {"iban": _IBAN, "account": _ACCOUNT, "ssn": _SSN}[what].match(text, last + 1)
            if m and m.start(1) >= done[what] and (what != "iban" or iban_valid(m[1])):
                done[what] = m.end(1)
                found.setdefault(what, []).append(m.span(1))
    return [(k, *s) for k in KINDS for s in found.get(k, ())]


def _join(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


@pandas_udf(struct_type(n_email="long", n_ip="long", n_card="long", n_phone="long", base="string", spans="string"))
def find_udf(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        spans = spans_of(text) if text else []
        base = [s for s in spans if s[0] in BASE_KINDS]
        rows.append((*(sum(s[0] == k for s in base) for k in BASE_KINDS), _join(base), _join(spans)))
    return pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base", "spans"])


def redacted(text: str) -> str:
    """``text`` with each span replaced by its kind in angle brackets; overlapping spans become one."""
    out, end = [], 0
    spans = sorted(spans_of(text), key=lambda s: (s[1], -s[2]))
    for i, (kind, a, b) in enumerate(spans):
        if a >= end:
            out += [text[end:a], f"<{kind}>"]
        end = max(end, b)
    return "".join(out) + text[end:]


@pandas_udf(T.StringType())
def redact_udf(texts: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else redacted(t) for t in texts], dtype=object)


def find(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, ``base`` and ``spans`` as kind:start:end joined by commas."""
    return small_batches(docs).select("doc_id", find_udf(F.col("text")).alias("p")).select("doc_id", "p.*")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by kind tags and n_chars, if there, brought up to date."""
    out = small_batches(docs).withColumn(text, redact_udf(F.col(text)))
    if "n_chars" in docs.columns:
        n: Column = F.length(F.col(text)).cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", n)
    return out
