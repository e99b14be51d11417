import random
import re

import pytest
from pyspark.sql import functions as F

from terrace.llm import pii


def by_patterns(text):
    """The base kinds straight from their patterns."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_random_texts_match_the_patterns():
    rng = random.Random(1)
    bits = ["@", "a", "b.", ".", "+", "1", "23", "4539578763621486", "-", " ", "(", "255", "0999", "é", "0.", "://", "x:y@", "a.b@c.de"]
    for _ in range(30_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))
        assert [s for s in pii.spans_of(text) if s[0] in pii.BASE_KINDS] == by_patterns(text), text


@pytest.mark.parametrize("text, kind, hit", [
    ("IBAN: DE89 3704 0044 0532 0130 00.", "iban", "DE89 3704 0044 0532 0130 00"),
    ("my account number: 12345678", "account", "12345678"),
    ("SSN 123-45-6789 ok", "ssn", "123-45-6789"),
    ("see https://bob:pw1@host.example/x", "login", "bob:pw1"),
])
def test_added_kinds(text, kind, hit):
    assert (kind, text.index(hit), text.index(hit) + len(hit)) in pii.spans_of(text)


@pytest.mark.parametrize("text", ["IBAN: DE89 3704 0044 0532 0130 01.", "an accountant 12345678", "SSN 000-45-6789", "http://host/@user", "iban", "account", "@", "+", "://", "1"])
def test_invalid_identifiers_are_left_alone(text):
    assert pii.spans_of(text) == []


def test_redaction():
    text = "mail a.b@c.de or +1 (229) 555-4838 é 🙂 from 10.0.0.1"
    assert pii.redacted(text) == "mail <email> or <phone> é 🙂 from <ip>"
    assert pii.redacted("nothing here") == "nothing here"
    assert pii.spans_of(pii.redacted(text)) == []


def test_long_digit_runs_take_linear_time():
    assert pii.spans_of("1" * 200_000) == [] and pii.spans_of("+1" * 50_000) == [] and pii.spans_of("a@" * 50_000) == []


def test_frame(odd_docs, no_docs, make_docs):
    got = pii.find(odd_docs).collect()
    assert len(got) == 8 and all(r["spans"] == "" for r in got)
    assert pii.find(no_docs).count() == 0 and pii.redact(no_docs).count() == 0
    d = make_docs([(1, "x a@b.de"), (2, None)]).withColumn("spans", F.lit("mine")).withColumn("p", F.lit(1))
    out = {r["doc_id"]: r for r in pii.redact(d).collect()}
    assert out[1]["text"] == "x <email>" and out[1]["n_chars"] == 9 and out[2]["text"] is None and out[1]["spans"] == "mine"
    assert pii.redact(odd_docs).columns == odd_docs.columns and pii.redact(odd_docs).exceptAll(odd_docs.withColumn("n_chars", F.length("text").cast("long"))).count() == 0
    assert {r["doc_id"]: r["n_email"] for r in pii.find(d).collect()} == {1: 1, 2: 0}


@pytest.mark.parametrize("cue, number, kind", [
    ("Social Security Number: ", "123-45-6789", "ssn"), ("social Security ", "123-45-6789", "ssn"), ("Ssn: ", "123-45-6789", "ssn"),
    ("My Account Number: ", "12345678", "account"), ("aCCt no. ", "12345678", "account"), ("KontoNr: ", "12345678", "account"),
    ("iBAN: ", "DE89 3704 0044 0532 0130 00", "iban"), ("İ é 🙂 Social Security: ", "123-45-6789", "ssn")])
def test_cues_in_any_case(cue, number, kind):
    text = f"{cue}{number} ok"
    assert pii.spans_of(text) == [(kind, len(cue), len(cue) + len(number))]
    assert pii.redacted(text) == f"{cue}<{kind}> ok"
