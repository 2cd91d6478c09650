"""Personal data: patterns, checksums, context words; the base spans against the plain patterns."""

import hashlib
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from presslake.llm import personal
from presslake.llm.personal import (dni, luhn, mod97, nir, op13_pii, redact_personal_data, scan_personal_data, scan_text,
                                    tax_id)

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _luhn(d):
    total = 0
    for k, c in enumerate(reversed(d)):
        x = int(c) * (2 if k % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _brute(text):
    """The contract's base spans, by the patterns as they stand."""
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                  or kind == "card" and 16 <= len(d) <= 19 and _luhn(d) or kind == "phone" and 8 <= len(d) <= 15)
            if ok:
                out.append((kind, *m.span()))
    return out


def _base(text):
    return [s[:3] for s in scan_text(text) if s[0] in personal.BASE_KINDS]


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="a1Z0.@+-_ ()%9é2\n", max_size=60))
def test_base_spans_are_those_of_the_plain_patterns(text):
    assert _base(text) == _brute(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="0123456789 -.+", max_size=80))
def test_base_spans_in_digits(text):
    assert _base(text) == _brute(text)


def test_checksums():
    assert luhn("4111111111111111") and not luhn("4111111111111112") and luhn("378282246310005")
    assert mod97("GB82WEST12345698765432") and mod97("DE89370400440532013000") and not mod97("DE88370400440532013000")
    assert nir("255081416802538") and not nir("255081416802539")
    assert dni("12345678Z") and dni("X1234567L") and not dni("12345678A")
    assert tax_id("86095742719") and tax_id("47036892816") and not tax_id("86095742718")


@pytest.mark.parametrize("text, kinds", [
    ("IBAN GB82 WEST 1234 5698 7654 32 THE END", ["iban"]), ("DE89 3704 0044 0532 0130 00", ["iban"]),
    ("DE88 3704 0044 0532 0130 00", []), ("card 378282246310005", ["card_short"]), ("order 378282246310005", []),
    ("378282246310005 is long", []), ("my SSN is 536-90-4399.", ["ssn"]), ("part 536-90-4399", []), ("SSN 000-90-4399", []),
    ("NIR 2 55 08 14 168 025 38", ["nir"]), ("DNI 12345678Z", ["dni"]), ("DNI 12345678A", []),
    ("Steuer 86095742719", ["tax_id"]), ("phone 555-123-4567", ["phone_local"]), ("555-123-4567", []),
    ("call +1 (361) 555-8283", ["phone"]), ("the 555.123.4567.8 release", []), ("token 5f367f08b1a810c7777ad785b", [])])
def test_words_and_checksums_decide(text, kinds):
    assert [s[0] for s in scan_text(text)] == kinds


def test_a_base_span_stays_whatever_its_score():
    spans = scan_text("invoice 4111 1111 1111 1111 total")
    assert [s[0] for s in spans] == ["card"] and spans[0][3] < 0.5
    assert scan_text("visa 4111 1111 1111 1111")[0][3] == 1.0


@pytest.mark.parametrize("text", [
    "a" * 400_000, "a" * 200_000 + "@", "@a" * 100_000, "a@b" * 100_000, "1" * 400_000, "1." * 200_000, "1 " * 200_000,
    "+1" + " " * 400_000, "+1 " * 100_000, "A1" * 200_000, "GB82 " * 80_000, "12-" * 100_000, "9" * 5_000 + ".1.1.1"])
def test_hostile_texts_take_linear_time(text):
    start = time.time()
    scan_text(text)
    assert time.time() - start < 20


def test_edges(spark, edge, empty):
    rows = scan_personal_data(edge.union(edge)).collect()
    assert len(rows) == 2 * edge.count() and all(not r.spans for r in rows if r.id in (2, 3, 4, 5))
    assert scan_personal_data(empty).count() == 0 and redact_personal_data(empty).count() == 0
    assert redact_personal_data(edge).columns == edge.columns and redact_personal_data(edge).count() == edge.count()
    docs = spark.createDataFrame([(1, "mail me@x.org or IBAN DE89370400440532013000 😀 +1 (361) 555-8283"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in redact_personal_data(docs).collect()}
    assert got == {1: "mail [email] or IBAN [iban] 😀 [phone]", 2: None}


def test_query_against_brute_force(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op13_pii(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        base = _brute(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, *_ in base) for x in PLAIN]
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))
