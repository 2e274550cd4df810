from __future__ import annotations

import hashlib
import random
import re

import pytest
from cases import documents, with_clashes

from trafficlens.llm import personal_data as pd

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, found):
    digits = [int(c) for c in found if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in BASE.items() for m in re.finditer(p, text or "") if passes(k, m.group())]


def base(text):
    return [s for s in pd.spans(text, pd.anchors()) if s[0] in pd.BASE]


def held(text, kind):
    return [text[b:e] for k, b, e in pd.spans(text, pd.anchors()) if k == kind]


@pytest.mark.parametrize("signs", ["a@.b1", "12.", "1 -9.", "+1 ().-2", "a@b.c1+2 -3\n", "é@x.1 ñ+45"])
def test_base_kinds_equal_the_patterns_on_random_texts(signs):
    r = random.Random(signs)
    automaton = pd.anchors()
    for _ in range(3000):
        text = "".join(r.choices(signs, k=r.randrange(60)))
        assert [s for s in pd.spans(text, automaton) if s[0] in pd.BASE] == brute(text), text


def test_base_kinds_on_written_cases():
    text = ("mail x.y+z@mail-1.example.com, a@b@c.de. 1.2.3.4.5.6.7.8.9 and 256.1.1.1 or 010.0.0.255; card 4111 1111 1111 1111 "
            "and 4111-1111-1111-1112; call +1 (555) 555-0100 or +49 30 1234567.")
    assert base(text) == brute(text)
    assert {k for k, _, _ in base(text)} == set(pd.BASE)


def test_kinds_that_anchors_add():
    assert held("see ftp://joe:pa55@host.net/x", "login") == ["joe:pa55"]
    assert held("an jörg@müller.de, bitte", "wide_email") == ["jörg@müller.de"]
    assert held("write joe.b [at] mail(dot)example.com now", "hidden_email") == ["joe.b [at] mail(dot)example.com"]
    assert held("from fe80::1ff:fe23:4567:890a on 12:30:45", "ipv6") == ["fe80::1ff:fe23:4567:890a"]
    assert held("IBAN: DE89 3704 0044 0532 0130 00 danke", "iban") == ["DE89 3704 0044 0532 0130 00"]
    assert held("IBAN: DE88 3704 0044 0532 0130 00 danke", "iban") == []
    assert held("SSN 123-45-6789, ssn: 666-12-1234", "ssn") == ["123-45-6789"]
    assert held("Account no: AB-123456 and accountable 123456", "account") == ["AB-123456"]
    assert held("api_key = 'abcdefgh12' token: short", "secret") == ["abcdefgh12"]
    assert held("lives at 12 Old Mill Street, near 3 streets", "street") == ["12 Old Mill Street"]


def test_adversarial_texts_take_linear_time():
    for text in ("1" * 300_000, "1." * 150_000, "a" * 300_000 + "@", "@" * 300_000, "+1" * 150_000, "+1 " + "-" * 300_000,
                 ":" * 300_000, "a@" * 150_000, "1 " * 150_000, "token=" * 50_000, "iban de89" * 30_000, "[at]" * 70_000, "://a:" * 60_000):
        pd.spans(text, pd.anchors())


def test_query_digest_against_patterns(spark, folder):
    got = {r["doc_id"]: r for r in pd.op12_personal_data(spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        want, row = brute(r["text"]), got[r["doc_id"]]
        told = ",".join(f"{k}:{b}:{e}" for k, b, e in want)
        assert row["base_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in pd.BASE] == [sum(x[0] == k for x in want) for k in pd.BASE]
        assert row["spans"] == told or row["spans"].startswith(told + ",") or not told


def test_awkward_rows(spark):
    texts = [None, "", "x" * 200_000 + " a@b.c", "a@b.c", "a@b.c", "none"]
    docs = with_clashes(documents(spark, texts, ids=[1, 2, 3, 4, 4, None])).selectExpr("*", "'x' AS spans", "'y' AS _id")
    got = sorted(((r[0] is None, r[0] or 0), [tuple(s) for s in r["spans"]]) for r in pd.find(docs).collect())
    assert got == [((False, 1), []), ((False, 2), []), ((False, 3), [("email", 200_001, 200_006)]),
                   ((False, 4), [("email", 0, 5)]), ((False, 4), [("email", 0, 5)]), ((True, 0), [])]
    assert pd.find(documents(spark, [])).collect() == []
    masked = pd.redact(docs)
    assert set(masked.columns) == set(docs.columns)
    assert sorted((r["text"] or "")[-10:] for r in masked.collect()) == ["", "", "[EMAIL]", "[EMAIL]", "none", "xx [EMAIL]"]


def test_masks_do_not_overlap():
    text = "call +1 (555) 555-0100 or a@b.c"
    assert pd.masked(text, [("phone", 5, 22), ("card", 8, 22), ("email", 26, 31)]) == "call [PHONE] or [EMAIL]"
