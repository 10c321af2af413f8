"""Spans of personal data against plain regular expressions, and what the parsers add."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import SF
from tripkiln.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def checksum(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d // 10 + d % 10
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": lambda: True,
                "ip": lambda: all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") < 256 for p in m.group().split(".")),
                "card": lambda: 16 <= len(digits) <= 19 and checksum(digits),
                "phone": lambda: 8 <= len(digits) <= 15,
            }[kind]()
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def base(text):
    return [s for s in pii.find_spans(text) if s[0] in pii.BASE]


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="a.Z_%+-@@..0123456789 ()é\n漢", max_size=60))
def test_base_spans_of_any_text(text):
    assert base(text) == brute(text)


def test_base_spans_of_pieces():
    rng = random.Random(5)
    pieces = [
        "a@b.c", "x.y+z@mail.example.com", "@", "a@b", "a@b@c.d", "..@a.b", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "00255.1.1.1", "9" * 5000 + ".1.1.1",
        "4111 1111 1111 1111", "4111-1111-1111-1111", "41111111111111112", "+1 (017) 555-7713", "+12", "+1-2", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "é", " ",
        " ", "\n", ".", "-", "7", "🙂", "rené@x.de", "DE89 3704 0044 0532 0130 00", "+491234567.",
    ]
    for _ in range(1200):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 8)))
        assert base(text) == brute(text), text


@pytest.mark.parametrize(
    "text, kind, found",
    [
        ("so rené.12@mail1.example.com sagte", "address", ["rené.12@mail1.example.com"]),
        ("an straßé@bücher.de.", "address", ["straßé@bücher.de"]),
        ("联系rené@x.fr谢谢", "address", ["rené@x.fr"]),
        ('"Ann Lee"@example.com', "address", ['"Ann Lee"@example.com']),
        ("plain.12@mail1.example.com", "address", []),
        ("see mailto:bob@intranet now", "address", ["bob@intranet"]),
        ("call tel:5551234567, or Tel:+1-555-0100", "address", ["5551234567"]),
        ("ftp://ann:secret@files.example/x and https://example.org/a", "address", ["ann:secret@files.example"]),
        ("IBAN: DE89 3704 0044 0532 0130 00 bitte", "account", ["DE89 3704 0044 0532 0130 00"]),
        ("FR1420041010050500013M02606 payé", "account", ["FR1420041010050500013M02606"]),
        ("pay to GB29 NWBK 6016 1331 9268 19 AB", "account", ["GB29 NWBK 6016 1331 9268 19"]),
        ("DE88 3704 0044 0532 0130 00", "account", []),
        ("Account number: 0012-345678 was", "account", ["0012-345678"]),
        ("SSN 123-45-6789", "account", ["123-45-6789"]),
        ("passport no. C01X", "account", []),
        ("KONTO 1234567", "account", ["1234567"]),
        ("the accounts 1234567", "account", []),
        ("discount 1234567", "account", []),
    ],
)
def test_added_spans(text, kind, found):
    spans = pii.find_spans(text)
    assert [text[a:b] for k, a, b in spans if k == kind] == found
    assert [s for s in spans if s[0] in pii.BASE] == brute(text)


def test_work_is_linear_in_hostile_texts():
    for unit in ("@", "a@", "a.", "1.", "1 ", "+1", "tel:", "http://", "é@é.", "account ", "AA11", '"@', "sip:a"):
        assert isinstance(pii.find_spans(unit * 40_000), list)


def test_query_matches_brute_force(spark, docs):
    got = {r["doc_id"]: r for r in pii.query(spark, SF).collect()}
    rows = docs.collect()
    assert len(got) == len(rows) and sum(r["n_email"] for r in got.values()) > 0
    for r in rows:
        want, mine = brute(r["text"]), got[r["doc_id"]]
        assert [mine[f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in want) for k in pii.BASE]
        assert mine["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        assert mine["spans"] == ",".join(f"{k}:{a}:{b}" for k, a, b in pii.find_spans(r["text"] or ""))


def test_planted_addresses_are_whole(spark):
    """Every address of the documents is covered from its first letter on, and texts without any data have no spans."""
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    rows = pii.personal_spans(table).where("text rlike '[@+0-9]' or size(pii) > 0").collect()
    whole = 0
    for r in rows:
        spans = [tuple(s) for s in r["pii"]]
        for m in re.finditer(r"\w+\.[0-9]{2}@mail[0-9]\.example\.com", r["text"]):
            assert any(a <= m.start() and m.end() <= b for _, a, b in spans), m.group()
            whole += 1
        assert [s for s in spans if s[0] in pii.BASE] == brute(r["text"])
        for kind, a, b in spans:
            assert kind != "account" and (kind != "address" or "@" in r["text"][a:b])
    assert whole > 50


def test_edge_rows(spark, edge_docs, no_docs):
    df = edge_docs.withColumn("PII", F.lit("x")).unionByName(
        spark.createDataFrame([(20, "🙂 a@b.c"), (20, "🙂 a@b.c")], "doc_id long, text string"), allowMissingColumns=True
    )
    got = pii.personal_spans(df)
    assert got.columns == [*edge_docs.columns, "pii"] and got.count() == df.count()
    assert [[tuple(s) for s in r["pii"]] for r in got.where("doc_id = 20").collect()] == [[("email", 2, 7)]] * 2
    assert all(r["pii"] == [] for r in got.where("doc_id is null or doc_id < 20").collect())
    assert pii.personal_spans(no_docs).count() == 0
    masked = {r["text"] for r in pii.mask_personal(df).collect()}
    assert {"🙂 <EMAIL>", None, "", "one two three four five six"} <= masked
    assert pii.masked("rené.1@x.de +1 (017) 555-7713", pii.find_spans("rené.1@x.de +1 (017) 555-7713")) == "<ADDRESS> <PHONE>"
