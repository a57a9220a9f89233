"""Base spans against plain search, the label model, and redaction."""

import hashlib
import re

from tests.conftest import TESTDATA
from tests.llm.tables import SCHEMA, odd_documents, with_clashes
from terratally.llm import pii
from terratally.llm.queries import QUERIES

# The patterns as the contract states them.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TRICKY = [
    "a@b.c%d@e.f and g@h, i@j.k.l. m..n@o-p.q",
    "1.2.3.4.5.6.7.8 256.1.1.1 0255.0.00.1 9.9.9",
    "4111 1111 1111 1111, 4111-1111-1111-1112, 4111  1111 1111 1111, 378282246310005 1",
    "+1 (988) 555-2485. +44 20 7946 0958) +1-- +12 345 678 9 ++1 234 567 8901",
    "﷐ a@b.cd ﷐﷑ 💡 +1 (988) 555-2485 é 10.0.0.1",
    "7" * 4000 + " " + "a" * 4000 + "@x " + "5.6." * 500,
]


def luhn(digits):
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text):
    found = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for match in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", match[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(part) <= 255 for part in match[0].split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((match.start(), rank, match.end(), kind))
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found)]


def held(rows, texts):
    for row in rows:
        spans = base_spans(texts[row["doc_id"]])
        assert row["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(row["spans"].split(",")) | {""}
        assert [row[f"n_{kind}"] for kind in PLAIN] == [sum(s.startswith(kind) for s in spans) for kind in PLAIN]


def test_table_against_plain_search(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()}
    held(QUERIES["op5_pii"](spark, TESTDATA).collect(), texts)


def test_tricky_texts(spark):
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(TRICKY)], SCHEMA)
    held(pii.digest(pii.detect(docs)).collect(), dict(enumerate(TRICKY)))


def test_votes_that_agree_are_trusted():
    """A pattern of labelers that vote like the others counts more than one of dissenters."""
    ones = sum(2 * 3**i for i in range(pii.LABELERS))
    counts = {ones: 500, 0: 500, ones - 1: 20, 1: 20}
    chance, right = pii.reliabilities(counts)
    assert chance[ones] > 0.99 and chance[0] < 0.01
    assert all(0.05 <= p <= 0.95 for pair in right for p in pair)
    assert pii.reliabilities({})[0][ones] >= 0.5


def test_redaction(spark):
    docs = with_clashes(odd_documents(spark))
    assert pii.redact(docs).columns == docs.columns
    assert pii.redact(docs).count() == docs.count()
    rows = [(1, "mail a@b.cd now", None, None, None), (1, "mail a@b.cd now", None, None, None), (2, None, None, None, None)]
    texts = [r["text"] for r in pii.redact(spark.createDataFrame(rows, SCHEMA)).orderBy("doc_id").collect()]
    assert texts == ["mail <EMAIL> now"] * 2 + [None]


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert pii.digest(pii.detect(empty)).collect() == [] and pii.redact(empty).collect() == []


def test_long_texts(spark):
    """Thousands of spans and words in one text: base spans, other words and what redaction leaves."""
    mails = " ".join(f"user{i}@host{i}.com," for i in range(4000))
    mixed = " ".join(
        (f"(word{i})", f"10.0.0.{i % 300}", f"a{i}@b.cd/x{i}", "+1 (988) 555-2485", "plain")[i % 5] for i in range(5000)
    )
    texts = {1: mails, 2: mixed}
    docs = spark.createDataFrame([(k, t, None, None, None) for k, t in texts.items()], SCHEMA)
    held(pii.digest(pii.detect(docs)).collect(), texts)
    for row in pii.candidates(docs).collect():
        text = texts[row["doc_id"]]
        base = [tuple(map(int, s.split(":")[1:])) for s in base_spans(text)]
        words = []
        for match in re.finditer(r"\S*\d\S*", text):
            start = match.start() + len(match[0]) - len(match[0].lstrip("([{<\"'"))
            end = match.start() + len(match[0].rstrip(".,;:!?)]}>\"'"))
            if not any(a < end and start < b for a, b in base):
                words.append((start, end))
        assert [(s["start"], s["end"]) for s in row["spans"] if s["kind"] == len(PLAIN)] == words
    shown = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert shown[1] == "<EMAIL>, " * 3999 + "<EMAIL>,"
    assert "@" not in shown[2] and shown[2].count("plain") == 1000 and shown[2].count("<PHONE>") == 1000
