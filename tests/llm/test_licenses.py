"""Phrases, places, and licence expressions."""

import re

import pytest

from tests.conftest import TESTDATA
from tests.llm.tables import SCHEMA, odd_documents, with_clashes
from terratally.llm import licenses
from terratally.llm.queries import QUERIES

WORD = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def base(text):
    """Words and places of the base phrases, by plain search."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(WORD, low)
    places, found = [], set()
    for phrase, label in licenses.BASE_PHRASES.items():
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                places.append(i)
                found.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(found))


def test_table_against_plain_search(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()}
    for row in QUERIES["op4_license_scan"](spark, TESTDATA).collect():
        assert tuple(row)[1:6] == base(docs[row["doc_id"]])
        assert 0 <= row["score"] <= 1 and (row["score"] > 0) == bool(row["labels"])


@pytest.mark.parametrize(
    "text",
    ["MIT License MIT license", "cc by cc by-nc", "Apache  LICENSE, gnu\ngeneral public license", "", "é MIT licensé", "mit-license"],
)
def test_places(text):
    assert licenses.scan_text(text)[:5] == base(text)


@pytest.mark.parametrize(
    ("line", "postfix", "free"),
    [
        ("MIT", "mit", True),
        ("MIT OR GPL-2.0-only", "mit gpl-2.0-only or", True),
        ("MIT AND GPL-3.0", "mit gpl-3.0 and", False),
        ("(MIT OR GPL-2.0) AND Apache-2.0", "mit gpl-2.0 or apache-2.0 and", True),
        ("GPL-2.0 OR MIT AND GPL-3.0", "gpl-2.0 mit gpl-3.0 and or", False),
        ("Apache-2.0 WITH LLVM-exception OR GPL-2.0", "apache-2.0 llvm-exception with gpl-2.0 or", True),
        ("MIT and", "mit", True),
        ("((MIT", "mit", True),
        ("MIT */ and more words", "mit more and", False),
        ("", "", False),
        ("AND MIT", "", False),
        ("(MIT)) OR", "mit", True),
    ],
)
def test_expressions(line, postfix, free):
    tokens = licenses.postfix(line)
    assert " ".join(tokens) == postfix
    assert licenses.evaluate(tokens)[0] is free


def test_identifier_tag():
    row = licenses.scan_text("// SPDX-License-Identifier: MIT OR Apache-2.0\ncode")
    assert row[5] == "apache-2.0,mit" and row[6] > 0.9 and row[8] is True


def test_odd_rows(spark):
    docs = with_clashes(odd_documents(spark))
    found = licenses.scan(docs).collect()
    assert len(found) == docs.count()
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).collect() == []
