"""Licence scan: phrases by an Aho-Corasick automaton, expressions by a shunting yard."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from terratally.llm.common import ALNUM, id_and_text

# Phrases that always count, by label.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Further notices; their labels come on top.
NOTICE_PHRASES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "bsd license": "bsd",
    "bsd 2 clause": "bsd",
    "bsd 3 clause": "bsd",
    "isc license": "isc",
    "eclipse public license": "epl",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "cc0": "cc0",
    "creative commons attribution": "cc-by",
    "public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
    "permission is hereby granted free of charge to any person": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "this program is free software you can redistribute it": "gpl",
    "unless required by applicable law or agreed to in writing software": "apache",
}
TAG = "spdx license identifier"
#: How sure one kind of evidence makes; several count as independent.
WEIGHTS = {"tag": 0.9, "base": 0.6, "notice": 0.5}
_PERMISSIVE = re.compile(
    r"(mit|apache|bsd|isc|cc0|cc-by|cc-by-[0-9.]+|unlicense|zlib|public-domain)([-.+0-9a-z]*)$"
)
_NOT_PERMISSIVE = re.compile(r"cc-by-(nc|nd|sa)")

_TAG_LINE = re.compile(r"spdx[^a-z0-9]+license[^a-z0-9]+identifier[ \t]*:?[ \t]*([^\r\n]*)", re.I)
_TOKEN = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+\-]*")
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, expressions string, permissive boolean"
)


def postfix(line: str) -> list[str]:
    """Shunting yard: the licence expression that ``line`` starts with, operands before operators.

    Reading stops at the first word that cannot continue an expression; what is still open then is
    closed, and an operator without its right side is dropped. No expression gives an empty list.
    """
    output: list[str] = []
    operators: list[str] = []
    operand_next = True
    for match in _TOKEN.finditer(line):
        token = match.group().rstrip(".").lower()
        if operand_next:
            if token == "(":
                operators.append(token)
            elif token in _PRECEDENCE or token == ")":
                break
            else:
                output.append(token)
                operand_next = False
        elif token in _PRECEDENCE:
            while operators and _PRECEDENCE.get(operators[-1], 0) >= _PRECEDENCE[token]:
                output.append(operators.pop())
            operators.append(token)
            operand_next = True
        elif token == ")" and "(" in operators:
            while (top := operators.pop()) != "(":
                output.append(top)
        else:
            break
    if operand_next:
        while operators and operators[-1] == "(":
            operators.pop()
        if operators:
            operators.pop()
    output.extend(x for x in reversed(operators) if x != "(")
    return output


def is_permissive(label: str) -> bool:
    return bool(_PERMISSIVE.match(label)) and not _NOT_PERMISSIVE.match(label)


def evaluate(tokens: list[str]) -> tuple[bool, list[str]]:
    """Whether an expression allows free use, and its licences: ``or`` asks for one side, ``and``
    for both; an exception after ``with`` only adds rights to the licence before it."""
    stack: list[tuple[bool, list[str]]] = []
    for token in tokens:
        if token not in _PRECEDENCE:
            stack.append((is_permissive(token), [token]))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            stack.append(left)
        else:
            free = left[0] or right[0] if token == "or" else left[0] and right[0]
            stack.append((free, left[1] + right[1]))
    return stack[0] if stack else (False, [])


@cache
def _automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for phrase, label in NOTICE_PHRASES.items():
        automaton.add_word(f" {phrase} ", ("notice", label, len(phrase)))
    for phrase, label in BASE_PHRASES.items():
        automaton.add_word(f" {phrase} ", ("base", label, len(phrase)))
    automaton.add_word(f" {TAG} ", ("tag", "", len(TAG)))
    automaton.make_automaton()
    return automaton


_TO_WORDS = bytes(
    (b + 0x20 if 0x41 <= b <= 0x5A else b) if ALNUM[b] else 0x20 for b in range(256)
)


def scan_text(text: str) -> tuple:
    """Digest of one whole text, in the order of ``SCHEMA`` after the key."""
    words = text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()
    # One character per byte, so that the automaton sees places as they are.
    line = (b" " + b" ".join(words) + b" ").decode("latin-1") if words else ""
    hits = sorted((end - size, kind, label) for end, (kind, label, size) in _automaton().iter(line))
    base_places, found = [], {"base": set(), "notice": set(), "tag": set()}
    word = at = 0
    for start, kind, label in hits:
        word, at = word + line.count(" ", at, start), start
        found[kind].add(label)
        if kind == "base":
            base_places.append(word - 1)
    verdicts, licences, expressions = [], set(), []
    if found["tag"]:
        for match in _TAG_LINE.finditer(text):
            tokens = postfix(match.group(1))
            if tokens:
                free, names = evaluate(tokens)
                verdicts.append(free)
                licences.update(names)
                expressions.append(" ".join(tokens))
    named = found["base"] | found["notice"]
    doubt = 1.0
    for kind, evidence in (("tag", licences), ("base", found["base"]), ("notice", found["notice"])):
        doubt *= (1 - WEIGHTS[kind]) ** len(evidence)
    free = all(verdicts) if verdicts else bool(named) and all(map(is_permissive, named))
    return (
        len(words),
        len(base_places),
        min(base_places, default=None),
        max(base_places, default=None),
        ",".join(sorted(found["base"])),
        ",".join(sorted(named | licences)),
        round(1 - doubt, 12),
        ";".join(expressions),
        free,
    )


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``SCHEMA`` per input row.

    A null or empty text has no words, no labels and score 0. Repeated rows give repeated results,
    other columns are ignored, an empty table gives no rows. Texts are scanned whole, one at a time.
    """
    kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), pa.string(), pa.bool_()]
    names = [column.split()[0] for column in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.columns
            rows = [(k.as_py(), *scan_text(t.as_py())) for k, t in zip(keys, texts, strict=True)]
            columns = zip(*rows, strict=True) if rows else [()] * len(names)
            arrays = [pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return id_and_text(docs, key, text).toDF("doc_id", "text").mapInArrow(run, SCHEMA)
