"""Pieces against the tokenizer itself, and the layout of the sequences."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.conftest import TESTDATA
from tests.llm.tables import SCHEMA, odd_documents, odd_rows, with_clashes
from terratally.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made.encode_special_tokens = True
    return made


def expected(tokenizer, key, text):
    ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
    first = len(ids) % 1024 or 1024
    bounds = [0, *range(first, len(ids) + 1, 1024)]
    return [
        (key, i, a, b - a, zlib.crc32(np.asarray(ids[a:b], "<u4").tobytes()))
        for i, (a, b) in enumerate(zip(bounds, bounds[1:]))
    ]


def laid_out(rows):
    """Sequences hold at most 1024 tokens and no gaps; gives their number."""
    places = defaultdict(list)
    for row in rows:
        places[row["sequence_id"]].append((row["offset"], row["length"]))
    for pieces in places.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    return len(places)


def test_table(spark, tokenizer):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    rows = packing.pack(docs).collect()
    wanted = [p for r in docs.collect() for p in expected(tokenizer, r["doc_id"], r["text"])]
    assert sorted(tuple(r)[:5] for r in rows) == sorted(wanted)
    tokens = sum(r["length"] for r in rows)
    assert laid_out(rows) <= -(-tokens // 1024) + 1


def test_odd_rows(spark, tokenizer):
    rows = packing.pack(with_clashes(odd_documents(spark))).collect()
    wanted = [p for r in odd_rows() for p in expected(tokenizer, r[0], r[1])]
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(wanted, key=str)
    laid_out(rows)
    assert packing.pack(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("text", ["<|endoftext|> x", "日本語 тест ελληνικά", "a\u0085b   c", "don't  stop\n\n ", "é" * 3000])
def test_ids_are_the_tokenizers(tokenizer, text):
    found = packing.token_ids(text, packing.default_vocabulary()).tolist()
    assert found == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=12))
def test_bins_hold_everything(counts):
    fillings = packing.complete_bins(counts, 64, 5_000)
    used = defaultdict(int)
    for filling in fillings:
        assert sum(filling.lengths) <= 64
        for length in filling.lengths:
            used[length] += filling.times
    assert dict(used) == counts
    fitted = sum(f.times for f in packing._fill(counts, 64, 64))
    assert sum(f.times for f in fillings) <= fitted


def test_completion_beats_best_fit():
    """Best fit puts 6 beside 4 and then has to open more bins; the search finds 3 + 1."""
    counts = {7: 1, 6: 1, 4: 1, 3: 1}
    assert sum(f.times for f in packing.complete_bins(counts, 10)) == 2


def fewest_bins(counts, capacity):
    """Optimum by plain search over all ways to fill the bin of the largest piece."""
    from functools import cache

    def ways(pieces, room):
        yield ()
        for i, x in enumerate(pieces):
            if x <= room and x not in pieces[:i]:
                for more in ways(pieces[i + 1 :], room - x):
                    yield (x, *more)

    @cache
    def bins(pieces):
        if not pieces:
            return 0
        fewest = len(pieces)
        for way in set(ways(pieces[1:], capacity - pieces[0])):
            rest = list(pieces[1:])
            for x in way:
                rest.remove(x)
            fewest = min(fewest, 1 + bins(tuple(rest)))
        return fewest

    return bins(tuple(sorted((x for x, n in counts.items() for _ in range(n)), reverse=True)))


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(2, 20), st.integers(1, 3), min_size=1, max_size=4))
def test_fewest_bins_on_small_tables(counts):
    best = fewest_bins(counts, 20)
    assert sum(f.times for f in packing.complete_bins(counts, 20)) == best
    assert packing._least_bins(counts, 20) <= best
    assert packing._branch(counts, 20, best - 1, packing._Steps(10**6)) is None
    found = packing._branch(counts, 20, best, packing._Steps(10**6))
    used = defaultdict(int)
    for filling in found:
        assert sum(filling.lengths) <= 20
        for length in filling.lengths:
            used[length] += filling.times
    assert dict(used) == counts and sum(f.times for f in found) <= best


def test_hard_mix_of_lengths():
    """One filling per largest piece needs 248 bins here; these counts fit into 237."""
    counts = {500: 100, 350: 100, 175: 90, 524: 3, 260: 300, 263: 200}
    fillings = packing.complete_bins(counts, 1024)
    assert sum(f.times for f in fillings) <= 237
    assert {x: sum(f.times * f.lengths.count(x) for f in fillings) for x in counts} == counts


def test_hot_length():
    """A third of the pieces have 600 tokens and need a bin each; 5,000 of these take a 400, 5,000 a
    300, and the rest goes into 2,000 bins of two 300s and three 130s."""
    counts = {600: 10_000, 400: 5_000, 300: 9_000, 130: 6_000}
    bins = sum(f.times for f in packing.complete_bins(counts, 1024, 20_000))
    assert packing._least_bins(counts, 1024) <= bins <= 12_000
