"""Counts, normalisation and scores against a plain model."""

import math
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import DataFrameWriter

from tests.conftest import TESTDATA
from tests.llm.tables import SCHEMA, odd_documents, odd_rows, with_clashes, words
from terratally.llm import katz


def tokens(text):
    return [w.lower() for w in words(text)] + [None]


def held_out(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 10 == 0


def base(rows):
    counts = Counter(w for key, text in rows if not held_out(key) for w in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for key, text in rows:
        score = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in tokens(text))
        known = sum(counts[w] > 0 for w in tokens(text))
        out.append((key, held_out(key), len(tokens(text)), known, total, score))
    return sorted(out, key=str)


def result(frame):
    return sorted(((*tuple(r)[:5], r["base_score"]) for r in frame.collect()), key=str)


def same(found, wanted):
    assert [row[:5] for row in found] == [row[:5] for row in wanted]
    assert [row[5] for row in found] == pytest.approx([row[5] for row in wanted], rel=1e-9)


@pytest.mark.parametrize("pairs", [0, 1 << 19])
def test_base_scores(spark, monkeypatch, pairs):
    monkeypatch.setattr(katz, "KNOWN_PAIRS", pairs)
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet").where("doc_id < 100")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    same(result(katz.score(docs, size=500)), base(rows))


def test_scores_sum_to_one(spark, monkeypatch):
    """What the model gives all classes after a history adds up, seen or not."""
    docs = spark.createDataFrame([(i, "a b c a b d " * (i % 3 + 1) + f"e{i}") for i in range(1, 40)], "doc_id long, text string")
    training = katz._rows(docs, "text").where("NOT held_out").select("text")
    words_ = katz.word_counts(training)
    known = katz.classes(words_, training.count(), 8)
    made = katz.model(known, katz.pair_counts(training, known))
    pairs = {r["pair"]: r["n"] for r in katz.pair_counts(training, known).collect()}
    assert known.alone.sum() == pytest.approx(1)
    for history in range(len(known.counts)):
        total = 0.0
        for follower in range(len(known.counts)):
            pair = np.array([history << 16 | follower], dtype=np.uint32).view(np.int32)
            n = pairs.get(int(pair[0]), 0)
            log = made.seen(pair, np.array([n])) if n else made.unseen(pair)
            total += 10 ** float(log[0])
        assert total == pytest.approx(1)


def test_counts_go_when_their_grams_are_written(spark, monkeypatch):
    gone = []
    monkeypatch.setattr(katz, "discard", lambda *frames: gone.extend(f.columns for f in frames), raising=False)
    docs = spark.createDataFrame([(i, f"a b c e{i}") for i in range(20)], "doc_id long, text string")
    katz.score(docs).collect()
    assert gone == [["history", "n", "lower", "below"]] * (katz.ORDER - 1)


def test_pairs_help_on_held_out_text(spark):
    text = "the cat sat on the mat and the dog sat on the rug "
    docs = spark.createDataFrame([(i, text * 5) for i in range(60)], "doc_id long, text string")
    rows = katz.score(docs).where("held_out").collect()
    assert rows and all(r["score"] > r["base_score"] for r in rows)


def test_discounts_fall_back():
    assert katz.discounts({})[1] == 0.5
    good = katz.discounts({1: 1000, 2: 400, 3: 220, 4: 140, 5: 100, 6: 75})
    assert np.all((good[1:6] > 0) & (good[1:6] < 1)) and good[6] == 1


def test_odd_rows(spark):
    docs = with_clashes(odd_documents(spark))
    rows = [(r[0], r[1]) for r in odd_rows()]
    same(result(katz.score(docs)), base(rows))
    assert katz.score(spark.createDataFrame([], SCHEMA)).collect() == []


def plain_scores(rows, order):
    """The recursion as it is written, over all words and no classes."""
    counts = [Counter() for _ in range(order + 1)]
    followers = [{} for _ in range(order + 1)]

    def grams(text, k):
        all_ = [None] * (order - 1) + tokens(text)
        return [tuple(all_[i - k + 1 : i + 1]) for i in range(order - 1, len(all_))]

    for key, text in rows:
        if not held_out(key):
            for k in range(1, order + 1):
                counts[k].update(grams(text, k))
    total, distinct = sum(counts[1].values()), len(counts[1])
    factors = [katz.discounts(Counter(c.values())) for c in counts]
    for k in range(2, order + 1):
        for gram in counts[k]:
            followers[k].setdefault(gram[:-1], []).append(gram)
    weights = {}

    def seen(gram):
        k, n = len(gram), counts[len(gram)][gram]
        behind = sum(counts[k][g] for g in followers[k][gram[:-1]])
        return factors[k][min(n, len(factors[k]) - 1)] * n / (behind + 1)

    def weight(history, k):
        if history not in followers[k]:
            return 1.0
        if history not in weights:
            found = followers[k][history]
            weights[history] = (1 - sum(map(seen, found))) / (1 - sum(probability(g[1:]) for g in found))
        return weights[history]

    def probability(gram):
        k = len(gram)
        if k == 1:
            return (counts[1][gram] + 0.1) / (total + 0.1 * (distinct + 1))
        return seen(gram) if counts[k][gram] else weight(gram[:-1], k) * probability(gram[1:])

    return {key: sum(math.log10(probability(g)) for g in grams(text, order)) for key, text in rows}


@pytest.mark.parametrize(("order", "size", "known"), [(3, 4, 0), (3, 1 << 16, 50), (2, 4, 1 << 19), (4, 20, 50)])
def test_rare_words_keep_their_histories(spark, monkeypatch, order, size, known):
    """Scores are those of the full model, however few words and keys the tasks hold."""
    monkeypatch.setattr(katz, "KNOWN_PAIRS", known)
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet").where("doc_id < 60")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = {r["doc_id"]: r["score"] for r in katz.score(docs, size=size, order=order).collect()}
    assert any(held_out(key) for key, _ in rows)
    assert found == pytest.approx(plain_scores(rows, order), rel=1e-7)


@pytest.mark.parametrize(("order", "known"), [(2, 1 << 19), (3, 0), (3, 1 << 19), (4, 1 << 19)])
def test_frequent_keys_spread_over_buckets(spark, monkeypatch, order, known):
    """Many buckets, chunks and goes, and keys too frequent for a bucket, give the full model's scores."""
    monkeypatch.setattr(katz, "KNOWN_PAIRS", known)
    monkeypatch.setattr(katz, "BUCKET_TOKENS", 256)
    monkeypatch.setattr(katz, "CHUNK_TOKENS", 500)
    monkeypatch.setattr(katz, "SHARES", 3)
    draw = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in draw.zipf(1.4, draw.integers(0, 60)) % 500) for _ in range(150)]
    texts += ["of the of the of the", "", "of the end"] * 40
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    scored = katz.score(docs, size=30, order=order).cache()
    same(result(scored), base(rows))
    found = {r["doc_id"]: r["score"] for r in scored.collect()}
    assert found == pytest.approx(plain_scores(rows, order), rel=1e-7)


def test_repeated_rows_and_null_ids_count_one_by_one(spark):
    rows = [(1, "a b c a b"), (1, "a b c a b"), (None, "a b d"), (None, None), (1, "b c")]
    rows += [(i, f"a b c{i % 3}") for i in range(2, 40)]
    scored = katz.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    wanted = []
    for i, row in enumerate(rows):
        # Of rows with an id, the plain scores keep that of the last one.
        wanted.append(plain_scores([*rows[:i], *rows[i + 1 :], row], katz.ORDER)[row[0]])
    assert sorted(r["score"] for r in scored) == pytest.approx(sorted(wanted), rel=1e-9)


def test_counts_take_few_bytes_of_disk(spark, monkeypatch):
    """Of a random text, with as many triples as words, all tables that an order leaves or passes on."""
    sizes = {}
    write = DataFrameWriter.parquet

    def weighed(writer, path, *args, **kwargs):
        write(writer, path, *args, **kwargs)
        files = Path(path.removeprefix("file:")).rglob("*.parquet")
        sizes[Path(path).name] = sum(f.stat().st_size for f in files)

    monkeypatch.setattr(DataFrameWriter, "parquet", weighed)
    draw = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in draw.integers(0, 3000, 2000)) for _ in range(100)]
    katz.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    grams = [n for label, n in sizes.items() if label.startswith("katz-") and "words" not in label]
    assert grams and sum(grams) < 24 * 2 * 200_000
