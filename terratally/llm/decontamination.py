"""Benchmark decontamination by templates: windows with typed placeholders, then slot consistency.

Numbers, names and units become placeholders, so that a question with other values keeps its
template. Template windows of a document are hash-joined with those of the benchmark; windows on
one diagonal belong together, and count only if every value of the item always became the same
value in the document. Verbatim words make a second, plain set of windows, so a passage whose
letters' case was changed is found as well; these always count, whatever else is on their diagonal.

Items of fewer words than a window are one window whole. With ``LEAST_WORDS`` words or more they
match anywhere by their words; by their template, if too few of these are literal, only a stretch
between two sentence bounds, so "What is 12 plus 7" is found in "Q: What is 15 plus 9?". Even shorter
items, such as "Yes", match only a text that has no other words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terratally.llm.common import (
    ALNUM,
    Texts,
    byte_table,
    chain,
    fresh,
    id_and_text,
    mix,
    signed,
    slices,
)

WINDOW = 8
#: Literal words that a template window needs; with fewer it would fit too much.
LEAST_LITERALS = 4
#: Literal words that are enough for a short item's template between sentence bounds.
SENTENCE_LITERALS = 2
#: Words from which on an item may be a part of a text.
LEAST_WORDS = 4
#: Bits of the filter that saves shuffling windows no benchmark has; a fixed size, whatever the input.
FILTER_BITS = 1 << 24
#: Share or number of an item's windows that make a document contaminated.
LEAST_COVERAGE = 0.25
LEAST_WINDOWS = 6

# Units of measure that follow a number.
UNITS = (
    "mm cm m km in ft yd mi inch inches feet foot miles mile meters metres meter metre mg g kg t "
    "lb lbs oz tons ml l liters litres s sec seconds min minutes h hours hour days day weeks years "
    "mph kmh km2 m2 hz khz mhz ghz w kw mw v a j kj cal kcal c f k percent dollars euros usd eur"
).split()

_DIGIT = byte_table((0x30, 0x39))
_UPPER = byte_table((0x41, 0x5A))
_LOWER = byte_table((0x61, 0x7A))
_SENTENCE_END = byte_table((0x0A, 0x0A), (0x21, 0x21), (0x2E, 0x2E), (0x3A, 0x3A), (0x3F, 0x3F))
_SLOTS = mix(np.arange(101, 104, dtype=np.uint64))  # number, name, unit
_WINDOW_SCHEMA = "hash long, position int, slots array<long>"


def _unit_hashes() -> np.ndarray:
    words = pa.array(UNITS)
    (texts,) = slices(words)
    return np.sort(texts.hashes(texts.offsets[:-1], texts.offsets[1:]))


def templates(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per token: hash of the word, hash of word or placeholder, value (0 if literal), text number,
    and whether it begins a sentence."""
    starts, ends, owner = texts.runs(ALNUM)
    words = texts.lowered().hashes(starts, ends)
    if not len(starts):
        return words, words, words, owner, np.zeros(0, dtype=bool)
    data = texts.data
    number = _DIGIT[data[starts]]
    ended = np.concatenate(([0], np.cumsum(_SENTENCE_END[data])))
    first = np.ones(len(starts), dtype=bool)
    first[1:] = (owner[1:] != owner[:-1]) | (ended[starts[1:]] > ended[ends[:-1]])
    second = data[np.minimum(starts + 1, len(data) - 1)]
    name = _UPPER[data[starts]] & (ends - starts > 1) & _LOWER[second] & ~first
    unit = np.zeros(len(starts), dtype=bool)
    after = np.flatnonzero(number[:-1] & (owner[1:] == owner[:-1])) + 1
    unit[after] = np.isin(words[after], _unit_hashes()) & ~number[after]
    kind = np.select([number, name, unit], [0, 1, 2], -1)
    value = np.where(kind < 0, np.uint64(0), words)
    return words, np.where(kind < 0, words, _SLOTS[kind]), value, owner, first


def _windows(texts: Texts, size: int):
    """Text number, hash, position and values of each template window and each plain window."""
    words, shapes, values, owner, first = templates(texts)
    n = max(0, len(words) - size + 1)
    inside = owner[:n] == owner[size - 1 :][:n]
    if size < LEAST_WORDS:
        inside &= np.bincount(owner, minlength=len(texts))[owner[:n]] == size
    typed = np.concatenate(([0], np.cumsum(values != 0)))
    slots = typed[size:][:n] - typed[:n] if n else np.zeros(0, np.int64)
    position = np.arange(len(words)) - np.searchsorted(owner, owner)
    plain = np.flatnonzero(inside)
    yield owner[plain], chain(words, size)[plain], position[plain], None
    typical = size - slots >= LEAST_LITERALS
    if size < WINDOW:
        bounds = np.append(first, True)
        sentence = bounds[:n] & bounds[size:]
        typical |= sentence & (size - slots >= SENTENCE_LITERALS)
    shaped = np.flatnonzero(inside & (slots > 0) & typical)
    rows = values[shaped[:, None] + np.arange(size)] if len(shaped) else np.zeros((0, size), np.uint64)
    yield owner[shaped], chain(shapes, size)[shaped], position[shaped], rows


def _keyed_windows(rows: DataFrame, sizes, bits: bytes | None, key: str) -> DataFrame:
    """Windows of all rows of (key, row hash, text); with ``bits`` only those that it may know."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if bits is None else np.frombuffer(bits, dtype=np.uint8)
        for batch in batches:
            for texts in slices(batch.column(2)):
                for size in sizes:
                    for owner, hashes, position, values in _windows(texts, size):
                        if known is not None:
                            at = hashes & np.uint64(FILTER_BITS - 1)
                            hit = (known[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1
                            keep = np.flatnonzero(hit)
                            owner, hashes, position = owner[keep], hashes[keep], position[keep]
                            values = None if values is None else values[keep]
                        row = pa.array(owner + texts.first)
                        if values is None:
                            lists = pa.array([[]] * len(row), pa.list_(pa.int64()))
                        else:
                            width = np.arange(0, values.size + 1, size, dtype=np.int32)
                            lists = pa.ListArray.from_arrays(pa.array(width), pa.array(signed(values.ravel())))
                        yield pa.RecordBatch.from_arrays(
                            [
                                batch.column(0).take(row),
                                batch.column(1).take(row),
                                pa.array(signed(hashes)),
                                pa.array(position.astype(np.int32)),
                                lists,
                            ],
                            [key, "row_hash", "hash", "position", "slots"],
                        )

    return rows.mapInArrow(run, f"{key} long, row_hash long, {_WINDOW_SCHEMA}")


def _filter(windows: DataFrame) -> bytes:
    """Bit per hash of the benchmark's windows, from at most 16 partial filters of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.zeros(FILTER_BITS, dtype=bool)
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            marked[values & np.uint64(FILTER_BITS - 1)] = True
        packed = np.packbits(marked, bitorder="little").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], ["bits"])

    parts = windows.select("hash").coalesce(16).mapInArrow(run, "bits binary").collect()
    total = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for part in parts:
        total |= np.frombuffer(part["bits"], dtype=np.uint8)
    return total.tobytes()


def _named(table: DataFrame, key: str, text: str) -> DataFrame:
    rows = id_and_text(table, key, text)
    return rows.select(F.col(key).alias(key), F.xxhash64(text).alias("row_hash"), text)


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_key: str = "doc_id",
    item_key: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """One row per document and item that share verbatim windows or windows with consistent slots.

    ``doc_id, row_hash, item_id, n_windows, n_verbatim, n_matched, coverage, changed``: windows of the
    item on diagonals with consistent slots, its verbatim windows on any diagonal, those that are
    either, their share of the item's windows, and whether a consistent slot has another value.
    Items shorter than the window are one window whole, under the rules above; items without words
    match nothing.
    """
    items = _named(benchmark, item_key, text).toDF("item_id", "row_hash", "text")
    words = F.size(F.regexp_extract_all("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0)))
    items = items.withColumn("words", words).where("words > 0")
    lengths = F.least("words", F.lit(WINDOW))
    sizes = [r[0] for r in items.select(lengths).distinct().collect()]  # WINDOW values at most
    made = None
    for size in sizes:
        part = _keyed_windows(
            items.where(lengths == size).select("item_id", "row_hash", "text"), [size], None, "item_id"
        )
        made = part if made is None else made.unionByName(part)
    if made is None:
        made = docs.sparkSession.createDataFrame([], f"item_id long, row_hash long, {_WINDOW_SCHEMA}")
    made = made.toDF("item_id", "item_hash", "hash", "item_position", "item_slots")
    per_item = items.select(
        F.col("item_id").alias("item"),
        F.col("row_hash").alias("item_row"),
        (F.col("words") - lengths + 1).alias("item_windows"),
    ).distinct()
    rows = _named(docs, doc_key, text).toDF("doc_id", "row_hash", "text")
    found = _keyed_windows(rows, sorted(sizes), _filter(made), "doc_id")
    pairs = found.distinct().join(made.distinct(), "hash")
    typed = F.filter(
        F.arrays_zip(F.col("item_slots").alias("i"), F.col("slots").alias("d")),
        lambda slot: slot["i"] != 0,
    )
    diagonal = pairs.groupBy(
        "doc_id", "row_hash", "item_id", "item_hash",
        (F.col("position") - F.col("item_position")).alias("diagonal"),
    ).agg(
        F.array_distinct(F.flatten(F.collect_set(typed))).alias("slots"),
        F.collect_set("item_position").alias("positions"),
        F.collect_set(F.when(F.size("item_slots") == 0, F.col("item_position"))).alias("verbatim"),
    )
    kept_values = F.size(F.array_distinct(F.transform("slots", lambda s: s["i"])))
    consistent = F.size("slots") == kept_values

    def distinct(positions):
        return F.size(F.array_distinct(F.flatten(F.collect_list(positions))))

    by_item = diagonal.groupBy("doc_id", "row_hash", "item_id", "item_hash").agg(
        distinct(F.when(consistent, F.col("positions"))).alias("n_windows"),
        distinct(F.col("verbatim")).alias("n_verbatim"),
        distinct(F.when(consistent, F.col("positions")).otherwise(F.col("verbatim"))).alias("n_matched"),
        F.max(consistent & F.exists("slots", lambda s: s["i"] != s["d"])).alias("changed"),
    ).where("n_matched > 0")
    return by_item.join(
        per_item,
        F.col("item_id").eqNullSafe(F.col("item")) & (F.col("item_hash") == F.col("item_row")),
    ).select(
        "doc_id", "row_hash", "item_id", "n_windows", "n_verbatim", "n_matched",
        F.least(F.col("n_matched") / F.col("item_windows"), F.lit(1.0)).alias("coverage"),
        "changed",
    )


def leaks(docs: DataFrame, benchmark: DataFrame, **columns: str) -> DataFrame:
    """Matches that make a document contaminated."""
    enough = (F.col("coverage") >= LEAST_COVERAGE) | (F.col("n_matched") >= LEAST_WINDOWS)
    return matches(docs, benchmark, **columns).where(enough)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, n_items, item_id, n_windows, n_verbatim, coverage, changed, contaminated`` per document.

    ``item_id`` is the item with the largest coverage, the smallest id among equals; without a leak
    the counts are 0 and it is null. Null or empty texts are clean, an empty benchmark leaves all
    clean, repeated rows are judged alike, other columns are ignored.
    """
    worst = F.max(F.struct("coverage", (-F.col("item_id")).alias("minus"), "n_windows", "n_verbatim", "changed"))
    found = leaks(docs, benchmark, text=text).groupBy("doc_id", "row_hash").agg(
        F.countDistinct("item_id").alias("n_items"), worst.alias("worst")
    ).toDF("key", "hash", "n_items", "worst")
    rows = _named(docs, "doc_id", text).select("doc_id", "row_hash")
    same = F.col("doc_id").eqNullSafe(F.col("key")) & (F.col("row_hash") == F.col("hash"))
    return rows.join(found, same, "left").select(
        "doc_id",
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        (-F.col("worst.minus")).alias("item_id"),
        F.coalesce("worst.n_windows", F.lit(0)).alias("n_windows"),
        F.coalesce("worst.n_verbatim", F.lit(0)).alias("n_verbatim"),
        F.coalesce("worst.coverage", F.lit(0.0)).alias("coverage"),
        F.coalesce("worst.changed", F.lit(False)).alias("changed"),
        F.col("hash").isNotNull().alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` without a leak, with all their columns."""
    key, row = fresh(docs, "key", "row")
    found = leaks(docs, benchmark, text=text).select("doc_id", "row_hash").distinct().toDF(key, row)
    hashed = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(key)) & (hashed == F.col(row))
    return docs.join(found, same, "left_anti")
