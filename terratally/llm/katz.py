"""Katz backoff language model: counts of all training text, scores of all documents.

A token is a word or the end of its document; before a text stand ``ORDER - 1`` ends. Every word,
however rare, is counted by its 64-bit hash, alone and behind each history of up to ``ORDER - 1``
tokens. Counts are discounted by Good-Turing, order by order, and what that frees goes to the
followers never seen, in proportion to the next lower order, by a weight per history that makes
every distribution sum to one. A token's log probability is therefore, recursively,

    seen:    log10(d(n) * n / (n(h) + 1))        unseen: log10(a(h)) + that behind a shorter history

and without history the plain smoothed frequency. As a sum over all orders this is the plain
frequency, the weight of every known history, and for every seen gram its gain, which is what it is
worth beyond an unseen one. So a document's score is a sum of values looked up by one key each;
training text, whose grams have all been seen, needs those of the highest order alone.

The counts grow with the corpus and are only shuffled: grams as packed columns, in buckets that a
task holds one at a time. A gram is counted in the bucket of its lower gram, that without its first
token; all counts that its discounted share needs are there, so training text is scored there too. From
there it goes, with those counts, to the bucket of its history, where the history gets its weight and
held-out text is scored. Keys that are frequent enough to fill a bucket are spread over all of them, and
every task knows their counts. ``Model`` over ``Classes`` is a model of fixed size, where all but the
most frequent words share one class; ``score`` takes only its words.
"""

from __future__ import annotations

import ctypes
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terratally.llm.common import LOWERED_VALUE, NOT_SPACE, Texts, discard, mix, signed, slices, staged, staged_apart

#: Classes: the shared one, the end, and the most frequent words. Two of them fit into 32 bits.
CLASSES = 1 << 16
OTHER, END = 0, 1
#: Tokens of the longest gram.
ORDER = 3
#: At most so many frequent grams of an order have counts that every task knows.
KNOWN_PAIRS = 1 << 19
#: Tokens of training text to a bucket; a key with an eighth of that is spread over the buckets.
BUCKET_TOKENS = 3 << 18
#: Tokens whose grams a task counts before they are shuffled.
CHUNK_TOKENS = 1 << 19
#: An order above pairs is counted in so many goes, each with its own buckets.
SHARES = 2
#: Its histories are weighed in so many.
WEIGHED_SHARES = 3
#: Counts up to this are discounted.
DISCOUNTED = 5
ADDED = 0.1
_KEY = "doc_id long, row_hash long"
#: Hash of the end as a token of grams.
_END = mix(np.array([0xE0D], dtype=np.uint64))
#: The key of some tokens is that of all but the last times this, plus the last.
_STEP = 0xD1342543DE82EF95
_PACKED = "bucket int, kind int, chunk long, payload binary"
_TRAINING, _HELD_OUT, _WORDS, _DOCUMENTS = range(4)
_COUNTED = "history long, n binary, lower long, below binary, for_documents boolean"
#: What else than the buckets of histories stands in ``history`` of counted rows.
_COUNTS, _OFTEN, _SEEN, _ROWS, _PLAIN, _GAINS = -1, -2, -3, -4, -5, -6
#: What else than the chunk of held-out text stands in ``lower``.
_ALONE, _SPREAD = -1, -2


def _rows(docs: DataFrame, text: str) -> DataFrame:
    """Rows with their side: held out where crc32 of the id as text ends on 0; null counts as empty."""
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("row_hash"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        (F.crc32(number.cast("binary")) % 10 == 0).alias("held_out"),
    )


def _words(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, owner = texts.runs(NOT_SPACE)
    return signed(texts.hashes(starts, ends, texts.prefix_hashes(LOWERED_VALUE))), owner


def _counted(name: str, kind: pa.DataType, values: list[np.ndarray]) -> pa.RecordBatch:
    found, n = np.unique(np.concatenate(values), return_counts=True) if values else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(found, kind), pa.array(n, pa.int64())], [name, "n"])


def word_counts(training: DataFrame) -> DataFrame:
    """``word long, n long``: how often each word, by its hash, occurs; the ends are not in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _counted("word", pa.int64(), [_words(t)[0] for t in slices(batch.column(0))])

    found = training.select("text").mapInArrow(run, "word long, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


class Slots:
    """Distinct hashes, found by some of their bits; those that share these stand in another table."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.tables = keys, []
        left = np.arange(len(keys))
        while len(left):
            factor, shift = _step(len(self.tables)), np.uint64(62 - len(left).bit_length())
            slots = keys[left] * factor >> shift
            table = np.zeros(4 << len(left).bit_length(), dtype=np.min_scalar_type(len(keys)))
            table[slots] = left
            self.tables.append((factor, shift, table))
            left = left[table[slots] != left]

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which ``values`` are there, and where; elsewhere the place means nothing."""
        if not self.tables:
            return np.zeros(len(values), dtype=bool), np.zeros(len(values), dtype=np.int64)
        factor, shift, table = self.tables[0]
        at = table[values * factor >> shift]
        there = self.keys[at] == values
        for factor, shift, table in self.tables[1:]:
            left = np.flatnonzero(~there)
            some = values[left]
            at[left] = table[some * factor >> shift]
            there[left] = self.keys[at[left]] == some
        return there, at


@dataclass(frozen=True)
class Classes:
    """The words with a class of their own, ordered by hash, and counts by class."""

    words: np.ndarray
    numbers: np.ndarray
    counts: np.ndarray
    tokens: int
    distinct: int

    @property
    def alone(self) -> np.ndarray:
        """Probability of each class without history; sums to one."""
        return (self.counts + ADDED) / (self.tokens + ADDED * len(self.counts))

    @cached_property
    def _slots(self) -> Slots:
        return Slots(self.words.view(np.uint64))

    def of(self, words: np.ndarray) -> np.ndarray:
        there, at = self._slots.find(words.view(np.uint64))
        found = np.zeros(len(words), dtype=np.uint32)  # OTHER
        found[there] = self.numbers[at[there]]
        return found

    @cached_property
    def _hashes(self) -> np.ndarray:
        hashes = np.zeros(len(self.counts), dtype=np.uint64)
        hashes[self.numbers] = self.words.view(np.uint64)
        hashes[END] = _END[0]
        return hashes

    def coded(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Classes of tokens, and the tokens of the shared one."""
        numbers = self.of(signed(tokens))
        numbers[tokens == _END[0]] = END
        return numbers, tokens[numbers == OTHER]

    def decoded(self, numbers: np.ndarray, others: np.ndarray) -> np.ndarray:
        tokens = self._hashes[numbers.astype(np.int64)]
        tokens[numbers == OTHER] = others
        return tokens

    def base(self, counts: np.ndarray) -> np.ndarray:
        """log10 of the plain smoothed frequency of a token with this count."""
        return np.log10((counts + ADDED) / (self.tokens + ADDED * (self.distinct + 1)))


def classes(words: DataFrame, documents: int, size: int = CLASSES) -> Classes:
    """Classes from staged word counts and the number of training documents."""
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("k")).first()
    top = words.orderBy(F.desc("n"), "word").limit(size - 2).toArrow()
    found, n = (top.column(c).to_numpy() for c in ("word", "n"))
    counts = np.zeros(len(found) + 2, dtype=np.float64)
    counts[END], counts[2:] = documents, n
    counts[OTHER] = total["n"] - n.sum()
    order = np.argsort(found)
    return Classes(
        found[order],
        (order + 2).astype(np.uint32),
        counts,
        total["n"] + documents,
        total["k"] + (documents > 0),
    )


def _pairs_of(texts: Texts, known: Classes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of classes with their texts, each text's end included; words and their texts.

    The end of the text before stands for the start of a text.
    """
    words, owner = _words(texts)
    n = np.bincount(owner, minlength=len(texts))
    ends = np.cumsum(n + 1) - 1
    tokens = np.full(len(words) + len(texts), END, dtype=np.uint32)
    tokens[np.arange(len(words)) + owner] = known.of(words)
    before = np.empty_like(tokens)
    before[:1] = END
    before[1:] = tokens[:-1]
    before[ends[:-1] + 1] = END
    return (before << np.uint32(16)) | tokens, np.repeat(np.arange(len(texts)), n + 1), words, owner


def pair_counts(training: DataFrame, known: Classes) -> DataFrame:
    """``pair int, n long``: how often class ``pair & 65535`` follows class ``pair >> 16``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_pairs_of(t, known)[0].view(np.int32) for t in slices(batch.column(0))]
            yield _counted("pair", pa.int32(), found)

    found = training.select("text").mapInArrow(run, "pair int, n long")
    return found.groupBy("pair").agg(F.sum("n").alias("n"))


def discounts(of_count: dict[int, int], most: int = DISCOUNTED) -> np.ndarray:
    """Factor by which a count of 0..most is lowered; index ``most + 1`` and above stay.

    Good-Turing in Katz' form. Where there are too few counts of counts for that, or its factor
    would not lie between 0 and 1, half a count is taken off.
    """
    factors = np.ones(most + 2)
    once = of_count.get(1, 0)
    beyond = (most + 1) * of_count.get(most + 1, 0) / once if once else 1.0
    for r in range(1, most + 1):
        here, above = of_count.get(r, 0), of_count.get(r + 1, 0)
        factor = ((r + 1) * above / (r * here) - beyond) / (1 - beyond) if here and beyond < 1 else 0
        factors[r] = factor if 0 < factor < 1 else (r - 0.5) / r
    return factors


@dataclass(frozen=True)
class Model:
    known: Classes
    factors: np.ndarray
    histories: np.ndarray
    weights: np.ndarray

    def unseen(self, pairs: np.ndarray) -> np.ndarray:
        """log10 of the probability that a pair has as one never seen."""
        pairs = pairs.view(np.uint32)
        log_alone = np.log10(self.known.alone)
        return np.log10(self.weights[pairs >> 16]) + log_alone[pairs & 0xFFFF]

    def seen(self, pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        factor = self.factors[np.minimum(counts, len(self.factors) - 1)]
        return np.log10(factor * counts / (self.histories[pairs.view(np.uint32) >> 16] + 1))


def model(known: Classes, pairs: DataFrame) -> Model:
    """Discounts and weights from the staged pairs; what is collected has a row per class at most."""
    of_count = pairs.where(F.col("n") <= DISCOUNTED + 1).groupBy("n").count().collect()
    factors = discounts({r["n"]: r["count"] for r in of_count})
    size, alone = len(known.counts), known.alone

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            history, follower = pair.view(np.uint32) >> 16, pair.view(np.uint32) & 0xFFFF
            kept = factors[np.minimum(n, len(factors) - 1)] * n
            sums = [np.bincount(history, w, size) for w in (n.astype(float), kept, alone[follower])]
            some = np.flatnonzero(sums[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)), *(pa.array(s[some]) for s in sums)],
                ["history", "n", "kept", "covered"],
            )

    schema = "history int, n double, kept double, covered double"
    table = (
        pairs.mapInArrow(run, schema)
        .groupBy("history")
        .agg(*(F.sum(c).alias(c) for c in ("n", "kept", "covered")))
        .toArrow()
    )
    history, n, kept, covered = (c.to_numpy() for c in table.columns)
    histories, weights = np.zeros(size), np.ones(size)
    histories[history] = n
    free = 1 - kept / (n + 1)
    weights[history] = free / np.maximum(1 - covered, 1e-12)
    return Model(known, factors, histories, weights)


def _lookup(sorted_values: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_values):
        return np.zeros(len(values), dtype=bool), np.zeros(len(values), dtype=np.int64)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[at] == values, at


def _keep_freed() -> None:
    """Has the C library keep up to 128 MB that was freed; fetching it anew costs more than the sorts."""
    try:
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, 1 << 25)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, 1 << 27)  # M_TRIM_THRESHOLD
    except (AttributeError, OSError):  # another library
        pass


def _planes(values: np.ndarray) -> np.ndarray:
    """The bytes of floats, or of whole numbers from 0 on as far as the largest needs them, by place."""
    data = np.ascontiguousarray(values, dtype=np.float64 if values.dtype.kind == "f" else np.uint64)
    width = 8 if values.dtype.kind == "f" else (int(data.max()).bit_length() + 7) // 8 if len(data) else 0
    return np.ascontiguousarray(data.view(np.uint8).reshape(-1, 8)[:, :width].T)


def _joined(*planes: np.ndarray) -> bytes:
    """Arrays as one compressed string of their planes."""
    head = struct.pack(f"<{1 + 2 * len(planes)}q", len(planes), *(n for x in planes for n in x.shape))
    raw = b"".join([head, *(np.ascontiguousarray(x).data for x in planes)])
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _packed(*arrays: np.ndarray) -> bytes:
    return _joined(*map(_planes, arrays))


def _unpacked(payload: bytes) -> list[np.ndarray]:
    """Arrays of whole numbers of some width; floats have to be viewed as such."""
    size = int.from_bytes(payload[:8], "little")
    raw = pa.decompress(memoryview(payload)[8:], decompressed_size=size, codec="zstd", asbytes=True)
    shapes = struct.unpack_from(f"<{2 * struct.unpack_from('<q', raw)[0]}q", raw, 8)
    out, start = [], 8 + 8 * len(shapes)
    for width, n in zip(shapes[::2], shapes[1::2], strict=True):
        planes = np.frombuffer(raw, np.uint8, n * width, start)
        start += n * width
        if width > 1:
            values = np.zeros((n, 8), dtype=np.uint8)
            values[:, :width] = planes.reshape(width, n).T
            planes = values.reshape(-1).view(np.uint64)
        out.append(planes if width else np.zeros(n, dtype=np.uint8))
    return out


def _floats(values: np.ndarray) -> np.ndarray:
    return values.view(np.float64) if len(values) else np.zeros(0)


def _unpacked_all(payloads: list[bytes], arrays: int) -> list[np.ndarray]:
    """The arrays of all payloads, one after another, and how long each payload's last one is."""
    opened = [_unpacked(payload) for payload in payloads]
    none = np.zeros(0, dtype=np.uint64)
    whole = [np.concatenate([none, *(x[i] for x in opened)]) for i in range(arrays)]
    return [*whole, np.array([len(x[arrays - 1]) for x in opened], dtype=np.int64)]


def _steps(keys: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Planes of what each of the sorted ``keys`` is beyond the one before, and those that have none."""
    steps = np.diff(keys, prepend=np.zeros(1, dtype=np.uint64))
    steps[bounds[:-1]] = 0
    return _planes(steps), keys[bounds[:-1]].reshape(-1, 1).view(np.uint8).reshape(-1, 8, 1)


def _sums_of(steps: list[np.ndarray], firsts: list[np.ndarray]) -> np.ndarray:
    keys = (np.cumsum(x, dtype=np.uint64) + y[0] for x, y in zip(steps, firsts, strict=True))
    return np.concatenate([np.zeros(0, dtype=np.uint64), *keys])


def _step(times: int) -> np.uint64:
    return np.uint64(pow(_STEP, times, 1 << 64))


def _new(values: np.ndarray) -> np.ndarray:
    """Where another value begins."""
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    return new


def _summed(keys: np.ndarray, n: np.ndarray):
    """Distinct keys, a place of each, the number of each place's key, and the sums."""
    if not len(keys):
        return keys, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), n
    order = np.argsort(keys)
    new = _new(keys[order])
    at = np.flatnonzero(new)
    number = np.empty(len(keys), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    sums = np.add.reduceat(n[order], at)
    at = order[at]
    return keys[at], at, number, sums


@dataclass(frozen=True)
class Frequent:
    """Keys in order, and how often each occurs."""

    keys: np.ndarray
    n: np.ndarray

    @cached_property
    def _slots(self) -> Slots:
        return Slots(self.keys)

    def has(self, keys: np.ndarray) -> np.ndarray:
        return self._slots.find(keys)[0]

    def known(self, keys: np.ndarray, n: np.ndarray) -> np.ndarray:
        """``n`` with the counts of frequent ``keys`` in place."""
        there, at = _lookup(self.keys, keys)
        out = n.copy()
        out[there] = self.n[at[there]]
        return out


def _frequent(keys: np.ndarray, n: np.ndarray) -> Frequent:
    order = np.argsort(keys)
    return Frequent(keys[order], n[order].astype(np.float64))


@dataclass(frozen=True)
class Spread:
    """Where the grams of an order are counted, and where their histories are weighed.

    ``lows`` are the frequent histories of the lower grams, ``lowers`` the frequent lower grams and
    ``histories`` the frequent histories.
    """

    order: int
    buckets: int
    lows: Frequent
    lowers: Frequent
    histories: Frequent

    def keys(self, low: np.ndarray, first: np.ndarray, token: np.ndarray):
        """Keys of lower gram, gram and history."""
        lower = low * _step(1) + token
        return lower, first * _step(self.order - 1) + lower, first * _step(self.order - 2) + low

    def bucket(self, place: np.ndarray) -> np.ndarray:
        return ((place >> np.uint64(36)) * np.uint64(self.buckets) >> np.uint64(28)).astype(np.int64)

    def place(self, low: np.ndarray, lower: np.ndarray, gram: np.ndarray) -> np.ndarray:
        """A number that puts grams of a bucket together, in it those of a lower gram, then equal ones."""
        if self.order == 2:
            place, spread = mix(lower), np.arange(len(lower))
        else:
            place, spread = mix(low), np.flatnonzero(self.lows.has(low))
            place[spread] = mix(lower[spread])
        spread = spread[self.lowers.has(lower[spread])]
        place[spread] = mix(gram[spread])
        place &= ~np.uint64((1 << 36) - 1)
        place |= lower * _step(3) >> np.uint64(46) << np.uint64(18)
        place |= gram * _step(3) >> np.uint64(46)
        return place

    def by_history(self, history: np.ndarray, gram: np.ndarray):
        """Scattered keys of histories, their buckets, and which of them are spread."""
        spread, key = self.histories.has(history), mix(history)
        return key, self.bucket(np.where(spread, mix(gram), key)), spread


def _grams(texts: Texts, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the gram at each token: the key of all but its first and last token, these two, its text.

    Each text's end is a token.
    """
    words, owner = _words(texts)
    n = np.bincount(owner, minlength=len(texts))
    tokens = np.full(len(words) + order * len(texts), _END[0], dtype=np.uint64)
    tokens[np.arange(len(words)) + owner * order + order - 1] = words.view(np.uint64)
    own = np.repeat(np.arange(len(texts)), n + 1)
    at = np.arange(len(own)) + (own + 1) * (order - 1)
    low = np.zeros(len(own), dtype=np.uint64)
    for back in range(order - 2, 0, -1):
        low = low * _step(1) + tokens[at - back]
    return low, tokens[at - order + 1], tokens[at], own


def _payloads(parts: list[tuple], known: Classes, spread: Spread) -> Iterator[tuple[int, bytes]]:
    """Buckets with their grams: how many documents have each, which, and how often."""
    order = np.argsort(np.concatenate([x[0] for x in parts]))
    place, low, first, token, number = (np.concatenate(x)[order] for x in zip(*parts, strict=True))
    lower, gram, _ = spread.keys(low, first, token)
    bucket = spread.bucket(place)
    del order, place
    new_lower = _new(lower) | _new(bucket)
    new_gram = new_lower | _new(gram)
    entries = np.flatnonzero(new_gram | _new(number))
    times = np.diff(np.append(entries, len(number)))
    grams, lowers = np.flatnonzero(new_gram[entries]), np.flatnonzero(new_lower[entries])
    listed = np.diff(np.append(grams, len(entries)))
    sizes = np.diff(np.append(np.searchsorted(grams, lowers), len(grams)))
    low, token, first = low[entries[lowers]], token[entries[lowers]], first[entries[grams]]
    bucket, number = bucket[entries], number[entries]
    bounds = np.append(np.flatnonzero(_new(bucket)), len(entries))
    in_grams, in_lowers = np.searchsorted(grams, bounds), np.searchsorted(lowers, bounds)
    columns = []
    for values, ends in ((low, in_lowers), (token, in_lowers), (first, in_grams)):
        own, others = known.coded(values)
        columns += [(_planes(own), ends), (_planes(others), np.append(0, np.cumsum(own == OTHER))[ends])]
    columns += [(_planes(sizes), in_lowers), (_planes(listed), in_grams)]
    columns += [(_planes(number), bounds), (_planes(times), bounds)]
    for i in range(len(bounds) - 1):
        yield int(bucket[bounds[i]]), _joined(*(planes[:, ends[i] : ends[i + 1]] for planes, ends in columns))


def _word_payloads(parts: list[tuple], spread: Spread) -> Iterator[tuple[int, bytes]]:
    """Buckets with their words, by scattered keys, and the documents of each."""
    key, number = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(key)
    key, number = key[order], number[order]
    entries = np.flatnonzero(_new(key) | _new(number))
    times = np.diff(np.append(entries, len(key)))
    key, number = key[entries], number[entries]
    bucket = spread.bucket(key)
    bounds = np.append(np.flatnonzero(_new(bucket)), len(bucket))
    steps, firsts = _steps(key, bounds)
    columns = (steps, _planes(number), _planes(times))
    for i in range(len(bounds) - 1):
        at = slice(bounds[i], bounds[i + 1])
        yield int(bucket[bounds[i]]), _joined(firsts[i], *(x[:, at] for x in columns))


@dataclass(frozen=True)
class _Packed:
    """Grams of chunks, one after another: how many documents have each; these, and how often."""

    chunks: list[int]
    low: np.ndarray
    first: np.ndarray
    token: np.ndarray
    listed: np.ndarray
    number: np.ndarray
    times: np.ndarray
    #: Number of the chunk of each document.
    chunk: np.ndarray


def _opened(rows: list[tuple[int, bytes]], known: Classes) -> _Packed:
    *coded, sizes, listed, number, times, lengths = _unpacked_all([payload for _, payload in rows], 10)
    low, token, first = (known.decoded(*coded[i : i + 2]) for i in (0, 2, 4))
    sizes, listed, number, times = (x.astype(np.int32) for x in (sizes, listed, number, times))
    chunk = np.repeat(np.arange(len(rows), dtype=np.int32), lengths)
    low, token = np.repeat(low, sizes), np.repeat(token, sizes)
    return _Packed([chunk for chunk, _ in rows], low, first, token, listed, number, times, chunk)


def _by_chunk(chunk: np.ndarray, chunks: int, document: np.ndarray, *values: np.ndarray):
    """Of each chunk with any: its number, its documents and the sums of the values of each."""
    size = int(document.max()) + 1 if len(document) else 1
    place = chunk * np.int64(size) + document
    there, place = np.unique(place, return_inverse=True)
    bounds = np.searchsorted(there, np.arange(chunks + 1) * size)
    sums = [np.bincount(place, x, len(there)) for x in values]
    for i in np.flatnonzero(np.diff(bounds)):
        at = slice(bounds[i], bounds[i + 1])
        yield i, there[at] - i * size, *(x[at] for x in sums)


def gram_counts(rows: DataFrame, known: Classes, spread: Spread, highest: bool, share: int, shares: int) -> DataFrame:
    """Grams of one share of the buckets with the counts that their probabilities need.

    A row is ``history, n, lower, below``. For the bucket ``history`` it has keys of histories with the
    count of each gram (``n``), that of its lower gram and that of the lower gram's history (``below``),
    or the same for held-out text, with its documents; else what ``history`` below 0 says. Rows
    ``for_documents`` are done with, by chunk in ``lower``: the ``highest`` order has the counts of all
    training text, the first share of pairs all about the documents' plain words.
    """
    order, often, size = spread.order, _often(known), CHUNK_TOKENS
    plain = order == 2 and share == 0
    own_base = known.base(known.counts)
    own_base[OTHER] = known.base(np.zeros(1))[0]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _keep_freed()
        chunk = ((order * shares + share) << 20 | TaskContext.get().partitionId()) << 20
        parts: dict = {_TRAINING: [], _HELD_OUT: [], _WORDS: []}
        documents: list = []
        ready = listed = 0

        def plain_words(token: np.ndarray, owner: np.ndarray, number: np.ndarray):
            """Of each text its tokens, those known and their base, without the words left to be counted."""
            n = len(number)
            own = known.of(signed(token))
            own[token == _END[0]] = END
            base, left = own_base[own], np.flatnonzero(own == OTHER)
            often = spread.lowers.has(token[left])
            here, left = left[often], left[~often]
            base[here] = known.base(spread.lowers.known(token[here], np.zeros(len(here))))
            parts[_WORDS].append((mix(token[left]), number[owner[left]]))
            tokens = np.bincount(owner, minlength=n)
            new = np.bincount(owner[left], minlength=n) + (known.counts[END] == 0)
            return tokens, tokens - new, np.bincount(owner, base, n)

        def packed() -> pa.RecordBatch:
            out = [
                (bucket, kind, payload)
                for kind, some in parts.items()
                if some
                for bucket, payload in (
                    _word_payloads(some, spread) if kind == _WORDS else _payloads(some, known, spread)
                )
            ]
            ids = _packed(*(np.concatenate(x) for x in zip(*documents, strict=True)))
            out.append((int(mix(np.array([chunk], dtype=np.uint64))[0]) % spread.buckets, _DOCUMENTS, ids))
            bucket, kind, payload = zip(*out, strict=True)
            columns = [
                pa.array(bucket, pa.int32()),
                pa.array(kind, pa.int32()),
                pa.array([chunk] * len(out), pa.int64()),
                pa.array(payload, pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["bucket", "kind", "chunk", "payload"])

        for batch in batches:
            for texts in slices(batch.column(2)):
                held_out = batch.column(3).slice(texts.first, len(texts)).to_numpy(zero_copy_only=False)
                low, first, token, owner = _grams(texts, order)
                lower, gram, _ = spread.keys(low, first, token)
                place = spread.place(low, lower, gram)
                mine = spread.bucket(place) % shares == share
                # Only documents that are scored are numbered.
                scored = held_out | highest | plain
                number = np.where(scored, np.cumsum(scored) - 1 + listed, 0).astype(np.int32)
                for kind, side in ((_TRAINING, ~held_out), (_HELD_OUT, held_out)):
                    at = np.flatnonzero(mine & side[owner])
                    if len(at):
                        parts[kind].append((place[at], low[at], first[at], token[at], number[owner[at]]))
                        ready += len(at)
                words = (held_out, *plain_words(token, owner, number)) if plain else ()
                rows = np.flatnonzero(scored) + texts.first
                ids, hashes = (batch.column(x).take(pa.array(rows)) for x in (0, 1))
                documents.append(
                    (
                        ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint64),
                        ids.fill_null(0).to_numpy().view(np.uint64),
                        hashes.to_numpy().view(np.uint64),
                        *words,
                    )
                )
                listed += len(rows)
                if ready >= size:
                    yield packed()
                    documents = []
                    for some in parts.values():
                        some.clear()
                    ready = listed = 0
                    chunk += 1
        if documents:
            yield packed()

    def count(table: pa.Table) -> pa.Table:
        _keep_freed()
        kinds, chunks = table["kind"].to_pylist(), table["chunk"].to_pylist()
        payloads = table["payload"].to_pylist()
        out = [
            (_ROWS, payload, chunk, b"")
            for kind, chunk, payload in zip(kinds, chunks, payloads, strict=True)
            if kind == _DOCUMENTS
        ]
        training, held_out, words = (
            [(c, p) for k, c, p in zip(kinds, chunks, payloads, strict=True) if k == kind]
            for kind in (_TRAINING, _HELD_OUT, _WORDS)
        )
        training, held_out = _opened(training, known), _opened(held_out, known)
        found = _counted_grams(training, spread)
        counts = np.bincount(np.minimum(found.n, DISCOUNTED + 2).astype(np.int64), minlength=DISCOUNTED + 3)
        out.append((_COUNTS, _packed(counts), _ALONE, b""))
        many = np.flatnonzero(found.n >= often)
        if len(many):
            out.append((_OFTEN, _packed(found.gram[many], found.n[many].astype(np.uint64)), _ALONE, b""))
        if highest:
            out += [(_SEEN, payload, chunk, b"") for chunk, payload in _training_counts(training, found)]
        out += _by_history(found.history, found.gram, (found.n, found.n_lower, found.n_low), spread)
        out += _held_out(held_out, found, spread)
        out += [(_PLAIN, payload, chunk, b"") for chunk, payload in _known_words(words, found)]
        columns = [pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), _KINDS, strict=True)]
        columns.append(pa.array([row[0] <= _SEEN for row in out]))
        return pa.Table.from_arrays(columns, ["history", "n", "lower", "below", "for_documents"])

    return rows.mapInArrow(pack, _PACKED).groupBy("bucket").applyInArrow(count, _COUNTED)


_KINDS = (pa.int64(), pa.binary(), pa.int64(), pa.binary())


@dataclass(frozen=True)
class _Found:
    """Distinct grams in the order of their keys, and for each gram of the packed ones its number."""

    gram: np.ndarray
    history: np.ndarray
    ends: np.ndarray
    lowers: Frequent
    n: np.ndarray
    n_lower: np.ndarray
    n_low: np.ndarray
    number: np.ndarray


def _counted_grams(training: _Packed, spread: Spread) -> _Found:
    n = np.zeros(0)
    if len(training.listed):
        n = np.add.reduceat(training.times.astype(np.float64), np.cumsum(training.listed) - training.listed)
    lower, gram, history = spread.keys(training.low, training.first, training.token)
    gram, at, number, n = _summed(gram, n)
    low, lower, token = training.low[at], lower[at], training.token[at]
    keys, first_at, of_gram, n_lower = _summed(lower, n)
    n_lower = spread.lowers.known(keys, n_lower)
    if spread.order == 2:  # plain words stand behind nothing
        n_low = np.zeros(len(keys))
    else:
        lows, _, of_lower, n_low = _summed(low[first_at], n_lower)
        n_low = spread.lows.known(lows, n_low)[of_lower]
    lowers = Frequent(keys, n_lower)
    return _Found(gram, history[at], token == _END[0], lowers, n, n_lower[of_gram], n_low[of_gram], number)


def _training_counts(training: _Packed, found: _Found) -> Iterator[tuple[int, bytes]]:
    """By chunk, documents with the count of a gram, that of the next token's history, and how often.

    The next token's history is the lower gram, unless that ends with an end.
    """
    gram = np.repeat(found.number, training.listed)
    bounds = np.searchsorted(training.chunk, np.arange(len(training.chunks) + 1))
    counts = found.n, np.where(found.ends, 0, found.n_lower)
    columns = [_planes(x) for x in (training.number, *(x.astype(np.uint64)[gram] for x in counts), training.times)]
    for chunk, first, last in zip(training.chunks, bounds[:-1], bounds[1:], strict=True):
        yield chunk, _joined(*(x[:, first:last] for x in columns))


def _known_words(words: list[tuple[int, bytes]], found: _Found) -> Iterator[tuple[int, bytes]]:
    """By chunk, documents with the count of a word that training text has, and how often."""
    counts = _frequent(mix(found.lowers.keys), found.lowers.n)
    for chunk, payload in words:
        first, steps, document, times = _unpacked(payload)
        there, at = _lookup(counts.keys, np.cumsum(steps, dtype=np.uint64) + first)
        yield chunk, _packed(document[there], counts.n[at[there]].astype(np.uint64), times[there])


def _by_history(history, gram, counts, spread: Spread, chunks=None, *more) -> Iterator[tuple]:
    """Rows for the buckets of histories; ``more`` and the number among ``chunks`` are of held-out text."""
    history, bucket, apart = spread.by_history(history, gram)
    if chunks is None:
        bucket = bucket * 2 + apart
    order = np.argsort(history)
    order = order[np.argsort(bucket[order], kind="stable")]
    bucket, history = bucket[order], history[order]
    n, n_lower, n_low, *more = (x[order] for x in (*counts, *more))
    bounds = np.append(np.flatnonzero(_new(bucket)), len(bucket))
    if not len(bucket):
        return
    steps, firsts = _steps(history, bounds)
    values = [steps, *(_planes(x) for x in (n.astype(np.uint64), *more))]
    below = [_planes(x.astype(np.uint64)) for x in (n_lower, n_low)]
    end = [] if chunks is None else [_planes(chunks)]
    for i in range(len(bounds) - 1):
        at, place = slice(bounds[i], bounds[i + 1]), int(bucket[bounds[i]])
        payload = _joined(firsts[i], *(x[:, at] for x in values), *end), _joined(*(x[:, at] for x in below))
        if chunks is None:
            yield place // 2, payload[0], _SPREAD if place % 2 else _ALONE, payload[1]
        else:
            yield place, payload[0], 0, payload[1]


def _held_out(held_out: _Packed, found: _Found, spread: Spread) -> Iterator[tuple]:
    _, gram, history = spread.keys(held_out.low, held_out.first, held_out.token)
    there, at = _lookup(found.gram, gram)
    counts = []
    for n in (found.n, found.n_lower, found.n_low):
        counts.append(np.zeros(len(gram)))
        counts[-1][there] = n[at[there]]
    history, gram, *counts = (np.repeat(x, held_out.listed) for x in (history, gram, *counts))
    chunks = np.array(held_out.chunks, dtype=np.uint64)
    more = held_out.number, held_out.times, held_out.chunk
    yield from _by_history(history, gram, counts, spread, chunks, *more)


def _pieces(ns: list[bytes], belows: list[bytes]) -> tuple[np.ndarray, ...]:
    """History, count, count of the lower gram and of its history, of all pieces' grams."""
    opened = [_unpacked(n) for n in ns]
    history = _sums_of([x[1] for x in opened], [x[0] for x in opened])
    n = np.concatenate([np.zeros(0), *(x[2] for x in opened)])
    return history, n, *(x.astype(np.float64) for x in _unpacked_all(belows, 2)[:2])


@dataclass(frozen=True)
class Discounts:
    """Factors of an order, and the probability of its lower grams."""

    known: Classes
    factors: np.ndarray
    #: Of the order below; None below which stand the plain words.
    lower: np.ndarray | None

    def below(self, n_lower: np.ndarray, n_low: np.ndarray) -> np.ndarray:
        """Probability of lower grams seen so often behind such histories."""
        if self.lower is None:
            return (n_lower + ADDED) / (self.known.tokens + ADDED * (self.known.distinct + 1))
        return self.lower[np.minimum(n_lower, len(self.lower) - 1).astype(np.int64)] * n_lower / (n_low + 1)

    def kept(self, n: np.ndarray) -> np.ndarray:
        return self.factors[np.minimum(n, len(self.factors) - 1).astype(np.int64)] * n

    def sums(self, history: np.ndarray, n: np.ndarray, n_lower: np.ndarray, n_low: np.ndarray):
        """Distinct histories, how often each has a follower, what of that is kept, what is covered below."""
        found, _, number, total = _summed(history, n)
        covered = self.below(n_lower, n_low)
        return found, total, *(np.bincount(number, x, len(found)) for x in (self.kept(n), covered))


def _weight(total: np.ndarray, kept: np.ndarray, covered: np.ndarray) -> np.ndarray:
    return np.log10((1 - kept / (total + 1)) / np.maximum(1 - covered, 1e-12))


def _spread_histories(counts: DataFrame, made: Discounts, spread: Spread):
    """The frequent histories, in order, with their totals and weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, *sums = made.sums(*_pieces(*(x.to_pylist() for x in batch.columns)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (signed(found), *sums)], ["history", "total", "kept", "covered"]
            )

    if not len(spread.histories.keys):
        none = np.zeros(0)
        return none.astype(np.uint64), none, none
    schema = "history long, total double, kept double, covered double"
    table = (
        counts.where(F.col("lower") == _SPREAD)
        .select("n", "below")
        .mapInArrow(run, schema)
        .groupBy("history")
        .agg(*(F.sum(x).alias(x) for x in ("total", "kept", "covered")))
        .toArrow()
    )
    history, total, kept, covered = (x.to_numpy() for x in table.columns)
    order = np.argsort(history.view(np.uint64))
    return tuple(x[order] for x in (history.view(np.uint64), total, _weight(total, kept, covered)))


def _scored(rows: DataFrame, made: Discounts, frequent: tuple) -> DataFrame:
    """Weights of histories, and by them ``chunk, kind, payload``, what held-out text gains."""
    keys, totals, weights = frequent

    def run(table: pa.Table) -> pa.Table:
        _keep_freed()
        lower, n, below = (table[x].to_pylist() for x in ("lower", "n", "below"))
        training = [i for i, x in enumerate(lower) if x in (_ALONE, _SPREAD)]
        found, *sums = made.sums(*_pieces([n[i] for i in training], [below[i] for i in training]))
        total, weight = sums[0], _weight(*sums)
        others = [i for i, x in enumerate(lower) if x not in (_ALONE, _SPREAD)]
        opened = [_unpacked(n[i]) for i in others]
        history = _sums_of([x[1] for x in opened], [x[0] for x in opened])
        count, document, times = (np.concatenate([np.zeros(0), *(x[i] for x in opened)]) for i in (2, 3, 4))
        none = np.zeros(0, dtype=np.uint64)
        # The chunks that stand at the end of each row, numbered.
        chunks = (x[6].astype(np.uint64)[x[5].astype(np.int64)] for x in opened)
        out, chunk = np.unique(np.concatenate([none, *chunks]), return_inverse=True)
        value, behind = np.zeros(len(history)), np.zeros(len(history))
        for some, some_total, some_weight in ((found, total, weight), (keys, totals, weights)):
            there, at = _lookup(some, history)
            value[there], behind[there] = some_weight[at[there]], some_total[at[there]]
        seen = np.flatnonzero(count)
        counts = (x[seen].astype(np.float64) for x in _unpacked_all([below[i] for i in others], 2)[:2])
        value[seen] = np.log10(made.kept(count[seen]) / (behind[seen] + 1) / made.below(*counts))
        sums = _by_chunk(chunk, len(out), document.astype(np.int64), value * times)
        payloads = [_packed(documents, total) for _, documents, total in sums]
        columns = [
            pa.array(list(out), pa.int64()),
            pa.array([_GAINS] * len(out), pa.int64()),
            pa.array(payloads, pa.binary()),
        ]
        return pa.Table.from_arrays(columns, ["chunk", "kind", "payload"])

    return rows.groupBy("history").applyInArrow(run, "chunk long, kind long, payload binary")


def _often(known: Classes) -> float:
    """How often a frequent key occurs at least; there are ``KNOWN_PAIRS`` of an order at most."""
    return max(BUCKET_TOKENS / 8, known.tokens / KNOWN_PAIRS) if KNOWN_PAIRS else float("inf")


def _as_histories(frequent: Frequent, length: int, known: Classes) -> Frequent:
    """Frequent grams of ``length`` tokens as histories; that of ends alone begins every text."""
    start = np.zeros(1, dtype=np.uint64)
    for _ in range(length):
        start = start * _step(1) + _END
    documents = known.counts[END]
    others = frequent.keys != start[0]
    begins = [documents] if documents >= _often(known) else []
    return _frequent(
        np.append(frequent.keys[others], start[: len(begins)]), np.append(frequent.n[others], begins)
    )


def order_tables(
    rows: DataFrame, known: Classes, spread: Spread, lower: np.ndarray | None, highest: bool
) -> tuple[DataFrame, np.ndarray, Frequent]:
    """What the grams and histories of an order give the documents, its factors, its frequent grams.

    Documents are ``chunk, kind, payload``: the rows of a chunk, and counts or gains by the number of its
    rows. ``lower`` are the factors of the order below.
    """
    order = spread.order
    passes = 1 if order == 2 else min(SHARES, spread.buckets)
    parts = [gram_counts(rows, known, spread, highest, share, passes) for share in range(passes)]
    counts, done = staged_apart(parts, f"katz-{order}", "for_documents")
    # As many numbers for each bucket.
    few = counts.where(F.col("history") == _COUNTS).select("n").toArrow().column(0).to_pylist()
    of_count = sum((_unpacked(x)[0].astype(np.int64) for x in few), np.zeros(DISCOUNTED + 3, dtype=np.int64))
    factors = discounts(dict(enumerate(of_count[: DISCOUNTED + 2].tolist())))
    many = counts.where(F.col("history") == _OFTEN).select("n").toArrow().column(0).to_pylist()
    none = [np.zeros(0, dtype=np.uint64)] * 2
    frequent = _frequent(*(np.concatenate(x) for x in zip(none, *map(_unpacked, many), strict=True)))
    made = Discounts(known, factors, lower)
    histories = _spread_histories(counts, made, spread)
    share = F.col("history") % WEIGHED_SHARES
    goes = [counts.where((F.col("history") >= 0) & (share == i)) for i in range(WEIGHED_SHARES)]
    scored = [_scored(rows, made, histories) for rows in goes]
    gains = staged(scored[0], f"katz-grams-{order}", *scored[1:])
    discard(counts)
    done = done.select(F.col("lower").alias("chunk"), F.col("history").alias("kind"), F.col("n").alias("payload"))
    return done.unionByName(gains), factors, frequent


def _documents(grams: DataFrame, factors: np.ndarray, plain: bool, begins: float = 0.0) -> DataFrame:
    """``doc_id, row_hash, gain`` of the documents of each chunk, or all about them if ``plain``.

    ``begins`` is what training text has besides its grams.
    """

    def run(table: pa.Table) -> pa.Table:
        rows = list(zip(table["kind"].to_pylist(), table["payload"].to_pylist(), strict=True))
        null, ids, hashes, *more = next(_unpacked(payload) for kind, payload in rows if kind == _ROWS)
        gain, base, known = np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(len(ids), dtype=np.int64)
        for kind, payload in rows:
            if kind == _GAINS:
                document, value = _unpacked(payload)
                gain[document.astype(np.int64)] += _floats(value)
            elif kind == _SEEN:
                document, n, behind, times = _unpacked(payload)
                n = n.astype(np.int64)
                value = np.log10(factors[np.minimum(n, len(factors) - 1)] * n / (behind.astype(np.float64) + 1))
                gain += np.bincount(document, value * times, len(ids))
            elif kind == _PLAIN:
                document, n, times = _unpacked(payload)
                value = np.log10((n.astype(np.float64) + ADDED) / ADDED)
                known += np.bincount(document, times, len(ids)).astype(np.int64)
                base += np.bincount(document, value * times, len(ids))
        ids, hashes = (signed(x.astype(np.uint64)) for x in (ids, hashes))
        columns = [pa.array(ids, pa.int64(), mask=null.astype(bool)), pa.array(hashes)]
        if not plain:
            return pa.Table.from_arrays([*columns, pa.array(gain)], ["doc_id", "row_hash", "gain"])
        held_out, tokens, of_known, of_base = more
        held_out, base = held_out.astype(bool), base + _floats(of_base)
        columns += [
            pa.array(held_out),
            pa.array(tokens.astype(np.int64)),
            pa.array(of_known.astype(np.int64) + known),
            pa.array(base),
            pa.array(gain + np.where(held_out, base, begins)),
        ]
        return pa.Table.from_arrays(columns, names)

    names = ["doc_id", "row_hash", "held_out", "n_tokens", "n_known", "base_score", "score"]
    kinds = "held_out boolean, n_tokens long, n_known long, base_score double, score double"
    return grams.groupBy("chunk").applyInArrow(run, f"{_KEY}, {kinds if plain else 'gain double'}")


def score(docs: DataFrame, text: str = "text", size: int = CLASSES, order: int = ORDER) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    An empty or null text has its end alone. Repeated rows are scored, and trained on, one by one;
    with no training rows every token is unknown. Other columns are ignored, an empty table gives
    no rows. ``size`` and ``KNOWN_PAIRS`` bound what tasks hold and change no result.
    """
    if order < 2:
        raise ValueError("a gram has two tokens at least")
    spark = docs.sparkSession
    rows = _rows(docs, text)
    training = rows.where(~F.col("held_out")).select("text")
    documents = training.count()
    words = staged(word_counts(training), "katz-words")
    known = classes(words, documents, size)
    buckets = max(1, -(-known.tokens // BUCKET_TOKENS))
    many = words.where(F.col("n") >= F.lit(_often(known))).toArrow()
    ends = _END[: int(documents >= _often(known))]
    frequent = _frequent(
        np.append(many.column("word").to_numpy().view(np.uint64), ends),
        np.append(many.column("n").to_numpy(), [documents] * len(ends)),
    )
    # Before a word, with no history, stand all tokens.
    lows = Frequent(np.zeros(1, dtype=np.uint64), np.array([float(known.tokens)]))
    factors, tables = None, []
    # Where nothing is seen, longer grams give nothing.
    for k in range(2, (order if documents else 2) + 1):
        histories = _as_histories(frequent, k - 1, known)
        spread = Spread(k, buckets, lows, frequent, histories)
        grams, factors, frequent = order_tables(rows, known, spread, factors, k == order)
        tables.append((grams, factors))
        lows = histories
    # The first token of training text stands behind ends alone.
    summary = _documents(*tables[0], True, -float(np.log10(documents + 1)))
    if len(tables) > 1:
        summary = _with_gains(staged(summary, "katz-documents"), tables[1:])
    return summary.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def _with_gains(summary: DataFrame, tables: list[tuple[DataFrame, np.ndarray]]) -> DataFrame:
    gains = reduce(DataFrame.unionByName, [_documents(grams, factors, False) for grams, factors in tables])
    joined = gains.groupBy(F.col("doc_id").alias("key"), F.col("row_hash").alias("hash")).agg(
        F.sum("gain").alias("gain")
    )
    # Repeated rows have all added to the same sums.
    repeats = summary.groupBy(F.col("doc_id").alias("key2"), F.col("row_hash").alias("hash2")).agg(
        F.count("*").alias("rows")
    )
    sums = joined.join(repeats, F.col("key").eqNullSafe(F.col("key2")) & (F.col("hash") == F.col("hash2")))
    same = F.col("doc_id").eqNullSafe(F.col("key")) & (F.col("row_hash") == F.col("hash"))
    score = F.col("score") + F.coalesce(F.col("gain") / F.col("rows"), F.lit(0.0))
    return summary.join(sums, same, "left").withColumn("score", score)
