"""Removal of repeated byte strings across documents by interval expansion from seeds.

A suffix array lists all suffixes in order, and those that start alike form an interval; extending
the common start to the left, breadth first, splits intervals until they hold one suffix or reach
the wanted length. Sorting the suffixes of a whole corpus would move it many times over, so the
expansion starts at seeds instead of at single bytes: every ``length`` bytes contain, at a place
that their content alone decides, a seed of half that length (the smallest hash among the seeds in
them). Equal strings have equal seeds at equal places. Seeds that occur once are dropped, the
suffixes that begin with one of the others make its interval, and each interval is extended
backwards, level by level, up to the threshold. Intervals of frequent seeds are too large for one
task; there, every level's strings are grouped by their hash, and the first of each is joined back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terratally.llm.common import BYTE_VALUE, Texts, mix, powers, signed, slices, staged

LENGTH = 100
#: Bits of the filter of repeated seeds, and how many it may hold; beyond that they are joined.
FILTER_BITS = 1 << 26
FILTER_SEEDS = FILTER_BITS // 8
#: The suffixes of seeds with more than this never meet in one task.
FREQUENT = 20_000
#: Frequent seeds whose strings a task makes at a time.
STRING_SEEDS = 5_000
#: Suffixes whose surroundings a task cuts out at a time, and documents it puts together at a time.
CUT_ROWS = 20_000
KEPT_ROWS = 500
#: Suffixes that one task call extends, on average.
GROUP_ROWS = 5_000

_ROW = "doc_id long, row_hash long"
_SUFFIX = f"bucket int, seed long, {_ROW}, at int, left_bytes int, context binary, to int"
_STRING = f"string long, {_ROW}, start int, at int"

_NAMES = [column.split()[0] for column in _SUFFIX.split(", ")]


def _rows(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("row_hash"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )


def seeds(texts: Texts, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, hash and text of the seed of every ``length`` bytes of a text, each place once.

    The leftmost of equal hashes counts, and only the content of the bytes decides, so equal
    strings choose alike wherever they stand.
    """
    size = length // 2
    data, offsets = texts.data, texts.offsets
    n = len(data) - size + 1
    if len(data) < length:
        none = np.zeros(0, dtype=np.int64)
        return none, none.astype(np.uint64), none
    sums = texts.prefix_hashes()
    _, down = powers(len(data) + 1)
    hashes = mix((sums[size:] - sums[:n]) * down[:n])
    order = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    span = length - size + 1  # seeds that start within ``length`` bytes
    least, width = order, 1
    while width * 2 <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: n - span + 1], least[span - width : span - width + n - span + 1])
    starts = np.ones(len(least), dtype=bool)
    for end in offsets[1:]:
        starts[max(0, end - length + 1) : end] = False
    chosen = least[starts]
    places = np.unique(chosen & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return places, hashes[places], np.searchsorted(offsets, places, "right") - 1


def _repeated(rows: DataFrame, length: int) -> DataFrame:
    """``seed long, n long`` of seeds that occur more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [signed(seeds(texts, length)[1]) for texts in slices(batch.column(0))]
            seed, n = np.unique(np.concatenate(found), return_counts=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(seed, pa.int64()), pa.array(n, pa.int64())], ["seed", "n"])

    found = rows.select("text").mapInArrow(run, "seed long, n long")
    return found.groupBy("seed").agg(F.sum("n").alias("n")).where("n > 1")


def _filter(repeated: DataFrame) -> bytes:
    """Two bits per repeated seed; at most eight partial filters of fixed size reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
        for batch in batches:
            hashes = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in _bits_of(hashes):
                np.bitwise_or.at(bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([bits.tobytes()], pa.binary())], ["bits"])

    total = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for part in repeated.select("seed").coalesce(8).mapInArrow(run, "bits binary").toLocalIterator():
        total |= np.frombuffer(part["bits"], dtype=np.uint8)
    return total.tobytes()


def _bits_of(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(FILTER_BITS - 1)
    return hashes & mask, (hashes >> np.uint64(36)) & mask


def _known(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    known = np.ones(len(hashes), dtype=bool)
    for at in _bits_of(hashes):
        known &= ((bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
    return known


def _places(rows: DataFrame, repeated: DataFrame, length: int) -> DataFrame:
    """Rows with the places of their repeated seeds, by joining seeds; for too many for a filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column(2)):
                at, hashes, owner = seeds(texts, length)
                row = pa.array(owner + texts.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(row),
                        batch.column(1).take(row),
                        pa.array(signed(hashes)),
                        pa.array((at - texts.offsets[owner]).astype(np.int32)),
                    ],
                    ["key", "hash", "seed", "at"],
                )

    found = rows.mapInArrow(run, "key long, hash long, seed long, at int").join(repeated, "seed")
    places = found.groupBy("key", "hash").agg(F.collect_set("at").alias("places"))
    same = F.col("doc_id").eqNullSafe(F.col("key")) & (F.col("row_hash") == F.col("hash"))
    return rows.join(places, same).select("doc_id", "row_hash", "text", "places")


def _order(doc_id: pa.Array, row_hash: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sort keys of documents; a null id comes first."""
    ids = doc_id.fill_null(-(2**63)).to_numpy(zero_copy_only=False)
    return ids, row_hash.to_numpy(zero_copy_only=False)


def _suffixes(rows: DataFrame, repeated: DataFrame, length: int) -> tuple[DataFrame, DataFrame | None]:
    """Suffixes of repeated seeds with the bytes around them, as in ``_SUFFIX``.

    Of equal surroundings in one batch only the first goes on; in the others, all bytes are
    repeats, which is a row with ``to`` and no bytes. Of frequent seeds, if there are any, the
    strings of ``length`` bytes around them make the second table, as in ``_STRING``; ``at`` is
    the place of the seed.
    """
    size = length // 2
    repeats = repeated.count()
    # All of them: there are at most as many as bytes of text by FREQUENT.
    frequent = repeated.where(F.col("n") > FREQUENT).select("seed").toArrow().column(0).to_numpy()
    occurrences = repeated.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = int(max(1, occurrences // GROUP_ROWS))
    packed = _filter(repeated) if repeats <= FILTER_SEEDS else None

    def found(batch: pa.RecordBatch, bits: np.ndarray | None) -> dict[str, np.ndarray]:
        """Known seeds of a batch: row, place, bounds of what is around, and hashes of these."""
        parts = []
        for texts in slices(batch.column(2)):
            sums = texts.prefix_hashes()
            if bits is not None:
                at, hashes, owner = seeds(texts, length)
                kept = np.flatnonzero(_known(bits, hashes))
                at, hashes, owner = at[kept], hashes[kept], owner[kept]
            else:
                lists = batch.column(3).slice(texts.first, len(texts))
                n = lists.value_lengths().to_numpy(zero_copy_only=False)
                owner = np.repeat(np.arange(len(texts)), n)
                at = lists.flatten().to_numpy(zero_copy_only=False) + texts.offsets[owner]
                hashes = stretch_hashes(sums, at, at + size)
            origin = texts.offsets[owner]
            first = np.maximum(origin, at - (length - size))
            last = np.minimum(texts.offsets[owner + 1], at + length)
            parts.append(
                {
                    "row": (owner + texts.first).astype(np.int32),
                    "seed": hashes,
                    "around": stretch_hashes(sums, first, last) ^ mix(hashes),
                    "at": (at - origin).astype(np.int32),
                    "first": (first - origin).astype(np.int32),
                    "last": (last - origin).astype(np.int32),
                }
            )
        return {name: np.concatenate([part.pop(name) for part in parts]) for name in list(parts[0])}

    def leading(batches: Iterator[pa.RecordBatch]):
        """Batches with their seeds, the first of equal surroundings, and what repeats these."""
        bits = None if packed is None else np.frombuffer(packed, dtype=np.uint8)
        for batch in batches:
            if not batch.num_rows:
                continue
            here = found(batch, bits)
            row = here["row"]
            ids, row_hashes = _order(batch.column(0), batch.column(1))
            order = np.lexsort((here["at"], row_hashes[row], ids[row], here["around"]))
            around = here["around"][order]
            new = np.ones(len(order), dtype=bool)
            new[1:] = around[1:] != around[:-1]
            lead = order[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(order) else order
            # A repeated row is the same document, so its suffixes are no repeats of the other's.
            same = (
                (ids[row[order]] == ids[row[lead]])
                & (row_hashes[row[order]] == row_hashes[row[lead]])
                & (here["at"][order] == here["at"][lead])
            )
            alone = order[new]
            split = np.isin(signed(here["seed"][alone]), frequent)
            yield batch, here, alone, split, order[~same]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, here, alone, split, later in leading(batches):
            yield _repeated_rows(batch, here, later, buckets)
            row = here["row"]
            alone = alone[~split]
            alone = alone[np.argsort(row[alone], kind="stable")]
            texts, held, raw = batch.column(2), -1, b""
            for part in range(0, len(alone), CUT_ROWS):
                mine = alone[part : part + CUT_ROWS]
                seed, contexts = here["seed"][mine], []
                for i in mine.tolist():
                    if row[i] != held:
                        held = row[i]
                        raw = texts[int(held)].as_py().encode()
                    contexts.append(raw[here["first"][i] : here["last"][i]])
                taken = pa.array(row[mine])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((mix(seed) % np.uint64(buckets)).astype(np.int32)),
                        pa.array(signed(seed)),
                        batch.column(0).take(taken),
                        batch.column(1).take(taken),
                        pa.array(here["at"][mine].astype(np.int32)),
                        pa.array((here["at"][mine] - here["first"][mine]).astype(np.int32)),
                        pa.array(contexts, pa.binary()),
                        pa.nulls(len(mine), pa.int32()),
                    ],
                    _NAMES,
                )

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, here, alone, split, _ in leading(batches):
            hot = alone[split]
            hot = hot[np.lexsort((here["at"][hot], here["row"][hot]))]
            for texts in slices(batch.column(2)):
                low, high = np.searchsorted(here["row"][hot], [texts.first, texts.first + len(texts)])
                sums = texts.prefix_hashes()
                for part in range(low, high, STRING_SEEDS):
                    mine = hot[part : min(part + STRING_SEEDS, high)]
                    starts = here["at"][mine][:, None] - np.arange(length - size + 1)
                    inside = (starts >= here["first"][mine][:, None]) & (starts + length <= here["last"][mine][:, None])
                    which, _ = np.nonzero(inside)
                    start, owner = starts[inside], here["row"][mine][which]
                    # A string with several of the seeds is needed once.
                    _, once = np.unique(owner.astype(np.int64) << 40 | start, return_index=True)
                    start, owner, which = start[once], owner[once], which[once]
                    origin = texts.offsets[owner - texts.first] + start
                    taken = pa.array(owner)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(signed(stretch_hashes(sums, origin, origin + length))),
                            batch.column(0).take(taken),
                            batch.column(1).take(taken),
                            pa.array(start.astype(np.int32)),
                            pa.array(here["at"][mine][which].astype(np.int32)),
                        ],
                        ["string", "doc_id", "row_hash", "start", "at"],
                    )

    source = rows if packed is not None else _places(rows, repeated, length)
    return source.mapInArrow(run, _SUFFIX), source.mapInArrow(strings, _STRING) if len(frequent) else None


def _of_strings(strings: DataFrame, length: int) -> DataFrame:
    """``doc_id, row_hash, start, to`` as of ``_intervals``; strings of one hash never meet in a task."""
    place = F.struct("doc_id", "row_hash", "start")  # a null id comes first
    firsts = (
        strings.groupBy("string")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where(~F.col("first").eqNullSafe(F.col("last")))
        .select("string", "first")
    )
    # Strings around one seed overlap, so they make one interval.
    return (
        strings.join(firsts, "string")
        .where(~place.eqNullSafe(F.col("first")))
        .groupBy("doc_id", "row_hash", "at")
        .agg(F.min("start").alias("start"), (F.max("start") + length).cast("int").alias("to"))
        .drop("at")
    )


def _repeated_rows(batch: pa.RecordBatch, here: dict[str, np.ndarray], later: np.ndarray, buckets: int):
    """Surroundings that an earlier text of the batch has as well, merged where they overlap."""
    later = later[np.lexsort((here["first"][later], here["row"][later]))]
    row, first, last = (here[name][later].astype(np.int64) for name in ("row", "first", "last"))
    reach = np.maximum.accumulate(last + row * (1 << 40)) - row * (1 << 40) if len(later) else last
    new = np.ones(len(later), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (first[1:] > reach[:-1])
    at = np.flatnonzero(new)
    ends = np.append(at[1:], len(later)) - 1 if len(at) else at
    taken = pa.array(row[at])
    spread = mix((first[at] + row[at] * 1_000_003).astype(np.uint64)) % np.uint64(buckets)
    nothing = pa.array(np.zeros(len(at), dtype=np.int32))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(spread.astype(np.int32)),
            pa.array(np.zeros(len(at), dtype=np.int64)),
            batch.column(0).take(taken),
            batch.column(1).take(taken),
            pa.array(first[at].astype(np.int32)),
            nothing,
            pa.nulls(len(at), pa.binary()),
            pa.array(reach[ends].astype(np.int32)),
        ],
        _NAMES,
    )


def stretch_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


def expand(seed: np.ndarray, doc: np.ndarray, at: np.ndarray, left: np.ndarray,
           contexts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest backward extension with which each suffix repeats an earlier one, or -1.

    Rows stand in document order, ``doc`` numbers equal documents. At level l the intervals hold
    suffixes that agree in the l bytes before their seed; an interval of one ends. In the others,
    suffixes that agree in ``length`` bytes from there are equal strings, all but the first of
    which are repeats.
    """
    size = length // 2
    most = length - size
    n = len(seed)
    lengths = np.fromiter(map(len, contexts), dtype=np.int64, count=n)
    table = np.zeros((n, most + length), dtype=np.uint8)
    flat = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    begin = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    row = np.repeat(np.arange(n), lengths)
    column = np.arange(len(flat)) - begin[row] + (most - left)[row]
    table[row, column] = flat
    up, down = powers(most + length + 1)
    sums = np.zeros((n, most + length + 1), dtype=np.uint64)
    np.cumsum(BYTE_VALUE[table] * up[: most + length], axis=1, out=sums[:, 1:])
    right = lengths - left - size
    least, greatest = np.full(n, -1), np.full(n, -1)
    alive = np.arange(n)
    for level in range(most + 1):
        alive = alive[left[alive] >= level]
        begun = mix((sums[alive, most] - sums[alive, most - level]) * down[most - level] ^ seed[alive])
        _, inverse, count = np.unique(begun, return_inverse=True, return_counts=True)
        alive = alive[count[inverse] > 1]
        if not len(alive):
            break
        some = alive[right[alive] >= most - level]
        whole = (sums[some, most + length - level] - sums[some, most - level]) * down[most - level]
        whole = mix(whole ^ seed[some])
        order = np.argsort(whole, kind="stable")
        new = np.ones(len(order), dtype=bool)
        new[1:] = whole[order][1:] != whole[order][:-1]
        if new.all():
            continue
        lead = some[order[np.flatnonzero(new)[np.cumsum(new) - 1]]]
        here = some[order]
        repeats = here[(doc[here] != doc[lead]) | (at[here] != at[lead])]
        least[repeats] = np.where(least[repeats] < 0, level, least[repeats])
        greatest[repeats] = level
    return least, greatest


def _intervals(suffixes: DataFrame, length: int) -> DataFrame:
    """``doc_id, row_hash, start, to``: bytes of strings that start earlier as well."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        given = table.filter(table.column("to").is_valid())
        table = table.filter(table.column("to").is_null())
        column = lambda name: table.column(name).to_numpy()
        ids = table.column("doc_id").fill_null(-(2**63)).to_numpy()
        order = np.lexsort((column("at"), column("row_hash"), ids))
        at, left = column("at")[order].astype(np.int64), column("left_bytes")[order].astype(np.int64)
        hashes, ids = column("row_hash")[order], ids[order]
        doc = np.concatenate(([0], np.cumsum((hashes[1:] != hashes[:-1]) | (ids[1:] != ids[:-1]))))[: len(order)]
        contexts = table.column("context").take(pa.array(order)).to_pylist()
        seed = column("seed")[order].view(np.uint64)
        least, greatest = expand(seed, doc, at, left, contexts, length)
        hit = np.flatnonzero(least >= 0)
        taken = pa.array(order[hit])
        found = pa.table(
            {
                "doc_id": table.column("doc_id").take(taken),
                "row_hash": table.column("row_hash").take(taken),
                "start": pa.array((at - greatest)[hit].astype(np.int32)),
                "to": pa.array((at - least + length)[hit].astype(np.int32)),
            }
        )
        return pa.concat_tables([found, given.select(["doc_id", "row_hash", "at", "to"]).rename_columns(found.column_names)])

    return suffixes.groupBy("bucket").applyInArrow(run, f"{_ROW}, start int, to int")


def repeats(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """Every row with the intervals of its repeated bytes: ``doc_id, row_hash, text, starts, ends``."""
    rows = _rows(docs, text)
    repeated = staged(_repeated(rows, length), "substring-seeds")
    suffixes, strings = _suffixes(rows, repeated, length)
    found = _intervals(suffixes, length)
    if strings is not None:
        found = found.unionByName(_of_strings(strings, length))
    lists = found.groupBy(F.col("doc_id").alias("key"), F.col("row_hash").alias("hash")).agg(
        F.sort_array(F.collect_set(F.struct("start", "to"))).alias("spans")
    )
    same = F.col("doc_id").eqNullSafe(F.col("key")) & (F.col("row_hash") == F.col("hash"))
    return rows.join(lists, same, "left").select(
        "doc_id", "row_hash", "text", F.col("spans.start").alias("starts"), F.col("spans.to").alias("ends")
    )


def _kept(data: bytes, starts: list[int] | None, ends: list[int] | None) -> tuple[bytes, int]:
    """Bytes outside the sorted intervals, and the number of maximal runs these make."""
    if not starts:
        return data, 0
    kept, done, runs = [], 0, 0
    reached = -1
    for start, end in zip(starts, ends, strict=True):
        if start > reached:
            runs += 1
            kept.append(data[done:start])
        reached = done = max(reached, end)
    kept.append(data[done:])
    return b"".join(kept), runs


def deduplicate(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` (the remaining bytes) per row.

    A null text is empty. Documents are in the order of their ids, null first, then of a hash of
    their texts; rows alike in both are one document given repeatedly and come out alike. Other
    columns are ignored, an empty table gives no rows.
    """
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, KEPT_ROWS):
                part = batch.slice(first, KEPT_ROWS)
                columns = [part.column(0).to_pylist(), *(part.column(i).to_pylist() for i in (2, 3, 4))]
                out = []
                for key, whole, starts, ends in zip(*columns, strict=True):
                    data = whole.encode()
                    kept, runs = _kept(data, starts, ends)
                    out.append((key, len(data), len(data) - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                arrays = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return repeats(docs, text, length).mapInArrow(run, schema)
