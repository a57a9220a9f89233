"""Best-fit packing of tokenised documents into sequences by bin completion.

Documents become pieces of at most ``capacity`` tokens. What has to be decided depends only on how
many pieces there are of each length, a table of at most ``capacity`` rows. Bin completion works
on that table: it takes the largest piece left, enumerates the undominated fillings of the room
beside it, and branches over them while the summed waste leaves a chance to save a bin; best-fit
packings are the incumbents. Pieces are then numbered within their length and looked up in the
fillings, which is a narrow join-free pass.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terratally.llm.common import id_and_text, staged

CAPACITY = 1024
END_OF_DOCUMENT = 2
#: Rows of one numbering group; their number grows with the input.
_GROUP_ROWS = 20_000
#: Nodes that one search for a filling may visit before the best one so far is taken.
_NODES = 4_000
#: Fillings of a bin that are enough to branch over before more wasteful ones are looked for.
_WIDTH = 16
#: Steps that the branch and bound over whole packings may take.
STEPS = 300_000
#: Wasted tokens per bin that end its search, one round each.
WASTE_BOUNDS = (0, 1, 2, 3, 4, 6, 8, 10, 12, 14, 16, 20, 24, 32, 48, 64)
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@cache
def _tokenizers(folder: str):
    """The byte-level BPE twice: merge ranks for Latin text, which is quick, and the full file.

    Both hold one vocabulary. The splitting patterns differ at most in the Unicode version of
    their letter tables, so text with other scripts goes through the file itself.
    """
    import tiktoken
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(f"{folder}/byte_bpe_50k.json")
    full.encode_special_tokens = True
    with open(f"{folder}/byte_bpe_50k.tiktoken", "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    pattern = (
        r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    )
    quick = tiktoken.Encoding("latin", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return full, quick


def default_vocabulary() -> str:
    """Folder of the vocabulary files."""
    import os

    import public_tokenizers

    return os.path.dirname(public_tokenizers.path("byte_bpe_50k.json"))


def token_ids(text: str, folder: str) -> np.ndarray:
    full, quick = _tokenizers(folder)
    latin = text.isascii() or max(text) < "ɐ"
    ids = quick.encode_ordinary(text) if latin else full.encode(text, add_special_tokens=False).ids
    return np.asarray([*ids, END_OF_DOCUMENT], dtype="<u4")


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """Pieces of every document: whole if it fits, else cut, the first piece taking the rest.

    A null text is empty and gives the closing token alone. Rows with equal or null ``doc_id`` are
    documents of their own; other columns are ignored.
    """
    folder = vocabulary or default_vocabulary()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_pylist()
            out: list[tuple] = []
            for row, key in enumerate(keys):
                ids = token_ids(batch.column(1)[row].as_py(), folder)
                first = len(ids) % capacity or capacity
                bounds = [0, *range(first, len(ids) + 1, capacity)]
                for number, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    out.append((key, number, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = list(zip(*out, strict=True)) or [()] * 5
            names = [c.split()[0] for c in _PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)], names
            )

    return id_and_text(docs).mapInArrow(cut, _PIECES)


@dataclass(frozen=True)
class Filling:
    """``times`` bins of equal content: lengths in order, the largest first."""

    lengths: tuple[int, ...]
    times: int


def complete_bins(
    counts: dict[int, int], capacity: int = CAPACITY, most_steps: int = STEPS
) -> list[Filling]:
    """Fillings for all pieces, in as few bins as the search finds.

    Incumbents come from best-fit decreasing and from rounds that fill one bin after the other,
    each with another bound on the waste that ends a bin's search: fillings without any waste use
    up small pieces that a later bin may need more. While more bins than the lower bound are used,
    ``_branch`` looks for one bin fewer; what it finds is the next incumbent. It may take
    ``most_steps`` steps in all; where it ends within them without a find, the incumbent is the optimum.
    """
    least = _least_bins(counts, capacity)
    best, bins = [], float("inf")
    for bound in (capacity, *WASTE_BOUNDS):
        fillings = _fill(counts, capacity, bound)
        used = sum(filling.times for filling in fillings)
        if used < bins:
            best, bins = fillings, used
        if bins <= least:
            return best
    steps = _Steps(most_steps)
    while bins > least:
        found = _branch(counts, capacity, bins - 1, steps)
        if found is None:
            break
        best, bins = found, sum(filling.times for filling in found)
    return best


def _least_bins(counts: dict[int, int], capacity: int) -> int:
    """Bins that any packing needs.

    For every small length: larger pieces than half a bin need one each, and what is at least that
    small length must go into the room they leave, or into more bins.
    """
    lengths = sorted(x for x, n in counts.items() if n > 0)
    least = -(-sum(x * counts[x] for x in lengths) // capacity)
    big = [x for x in lengths if 2 * x > capacity]
    for small in (x for x in lengths if 2 * x <= capacity):
        beside = [x for x in big if x <= capacity - small]
        room = sum((capacity - x) * counts[x] for x in beside)
        between = sum(x * counts[x] for x in lengths if small <= x and 2 * x <= capacity)
        least = max(least, sum(counts[x] for x in big) + max(0, -(-(between - room) // capacity)))
    return max(least, sum(counts[x] for x in big))


class _Steps:
    """Steps that a search may still take."""

    def __init__(self, left: int):
        self.left = left


def _branch(counts: dict[int, int], capacity: int, bins: int, steps: _Steps) -> list[Filling] | None:
    """A packing into ``bins`` bins by depth-first bin completion, or None.

    A node completes a bin around the largest piece left. Its branches are the undominated fillings
    of the room beside it whose waste, added to that of the bins before, fits what ``bins`` bins can
    waste at all; the least waste comes first. A branch uses a filling for as many bins as the
    counts allow, and later for one bin only, so every packing is reached.
    """
    spare = bins * capacity - sum(x * n for x, n in counts.items())
    if spare < 0:
        return None
    path: list[Filling] = []
    seen: dict[tuple, int] = {}  # most waste left with which these pieces failed

    def branches(left: dict[int, int], waste: int) -> Iterator[tuple[Filling, int]]:
        largest = max(left)
        rest = dict(left)
        rest[largest] -= 1
        found = [
            (room, (largest, *beside))
            for room, beside in _fillings(rest, capacity - largest, min(waste, capacity), steps)
        ]
        most = [min(left[x] // y.count(x) for x in set(y)) for _, y in found]
        for (room, lengths), times in zip(found, most, strict=True):
            yield Filling(lengths, times), room * times
        for (room, lengths), times in zip(found, most, strict=True):
            if times > 1:
                yield Filling(lengths, 1), room

    left = {x: n for x, n in counts.items() if n > 0}
    todo = [(left, spare, branches(left, spare))] if left else []
    while todo:
        left, waste, more = todo[-1]
        taken = next(((f, w) for f, w in more if w <= waste), None) if steps.left > 0 else None
        if taken is None:
            if steps.left <= 0:
                return None
            seen[tuple(sorted(left.items()))] = waste
            todo.pop()
            if path:
                path.pop()
            continue
        filling, used = taken
        after = dict(left)
        for x in set(filling.lengths):
            after[x] -= filling.times * filling.lengths.count(x)
            if not after[x]:
                del after[x]
        path.append(filling)
        if not after:
            return path
        if seen.get(tuple(sorted(after.items())), -1) >= waste - used:
            path.pop()
            continue
        todo.append((after, waste - used, branches(after, waste - used)))
    return None


def _fillings(
    left: dict[int, int], room: int, most: int, steps: _Steps
) -> list[tuple[int, tuple[int, ...]]]:
    """``(waste, lengths)`` of the undominated fillings of ``room`` that waste at most ``most``.

    Least waste first, then large pieces. They are looked for with growing bounds on the waste, so
    that among very many the full ones are found first.
    """
    sizes = sorted((x for x, n in left.items() if n > 0 and x <= room), reverse=True)
    beyond = [0] * (len(sizes) + 1)
    for i in range(len(sizes) - 1, -1, -1):
        beyond[i] = beyond[i + 1] + sizes[i] * min(left[sizes[i]], room // sizes[i])
    for bound in sorted({min(most, b) for b in (0, 8, 64, room)}):
        out = []
        stack: list[tuple[int, int, tuple[int, ...]]] = [(0, room, ())]
        visited = 0
        while stack and visited < _NODES and steps.left > 0:
            at, free, taken = stack.pop()
            visited += 1
            steps.left -= 1
            while at < len(sizes) and sizes[at] > free:
                at += 1
            if free - beyond[at] > bound:
                continue
            if at == len(sizes):
                if not _dominated(taken, free, left, sizes):
                    out.append((free, taken))
                continue
            length = sizes[at]
            fitting = min(left[length], free // length)
            stack.extend((at + 1, free - k * length, taken + (length,) * k) for k in range(fitting + 1))
        if len(out) >= _WIDTH or visited >= _NODES:
            break
    return sorted(out, key=lambda f: (f[0], tuple(-x for x in f[1])))


def _dominated(taken: tuple[int, ...], waste: int, left: dict[int, int], sizes: list[int]) -> bool:
    """Whether a larger piece left fits in place of one or two taken, which are easier to place later."""
    for x in sizes:
        if taken.count(x) >= left[x]:
            continue
        for i, y in enumerate(taken):
            if y < x <= y + waste:
                return True
            if any(y + z <= x <= y + z + waste for z in taken[i + 1 :]):
                return True
    return False


def _fill(counts: dict[int, int], capacity: int, bound: int) -> list[Filling]:
    left = {length: n for length, n in counts.items() if n > 0}
    out = []
    while left:
        largest = max(left)
        rest = dict(left)
        rest[largest] -= 1
        beside = _search(rest, capacity - largest, bound)
        lengths = (largest, *beside)
        times = min(left[x] // lengths.count(x) for x in set(lengths))
        for x in lengths:
            left[x] -= times
        for x in set(lengths):
            if not left[x]:
                del left[x]
        out.append(Filling(lengths, times))
    return out


def _best_fit(left: dict[int, int], room: int) -> tuple[int, ...]:
    """Largest piece that fits, again and again."""
    out = []
    for length in sorted(left, reverse=True):
        while length <= room and left[length] > out.count(length):
            out.append(length)
            room -= length
    return tuple(out)


def _search(left: dict[int, int], room: int, bound: int) -> tuple[int, ...]:
    """A filling of ``room`` that wastes at most ``bound``, or else the least, by branch and bound.

    Best fit is the first incumbent. Lengths are tried from large to small, so of equally full
    fillings the first has the largest pieces: it dominates those with several smaller ones in
    their place, as small pieces are easier to place later. A branch ends where even all pieces
    left cannot beat the incumbent.
    """
    best = _best_fit(left, room)
    waste = room - sum(best)
    if waste <= bound:
        return best
    sizes = sorted((x for x, n in left.items() if n > 0 and x <= room), reverse=True)
    beyond = [0] * (len(sizes) + 1)
    for i in range(len(sizes) - 1, -1, -1):
        beyond[i] = beyond[i + 1] + sizes[i] * min(left[sizes[i]], room // sizes[i])
    visited = 0
    stack: list[tuple[int, int, tuple[int, ...]]] = [(0, room, ())]
    while stack and waste > bound and visited < _NODES:
        at, free, taken = stack.pop()
        visited += 1
        if free < waste:
            best, waste = taken, free
        while at < len(sizes) and sizes[at] > free:
            at += 1
        if at == len(sizes) or free - beyond[at] >= waste:
            continue
        length = sizes[at]
        most = min(left[length], free // length)
        stack.extend((at + 1, free - k * length, taken + (length,) * k) for k in range(most + 1))
    return best


def _ranked(parts: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """Number pieces within their length from 0, in groups of bounded size, and count lengths.

    The rows of a length are dealt into buckets by hash, as many as the input needs; a bucket
    starts where those before it end.
    """
    buckets = max(1, parts.count() // _GROUP_ROWS)
    dealt = parts.withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets))
    )
    sizes = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = staged(
        sizes.withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0))), "packing-buckets"
    )
    totals = starts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # one row per length
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    numbered = dealt.withColumn("place", F.row_number().over(within) - 1)
    ranked = numbered.join(starts.drop("n"), ["length", "bucket"]).withColumn(
        "rank", F.col("ahead") + F.col("place")
    )
    return ranked.drop("bucket", "ahead", "place"), {r["length"]: r["n"] for r in totals}


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """Every piece with its sequence and its place there.

    Columns of ``pieces`` and ``sequence_id long, offset long``; sequences are numbered from 0 and
    hold their pieces without gaps. No documents, no rows.
    """
    parts = staged(pieces(docs, capacity, vocabulary), "packing-pieces")
    ranked, counts = _ranked(parts)
    table = _segments(complete_bins(counts, capacity))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
            length, rank = get("length"), get("rank")
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for size in np.unique(length):
                mine = np.flatnonzero(length == size)
                first, base, at = table[int(size)]
                k = np.searchsorted(first, rank[mine], "right") - 1
                sequence[mine] = base[k] + rank[mine] - first[k]
                offset[mine] = at[k]
            kept = [batch.column(n) for n in names[:5]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names)

    return ranked.mapInArrow(place, f"{_PIECES}, sequence_id long, offset long")


def _segments(fillings: list[Filling]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: first rank of each stretch, its first sequence, and the offset in the sequence.

    A filling uses ``times`` pieces for each of its slots; the table has one row per slot of a
    filling, so its size is bound by the lengths, not by the pieces.
    """
    used: dict[int, int] = {}
    rows: dict[int, list[tuple[int, int, int]]] = {}
    base = 0
    for filling in fillings:
        offset = 0
        for length in filling.lengths:
            rows.setdefault(length, []).append((used.get(length, 0), base, offset))
            used[length] = used.get(length, 0) + filling.times
            offset += length
        base += filling.times
    return {n: tuple(np.array(c, np.int64) for c in zip(*r, strict=True)) for n, r in rows.items()}
