"""Helpers the text operators share: staging, row identity, and words of an Arrow batch in numpy."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terratally.sources.warehouse import shared_folder

#: Bytes of text that numpy works on at a time; a longer text makes a slice of its own. A worker
#: keeps what its largest slice took, some hundred bytes for each byte of text.
SLICE_BYTES = 1 << 18
#: Has Spark remove the shuffle files of a write when it ends, as only the folder is read later.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SEED = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D


def new_folder(spark: SparkSession, label: str) -> str:
    """A name below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def staged(frame: DataFrame, label: str, *more: DataFrame) -> DataFrame:
    """Write ``frame`` once into the shared folder and go on from the files.

    ``more`` frames of its columns are written after it, each when the shuffle files of the one
    before are gone.
    """
    path = _written([frame, *more], label)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def staged_apart(frames: list[DataFrame], label: str, flag: str) -> tuple[DataFrame, DataFrame]:
    """As ``staged``, the rows without and with ``flag`` as tables of their own, to discard by themselves."""
    path = _written(frames, label, flag)
    spark, schema = frames[0].sparkSession, frames[0].drop(flag).schema
    folders = [f"{path}/{flag}={value}" for value in ("false", "true")]
    for folder in folders:  # without such rows there is none
        place, system = _place(spark, folder)
        system.mkdirs(place)
    without, with_flag = (spark.read.schema(schema).parquet(folder) for folder in folders)
    return without, with_flag


def _written(frames: list[DataFrame], label: str, *by: str) -> str:
    spark = frames[0].sparkSession
    path = new_folder(spark, label)
    _made.add(path)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        for frame in frames:
            frame.write.mode("append").partitionBy(*by).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return path


def discard(*frames: DataFrame) -> None:
    """Remove the folders of staged ``frames`` that nothing is going to read again."""
    for frame in frames:
        _remove(frame.sparkSession, {file.rsplit("/", 1)[0] for file in frame.inputFiles()})


def _remove(spark: SparkSession, folders: set[str]) -> None:
    for folder in folders:
        place, system = _place(spark, folder)
        system.delete(place, True)


def _place(spark: SparkSession, folder: str):
    """The folder's path, and the file system it is in."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(context._jsc.hadoopConfiguration())


class Stages:
    """Owner of what the stages of a pipeline write on their way.

    A stage's own tables are superseded once its result has been written, that is, when the next
    stage starts on rows that are not read from them.
    """

    def __init__(self) -> None:
        self._left: set[str] = set()

    def run(self, stage, spark: SparkSession, docs: DataFrame, *more) -> DataFrame:
        if self._left:
            read = docs.inputFiles()
            done = {folder for folder in self._left if not any(folder in file for file in read)}
            _remove(spark, done)
            self._left -= done
        before = set(_made)
        try:
            return stage(spark, docs, *more)
        finally:
            self._left |= _made - before


#: Folders that ``staged`` has written in this process.
_made: set[str] = set()


def fresh(frame: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``frame`` has."""
    taken = {column.lower() for column in frame.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def id_and_text(rows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The two columns the operators read, as ``(key long, text string)``, null text as empty."""
    return rows.select(
        F.col(key).cast("long").alias(key), F.coalesce(F.col(text), F.lit("")).alias(text)
    )


def ascii_lower(text: Column) -> Column:
    """A-Z alone in lower case; ``lower`` would fold other letters as well."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also inside array functions."""
    return F.transform(F.array(value), body)[0]


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """True for the byte values in the closed ``ranges``."""
    table = np.zeros(256, dtype=bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


#: Bytes of words between the six ASCII white-space characters.
NOT_SPACE = ~byte_table((0x20, 0x20), (0x09, 0x0D))
#: Bytes of words of ASCII letters and digits, all other characters from U+0080 on included.
ALNUM = byte_table((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def mix(values: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (a bijection, so nothing collides here)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _SEED)
#: The same for bytes of text not yet in lower case.
LOWERED_VALUE = BYTE_VALUE[_LOWER]
_powers = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i below ``n``."""
    if len(_powers["up"]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for name, factor in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, factor, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


class Texts:
    """Some whole texts of a batch as one byte array; ``offsets[i]`` is where text i starts."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray):
        self.first, self.data, self.offsets = first, data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def lowered(self) -> Texts:
        return Texts(self.first, _LOWER[self.data], self.offsets)

    def runs(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text number of the longest runs of bytes that ``table`` accepts."""
        inside = table[self.data]
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        bounds = self.offsets[(self.offsets > 0) & (self.offsets < len(inside))]
        before[bounds] = False
        after = np.empty_like(inside)
        after[-1:] = False
        after[:-1] = inside[1:]
        after[bounds - 1] = False
        starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(inside & ~after) + 1
        return starts, ends, self.owner(starts)

    def owner(self, positions: np.ndarray) -> np.ndarray:
        """Text number of each of the ascending ``positions``."""
        return np.repeat(np.arange(len(self)), np.diff(np.searchsorted(positions, self.offsets)))

    def prefix_hashes(self, values: np.ndarray = BYTE_VALUE) -> np.ndarray:
        up, _ = powers(len(self.data) + 1)
        sums = np.empty(len(self.data) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(values[self.data] * up[:-1], out=sums[1:])
        return sums

    def hashes(self, starts: np.ndarray, ends: np.ndarray, sums=None) -> np.ndarray:
        """64-bit hash of each stretch of bytes, the same wherever the stretch stands."""
        sums = self.prefix_hashes() if sums is None else sums
        _, down = powers(len(self.data) + 1)
        raw = (sums[ends] - sums[starts]) * down[starts]
        return mix(raw ^ ((ends - starts).astype(np.uint64) * _SEED))


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """Whole texts of an Arrow column, about ``limit`` bytes at a time and without copying."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        return
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        part = offsets[first : last + 1]
        yield Texts(first, data[part[0] : part[-1]], part - part[0])
        first = last


def chain(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every ``length`` consecutive values."""
    n = max(0, len(hashes) - length + 1)
    total = hashes[:n].copy()
    for step in range(1, length):
        total = mix(total * np.uint64(3) + _SEED) + hashes[step : step + n]
    return mix(total)


def shingles(words: np.ndarray, owner: np.ndarray, count: int, size: int):
    """Hash and text number of each run of ``size`` words; a shorter text is one run whole."""
    per_text = np.bincount(owner, minlength=count)
    whole = chain(words, size)
    inside = owner[: len(whole)] == owner[size - 1 :][: len(whole)]
    values, owners = [whole[inside]], [owner[: len(whole)][inside]]
    ends = np.cumsum(per_text)
    for length in range(1, size):
        short = np.flatnonzero(per_text == length)
        if len(short):
            at = ends[short] - length
            values.append(_rows_chain(words[at[:, None] + np.arange(length)]))
            owners.append(short)
    return np.concatenate(values), np.concatenate(owners)


def _rows_chain(rows: np.ndarray) -> np.ndarray:
    total = rows[:, 0].copy()
    for step in range(1, rows.shape[1]):
        total = mix(total * np.uint64(3) + _SEED) + rows[:, step]
    return mix(total ^ np.uint64(rows.shape[1]))


def distinct_pairs(values: np.ndarray, owner: np.ndarray):
    """Distinct (owner, value) in that order, and how often each occurs; changes ``values``."""
    if len(owner) and np.any(owner[1:] < owner[:-1]):
        order = np.argsort(owner, kind="stable")
        values, owner = values[order], owner[order]
    bounds = np.flatnonzero(np.diff(owner, prepend=-1, append=-1))
    for first, last in zip(bounds[:-1], bounds[1:], strict=True):
        values[first:last].sort()
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return values[at], owner[at], np.diff(np.append(at, len(values)))


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def list_array(values: np.ndarray, counts: np.ndarray, kind=None) -> pa.ListArray:
    """One list per text from values that stand in text order."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))
