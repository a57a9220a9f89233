"""Hard negatives by exact inner products, scored with Four-Russians tables.

Components are whole numbers, ``floor(256 * x)``. A candidate is kept as bit planes in two's
complement: for every eight dimensions and every plane one byte holds a bit of each. For an
anchor and eight dimensions a table of 256 entries holds the sum of every subset of its
components; the bytes of a plane index these tables, and doubling the running sum between
planes gives the full inner product. Nothing is estimated.

Anchors and candidates meet in the cells of a grid: candidates are dealt to stripes, anchors to
bands, and each cell gets one stripe and one band, both of bounded size. A cell hands on only
its best rows per anchor.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terratally.llm.common import staged

#: Every so many ids an anchor.
ANCHOR_STEP = 100
POSITIVES = 5
NEGATIVES = 10
#: A negative has between these hundredths of its positive's score.
LOW, HIGH = 30, 90
#: Candidates that are packed together, and packed blocks and anchors of a cell, on average.
BLOCK = 4096
BLOCKS_A_STRIPE = 4
ANCHORS_A_BAND = 2048
#: Candidates and anchors scored in one go, so that sums and tables stay in the cache.
_ROWS, _ANCHORS = 1024, 64

_BLOCKS = "first_id long, n int, planes int, groups int, ids binary, labels binary, bits binary"
_POSITIVE = "anchor_row long, anchor_id long, positive_id long, positive_score long"
_NEGATIVE = f"{_POSITIVE}, place int, negative_id long, negative_score long"


def mine(embeddings: DataFrame, anchor_step: int = ANCHOR_STEP) -> DataFrame:
    """The first negatives of every anchor and positive.

    ``embeddings`` has vec_id, embedding and label; other columns are ignored, whatever their
    names. Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows without an id, label or vector, or with a null or non-finite component, take no part. An
    empty vector scores 0 with all; a shorter vector counts as filled up with zeros. Every row
    counts, also one that repeats another; rows with the anchor's own id are not among its
    positives or negatives, and anchors that agree in id, label and vector are asked once. An
    empty table gives no rows. Vectors whose scores could leave 64 bits are an error.
    """
    rows = participants(embeddings)
    candidates = staged(rows.mapInArrow(_packed, _BLOCKS), "candidate-blocks")
    anchors = staged(_anchors(rows, anchor_step), "anchors")
    grid = _Grid(candidates, anchors)
    best = _first(grid.cells(anchors, _positives_of, _POSITIVE), ["anchor_row"], "positive", POSITIVES)
    positives = staged(best.withColumnRenamed("rank", "place"), "positives")
    asked = anchors.join(_windows(positives), "anchor_row")
    found = grid.cells(asked, _negatives_of, _NEGATIVE)
    ranked = _first(found, ["anchor_row", "place"], "negative", NEGATIVES)
    return ranked.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def participants(embeddings: DataFrame) -> DataFrame:
    """vec_id, label after the shift of every seventh id, and the whole-number vector."""
    vector = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("long"))
    odd = F.exists(
        "embedding",
        lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == math.inf),
    )
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10)
    known = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    return embeddings.where(known & ~odd).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        shifted.otherwise(F.col("label").cast("long")).alias("label"),
        vector.alias("vector"),
    )


def _anchors(rows: DataFrame, step: int) -> DataFrame:
    asked = rows.where(F.col("vec_id") % step == 0).distinct()
    row = F.xxhash64("vec_id", "label", "vector").alias("anchor_row")
    return asked.select(row, F.col("vec_id").alias("anchor_id"), F.col("label").alias("anchor_label"), "vector")


def _windows(positives: DataFrame) -> DataFrame:
    """All positives of an anchor in one row."""
    listed = F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score")))
    return positives.groupBy("anchor_row").agg(listed.alias("positives"))


def _first(found: DataFrame, key: list[str], kind: str, count: int) -> DataFrame:
    order = Window.partitionBy(*key).orderBy(F.desc(f"{kind}_score"), f"{kind}_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


class _Grid:
    """Cells of a stripe of candidates and a band of anchors."""

    def __init__(self, candidates: DataFrame, anchors: DataFrame):
        spark = candidates.sparkSession
        self.stripes = max(1, math.ceil(candidates.count() / BLOCKS_A_STRIPE))
        self.bands = max(1, math.ceil(anchors.count() / ANCHORS_A_BAND))
        self.tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        stripe = F.pmod(F.xxhash64("first_id", "n"), F.lit(self.stripes)).cast("int")
        bands = F.sequence(F.lit(0), F.lit(self.bands - 1))
        self.candidates = candidates.select(
            stripe.alias("stripe"), F.explode(bands).alias("band"), *candidates.columns
        ).repartition(self.tasks, "stripe", "band")

    def cells(self, anchors: DataFrame, best, layout: str) -> DataFrame:
        """``best`` of every cell; a numbered repartition keeps small cells on many tasks."""
        band = F.pmod(F.col("anchor_row"), F.lit(self.bands)).cast("int")
        stripes = F.sequence(F.lit(0), F.lit(self.stripes - 1))
        dealt = anchors.select(
            band.alias("band"), F.explode(stripes).alias("stripe"), *anchors.columns
        ).repartition(self.tasks, "stripe", "band")

        def cell(blocks: pa.Table, asked: pa.Table) -> pa.Table:
            return best(blocks, asked)

        pairs = self.candidates.groupBy("stripe", "band").cogroup(dealt.groupBy("stripe", "band"))
        return pairs.applyInArrow(cell, layout)


# --- in tasks ---------------------------------------------------------------------


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of candidates, by label inside, as bit planes."""
    for batch in batches:
        for start in range(0, len(batch), BLOCK):
            part = batch.slice(start, BLOCK)
            ids, labels = part["vec_id"].to_numpy(), part["label"].to_numpy()
            order = np.lexsort((ids, labels))
            bits, planes, groups = bit_planes(_matrix(part["vector"])[order])
            row = [int(ids[0]), len(ids), planes, groups, ids[order].tobytes(), labels[order].tobytes(), bits.tobytes()]
            yield pa.record_batch(
                [pa.array([value]) if i not in (1, 2, 3) else pa.array([value], pa.int32()) for i, value in enumerate(row)],
                names=["first_id", "n", "planes", "groups", "ids", "labels", "bits"],
            )


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of whole numbers, short ones filled up with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = vectors.value_lengths().to_numpy()
    width = -(-int(sizes.max(initial=0)) // 8) * 8
    out = np.zeros((len(vectors), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = vectors.flatten().to_numpy()
    return out


def bit_planes(matrix: np.ndarray) -> tuple[np.ndarray, int, int]:
    """Bytes as [plane, group of eight dimensions, row], lowest plane first, the last the sign."""
    n, width = matrix.shape
    top = int(np.where(matrix < 0, ~matrix, matrix).max(initial=0))
    planes, groups = top.bit_length() + 1, width // 8
    bits = np.empty((planes, groups, n), dtype=np.uint8)
    for plane in range(planes):
        bit = ((matrix >> plane) & 1).astype(np.uint8).reshape(n, groups, 8)
        bits[plane] = np.packbits(bit, axis=2, bitorder="little")[:, :, 0].T
    return bits, planes, groups


def subset_sums(anchors: np.ndarray, kind=np.int64) -> np.ndarray:
    """Sum of every subset of eight components, as [group, subset, anchor]."""
    n, width = anchors.shape
    grouped = anchors.reshape(n, width // 8, 8).astype(kind).transpose(1, 2, 0)
    tables = np.zeros((width // 8, 256, n), dtype=kind)
    for bit in range(8):
        tables[:, 1 << bit : 2 << bit] = tables[:, : 1 << bit] + grouped[:, bit, None]
    return tables


def scores(tables: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Inner products as [row, anchor] by look-up and doubling, highest plane first."""
    planes, groups, n = bits.shape
    groups = min(groups, len(tables))
    total = np.zeros((n, tables.shape[2]), dtype=tables.dtype)
    found = np.empty_like(total)
    for plane in range(planes - 1, -1, -1):
        if plane < planes - 1:
            total += total
        for group in range(groups):
            np.take(tables[group], bits[plane, group], axis=0, out=found, mode="clip")
            if plane == planes - 1:
                total -= found
            else:
                total += found
    return total


class _Block:
    def __init__(self, row: dict):
        n = row["n"]
        self.ids = np.frombuffer(row["ids"], dtype=np.int64)
        self.labels = np.frombuffer(row["labels"], dtype=np.int64)
        shape = (row["planes"], row["groups"], n)
        self.bits = np.frombuffer(row["bits"], dtype=np.uint8).reshape(shape)

    def of_label(self, label: int) -> slice:
        return slice(*np.searchsorted(self.labels, (label, label + 1)))


def _scored(blocks: pa.Table, asked: pa.Table, same: bool):
    """(asked row, candidate ids, scores) of each anchor and block, by the anchor's label."""
    if not len(blocks) or not len(asked):
        return
    labels = asked["anchor_label"].to_numpy()
    order = np.argsort(labels, kind="stable")
    matrix = _matrix(asked["vector"])
    for i in range(len(blocks)):
        block = _Block(blocks.slice(i, 1).to_pylist()[0])
        kind = _sum_type(matrix, block.bits.shape)
        for run in np.split(order, np.flatnonzero(np.diff(labels[order])) + 1):
            own = block.of_label(labels[run[0]])
            picked = [own] if same else [slice(0, own.start), slice(own.stop, None)]
            ids = np.concatenate([block.ids[s] for s in picked])
            bits = np.concatenate([block.bits[:, :, s] for s in picked], axis=2)
            for first in range(0, len(run) if len(ids) else 0, _ANCHORS):
                part = run[first : first + _ANCHORS]
                tables = subset_sums(matrix[part], kind)
                whole = np.empty((len(part), len(ids)), dtype=kind)
                for start in range(0, len(ids), _ROWS):
                    stop = start + _ROWS
                    whole[:, start:stop] = scores(tables, np.ascontiguousarray(bits[:, :, start:stop])).T
                for row, line in zip(part, whole, strict=True):
                    yield row, ids, line


def _sum_type(matrix: np.ndarray, shape: tuple[int, int, int]):
    planes, groups, _ = shape
    width = 8 * min(groups, matrix.shape[1] // 8)
    # While sums double, they stay below the largest product of all components.
    bound = width * max(1, int(np.abs(matrix).max(initial=0))) << planes
    if bound >= 1 << 63:
        raise ValueError("components are too large for scores of 64 bits")
    return np.int32 if bound < 1 << 31 else np.int64


def _best(ids: np.ndarray, line: np.ndarray, count: int) -> np.ndarray:
    """Where the first ``count`` by falling score and rising id stand."""
    at = np.arange(len(ids))
    if len(ids) > count:
        least = np.partition(line, len(line) - count)[len(line) - count]
        at = np.flatnonzero(line >= least)
    return at[np.lexsort((ids[at], -line[at].astype(np.int64)))][:count]


def _merged(parts: dict, key, ids: np.ndarray, line: np.ndarray, count: int) -> None:
    at = _best(ids, line, count)
    ids, line = ids[at], line[at].astype(np.int64)
    if key in parts:
        ids, line = np.concatenate([parts[key][0], ids]), np.concatenate([parts[key][1], line])
        at = _best(ids, line, count)
        ids, line = ids[at], line[at]
    parts[key] = ids, line


def _positives_of(blocks: pa.Table, asked: pa.Table) -> pa.Table:
    """The first rows of the same label in this cell, per anchor."""
    rows, keys = asked["anchor_row"].to_numpy(), asked["anchor_id"].to_numpy()
    parts: dict[int, tuple] = {}
    for anchor, ids, line in _scored(blocks, asked, same=True):
        other = ids != keys[anchor]
        _merged(parts, anchor, ids[other], line[other], POSITIVES)
    sizes = [len(ids) for ids, _ in parts.values()]
    anchors = np.repeat(np.fromiter(parts, dtype=np.int64, count=len(parts)), sizes)
    return pa.table(
        {
            "anchor_row": rows[anchors],
            "anchor_id": keys[anchors],
            "positive_id": _joined([p[0] for p in parts.values()]),
            "positive_score": _joined([p[1] for p in parts.values()]),
        }
    )


def _negatives_of(blocks: pa.Table, asked: pa.Table) -> pa.Table:
    """The first rows of other labels inside the window of each positive, in this cell."""
    rows, keys = asked["anchor_row"].to_numpy(), asked["anchor_id"].to_numpy()
    windows = asked["positives"].to_pylist() if len(asked) else []
    parts: dict[tuple, tuple] = {}
    for anchor, ids, line in _scored(blocks, asked, same=False):
        other = ids != keys[anchor]
        if not other.all():
            ids, line = ids[other], line[other]
        for at, positive in enumerate(windows[anchor]):
            score = positive["positive_score"]
            # 30 p <= 100 s <= 90 p, in whole numbers.
            inside = np.flatnonzero((line >= -(-LOW * score // 100)) & (line <= HIGH * score // 100))
            if len(inside):
                _merged(parts, (anchor, at), ids[inside], line[inside], NEGATIVES)
    sizes = [len(ids) for ids, _ in parts.values()]
    anchors = np.repeat(np.array([a for a, _ in parts], dtype=np.int64), sizes)
    asked_for = [windows[a][at] for a, at in parts]

    def of_positive(name: str, kind) -> np.ndarray:
        return np.repeat(np.array([p[name] for p in asked_for], dtype=kind), sizes)

    return pa.table(
        {
            "anchor_row": rows[anchors],
            "anchor_id": keys[anchors],
            "positive_id": of_positive("positive_id", np.int64),
            "positive_score": of_positive("positive_score", np.int64),
            "place": of_positive("place", np.int32),
            "negative_id": _joined([p[0] for p in parts.values()]),
            "negative_score": _joined([p[1] for p in parts.values()]),
        }
    )


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


MINING_SQL = f"""
WITH whole AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
        CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
    FROM whole a JOIN whole b ON a.vec_id % {ANCHOR_STEP} = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score
    FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES}
)
SELECT p.anchor_id, p.positive_id,
    CAST(row_number() OVER (
        PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
    s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
    AND {LOW} * p.positive_score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.positive_score
QUALIFY rank <= {NEGATIVES}
"""
