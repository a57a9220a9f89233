"""N-gram Jaccard join: near-duplicate documents by pivots, Voronoi regions and windows.

The distance is 1 - |x & y| / |x | y| over distinct word shingles, a metric. Documents within
``RADIUS`` of each other are linked, and the result is the exact connected components.

1. A document's shingles in the order of their hashes form a ring, and a partner has most of the
   ring's neighbours as neighbours too: a shingle it lacks parts two of them, one it has besides at
   most one. A document with more neighbours that no other document has has no partner; counting
   neighbours finds these. Other than single shingles, which all become common as a corpus grows,
   neighbours are shared by copies and hardly anything else.
2. Equal shingle sets become one node.
3. The two shingles of each pair of neighbours are a pivot of their own: a node is nearer to its
   pairs than to all others. A node goes to the regions of its rarest pairs, one more than a
   partner may lack, so two linked nodes meet in one region at least, and unlike ones that have some
   shingles in common hardly ever do. Copies share most of their pairs, so many regions have the
   same members; one of each goes on.
4. The most central member of a region is a document pivot, and a node is in the Voronoi cell of the
   pivot that most of its regions have. Members of larger cells meet their pivot, and the links
   found join most of what there is.
5. Links are then missing only between components that have a region in common. A node outside a
   region's largest component is in the windows of all cells that have members of other components
   in the region, and is held against all of these cells. That happens in blocks of bounded size:
   numpy counts what two blocks have in common, so pairs of documents are no rows of a join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terratally.llm.common import (
    NOT_SPACE,
    Texts,
    discard,
    distinct_pairs,
    fresh,
    list_array,
    mix,
    shingles,
    signed,
    slices,
    staged,
)
from terratally.llm.components import components

SHINGLE = 5
#: Linked from this similarity on, in percent.
PERCENT = 75
#: Share of all pairs of neighbours, by hash, that are counted; above the share that may be lost.
COUNTED_SHARE = 0.65
#: Bits that neighbours are told apart by; those taken for one another keep documents, drop none.
PAIR_BITS = 48
#: Nodes whose pivots a task makes at a time.
PIVOT_NODES = 500
#: Size up to which a cell's members do not meet their pivot first.
LEAF = 8
#: Shingles in a block of sets that a task holds against another block, as expected, and how many
#: a set counts as besides its own.
BLOCK = 1 << 16
NODE_LOAD = 64
#: Shingles in common, and pairs of sets, that are counted at a time.
STEP = 1 << 20


def missing_allowed(n: Column, percent: int = PERCENT) -> Column:
    """How many of ``n`` shingles a linked partner may lack: n - ceil(n * percent / 100)."""
    return F.floor(n * (100 - percent) / 100)


def neighbours_lost(n, percent: int = PERCENT):
    """How many of ``n`` pairs of neighbours a linked partner may lack.

    With a shingles missing and b more, 100 * (n - a) >= percent * (n + b), and 2 * a + b pairs go.
    """
    return np.maximum(n * (2 * (100 - percent)) // 100, n * (100 - percent) // percent)


def _sets(texts: Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes and the texts they are of, in text order, ascending in each."""
    lowered = texts.lowered()
    starts, ends, owner = lowered.runs(NOT_SPACE)
    values, owners = shingles(lowered.hashes(starts, ends), owner, len(texts), size)
    values, owners, _ = distinct_pairs(values, owners)
    return values, owners


def _neighbours(values: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """A hash of each shingle and the next of its text, the first being next to the last."""
    following = np.roll(values, -1)
    firsts = np.flatnonzero(np.diff(owners, prepend=-1))
    lasts = np.append(firsts[1:], len(values)) - 1
    if len(values):
        following[lasts] = values[firsts]
    return mix(mix(values * np.uint64(3)) + following)


def _rows(docs: DataFrame, text: str) -> DataFrame:
    """Rows by id and hash of the text; rows alike in both are repeats of one another."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("row_hash"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )


def _unshared(rows: DataFrame, size: int) -> DataFrame:
    """``doc_id, row_hash, unshared``: neighbours of one document alone, in the counted share."""
    bound = np.uint64(int(COUNTED_SHARE * 2**64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column(2)):
                values, owners = _sets(texts, size)
                pairs = _neighbours(values, owners)
                kept = pairs < bound
                row = pa.array(owners[kept] + texts.first)
                pair = mix(pairs[kept]) >> np.uint64(64 - PAIR_BITS)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(row), batch.column(1).take(row), pa.array(signed(pair))],
                    ["doc_id", "row_hash", "pair"],
                )

    found = rows.mapInArrow(run, "doc_id long, row_hash long, pair long")
    alone = found.groupBy("pair").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("doc_id"), F.min("row_hash").alias("row_hash")
    )
    return alone.where("n = 1").groupBy("doc_id", "row_hash").agg(F.count("*").alias("unshared"))


def _described(docs: DataFrame, text: str, size: int, percent: int) -> DataFrame:
    """``doc_id, row_hash, n, print1, print2, shingles``; no shingles where no partner is possible."""
    rows = _rows(docs, text)
    # A table of its own: the shuffle of all neighbours is gone before the texts are joined.
    unshared = staged(_unshared(rows, size), "jaccard-unshared").toDF("key", "hash", "unshared")
    same = F.col("doc_id").eqNullSafe(F.col("key")) & (F.col("row_hash") == F.col("hash"))
    joined = rows.join(unshared, same, "left").select(
        "doc_id", "row_hash", "text", F.coalesce("unshared", F.lit(0)).alias("unshared")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alone = batch.column(3).to_numpy(zero_copy_only=False)
            for texts in slices(batch.column(2)):
                values, owners = _sets(texts, size)
                n = np.bincount(owners, minlength=len(texts))
                mine = alone[texts.first : texts.first + len(texts)]
                open_ = (n > 0) & (mine <= neighbours_lost(n, percent))
                sums = np.concatenate(([np.uint64(0)], np.cumsum(mix(values))))
                other = np.concatenate(([np.uint64(0)], np.cumsum(mix(~values))))
                ends = np.cumsum(n)
                kept = open_[owners]
                part = batch.slice(texts.first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(n.astype(np.int64)),
                        pa.array(signed(sums[ends] - sums[ends - n])),
                        pa.array(signed(other[ends] - other[ends - n])),
                        list_array(signed(values[kept]), np.where(open_, n, 0)),
                    ],
                    ["doc_id", "row_hash", "n", "print1", "print2", "shingles"],
                )

    schema = "doc_id long, row_hash long, n long, print1 long, print2 long, shingles array<long>"
    return joined.mapInArrow(run, schema)


def _pivots(nodes: DataFrame, percent: int) -> tuple[DataFrame, Column]:
    """``node, n, region`` for each of a node's n pivots, and how many a linked partner may lack."""
    n = F.col("n")
    if percent <= 50:  # a partner may lack all pairs of neighbours, but not all shingles
        return nodes.select("node", "n", F.explode("shingles").alias("region")), missing_allowed(n, percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, PIVOT_NODES):
                batch = whole.slice(first, PIVOT_NODES)
                counts = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
                values = batch.column(2).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                owners = np.repeat(np.arange(len(counts)), counts)
                taken = pa.array(owners)
                pivots = pa.array(signed(_neighbours(values, owners)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(taken), batch.column(1).take(taken), pivots], ["node", "n", "region"]
                )

    pairs = nodes.select("node", "n", "shingles").mapInArrow(run, "node long, n long, region long")
    lost = F.greatest(F.floor(n * (2 * (100 - percent)) / 100), F.floor(n * (100 - percent) / percent))
    return pairs, lost


def _first_regions(nodes: DataFrame, percent: int) -> DataFrame:
    """``region, node, n, weight``: the regions of each node's rarest shared pivots.

    Pivots are ordered by frequency, then hash. A node's unshared ones come first; with those
    and the shared ones up to one more than a partner may lack, a partner has one of them as well.
    Regions of the same members, told by two hashes of these, would be divided alike and give the
    same links, so one stands for all. ``weight``, the number of a node's regions with those that
    are stood for, is largest for the most central of near copies.
    """
    pairs, lost = _pivots(nodes, percent)
    shared = pairs.groupBy("region").agg(F.count("*").alias("frequency")).where("frequency > 1")
    found = pairs.join(shared, "region")
    by_node = Window.partitionBy("node")
    ranked = found.select(
        "region",
        "node",
        "n",
        (lost + 1 - (F.col("n") - F.count("*").over(by_node))).alias("most"),
        F.row_number().over(by_node.orderBy("frequency", "region")).alias("place"),
    )
    placed = ranked.where("place <= most")
    members = [F.count("*").alias("members")] + [
        F.bit_xor(F.xxhash64("node", F.lit(salt))).alias(f"print{salt}") for salt in (1, 2)
    ]
    regions = placed.groupBy("region").agg(*members).where("members > 1")
    once = regions.groupBy("members", "print1", "print2").agg(
        F.min("region").alias("region"), F.count("*").alias("alike")
    )
    return placed.join(once.select("region", "alike"), "region").select(
        "region", "node", "n", F.sum("alike").over(by_node).alias("weight")
    )


def _cells(regions: DataFrame) -> DataFrame:
    """``node, n, cell, members``: each node's nearest pivot, and how many nodes have the same.

    Every region has its most central member as pivot; the nearest is that of most of a node's regions.
    """
    order = F.struct("weight", F.xxhash64("node", F.lit(1)).alias("order"), "node")
    pivots = regions.groupBy("region").agg(F.max(order).alias("pivot"))
    shared = regions.join(pivots, "region").groupBy("node", "n", "pivot").agg(F.count("*").alias("shared"))
    nearest = shared.groupBy("node", "n").agg(F.max(F.struct("shared", "pivot"))["pivot"]["node"].alias("cell"))
    sizes = nearest.groupBy("cell").agg(F.count("*").alias("members"))
    return nearest.join(sizes, "cell").select("node", "n", "cell", "members")


def _windows(regions: DataFrame, cells: DataFrame) -> DataFrame:
    """``node, n, root, cell``: nodes and the cells that may hold partners of another component.

    ``cells`` has ``node, n, cell, root``. A region's largest component is joined already, so links
    are missing only from its other members.
    """
    placed = regions.select("region", "node").join(cells, "node")
    held = placed.groupBy("region", "root", "cell").agg(F.count("*").alias("members"))
    held = staged(held, "jaccard-held")
    sizes = held.groupBy("region", "root").agg(F.sum("members").alias("members"))
    largest = sizes.groupBy("region").agg(
        F.max(F.struct("members", "root"))["root"].alias("largest"), F.count("*").alias("roots")
    )
    open_ = largest.where("roots > 1").select("region", "largest")
    probes = placed.join(open_, "region").where("root != largest").select("region", "node", "n", "root")
    others = held.select("region", F.col("root").alias("other"), "cell")
    found = probes.join(others, "region").where("root != other")
    windows = staged(found.select("node", "n", "root", "cell").distinct(), "jaccard-windows")
    discard(held)
    return windows


def _blocks(rows: DataFrame) -> DataFrame:
    """``cell, blocks``: how many blocks of bounded size the rows ``(cell, node, n)`` of a cell make."""
    load = F.sum(F.col("n") + NODE_LOAD)
    return rows.groupBy("cell").agg(F.ceil(load / BLOCK).cast("int").alias("blocks"))


def _dealt(probes: DataFrame, members: DataFrame) -> DataFrame:
    """``cell, p, m, node, root, probe``: each block p of a cell's probes with each block m of its members."""
    both = _blocks(probes).toDF("cell", "p").join(_blocks(members).toDF("cell", "m"), "cell")

    def side(rows: DataFrame, own: str, other: str, probe: bool) -> DataFrame:
        block = F.pmod(F.xxhash64("node"), F.col(own)).cast("int").alias(own)
        each = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other)
        spread = rows.join(both, "cell").select("cell", "node", "root", block, each)
        return spread.select("cell", "p", "m", "node", "root", F.lit(probe).alias("probe"))

    return side(probes, "p", "m", True).unionByName(side(members, "m", "p", False))


def _compared(probes: DataFrame, members: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` that join what is linked of the probes and members of each cell.

    Both have ``cell, node, n, root``. A set moves once for every block it is held against, not for
    every other set.
    """
    rows = _dealt(probes, members)
    found = rows.join(nodes.select("node", "shingles"), "node")

    def run(table: pa.Table) -> pa.Table:
        probe = table.column("probe").to_numpy()
        sides = [_side(table.filter(pa.array(side))) for side in (probe, ~probe)]
        return _joining(*sides, percent)

    return found.groupBy("cell", "p", "m").applyInArrow(run, "a long, b long")


def _side(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Root and size of each set, and the shingles of all in this order."""
    sets = table.column("shingles").combine_chunks()
    sizes = sets.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return table.column("root").to_numpy(), sizes, sets.flatten().to_numpy(zero_copy_only=False)


def _joining(probes: tuple, members: tuple, percent: int) -> pa.Table:
    """A forest ``(a, b)`` over the roots of linked sets of the two sides, less what is joined already."""
    (root, n, values), (other, n_other, other_values) = probes, members
    order = np.argsort(other_values, kind="stable")
    owners = np.repeat(np.arange(len(n_other)), n_other)[order]
    low = np.searchsorted(other_values[order], values, "left")
    times = np.searchsorted(other_values[order], values, "right") - low
    ends = np.cumsum(n)
    work = np.concatenate(([0], np.cumsum(times)))[ends] + np.arange(1, len(n) + 1) * len(n_other)
    starts, links, first = ends - n, [], 0
    while first < len(n):
        done = work[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(work, done + STEP, "right")))
        part = slice(starts[first], ends[last - 1])
        at, k = np.repeat(low[part], times[part]), times[part]
        at += np.arange(len(at)) - np.repeat(np.cumsum(k) - k, k)
        row = np.repeat(np.repeat(np.arange(last - first), n[first:last]), k)
        common = np.bincount(row * len(n_other) + owners[at], minlength=(last - first) * len(n_other))
        common = common.reshape(last - first, len(n_other))
        union = n[first:last, None] + n_other[None, :] - common
        x, y = np.nonzero((common * 100 >= union * percent) & (root[first:last, None] != other[None, :]))
        links.append(np.unique(np.stack((root[first + x], other[y])), axis=1))
        first = last
    ends_of = np.concatenate(links, axis=1) if links else np.zeros((2, 0), np.int64)
    names, ids = np.unique(ends_of, return_inverse=True)
    ids = ids.reshape(2, -1)
    least = np.arange(len(names))
    while True:
        before = least.copy()
        for a, b in ((0, 1), (1, 0)):
            np.minimum.at(least, ids[a], least[ids[b]])
        least = least[least]
        if np.array_equal(before, least):
            break
    tied = np.flatnonzero(least != np.arange(len(names)))
    return pa.table({"a": pa.array(names[tied], pa.int64()), "b": pa.array(names[least[tied]], pa.int64())})


def _joined(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """``roots`` after ``links (a, b)``: what is joined already takes part as its root alone."""
    if roots is None:
        return components(links)
    ends = links
    for end in ("a", "b"):
        known = roots.toDF(end, "root")
        ends = ends.join(known, end, "left").withColumn(end, F.coalesce("root", end)).drop("root")
    ends = staged(ends.where("a != b").distinct(), "links")
    if ends.isEmpty():
        discard(ends)
        return roots
    moved = components(ends)
    kept = roots.join(moved.toDF("root", "now"), "root", "left").select(
        "node", F.coalesce("now", "root").alias("root")
    )
    after = staged(kept.unionByName(moved.join(roots, "node", "left_anti")), "jaccard-roots")
    discard(roots, ends, moved)
    return after


def _roots(nodes: DataFrame, percent: int) -> DataFrame | None:
    """``node, root`` of the nodes that links join, or None. ``nodes`` is a staged table and does
    not outlive it.

    Members of large cells meet their pivot first, which joins most of them. Then every node is held
    against the cells that may have partners of another component, and that is all there are.
    """
    regions = staged(_first_regions(nodes, percent), "regions")
    cells = staged(_cells(regions), "jaccard-cells")
    # The sets move in every step, so only those still needed stay.
    active = staged(nodes.join(cells.select("node"), "node", "left_semi"), "jaccard-active")
    discard(nodes)
    alone = cells.withColumn("root", F.col("node"))
    large = alone.where(F.col("members") > LEAF)
    # A pivot may itself have another that is nearer.
    held = large.select("cell").distinct()
    pivots = alone.withColumn("cell", F.col("node")).join(held, "cell", "left_semi")
    links = staged(_compared(pivots, large, active, percent), "links")
    roots = _joined(None, links)
    discard(links)
    labelled = cells.join(roots, "node", "left").select(
        "node", "n", "cell", F.coalesce("root", "node").alias("root")
    )
    labelled = staged(labelled, "jaccard-labelled")
    discard(cells)
    windows = _windows(regions, labelled)
    discard(regions)
    links = staged(_compared(windows, labelled, active, percent), "links")
    discard(active, windows, labelled)
    roots = _joined(roots, links)
    discard(links)
    return roots


def _grouped(docs: DataFrame, text: str, size: int, percent: int) -> DataFrame:
    """Every row with ``first_doc`` and ``root`` of its class; both null if it has no partner."""
    described = staged(_described(docs, text, size, percent), "jaccard-documents")
    possible = described.where(F.size("shingles") > 0)
    classes = possible.groupBy("print1", "print2", "n").agg(
        F.min("doc_id").alias("first_doc"), F.first("shingles").alias("shingles")
    )
    nodes = staged(classes.withColumn("node", F.monotonically_increasing_id()), "jaccard-nodes")
    # The sets go as soon as nothing needs them; what names the rows and classes is a small part.
    rows = staged(described.select("doc_id", "row_hash", "n", "print1", "print2"), "jaccard-rows")
    prints = staged(nodes.select("print1", "print2", "n", "node", "first_doc"), "jaccard-classes")
    discard(described)
    roots = _roots(nodes, percent)
    if roots is not None:
        named = prints.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        least = named.groupBy("root").agg(F.min("first_doc").alias("first_doc"))
        prints = named.drop("first_doc").join(least, "root")
    else:
        prints = prints.withColumnRenamed("node", "root")
    prints = prints.select("print1", "print2", "n", "root", "first_doc")
    return rows.join(prints, ["print1", "print2", "n"], "left")


def join_components(
    docs: DataFrame, text: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row: the smallest id that links reach.

    Texts without words have no shingles and are linked with nothing; shorter ones are one shingle.
    Repeated rows are linked like other equal texts, rows without an id get the smallest id of their
    component or null. Other columns are ignored, an empty table gives no rows.
    """
    return _grouped(docs, text, size, percent).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("first_doc", "doc_id").alias("component_id"),
    )


def one_of_each(
    docs: DataFrame, text: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One row of ``docs`` of each component, with all its columns: that with the smallest id.

    A row without id stays only if its component has none with one.
    """
    grouped = staged(_grouped(docs, text, size, percent), "jaccard-grouped")
    rank = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "row_hash")
    members = grouped.where(F.col("root").isNotNull())
    best = members.groupBy("root").agg(F.min(rank).alias("best"))
    key, row, number, place = fresh(docs, "key", "row", "number", "place")
    dropped = (
        members.join(best, "root").where(rank != F.col("best")).select("doc_id", "row_hash").distinct()
    )
    hashed = docs.withColumn(row, F.xxhash64(text)).withColumn(number, F.col("doc_id").cast("long"))
    others = dropped.toDF(key, place)
    same = F.col(number).eqNullSafe(F.col(key)) & (F.col(row) == F.col(place))
    kept = hashed.join(others, same, "left_anti")
    repeats = members.groupBy("doc_id", "row_hash").count().where("count > 1")
    if repeats.isEmpty():
        return kept.drop(row, number)
    first = F.row_number().over(Window.partitionBy(number, row).orderBy(row))
    # Rows without words are linked with nothing, however often they are repeated.
    wordless = ~F.coalesce(F.col(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    once = kept.withColumn(place, first).where((F.col(place) == 1) | wordless)
    return once.drop(row, number, place)
