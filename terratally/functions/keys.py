"""Surrogate keys that do not depend on partitioning."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terratally.sources.warehouse import stored

_TRIP_SHIFT = 32
#: Copies of one row that are laid out together.
_BLOCK = 1_000
#: ``monotonically_increasing_id`` keeps the row in so many low bits, the partition above.
_ROW_BITS = 33


def hashed_key(*natural: Column) -> Column:
    return F.xxhash64(*natural)


def trip_key(origin: Column, destination: Column) -> Column:
    """Unique per ordered city pair while city keys stay below 2**32."""
    return F.shiftleft(origin.cast("long"), _TRIP_SHIFT) + destination.cast("long")


def with_dense_key(
    frame: DataFrame, name: str, order: list[Column], after: Column | int = 0
) -> DataFrame:
    """Number the rows after+1, after+2, ... in ``order`` without a one-task sort.

    Exact copies are counted first and laid out in blocks, so that a row that fills a large part
    of the table is spread like any other. ``order`` must tell rows that differ apart for the
    numbering to be reproducible. The rows are written once, see ``numbered``.
    """
    counted = frame.groupBy(*frame.columns).agg(F.count("*").alias("_copies"))
    last_block = F.expr(f"(_copies - 1) DIV {_BLOCK}")
    blocks = counted.select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), last_block)).alias("_block")
    )
    in_block = F.least(F.col("_copies") - F.col("_block") * _BLOCK, F.lit(_BLOCK))
    laid = _laid_out(blocks, [*order, F.col("_block")])
    unfolded = laid.select(*frame.columns, F.explode(F.sequence(F.lit(1).cast("long"), in_block)))
    start = F.lit(after) if isinstance(after, int) else after
    rows = _counted_up(unfolded.select(*frame.columns), "_before", [])
    return rows.select((start + F.col("_before") + 1).alias(name), *frame.columns)


def numbered(
    frame: DataFrame, name: str, order: list[Column], within: list[str] | None = None
) -> DataFrame:
    """Add the place of each row, from 0, in ``order`` among the rows that agree on ``within``.

    NULL agrees with NULL. One range partitioning lays the rows out, whatever the sizes of the
    groups, and they are written once; what the pieces of a group add to the places in later ones
    is counted from the files. Only one row per group and piece is ever brought together.
    """
    within = within or []
    laid = _laid_out(frame, [*(F.col(c) for c in within), *order])
    return _counted_up(laid, name, within)


def _laid_out(rows: DataFrame, order: list[Column]) -> DataFrame:
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def _counted_up(laid: DataFrame, name: str, within: list[str]) -> DataFrame:
    """Places of rows that stand in order inside and across their partitions."""
    columns = laid.columns
    rows = stored(laid.withColumn("_at", F.monotonically_increasing_id()), "laid-out")
    piece = F.shiftright("_at", _ROW_BITS)
    sizes = rows.groupBy(*within, piece.alias("_piece")).agg(
        F.min("_at").alias("_first"), F.count("*").alias("_rows")
    )
    earlier = Window.partitionBy(*within).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    shifts = stored(
        sizes.select(
            *(F.col(c).alias(f"_of_{c}") for c in within),
            "_piece",
            (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        ),
        "shifts",
    )
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in within]
    placed = rows.join(shifts, [piece == F.col("_piece"), *same])
    return placed.select(*columns, (F.col("_at") + F.col("_shift")).alias(name))
