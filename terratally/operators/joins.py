"""Joins for plans that AQE does not watch over."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def heavy_keys(rows: DataFrame, key: str, tasks: int) -> list:
    """Keys that hold more than one ``tasks``-th of ``rows``, so fewer than ``tasks`` of them.

    Counted over all of ``rows``: partial counts collapse a hot key in each map task.
    """
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).count()
    total = rows.count()
    return [row[key] for row in counts.where(F.col("count") * tasks > total).collect()]


def salted_lookup(
    rows: DataFrame,
    dimension: DataFrame,
    key: str,
    row_id: str,
    heavy: list | None = None,
    salts: int | None = None,
) -> DataFrame:
    """Inner join whose ``heavy`` keys are spread over ``salts`` tasks, by default all that shuffle.

    Without ``heavy``, the rows, which then can't be a stream, are counted for such keys.

    Batch queries leave this to AQE, which splits a hot partition when it sees one; a
    stateful stream runs without AQE. Only rows of the dimension with a heavy key are copied. The
    salt is a hash of the row's own id, so a repeated task sends every row to the same place again.
    """
    if salts is None:
        salts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if heavy is None:
        heavy = heavy_keys(rows, key, salts)

    def salt(name: str, spread: Column, alone: Column) -> Column:
        return F.when(F.col(name).isin(heavy), spread).otherwise(alone) if heavy else alone

    of_row = F.pmod(F.xxhash64(row_id), F.lit(salts)).cast("int")
    spread = rows.withColumn("_salt", salt(key, of_row, F.lit(0)))
    numbers = salt(key, F.sequence(F.lit(0), F.lit(salts - 1)), F.array(F.lit(0)))
    copies = dimension.withColumn("_salt", F.explode(numbers))
    return spread.join(copies, [key, "_salt"]).drop("_salt")
