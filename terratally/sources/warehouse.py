"""Parquet tables: published star, working tables, and what is still to be loaded."""

import tempfile
import uuid
from datetime import date
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

DAY_PARTITIONS = ("year", "month", "day")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _own_folder(spark.sparkContext.applicationId)


@cache
def _own_folder(_application: str) -> str:
    return tempfile.mkdtemp(prefix="terratally-")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write ``frame`` once and go on from the files.

    Used for dimensions that several joins share: they are computed once, a lost
    executor only re-reads files, and the planner knows the true size when it decides
    between broadcasting and shuffling.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def write_days(frame: DataFrame, path: str, day: str) -> None:
    """Write a fact split by year, month and day of column ``day``, which must be known.

    Only the days present in ``frame`` are replaced, so a load can be repeated.
    The rebalance hint lets AQE merge small days into one file and split big ones.
    """
    (
        split_by_day(frame, day)
        .hint("rebalance", *DAY_PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*DAY_PARTITIONS)
        .parquet(path)
    )


def day_layout(layout: StructType, day: str) -> StructType:
    """Layout of a fact kept by day: its columns, the day, and the partition columns."""
    whole = StructType([*layout.fields, StructField(day, DateType())])
    for part in DAY_PARTITIONS:
        whole.add(part, "integer")
    return whole


def split_by_day(frame: DataFrame, day: str) -> DataFrame:
    """Add the partition columns of a fact kept by day."""
    return frame.select(
        "*",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
    )


def read_days(
    spark: SparkSession,
    path: str,
    first: date | None = None,
    last: date | None = None,
    layout: StructType | None = None,
) -> DataFrame:
    """Read a fact back; the bounds prune whole partitions. With a layout it may be empty."""
    reader = spark.read if layout is None else spark.read.schema(layout)
    return within_days(reader.parquet(path), first, last)


def within_days(table: DataFrame, first: date | None, last: date | None) -> DataFrame:
    """Keep the day partitions of [first, last]."""
    ordinal = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
    if first is not None:
        table = table.where((F.col("year") >= first.year) & (ordinal >= _ordinal(first)))
    if last is not None:
        table = table.where((F.col("year") <= last.year) & (ordinal <= _ordinal(last)))
    return table


def _ordinal(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def missing_days(incoming: DataFrame, loaded: DataFrame, day: str) -> DataFrame:
    """Days that occur in ``incoming`` but not in ``loaded``."""
    return (
        incoming.select(day)
        .where(F.col(day).isNotNull())
        .distinct()
        .join(loaded.select(day).distinct(), day, "left_anti")
    )
