"""Purchases per day and sector from a stream of events."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from terratally.operators.joins import heavy_keys, salted_lookup
from terratally.sources.warehouse import shared_folder

_LATENESS = "2 days"
_TABLE = "day date, activity_sector string, purchases bigint, value double, batch bigint"


def daily_totals(events: DataFrame, staff: DataFrame, heavy: list | None = None) -> DataFrame:
    """Purchases of known employees per day and sector; ``events`` may be a stream.

    ``heavy`` names employees with a large share of the events; their rows are spread.
    """
    bought = events.where(F.col("event_type") == "purchase").select(
        "event_id",
        F.col("user_id").alias("nk_staff"),
        # The day as recorded, in whatever zone the session keeps; fixed 24-hour windows
        # would cut days in UTC.
        F.date_trunc("day", F.col("ts").cast("timestamp")).alias("day"),
        "value",
    )
    known = salted_lookup(
        bought.withWatermark("day", _LATENESS),
        staff.select("nk_staff", "activity_sector"),
        "nk_staff",
        "event_id",
        heavy or [],
    )
    return (
        known.groupBy("day", "activity_sector")
        .agg(F.count("*").alias("purchases"), F.sum("value").alias("value"))
        .select(
            F.to_date("day").alias("day"),
            "activity_sector",
            "purchases",
            F.round(F.round("value", 6), 2).alias("value"),
        )
    )


def follow_daily_totals(
    spark: SparkSession, folder: str, file_pattern: str, layout: str, staff: DataFrame, home: str
) -> StreamingQuery:
    """Take the event files that arrived since the last call with this ``home``.

    Every batch hands on the days it has changed, under its own number: a repeated batch replaces
    its rows, and the newest row of a day and sector counts. A day leaves the state two days after
    the latest one seen; events that come later still are dropped.
    """
    source = spark.read.schema(layout).option("pathGlobFilter", file_pattern).parquet(folder)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bought = source.where(F.col("event_type") == "purchase")
    events = (
        spark.readStream.schema(layout).option("pathGlobFilter", file_pattern).parquet(folder)
    )

    def add(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{home}/table/batch={batch_id}")

    query = (
        daily_totals(events, staff, heavy_keys(bought, "user_id", tasks))
        .writeStream.outputMode("update")
        .option("checkpointLocation", f"{home}/checkpoint")
        .foreachBatch(add)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def read_daily_totals(spark: SparkSession, home: str) -> DataFrame:
    """The newest totals of every day and sector."""
    table = spark.read.schema(_TABLE).parquet(f"{home}/table")
    newest = F.max_by(F.struct("purchases", "value"), "batch").alias("newest")
    return table.groupBy("day", "activity_sector").agg(newest).select("day", "activity_sector", "newest.*")


def stream_daily_totals(
    spark: SparkSession, folder: str, file_pattern: str, layout: str, staff: DataFrame
) -> DataFrame:
    """Run the events now available through ``daily_totals`` and return the table."""
    home = f"{shared_folder(spark)}/daily-totals-{uuid.uuid4().hex}"
    follow_daily_totals(spark, folder, file_pattern, layout, staff, home)
    return read_daily_totals(spark, home)
