"""Daily files into the warehouse, each file once."""

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terratally.operators.facts import cleaned_missions, cleaned_purchases
from terratally.schemas import MISSION_FILE, PURCHASE_FILE
from terratally.sources.delimited import Drop

ANY_DAY = "[0-9]*"


#: What tells a version of a file from another.
_VERSION = ("file", "modified", "file_bytes")
_OPTIONS = {
    "header": True,
    "sep": ";",
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": True,
    "ignoreTrailingWhiteSpace": True,
    "enforceSchema": False,
}


def _follow(spark: SparkSession, glob: str, schema: StructType) -> DataFrame:
    return spark.readStream.schema(schema).options(**_OPTIONS).csv(glob)


def _named(rows: DataFrame) -> DataFrame:
    """Add the file a row comes from, and what tells its versions apart."""
    return rows.select(
        "*",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_size").alias("file_bytes"),
    )


def _ingest(
    spark: SparkSession,
    glob: str,
    schema: StructType,
    clean: Callable[[DataFrame], DataFrame],
    table: str,
    checkpoint: str,
) -> None:
    def add(batch: DataFrame, batch_id: int) -> None:
        _take(batch, batch.select(*_VERSION).distinct(), table, f"b{batch_id:09d}")

    query = (
        _named(clean(_follow(spark, glob, schema)))
        .writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(add)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    _take_corrected(spark, glob, schema, clean, table)


def _take_corrected(
    spark: SparkSession, glob: str, schema: StructType, clean: Callable, table: str
) -> None:
    """Read files again that have changed since they were taken; a stream offers a name only once.

    What is collected are the names of changed files.
    """
    files = _files(spark, table)
    if files is None:
        return
    listed = _named(spark.read.format("binaryFile").load(glob)).select(*_VERSION)
    changed = listed.join(files, [*_VERSION], "left_anti").collect()
    if not changed:
        return
    last = files.agg(F.max("load")).first()[0]
    number = int(last[11:] or 0) + 1
    rows = spark.read.schema(schema).options(**_OPTIONS).csv([row.file for row in changed])
    versions = spark.createDataFrame(changed, listed.schema)
    _take(_named(clean(rows)), versions, table, f"{last[:10]}-{number:06d}")


def _take(rows: DataFrame, versions: DataFrame, table: str, load: str) -> None:
    """Write rows by month, then the versions of their files, which make them count.

    A load that is repeated replaces its own rows only.
    """
    dated = rows.drop("modified", "file_bytes").select(
        "*", F.year("date_iso").alias("year"), F.month("date_iso").alias("month")
    )
    (
        dated.hint("rebalance", "year", "month")
        .write.mode("overwrite")
        .partitionBy("year", "month")
        .parquet(f"{table}/rows/load={load}")
    )
    versions.coalesce(1).write.mode("overwrite").parquet(f"{table}/files/load={load}")


def _files(spark: SparkSession, table: str) -> DataFrame | None:
    """The version of each file that counts, and the load that brought it."""
    layout = "file string, modified timestamp, file_bytes bigint, load string"
    try:
        taken = spark.read.schema(layout).parquet(f"{table}/files")
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    newest = F.max_by(F.struct("modified", "file_bytes", "load"), "load").alias("newest")
    return taken.groupBy("file").agg(newest).select("file", "newest.*")


def read_ingested(spark: SparkSession, table: str) -> DataFrame:
    """The rows of the files taken so far, each file in its last version."""
    rows = spark.read.option("basePath", f"{table}/rows").parquet(f"{table}/rows")
    return rows.join(_files(spark, table).select("file", "load"), ["file", "load"], "left_semi").drop("file", "load")


def ingest_missions(spark: SparkSession, drop: Drop, table: str, checkpoint: str) -> None:
    """Take the mission files that arrived or changed since the last call into ``table``.

    ``checkpoint`` remembers the files already taken, so the call can be repeated or
    restarted after a failure without loading a file twice; a corrected file of the same name
    takes the place of the former one. Read the table with ``read_ingested``.
    """
    _ingest(spark, drop.missions(ANY_DAY), MISSION_FILE, cleaned_missions, table, checkpoint)


def ingest_purchases(spark: SparkSession, drop: Drop, table: str, checkpoint: str) -> None:
    """Take the purchase files that arrived or changed since the last call into ``table``."""
    _ingest(spark, drop.purchases(ANY_DAY), PURCHASE_FILE, cleaned_purchases, table, checkpoint)
