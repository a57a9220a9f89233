"""All questions when one key of every big table holds a third of its rows."""

import shutil

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tests.compare import TABLES, connect, differences, duckdb_result, spark_result

SOURCE = "/root/testdata/sf0.001"
QUERIES = contract.queries()
SQL = contract.oracle_sql()
CHOSEN = [n for n in QUERIES if n.startswith("q")] + [
    "fact_mission",
    "fact_equipment",
    "mission_mart",
    "equipment_mart",
    "dim_city_augmented",
    "dim_equipment",
    "equipment_co2_lookup",
    "stream_daily_totals",
]

# Nothing is small enough to broadcast, and tiny partitions count as skewed.
SHUFFLE_EVERYTHING = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
}


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    third = F.xxhash64("row") % 3 == 0
    hot = {"orders": ["o_custkey"], "lineitem": ["l_orderkey", "l_partkey"], "events": ["user_id"]}
    for table in TABLES:
        source = f"{SOURCE}/{table}.parquet"
        if table not in hot:
            shutil.copy(source, folder / f"{table}.parquet")
            continue
        rows = spark.read.parquet(source).withColumn("row", F.monotonically_increasing_id())
        for column in hot[table]:
            rows = rows.withColumn(column, F.when(third, F.lit(7)).otherwise(F.col(column)))
        rows = rows.drop("row").withColumn(
            hot[table][0], F.col(hot[table][0]).cast("long")
        )
        rows.toPandas().to_parquet(folder / f"{table}.parquet", coerce_timestamps="us")
    return str(folder)


@pytest.fixture(scope="module")
def tables(skewed):
    return connect(skewed)


@pytest.fixture(scope="module", autouse=True)
def shuffling(spark):
    for key, value in SHUFFLE_EVERYTHING.items():
        spark.conf.set(key, value)
    yield
    for key in SHUFFLE_EVERYTHING:
        spark.conf.unset(key)


@pytest.mark.parametrize("name", CHOSEN)
def test_whole_result_under_skew(spark, skewed, tables, name):
    found = spark_result(QUERIES[name](spark, skewed))
    assert differences(found, duckdb_result(tables, SQL[name])) == ""
