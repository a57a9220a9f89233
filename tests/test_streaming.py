from datetime import date, datetime

from pyspark.sql import functions as F

from terratally.sources.delimited import Drop
from terratally.sources.testbed import Testbed
from terratally.operators.joins import heavy_keys, salted_lookup
from terratally.streaming.daily import (
    daily_totals,
    follow_daily_totals,
    read_daily_totals,
    stream_daily_totals,
)
from terratally.streaming.ingest import ingest_missions, ingest_purchases, read_ingested
from tests.conftest import TESTDATA
from tests.drop import MISSIONS, PURCHASES, write_missions, write_purchases


def test_each_file_is_taken_once(spark, tmp_path):
    root, table, checkpoint = (tmp_path / n for n in ("drop", "table", "checkpoint"))
    early = [m for m in MISSIONS if m[1] < "20260901"]
    write_missions(root, early)

    def ingest():
        ingest_missions(spark, Drop(str(root)), str(table), str(checkpoint))
        return read_ingested(spark, str(table))

    assert ingest().count() == len(early)
    assert ingest().count() == len(early)
    write_missions(root, [m for m in MISSIONS if m[1] >= "20260901"])
    loaded = ingest()
    assert sorted(r.nk_mission for r in loaded.collect()) == sorted(m[2] for m in MISSIONS)
    assert loaded.where("year = 2026 and month = 11").count() == 1
    assert loaded.where("nk_mission = 'M01'").first().date_iso == date(2026, 5, 1)


def test_a_corrected_file_replaces_its_rows(spark, tmp_path):
    root, table, checkpoint = (tmp_path / n for n in ("drop", "table", "checkpoint"))

    def ingest():
        ingest_missions(spark, Drop(str(root)), str(table), str(checkpoint))
        return sorted((r.nk_mission, r.transport_raw) for r in read_ingested(spark, str(table)).collect())

    write_missions(root, MISSIONS)
    before = ingest()
    assert len(before) == len(MISSIONS)
    first = MISSIONS[0]
    of_day = [m for m in MISSIONS if m[:2] == first[:2]]
    corrected = [(*first[:2], "M99", *first[3:9], "Train", first[10])]
    write_missions(root, corrected)
    after = ingest()
    gone = {m[2] for m in of_day}
    assert after == sorted([r for r in before if r[0] not in gone] + [("M99", "Train")])
    assert ingest() == after
    write_missions(root, of_day)
    assert ingest() == before


def test_purchases_are_ingested(spark, tmp_path):
    root = tmp_path / "drop"
    write_purchases(root, PURCHASES)
    table = str(tmp_path / "table")
    ingest_purchases(spark, Drop(str(root)), table, str(tmp_path / "checkpoint"))
    assert read_ingested(spark, table).count() == len(PURCHASES)


def test_stream_equals_batch(spark):
    testbed = Testbed(spark, TESTDATA)
    layout = testbed.layout("events")
    streamed = stream_daily_totals(spark, TESTDATA, "events.parquet", layout, testbed.staff())
    batch = daily_totals(testbed.table("events"), testbed.staff())
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_hot_user_in_the_stream(spark, tmp_path):
    events = spark.range(2000).select(
        F.col("id").alias("event_id"),
        F.lit(datetime(2026, 5, 1, 10)).cast("timestamp_ntz").alias("ts"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("user_id"),
        F.lit("purchase").alias("event_type"),
        F.lit(1.0).alias("value"),
    )
    events.write.parquet(str(tmp_path / "events"))
    staff = spark.range(50).select(F.col("id").alias("nk_staff"), F.lit("s").alias("activity_sector"))
    layout = Testbed(spark, TESTDATA).layout("events")
    folder = str(tmp_path / "events")
    found = stream_daily_totals(spark, folder, "*.parquet", layout, staff).collect()
    assert [tuple(r) for r in found] == [(date(2026, 5, 1), "s", 2000, 2000.0)]


def test_only_heavy_keys_are_copied(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 400).alias("k")
    )
    heavy = heavy_keys(rows, "k", 8)
    assert heavy == [7]
    dimension = spark.range(500).withColumnRenamed("id", "k")
    joined = salted_lookup(rows, dimension, "k", "row", heavy, salts=8)
    assert joined.count() == 3000 and joined.columns == ["k", "row"]
    counted = dimension.withColumn("copies", F.lit(1))
    copies = salted_lookup(spark.range(64).select(F.lit(7).alias("k"), "id"), counted, "k", "id", heavy, salts=8)
    assert copies.count() == 64
    assert salted_lookup(rows, dimension, "k", "row", [], salts=8).count() == 3000


def test_late_rows_change_a_day_until_it_leaves_the_state(spark, tmp_path):
    folder, home = str(tmp_path / "events"), str(tmp_path / "home")
    layout = Testbed(spark, TESTDATA).layout("events")
    staff = spark.range(50).select(F.col("id").alias("nk_staff"), F.lit("s").alias("activity_sector"))

    def arrive(*days):
        made = [(i, datetime(2026, 5, day, 10), 1, "purchase", 1.0) for i, day in enumerate(days)]
        rows = spark.createDataFrame(made, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double")
        rows.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(folder)
        query = follow_daily_totals(spark, folder, "*.parquet", layout, staff, home)
        states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
        found = {r.day.day: r.purchases for r in read_daily_totals(spark, home).collect()}
        return found, states[-1]

    assert arrive(1, 2, 3, 3) == ({1: 1, 2: 1, 3: 2}, 2)  # the first day has left
    found, _ = arrive(2)  # within two days of the third
    assert found == {1: 1, 2: 2, 3: 2}
    found, state = arrive(20)
    assert found == {1: 1, 2: 2, 3: 2, 20: 1} and state == 1
    found, _ = arrive(2)  # too late
    assert found[2] == 2
    batch = read_daily_totals(spark, home)
    assert batch.groupBy("day").count().where("count > 1").isEmpty()
