"""What the plans must and must not contain, whatever the size of the data."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from terratally.operators.emissions import priced_missions
from terratally.operators.facts import with_staff
from terratally.plans.questions import QUESTIONS
from terratally.sources.testbed import Testbed
from tests.conftest import TESTDATA

QUERIES = contract.queries()


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, TESTDATA))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert node not in text


def test_period_and_columns_reach_the_scan(spark):
    text = plan(QUESTIONS["q20_monthly_total"](Testbed(spark, TESTDATA)))
    assert "GreaterThanOrEqual(o_orderdate,1996-05-01" in text
    assert "LessThan(l_shipdate,1996-11-01" in text
    assert "o_totalprice" not in text and "l_extendedprice" not in text
    # Purchases per month need no employee, so the line items skip the orders.
    assert text.count("orders.parquet") == 1


def test_rows_are_counted_before_they_are_priced(spark):
    text = plan(QUESTIONS["q08_eu_missions"](Testbed(spark, TESTDATA)))
    assert text.index("SIN(") < text.index("partial_count")


def test_filter_on_co2_does_not_repeat_the_formula(spark):
    testbed = Testbed(spark, TESTDATA)
    ledger = priced_missions(testbed.missions(), testbed.cities())
    text = plan(ledger.where("co2_kg > 100 AND transport_name LIKE 'Avion%'"))
    assert text.count("ASIN(") == 1


@pytest.mark.parametrize("name", ["fact_mission", "mission_mart", "mission_co2", "join_left_dims"])
def test_rows_take_distances_from_the_pairs(spark, name):
    assert "SIN(" not in plan(QUERIES[name](spark, TESTDATA))


@pytest.mark.parametrize("name", ["q10_sector_total", "q11_site_total", "q20_monthly_total"])
def test_catalogue_is_read_for_one_join(spark, name):
    """The parts are read for the catalogue and for the types of what was bought."""
    text = plan(QUERIES[name](spark, TESTDATA))
    scans = [line for line in text.splitlines() if "FileScan" in line and "part.parquet" in line]
    assert len(scans) <= 2


@pytest.mark.parametrize("name", ["dim_equipment", "dim_city_sites", "dim_city_augmented"])
def test_numbering_needs_no_exchange_of_rows(spark, name):
    text = plan(QUERIES[name](spark, TESTDATA))
    assert text.count("hashpartitioning") <= 4 and text.count("Exchange SinglePartition") <= 1


def test_pivot_has_no_window(spark):
    assert "Window" not in plan(QUERIES["q19_pivot"](spark, TESTDATA))


def test_top_k_is_not_a_full_sort(spark):
    for name in ("q09_top_days", "q16_top_destinations", "q18_top_missions"):
        assert "TakeOrderedAndProject" in plan(QUESTIONS[name](Testbed(spark, TESTDATA)))


def test_hot_employee_is_split(spark):
    """Someone with a third of all missions does not become one long task."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(0, 240000, 1, 8).select(
            F.xxhash64("id").alias("nk_mission"),
            F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 4000).alias("nk_staff"),
        )
        staff = spark.range(4000).select(
            F.col("id").alias("nk_staff"), (F.col("id") % 6).alias("sk_site")
        )
        per_site = with_staff(rows, staff).groupBy("sk_site")
        totals = per_site.agg(F.count("nk_mission").alias("n"), F.max("nk_mission"))
        assert sum(r.n for r in totals.collect()) == 240000
        assert "skew=true" in plan(totals)
    finally:
        for key in settings:
            spark.conf.unset(key)
