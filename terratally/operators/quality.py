"""Profiles and data-quality checks of the star."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terratally.functions.measures import tonnes, zero_if_null


def counted(frame: DataFrame, key: str, name: str) -> DataFrame:
    """Rows per value of ``key``, most frequent first."""
    return frame.groupBy(key).agg(F.count("*").alias(name)).orderBy(F.col(name).desc(), key)


def city_counts(cities: DataFrame) -> DataFrame:
    return cities.agg(
        F.count("*").alias("cities"), F.count_if("is_org_site").alias("org_sites")
    )


def cities_without_country(cities: DataFrame) -> DataFrame:
    return cities.where(F.col("country_iso2").isNull()).select("city_name").orderBy("city_name")


def longest_trips(trips: DataFrame, k: int = 10) -> DataFrame:
    return trips.orderBy(F.col("distance_km").desc(), "sk_trip").limit(k)


def trips_without_distance(trips: DataFrame) -> DataFrame:
    return trips.agg(
        F.count("*").alias("trips"),
        F.count_if(F.col("distance_km").isNull()).alias("without_distance"),
    )


def total_tonnes(totals: DataFrame, rows: str) -> DataFrame:
    """Row count and CO2 in tonnes of priced groups."""
    return totals.agg(
        F.coalesce(F.sum(rows), F.lit(0)).alias(rows),
        tonnes(zero_if_null(F.sum("co2_kg")), 2).alias("tco2e"),
    )


def without_co2(totals: DataFrame, rows: str, key: str, known: Column) -> DataFrame:
    """Rows per ``key`` whose CO2 is not known."""
    return (
        totals.where(~known)
        .groupBy(key)
        .agg(F.sum(rows).alias(rows))
        .orderBy(F.col(rows).desc(), key)
    )


def fact_total(fact: DataFrame, rows: str) -> DataFrame:
    """Row count and CO2 in tonnes of a published fact."""
    return total_tonnes(
        fact.select(F.lit(1).alias(rows), F.col("co2_impact_kg").alias("co2_kg")), rows
    )


def fact_without_co2(fact: DataFrame, rows: str, key: str) -> DataFrame:
    """Rows of a published fact per ``key`` whose CO2 is not known."""
    counted = fact.select(key, "co2_impact_kg", F.lit(1).alias(rows))
    return without_co2(counted, rows, key, F.col("co2_impact_kg").isNotNull())


def repeated_keys(table: str, frame: DataFrame, *key: str) -> DataFrame:
    """One row: how many keys there are and how many of them occur more than once."""
    per_key = frame.groupBy(*key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.lit(table).alias("table_name"),
        F.count("*").alias("keys"),
        F.count_if(F.col("n") > 1).alias("repeated"),
    ).select("table_name", "keys", "repeated")


def described(table: str, frame: DataFrame) -> DataFrame:
    """One row: name, row count and column list of a table."""
    return frame.agg(F.count("*").alias("row_count")).select(
        F.lit(table).alias("table_name"),
        "row_count",
        F.lit(", ".join(frame.columns)).alias("column_list"),
    )
