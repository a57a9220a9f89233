"""The two loads: reference tables once, then facts for any period."""

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terratally.functions import vocabulary
from terratally.operators import dimensions, facts
from terratally.operators.emissions import (
    mission_ledger_by_trip,
    with_purchase_emission,
)
from terratally.operators.quality import described
from terratally.schemas import IMPACT_FILE, PERSONNEL_FILE
from terratally.sources.delimited import (
    Drop,
    read_delimited,
    read_mission_days,
    read_purchase_days,
)
from terratally.sources.places import places
from terratally.sources.warehouse import stored


@dataclass(frozen=True)
class ReferenceTables:
    """What does not change from day to day. ``cities`` still has its coordinates."""

    first: date
    last: date
    dim_date: DataFrame
    dim_transport_type: DataFrame
    dim_equipment: DataFrame
    cities: DataFrame
    dim_staff: DataFrame
    places: DataFrame


@dataclass(frozen=True)
class Star:
    """The eight published tables and the calendar they count days by."""

    first: date
    last: date
    dim_date: DataFrame
    dim_transport_type: DataFrame
    dim_equipment: DataFrame
    dim_city: DataFrame
    dim_staff: DataFrame
    dim_trip: DataFrame
    fact_mission: DataFrame
    fact_equipment: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        names = [n for n in self.__dataclass_fields__ if n.startswith(("dim_", "fact_"))]
        return {name: getattr(self, name) for name in names}

    def counts(self) -> DataFrame:
        """Name, row count and columns of every table."""
        return reduce(
            DataFrame.unionByName, [described(n, t) for n, t in self.tables().items()]
        )

    def register(self) -> None:
        """Make every table a temporary view of its name."""
        for name, table in self.tables().items():
            table.createOrReplaceTempView(name)


def load_reference(
    spark: SparkSession,
    drop: Drop,
    first: date = dimensions.CALENDAR_FIRST,
    last: date = dimensions.CALENDAR_LAST,
    city_cache: str | None = None,
) -> ReferenceTables:
    """Build the reference tables from the staff files and the impact catalogue."""
    raw_staff = read_delimited(spark, drop.personnel(), schema=PERSONNEL_FILE)
    impacts = read_delimited(spark, drop.impacts(), ",", schema=IMPACT_FILE)
    return reference_of(
        dimensions.cleaned_personnel(raw_staff),
        dimensions.cleaned_impacts(impacts),
        places(spark, city_cache),
        first,
        last,
    )


def reference_of(
    personnel: DataFrame, impacts: DataFrame, known_places: DataFrame, first: date, last: date
) -> ReferenceTables:
    """The reference tables from cleaned rows; those that later joins share are written once.

    An employee or a (type, model) listed twice is an error: facts are joined to both, so each of
    their rows would come out as often.
    """
    spark = personnel.sparkSession
    site_names = stored(dimensions.one_row_per_city(personnel), "site-names")
    cities = stored(dimensions.site_cities(site_names, known_places), "site-cities")
    staff = stored(dimensions.staff(personnel, cities), "staff")
    _one_row_per(staff, "nk_staff")
    catalogue = stored(impacts, "catalogue")
    _one_row_per(catalogue.select("type", F.trim("model").alias("model")), "type", "model")
    return ReferenceTables(
        first=first,
        last=last,
        dim_date=dimensions.calendar(spark, first, last),
        dim_transport_type=dimensions.transport_types(spark),
        dim_equipment=stored(dimensions.equipment(catalogue), "equipment"),
        cities=cities,
        dim_staff=staff,
        places=known_places,
    )


def _one_row_per(table: DataFrame, *key: str) -> None:
    repeated = table.groupBy(*key).count().where("count > 1").first()
    if repeated is not None:
        named = ", ".join(f"{name} {repeated[name]!r}" for name in key)
        raise ValueError(f"listed {repeated['count']} times, which would multiply facts: {named}")


def _within_calendar(rows: DataFrame, first: date, last: date) -> None:
    """Facts keep a day by its number in the calendar, so a day beyond it would be lost."""
    seen = rows.agg(F.min("date_iso").alias("first"), F.max("date_iso").alias("last")).first()
    if seen["first"] is not None and (seen["first"] < first or seen["last"] > last):
        raise ValueError(
            f"rows of {seen['first']} to {seen['last']} leave the calendar {first} to {last}"
        )


def load_period(
    spark: SparkSession,
    drop: Drop,
    first: date,
    last: date,
    reference: ReferenceTables,
    known_cities: DataFrame | None = None,
) -> Star:
    """Build the star from the daily files of [first, last]; see ``star_of``."""
    return star_of(
        facts.cleaned_missions(read_mission_days(spark, drop, first, last)),
        facts.cleaned_purchases(read_purchase_days(spark, drop, first, last)),
        reference,
        known_cities,
    )


def star_of(
    missions: DataFrame,
    purchases: DataFrame,
    reference: ReferenceTables,
    known_cities: DataFrame | None = None,
    default_model: str = vocabulary.DEFAULT_MODEL,
) -> Star:
    """Build cities, trips and both facts from cleaned rows, read or ingested.

    Keys hold within this star; ``save_star`` replaces them by those of a stored one.
    ``known_cities`` may be the city table of an earlier load, whose keys are kept.
    """
    for rows in (missions, purchases):
        _within_calendar(rows, reference.first, reference.last)
    known = reference.cities if known_cities is None else known_cities
    new_names = stored(dimensions.new_cities(known, missions), "new-cities")
    cities = stored(
        dimensions.augmented_cities(known, new_names, reference.places), "cities"
    )
    trips = stored(dimensions.trips(missions, cities), "trips")
    staff = reference.dim_staff
    mission_ledger = mission_ledger_by_trip(
        facts.with_staff(missions, staff), cities, trips
    )
    purchase_ledger = with_purchase_emission(
        facts.with_staff(purchases, staff), reference.dim_equipment, default_model
    )
    calendar = (reference.first, reference.last)
    return Star(
        first=reference.first,
        last=reference.last,
        dim_date=reference.dim_date,
        dim_transport_type=reference.dim_transport_type,
        dim_equipment=reference.dim_equipment,
        dim_city=dimensions.published_cities(cities),
        dim_staff=staff,
        dim_trip=trips,
        fact_mission=facts.fact_mission(mission_ledger, *calendar),
        fact_equipment=facts.fact_equipment(purchase_ledger, *calendar),
    )


def with_day(fact: DataFrame, key: str, first: date) -> DataFrame:
    """Turn the calendar key of a fact back into its day."""
    return fact.withColumn("date_iso", F.date_add(F.lit(first), (F.col(key) - 1).cast("int")))
