"""Conformed dimensions: calendar, transport, city, staff, trip, equipment."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terratally.functions import geodesy, keys, measures, vocabulary
from terratally.schemas import (
    DIM_CITY,
    DIM_DATE,
    DIM_EQUIPMENT,
    DIM_STAFF,
    DIM_TRANSPORT_TYPE,
    DIM_TRIP,
    publish,
)

CALENDAR_FIRST = date(2026, 1, 1)
CALENDAR_LAST = date(2027, 12, 31)


def calendar(
    spark: SparkSession, first: date = CALENDAR_FIRST, last: date = CALENDAR_LAST
) -> DataFrame:
    """DIM_DATE: one row per day, numbered from 1."""
    bounds = spark.range(1).select(F.lit(first).alias("first"), F.lit(last).alias("last"))
    return calendar_between(bounds)


def calendar_between(bounds: DataFrame) -> DataFrame:
    """DIM_DATE for the one row (first, last) of ``bounds``."""
    days = bounds.select(
        "first", F.explode(F.sequence("first", "last")).alias("date_iso")
    )
    return publish(days, DIM_DATE, sk_date=F.datediff("date_iso", "first") + 1)


def whole_years(days: DataFrame, day: str) -> DataFrame:
    """Bounds of the calendar years that column ``day`` touches."""
    start = F.trunc(F.min(day), "year")
    end = F.date_sub(F.trunc(F.add_months(F.max(day), 12), "year"), 1)
    return days.agg(start.alias("first"), end.alias("last"))


def transport_types(spark: SparkSession) -> DataFrame:
    """DIM_TRANSPORT_TYPE: the modes of the emission table in their order."""
    rows = [
        (key, name, factor)
        for key, (name, factor) in enumerate(vocabulary.EMISSION_FACTORS.items(), 1)
    ]
    return spark.createDataFrame(rows, DIM_TRANSPORT_TYPE)


# --- cities -----------------------------------------------------------------------


def mission_ends(missions: DataFrame) -> DataFrame:
    """(city_name, country) of both ends of every mission, from one pass over them."""
    ends = F.array(
        *[
            F.struct(
                F.col(f"{end}_city").alias("city_name"),
                F.col(f"{end}_country").alias("country"),
            )
            for end in ("origin", "destination")
        ]
    )
    return missions.select(F.inline(ends))


def one_row_per_city(named: DataFrame) -> DataFrame:
    """Distinct named cities; of several countries the first by name is kept."""
    return (
        named.where(F.col("city_name").isNotNull())
        .groupBy("city_name")
        .agg(F.min("country").alias("country"))
    )


def new_cities(known: DataFrame, missions: DataFrame) -> DataFrame:
    """Mission cities that ``known`` does not list."""
    return one_row_per_city(mission_ends(missions)).join(
        known.select("city_name"), "city_name", "left_anti"
    )


def labelled_cities(named: DataFrame, is_org_site: bool) -> DataFrame:
    """Cities with their ISO country code and whether they are offices."""
    return named.select(
        "city_name",
        vocabulary.country_iso2(F.col("country")).alias("country_iso2"),
        F.lit(is_org_site).alias("is_org_site"),
    )


def site_cities(named: DataFrame, places: DataFrame) -> DataFrame:
    """DIM_CITY of the office sites, numbered by name, with coordinates.

    Numbering reads ``named`` several times; hand in a stored table.
    """
    labelled = labelled_cities(named, is_org_site=True)
    numbered = keys.with_dense_key(labelled, "sk_city", [F.col("city_name")])
    return numbered.join(places, "city_name", "left")


def augmented_cities(known: DataFrame, new: DataFrame, places: DataFrame) -> DataFrame:
    """DIM_CITY plus ``new``, numbered by name after the highest key of ``known``.

    The keys of ``known`` stay as they are. Numbering reads both frames several times;
    hand in stored tables.
    """
    highest = known.agg(F.coalesce(F.max("sk_city"), F.lit(0))).scalar()
    numbered = keys.with_dense_key(
        labelled_cities(new, is_org_site=False), "sk_city", [F.col("city_name")], highest
    )
    kept = known.select(*numbered.columns)
    return kept.unionByName(numbered).join(places, "city_name", "left")


def published_cities(cities: DataFrame) -> DataFrame:
    """DIM_CITY without the coordinates, which are for internal use."""
    return publish(cities, DIM_CITY)


# --- staff ------------------------------------------------------------------------


def cleaned_personnel(raw: DataFrame) -> DataFrame:
    """Staff file rows under engine names, titles and sectors normalised."""
    title = vocabulary.job_title(F.col("FONCTION_PERSONNEL"))
    return raw.select(
        F.col("ID_PERSONNEL").alias("nk_staff"),
        F.col("NOM_PERSONNEL").alias("last_name"),
        F.col("PRENOM_PERSONNEL").alias("first_name"),
        title.alias("job_title"),
        vocabulary.activity_sector(title).alias("activity_sector"),
        measures.parsed_date(F.col("DT_NAISS"), measures.DAY_FORMAT).alias("birth_date"),
        F.col("VILLE").alias("city_name"),
        F.col("PAYS").alias("country"),
    )


def staff(personnel: DataFrame, cities: DataFrame) -> DataFrame:
    """DIM_STAFF: employees of a known city; the others are left out."""
    sited = personnel.join(
        cities.select(F.col("sk_city").alias("sk_site"), "city_name"), "city_name"
    )
    return publish(sited, DIM_STAFF, sk_staff=keys.hashed_key(F.col("nk_staff")))


# --- trips ------------------------------------------------------------------------


def with_ends(
    rows: DataFrame,
    cities: DataFrame,
    origin: str,
    destination: str,
    on: str = "city_name",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Left-join the city dimension at both ends of a trip.

    Adds ``origin_<c>`` and ``destination_<c>`` for each column of ``carry`` and the
    reduced latitudes and longitudes the distance needs; those are worked out on the
    city side, once per city.
    """
    for end, key in (("origin", origin), ("destination", destination)):
        side = cities.select(
            F.col(on).alias(key),
            *[F.col(c).alias(f"{end}_{c}") for c in carry],
            geodesy.reduced_latitude("lat").alias(f"{end}_phi"),
            F.radians("lon").alias(f"{end}_lam"),
        )
        rows = rows.join(side, key, "left")
    return rows


_COORDINATES = ("origin_phi", "origin_lam", "destination_phi", "destination_lam")


def with_trip_distance(rows: DataFrame) -> DataFrame:
    """Replace the coordinates of ``with_ends`` by ``located`` and ``distance_km``.

    ``located`` says that both ends have coordinates, so the trip has a distance.
    """
    located = " AND ".join(f"{c} IS NOT NULL" for c in _COORDINATES)
    keep = [c for c in rows.columns if c not in _COORDINATES]
    return geodesy.with_distance(
        rows, _COORDINATES[:2], _COORDINATES[2:], [*keep, f"{located} AS located"]
    )


def trips(
    missions: DataFrame, cities: DataFrame, on: str = "city_name",
    origin: str = "origin_city", destination: str = "destination_city",
) -> DataFrame:
    """DIM_TRIP: one row per ordered pair of cities, the distance worked out once each."""
    pairs = missions.select(origin, destination).distinct()
    ended = with_ends(pairs, cities, origin, destination, on, carry=("sk_city",))
    return publish(
        with_trip_distance(ended),
        DIM_TRIP,
        sk_trip=keys.trip_key(F.col("origin_sk_city"), F.col("destination_sk_city")),
        sk_city_origin="origin_sk_city",
        sk_city_destination="destination_sk_city",
    )


# --- equipment --------------------------------------------------------------------


def cleaned_impacts(raw: DataFrame) -> DataFrame:
    """Impact file rows under engine names; an unreadable impact is NULL."""
    return raw.select(
        F.col("Type").alias("type"),
        F.col("Modèle").alias("model"),
        F.col("Impact").try_cast("double").alias("co2_impact_kg_ref"),
    )


def equipment(impacts: DataFrame) -> DataFrame:
    """DIM_EQUIPMENT: the catalogue numbered by (type, model).

    Numbering reads ``impacts`` several times; hand in a stored table if it is costly.
    """
    order = [
        F.coalesce("type", F.lit("")).alias("type"),
        F.coalesce("model", F.lit("")).alias("model"),
        F.col("co2_impact_kg_ref"),
    ]
    return publish(keys.with_dense_key(impacts, "sk_equipment", order), DIM_EQUIPMENT)
