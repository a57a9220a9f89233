"""From source rows to the two published facts and the wide marts over them."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terratally.functions import keys, measures, vocabulary
from terratally.operators.dimensions import CALENDAR_FIRST, CALENDAR_LAST
from terratally.schemas import FACT_EQUIPMENT, FACT_MISSION, publish

STAFF_ATTRIBUTES = (
    "sk_staff",
    "job_title",
    "activity_sector",
    "birth_date",
    "sk_site",
    "site_name",
    "site_country",
)


# --- cleaning ---------------------------------------------------------------------


def cleaned_missions(raw: DataFrame) -> DataFrame:
    """Mission file rows under engine names, date, type and flag parsed."""
    return raw.select(
        F.col("ID_MISSION").alias("nk_mission"),
        F.col("ID_PERSONNEL").alias("nk_staff"),
        measures.parsed_date(F.col("DATE_MISSION"), measures.SECOND_FORMAT).alias("date_iso"),
        vocabulary.mission_type(F.col("TYPE_MISSION")).alias("mission_type"),
        F.col("VILLE_DEPART").alias("origin_city"),
        F.col("PAYS_DEPART").alias("origin_country"),
        F.col("VILLE_DESTINATION").alias("destination_city"),
        F.col("PAYS_DESTINATION").alias("destination_country"),
        F.col("TRANSPORT").alias("transport_raw"),
        vocabulary.is_round_trip(F.col("ALLER_RETOUR")).alias("round_trip"),
    )


def cleaned_purchases(raw: DataFrame) -> DataFrame:
    """Purchase file rows under engine names, date parsed."""
    return raw.select(
        F.col("ID_MATERIELINFO").alias("nk_equipment"),
        F.col("ID_PERSONNEL").alias("nk_staff"),
        measures.parsed_date(F.col("DATE_ACHAT"), measures.SECOND_FORMAT).alias("date_iso"),
        F.col("TYPE").alias("type"),
        F.col("MODELE").alias("model"),
    )


def with_site(staff: DataFrame, cities: DataFrame) -> DataFrame:
    """Add name and country of the office to the employees."""
    return staff.join(
        cities.select(
            F.col("sk_city").alias("sk_site"),
            F.col("city_name").alias("site_name"),
            F.col("country_iso2").alias("site_country"),
        ),
        "sk_site",
        "left",
    )


def with_staff(rows: DataFrame, staff: DataFrame, key: str = "nk_staff") -> DataFrame:
    """Left-join the employee; ``staff_known`` tells whether there was one.

    The only join on the employee a plan needs: every staff attribute comes along, so
    AQE stays free to split an employee who holds a large share of the rows.
    """
    picked = [c for c in STAFF_ATTRIBUTES if c in staff.columns and c != key]
    return rows.join(
        staff.select(key, *picked, F.lit(True).alias("staff_known")), key, "left"
    )


# --- published facts --------------------------------------------------------------


def fact_mission(
    ledger: DataFrame, first: date = CALENDAR_FIRST, last: date = CALENDAR_LAST
) -> DataFrame:
    """FACT_MISSION from a ledger with staff and city keys."""
    return publish(
        ledger,
        FACT_MISSION,
        sk_fact_mission=keys.hashed_key(F.col("nk_mission")),
        sk_date_mission=measures.calendar_key(F.col("date_iso"), first, last),
        sk_trip=keys.trip_key(F.col("sk_origin"), F.col("sk_destination")),
        round_trip_flg="round_trip",
        co2_impact_kg="co2_kg",
    )


def fact_equipment(
    ledger: DataFrame, first: date = CALENDAR_FIRST, last: date = CALENDAR_LAST
) -> DataFrame:
    """FACT_EQUIPMENT from a ledger with staff and equipment keys."""
    return publish(
        ledger,
        FACT_EQUIPMENT,
        sk_fact_equipment=keys.hashed_key(F.col("nk_equipment")),
        sk_date_purchase=measures.calendar_key(F.col("date_iso"), first, last),
        co2_impact_kg="co2_kg",
    )


# --- marts ------------------------------------------------------------------------


def _with_calendar_parts(rows: DataFrame) -> DataFrame:
    return rows.select(
        "*",
        F.year("date_iso").cast("long").alias("year"),
        F.month("date_iso").cast("long").alias("month"),
        F.dayofmonth("date_iso").cast("long").alias("day"),
    )


def mission_mart(ledger: DataFrame) -> DataFrame:
    """Wide mission table: dated, of a known employee and site, by a listed transport
    and between known cities; other missions are left out."""
    complete = ledger.where(
        F.col("date_iso").isNotNull()
        & F.col("site_name").isNotNull()
        & F.col("has_factor")
        & F.col("sk_origin").isNotNull()
        & F.col("destination_city_name").isNotNull()
    )
    wide = _with_calendar_parts(complete)
    return wide.select(
        "nk_mission",
        "nk_staff",
        "date_iso",
        "year",
        "month",
        "day",
        "mission_type",
        "round_trip",
        "job_title",
        "activity_sector",
        "birth_date",
        "site_name",
        "transport_name",
        "sk_origin",
        "sk_destination",
        "destination_city_name",
        "distance_km",
        "co2_kg",
    )


def equipment_mart(ledger: DataFrame) -> DataFrame:
    """Wide purchase table: dated, of a known employee and site, with listed equipment."""
    complete = ledger.where(
        F.col("date_iso").isNotNull() & F.col("site_name").isNotNull() & F.col("listed")
    )
    wide = _with_calendar_parts(complete)
    return wide.select(
        *[c for c in ("nk_equipment",) if c in wide.columns],
        "nk_staff",
        "date_iso",
        "year",
        "month",
        "day",
        "job_title",
        "activity_sector",
        "site_name",
        "type",
        "co2_kg",
    )
