"""One query per operator over the test tables, beside the business questions."""

import uuid
from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terratally.functions import keys, vocabulary
from terratally.functions.measures import rounded
from terratally.operators import dimensions, emissions, facts, quality
from terratally.schemas import DIM_STAFF, DIM_TRANSPORT_TYPE, FACT_EQUIPMENT, FACT_MISSION
from terratally.plans.loads import Star, reference_of, star_of
from terratally.plans.questions import QUESTIONS
from terratally.plans.warehouse import StarSource, open_star, save_star
from terratally.sources.testbed import Testbed
from terratally.sources.warehouse import (
    read_days,
    shared_folder,
    stored,
    write_days,
)
from terratally.streaming.daily import stream_daily_totals as run_stream

# Hash keys have no counterpart outside Spark, so a comparison leaves them out.
_HASHED = ("sk_staff", "sk_fact_mission", "sk_fact_equipment")


def _to_grams(frame: DataFrame, *names: str) -> DataFrame:
    """Kilograms to the gram, kilometres to the metre."""
    return frame.withColumns({n: rounded(F.col(n), 3) for n in names})


# --- shared views -----------------------------------------------------------------


def _ledger(t: Testbed, sited: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    return emissions.mission_ledger(t.missions(sited=sited), t.cities(), carry)


def _mission_totals(t: Testbed, *by: str) -> DataFrame:
    return emissions.mission_totals(t.missions(), t.cities(), *by)


def _purchase_totals(t: Testbed, *by: str) -> DataFrame:
    return emissions.purchase_totals(
        t.purchases(), t.catalogue(), *by, default_model=t.default_model
    )


def _equipment(t: Testbed) -> DataFrame:
    """The numbered catalogue; numbering reads it several times, so it is stored first."""
    return dimensions.equipment(stored(t.catalogue(), "catalogue"))


def _stored_equipment(t: Testbed) -> DataFrame:
    """The numbered catalogue as a table, so that row-level joins know its size."""
    return stored(_equipment(t), "equipment")


def _purchase_ledger(t: Testbed, catalogue: DataFrame, sited: bool = False) -> DataFrame:
    return emissions.with_purchase_emission(
        t.purchases(staffed=True, sited=sited), catalogue, t.default_model
    )


def _trips(t: Testbed) -> DataFrame:
    return dimensions.trips(
        t.missions(), t.cities(), "sk_city", "sk_origin", "sk_destination"
    )


def _site_cities(t: Testbed) -> DataFrame:
    names = stored(dimensions.one_row_per_city(t.personnel()), "site-names")
    return dimensions.site_cities(names, t.places())


def _augmented(t: Testbed) -> DataFrame:
    known = stored(_site_cities(t), "site-cities")
    new = stored(dimensions.new_cities(known, t.named_missions()), "new-cities")
    return dimensions.augmented_cities(known, new, t.places())


def _all_cities(t: Testbed) -> DataFrame:
    """The cities of the augmented table, for checks that need no keys."""
    sites = dimensions.one_row_per_city(t.personnel())
    new = dimensions.new_cities(sites, t.named_missions())
    return dimensions.labelled_cities(sites, True).unionByName(
        dimensions.labelled_cities(new, False)
    )


def _years(t: Testbed) -> DataFrame:
    """First and last day of the years that missions and purchases touch."""
    days = t.table("orders").select(F.to_date("o_orderdate").alias("day")).unionByName(
        t.table("lineitem").select(F.to_date("l_shipdate").alias("day"))
    )
    return dimensions.whole_years(days, "day")


def _calendar(t: Testbed) -> DataFrame:
    return dimensions.calendar_between(_years(t))


def _bounds(t: Testbed) -> tuple[date, date]:
    """The calendar of DIM_DATE, by which the facts count their days."""
    return tuple(_years(t).first())


def _star(
    t: Testbed,
    first: date | None = None,
    last: date | None = None,
    catalogue: DataFrame | None = None,
) -> Star:
    """The star by the loads' own code, from rows as the files give them."""
    personnel = t.personnel().withColumn("nk_staff", F.col("nk_staff").cast("string"))
    reference = reference_of(
        personnel, t.catalogue() if catalogue is None else catalogue, t.places(), *_bounds(t)
    )
    staffed = {"nk_staff": F.col("nk_staff").cast("string")}
    missions = t.named_missions(first, last).withColumns(staffed).select(
        F.col("nk_mission").cast("string").alias("nk_mission"),
        *("nk_staff", "date_iso", "mission_type", "origin_city", "origin_country"),
        *("destination_city", "destination_country", "transport_raw", "round_trip"),
    )
    purchases = t.purchases(first, last, staffed=True).withColumns(staffed).select(
        "nk_equipment", "nk_staff", "date_iso", "type", "model"
    )
    return star_of(missions, purchases, reference, default_model=t.default_model)


# --- scans and sources ------------------------------------------------------------


def scan_date_window(t: Testbed) -> DataFrame:
    """Missions per day and site inside the period; the bounds reach the Parquet scan."""
    made = t.missions(*t.labels.period)
    return made.groupBy("date_iso", "sk_site").agg(F.count("*").alias("missions"))


def table_counts(t: Testbed) -> DataFrame:
    """Rows and columns of the eight tables of the loaded star."""
    return _star(t).counts()


def incremental_missing_dates(t: Testbed) -> DataFrame:
    """Days still to be loaded, and their missions, once the period has been."""
    loaded = t.raw_missions(*t.labels.period).select("date_iso")
    per_day = t.raw_missions().groupBy("date_iso").agg(F.count("*").alias("missions"))
    return per_day.join(loaded.distinct(), "date_iso", "left_anti").where(F.col("date_iso").isNotNull())


def warehouse_days(t: Testbed) -> DataFrame:
    """All missions saved by day; the second half of September read back, summed per day."""
    first, last = t.labels.months(9, 9)
    path = f"{shared_folder(t.spark)}/fact-mission-{uuid.uuid4().hex}"
    write_days(_ledger(t).select("nk_mission", "date_iso", "co2_kg"), path, "date_iso")
    later = read_days(t.spark, path, first.replace(day=16), last)
    return later.groupBy("date_iso").agg(
        F.count("*").alias("missions"), rounded(F.sum("co2_kg"), 3).alias("co2_kg")
    )


def warehouse_two_loads(t: Testbed) -> DataFrame:
    """Questions over a star saved in two halves, the catalogue having grown in between.

    The added equipment sorts before all other, so keys by rank alone would move.
    """
    root = f"{shared_folder(t.spark)}/star-{uuid.uuid4().hex}"
    first, last = t.labels.period
    middle = t.labels.months(8, 8)[0]
    save_star(_star(t, first, middle - timedelta(days=1)), root)
    added = t.catalogue().agg(
        F.lit("A").alias("type"), F.lit("A").alias("model"), F.lit(1.0).alias("co2_impact_kg_ref")
    )
    save_star(_star(t, middle, last, t.catalogue().unionByName(added)), root)
    source = StarSource(open_star(t.spark, root), t.labels)
    screens = QUESTIONS["q07_screens_managers"](source)
    cities = QUESTIONS["q16_top_destinations"](source)
    return screens.select(F.lit("screens").alias("label"), F.col("tco2e").alias("amount")).unionByName(
        cities.select(F.col("destination").alias("label"), F.col("co2_kg").alias("amount"))
    )


# --- dimensions -------------------------------------------------------------------


def dim_date(t: Testbed) -> DataFrame:
    return _calendar(t)


def dim_transport_type(t: Testbed) -> DataFrame:
    """All modes with the number of missions that used them."""
    used = _mission_totals(t).groupBy("transport_name").agg(F.sum("missions").alias("missions"))
    modes = dimensions.transport_types(t.spark)
    return modes.join(used, "transport_name", "left").select(
        *DIM_TRANSPORT_TYPE.names, F.coalesce("missions", F.lit(0)).alias("missions")
    )


def dim_equipment(t: Testbed) -> DataFrame:
    return _equipment(t)


def dim_city_sites(t: Testbed) -> DataFrame:
    return dimensions.published_cities(_site_cities(t))


def dim_city_augmented(t: Testbed) -> DataFrame:
    return _augmented(t)


def dim_staff(t: Testbed) -> DataFrame:
    cities = stored(_site_cities(t), "site-cities")
    table = dimensions.staff(t.personnel(), cities).select(*DIM_STAFF.names)
    return table.drop(*_HASHED, "last_name", "first_name")


def dim_trip(t: Testbed) -> DataFrame:
    return _to_grams(_trips(t), "distance_km")


# --- facts and emission rules -----------------------------------------------------


def fact_mission(t: Testbed) -> DataFrame:
    table = facts.fact_mission(_ledger(t), *_bounds(t)).select(*FACT_MISSION.names)
    return _to_grams(table.drop(*_HASHED), "co2_impact_kg")


def star_fact_mission(t: Testbed) -> DataFrame:
    """FACT_MISSION by the loads' own code, its trip read through DIM_TRIP and DIM_CITY."""
    star = _star(t)
    ends = star.dim_trip.select("sk_trip", "sk_city_origin", "sk_city_destination")
    rows = star.fact_mission.join(ends, "sk_trip", "left")
    for end in ("origin", "destination"):
        city = star.dim_city.select(
            F.col("sk_city").alias(f"sk_city_{end}"), F.col("city_name").alias(f"{end}_city")
        )
        rows = rows.join(city, f"sk_city_{end}", "left")
    named = rows.select(
        *("nk_mission", "sk_date_mission", "origin_city", "destination_city"),
        *("sk_transport_type", "mission_type", "round_trip_flg", "co2_impact_kg"),
    )
    return _to_grams(named, "co2_impact_kg")


def star_fact_equipment(t: Testbed) -> DataFrame:
    """FACT_EQUIPMENT by the loads' own code."""
    return _star(t).fact_equipment.drop(*_HASHED)


def star_keys(t: Testbed) -> DataFrame:
    """Distinct hashed keys of the star against distinct natural keys."""
    star = _star(t)
    tables = {
        "dim_staff": (star.dim_staff, "sk_staff", "nk_staff"),
        "fact_mission": (star.fact_mission, "sk_fact_mission", "nk_mission"),
        "fact_equipment": (star.fact_equipment, "sk_fact_equipment", "nk_equipment"),
    }
    counts = [
        table.groupBy(natural)
        .agg(F.min(key).alias("key"), F.countDistinct(key).alias("keys"))
        .agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("natural_keys"),
            F.countDistinct("key").alias("surrogate_keys"),
            F.max("keys").alias("most_per_natural_key"),
        )
        for name, (table, key, natural) in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def transport_haul_split(t: Testbed) -> DataFrame:
    split = _mission_totals(t)
    return split.groupBy("transport_name").agg(
        F.sum("missions").alias("missions"),
        rounded(F.min("distance_km"), 3).alias("shortest_km"),
        rounded(F.max("distance_km"), 3).alias("longest_km"),
    )


def mission_co2(t: Testbed) -> DataFrame:
    priced = _ledger(t).select("nk_mission", "distance_km", "co2_factor", "co2_kg")
    return _to_grams(priced, "distance_km", "co2_kg")


def fact_equipment(t: Testbed) -> DataFrame:
    ledger = _purchase_ledger(t, _stored_equipment(t))
    table = facts.fact_equipment(ledger, *_bounds(t)).select(*FACT_EQUIPMENT.names)
    return table.drop(*_HASHED)


def equipment_co2_lookup(t: Testbed) -> DataFrame:
    """Purchases and CO2 per type and by how the impact was found."""
    way = (
        F.when(F.col("exact"), "exact").when(F.col("listed"), "default").otherwise("none")
    )
    return (
        _purchase_totals(t)
        .groupBy("type", way.alias("found"))
        .agg(
            F.sum("purchases").alias("purchases"),
            rounded(F.sum("co2_kg"), 2).alias("co2_kg"),
        )
    )


def mission_mart(t: Testbed) -> DataFrame:
    ledger = _ledger(t, sited=True, carry=("city_name",))
    return _to_grams(facts.mission_mart(ledger), "distance_km", "co2_kg")


def equipment_mart(t: Testbed) -> DataFrame:
    catalogue = stored(t.catalogue(), "catalogue")
    return facts.equipment_mart(_purchase_ledger(t, catalogue, sited=True))


# --- joins ------------------------------------------------------------------------


def join_semi_staff(t: Testbed) -> DataFrame:
    """Missions of managers per month, the employees only used as a filter."""
    managers = t.staff().where(F.col("job_title") == t.labels.managers).select("nk_staff")
    made = t.raw_missions().join(managers, "nk_staff", "left_semi")
    return made.groupBy(F.month("date_iso").cast("long").alias("month")).agg(
        F.count("*").alias("missions")
    )


def join_inner_site(t: Testbed) -> DataFrame:
    """Missions per office and sector."""
    made = t.missions(sited=True).where(F.col("site_name").isNotNull())
    return made.groupBy("site_name", "activity_sector").agg(F.count("*").alias("missions"))


def join_left_dims(t: Testbed) -> DataFrame:
    """How many missions per raw transport find their day, employee, ends and mode."""
    days = _calendar(t)
    modes = F.broadcast(dimensions.transport_types(t.spark))
    joined = (
        _ledger(t)
        .drop("sk_transport_type")
        .join(days, "date_iso", "left")
        .join(modes, "transport_name", "left")
    )
    return joined.groupBy("transport_raw").agg(
        F.count("*").alias("missions"),
        F.count("sk_date").alias("with_date"),
        F.count("staff_known").alias("with_staff"),
        F.count("sk_origin").alias("with_origin"),
        F.count("sk_transport_type").alias("with_mode"),
    )


def join_left_trip(t: Testbed) -> DataFrame:
    """Every mission left-joined to DIM_TRIP on both ends."""
    trips = stored(_trips(t), "trips")
    ends = {"sk_city_origin": F.col("sk_origin"), "sk_city_destination": F.col("sk_destination")}
    rows = t.missions().withColumns(ends).select("nk_mission", *ends)
    joined = rows.join(trips, list(ends), "left")
    return _to_grams(joined, "distance_km")


# --- sets and scalars -------------------------------------------------------------


def distinct_trips(t: Testbed) -> DataFrame:
    return t.named_missions().select("origin_city", "destination_city").distinct()


def union_distinct_cities(t: Testbed) -> DataFrame:
    return dimensions.mission_ends(t.named_missions()).distinct()


def map_lookup_titles(t: Testbed) -> DataFrame:
    return t.staff().groupBy("title_raw", "job_title", "activity_sector").agg(
        F.count("*").alias("employees")
    )


def round_trip_flag(t: Testbed) -> DataFrame:
    return t.raw_missions().groupBy("round_trip_raw", "round_trip").agg(
        F.count("*").alias("missions")
    )


def surrogate_trip_key(t: Testbed) -> DataFrame:
    key = keys.trip_key(F.col("sk_origin"), F.col("sk_destination"))
    return t.missions().groupBy(key.alias("sk_trip")).agg(F.count("*").alias("missions"))


def _arrivals(t: Testbed) -> DataFrame:
    return t.raw_missions().groupBy(F.col("sk_destination").alias("sk_city")).agg(
        F.count("*").alias("missions")
    )


def country_iso2_lookup(t: Testbed) -> DataFrame:
    """Missions per country of destination, named and as ISO code."""
    return (
        _arrivals(t)
        .join(t.cities(regions=True), "sk_city")
        .groupBy("country_raw", "country_iso2")
        .agg(F.sum("missions").alias("missions"))
    )


def city_reference_lookup(t: Testbed) -> DataFrame:
    """Destinations with coordinates and clock, NULL where the reference has none."""
    named = t.cities().select("sk_city", "city_name")
    return (
        _arrivals(t)
        .join(named, "sk_city")
        .join(t.places(), "city_name", "left")
        .select("city_name", "lat", "lon", "timezone_iana", "missions")
    )


def trip_distance(t: Testbed) -> DataFrame:
    """Kilometres flown, driven or ridden one way per pair of cities."""
    totals = _mission_totals(t)
    return totals.groupBy("sk_origin", "sk_destination").agg(
        rounded(F.max("distance_km"), 3).alias("distance_km"),
        rounded(F.sum(F.col("missions") * F.col("distance_km")), 2).alias("total_km"),
    )


# --- profiles and data quality ----------------------------------------------------


def staff_by_title(t: Testbed) -> DataFrame:
    return quality.counted(t.staff(), "job_title", "employees")


def staff_by_sector(t: Testbed) -> DataFrame:
    return quality.counted(t.staff(), "activity_sector", "employees")


def staff_by_site(t: Testbed) -> DataFrame:
    return quality.counted(t.staff(), "sk_site", "employees")


def missions_by_type(t: Testbed) -> DataFrame:
    return quality.counted(t.raw_missions(), "mission_type", "missions")


def city_counts(t: Testbed) -> DataFrame:
    return quality.city_counts(_all_cities(t))


def dq_city_no_country(t: Testbed) -> DataFrame:
    return quality.cities_without_country(_all_cities(t))


def longest_trips(t: Testbed) -> DataFrame:
    return _to_grams(quality.longest_trips(_trips(t)), "distance_km")


def dq_trip_no_distance(t: Testbed) -> DataFrame:
    return quality.trips_without_distance(_trips(t))


def total_mission_co2(t: Testbed) -> DataFrame:
    return quality.total_tonnes(_mission_totals(t), "missions")


def _co2_known() -> Column:
    return F.col("has_factor") & F.col("located")


def dq_mission_no_co2(t: Testbed) -> DataFrame:
    totals = _mission_totals(t, "mission_type")
    return quality.without_co2(totals, "missions", "mission_type", _co2_known())


def total_equipment_co2(t: Testbed) -> DataFrame:
    return quality.total_tonnes(_purchase_totals(t), "purchases")


def dq_equipment_no_co2(t: Testbed) -> DataFrame:
    known = F.col("co2_kg").isNotNull()
    return quality.without_co2(_purchase_totals(t), "purchases", "type", known)


def dq_key_uniqueness(t: Testbed) -> DataFrame:
    """Repeated keys would multiply facts; there should be none."""
    catalogue = t.catalogue()
    is_default = vocabulary.is_default_model(F.col("model"), t.default_model)
    checks = [
        ("dim_staff", t.staff(), ["nk_staff"]),
        ("dim_city", t.cities(), ["city_name"]),
        ("dim_equipment", catalogue, ["type", "model"]),
        ("dim_equipment default", catalogue.where(is_default), ["type"]),
        ("fact_mission", t.raw_missions(), ["nk_mission"]),
        ("fact_equipment", t.purchases(), ["nk_equipment"]),
    ]
    return reduce(
        DataFrame.unionByName, [quality.repeated_keys(n, f, *k) for n, f, k in checks]
    )


# --- streaming --------------------------------------------------------------------


def stream_daily_totals(t: Testbed) -> DataFrame:
    return run_stream(t.spark, t.folder, "events.parquet", t.layout("events"), t.staff())


OPERATORS: dict[str, Callable[[Testbed], DataFrame]] = {
    operator.__name__: operator
    for operator in (
        scan_date_window,
        table_counts,
        incremental_missing_dates,
        warehouse_days,
        warehouse_two_loads,
        dim_date,
        dim_transport_type,
        dim_equipment,
        dim_city_sites,
        dim_city_augmented,
        dim_staff,
        dim_trip,
        fact_mission,
        star_fact_mission,
        star_fact_equipment,
        star_keys,
        transport_haul_split,
        mission_co2,
        fact_equipment,
        equipment_co2_lookup,
        mission_mart,
        equipment_mart,
        join_semi_staff,
        join_inner_site,
        join_left_dims,
        join_left_trip,
        distinct_trips,
        union_distinct_cities,
        map_lookup_titles,
        round_trip_flag,
        surrogate_trip_key,
        country_iso2_lookup,
        city_reference_lookup,
        trip_distance,
        staff_by_title,
        staff_by_sector,
        staff_by_site,
        missions_by_type,
        city_counts,
        dq_city_no_country,
        longest_trips,
        dq_trip_no_distance,
        total_mission_co2,
        dq_mission_no_co2,
        total_equipment_co2,
        dq_equipment_no_co2,
        dq_key_uniqueness,
        stream_daily_totals,
    )
}
