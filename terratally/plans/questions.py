"""The twenty business questions.

Each takes a source (``Star`` or ``Testbed``) and returns a DataFrame. A question narrows
the rows first, so dates, titles and sites reach the scans; counts equal rows; prices the
groups; and adds up. Rankings use the unrounded sums and end on the group key, so ties
come out the same every time.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terratally.functions.measures import age_in_years, rounded, tonnes, zero_if_null
from terratally.functions.vocabulary import EMISSION_FACTORS, FLIGHT
from terratally.operators.emissions import (
    mission_totals,
    priced_missions,
    purchase_totals,
)
from terratally.plans.sources import Source
from terratally.sources.warehouse import stored

_MODE_COLUMNS = ("short_haul", "long_haul", "train", "taxi", "public_transport")


def _mission_sums(source: Source, missions: DataFrame, *by: str, **options) -> DataFrame:
    return mission_totals(missions, source.cities(), *by, **options)


def _purchase_sums(source: Source, purchases: DataFrame, *by: str) -> DataFrame:
    return purchase_totals(
        purchases, source.catalogue(), *by, default_model=source.default_model
    )


def _total_tonnes(frame: DataFrame) -> DataFrame:
    return frame.agg(tonnes(zero_if_null(F.sum("co2_kg"))).alias("tco2e"))


def _at_site(*names: str) -> Column:
    return F.col("site_name").isin(*names)


# --- head counts ------------------------------------------------------------------


def q01_managers_on_site(source: Source) -> DataFrame:
    names = source.labels
    chosen = source.staff(sited=True).where(
        (F.col("job_title") == names.managers) & _at_site(names.paris)
    )
    return chosen.agg(F.count("*").alias("employees"))


def q02_data_engineers_country(source: Source) -> DataFrame:
    names = source.labels
    chosen = source.staff(sited=True).where(
        (F.col("job_title") == names.data_engineers)
        & (F.col("site_country") == names.us_country)
    )
    return chosen.agg(F.count("*").alias("employees"))


def q03_it_engineers(source: Source) -> DataFrame:
    chosen = source.staff().where(F.col("job_title") == source.labels.it_engineers)
    return chosen.agg(F.count("*").alias("employees"))


# --- purchases --------------------------------------------------------------------


def q04_desktop_count(source: Source) -> DataFrame:
    names = source.labels
    is_desktop = F.lit(False)
    for pattern in names.desktops:
        is_desktop = is_desktop | F.col("type").like(pattern)
    bought = source.purchases(*names.months(6, 9)).where(is_desktop)
    listed = _purchase_sums(source, bought).where("listed")
    return listed.agg(F.coalesce(F.sum("purchases"), F.lit(0)).alias("purchases"))


def q05_desktop_co2(source: Source) -> DataFrame:
    names = source.labels
    bought = source.purchases(*names.period).where(
        F.col("type") == names.desktop_without_screen
    )
    return _total_tonnes(_purchase_sums(source, bought))


def q06_laptops_role_sites(source: Source) -> DataFrame:
    names = source.labels
    bought = source.purchases(*names.period, sited=True).where(
        (F.col("type") == names.laptop)
        & (F.col("job_title") == names.data_engineers)
        & _at_site(names.london, names.new_york)
    )
    return _total_tonnes(_purchase_sums(source, bought))


def q07_screens_managers(source: Source) -> DataFrame:
    names = source.labels
    bought = source.purchases(*names.months(7, 9), staffed=True).where(
        (F.col("type") == names.screen) & (F.col("job_title") == names.managers)
    )
    return _total_tonnes(_purchase_sums(source, bought))


# --- missions ---------------------------------------------------------------------


def q08_eu_missions(source: Source) -> DataFrame:
    names = source.labels
    made = source.missions(*names.period, sited=True).where(_at_site(*names.eu_sites))
    return _total_tonnes(_mission_sums(source, made))


def q09_top_days(source: Source) -> DataFrame:
    names = source.labels
    flown = source.missions(*names.period, sited=True).where(
        (F.col("transport_raw") == FLIGHT) & _at_site(*names.eu_sites)
    )
    days = _mission_sums(source, flown, "date_iso").where("has_factor")
    return _top(days, "date_iso", 5)


def q12_intersite(source: Source) -> DataFrame:
    made = source.missions(*source.labels.months(9, 9))
    ended = _mission_sums(source, made, carry=("is_org_site",))
    return _total_tonnes(
        ended.where(F.col("origin_is_org_site") & F.col("destination_is_org_site"))
    )


def q13_seminars_site(source: Source) -> DataFrame:
    names = source.labels
    made = source.missions(*names.months(7, 7), sited=True).where(
        (F.col("mission_type") == names.seminar) & _at_site(names.los_angeles)
    )
    return _total_tonnes(_mission_sums(source, made))


def q14_conference_sector(source: Source) -> DataFrame:
    names = source.labels
    made = source.missions(*names.months(5, 9)).where(
        (F.col("mission_type") == names.conference) & F.col("staff_known")
    )
    return _ranked(_mission_sums(source, made, "activity_sector"), "activity_sector")


def q15_avg_age(source: Source) -> DataFrame:
    names = source.labels
    trained = source.missions(*names.months(7, 9)).where(
        (F.col("mission_type") == names.training)
        & (F.col("job_title") == names.data_engineers)
    )
    age = age_in_years(F.col("date_iso"), F.col("birth_date"))
    return trained.agg(F.round(zero_if_null(F.avg(age)), 1).alias("avg_age"))


def q16_top_destinations(source: Source) -> DataFrame:
    made = source.missions(*source.labels.period)
    ended = _mission_sums(source, made, carry=("city_name",)).where(
        F.col("origin_city_name").isNotNull() & F.col("destination_city_name").isNotNull()
    )
    return _top(
        ended.withColumnRenamed("destination_city_name", "destination"), "destination", 5
    )


def q17_top_mission_types(source: Source) -> DataFrame:
    names = source.labels
    made = source.missions(*names.months(5, 5), sited=True).where(
        (F.col("job_title") == names.managers) & _at_site(*names.eu_sites)
    )
    return _top(_mission_sums(source, made, "mission_type"), "mission_type", 3)


def q18_top_missions(source: Source) -> DataFrame:
    names = source.labels
    made = source.missions(*names.period, sited=True).where(_at_site(names.paris))
    if "co2_kg" not in made.columns:
        made = priced_missions(made, source.cities())
    return (
        made.where("has_factor")
        .orderBy(F.col("co2_kg").desc(), "nk_mission")
        .limit(5)
        .select(
            "nk_mission",
            "mission_type",
            "transport_name",
            rounded(F.col("co2_kg"), 1).alias("co2_kg"),
        )
    )


def q19_monthly_transport_site(source: Source) -> DataFrame:
    made = source.missions(*source.labels.period, sited=True).where(
        F.col("site_name").isNotNull()
    )
    months = made.withColumn("month", F.month("date_iso").cast("long"))
    summed = _mission_sums(source, months, "site_name", "month").where("has_factor")
    return (
        summed.groupBy("site_name", "month", "transport_name")
        .agg(tonnes(F.sum("co2_kg"), 2).alias("tco2e"))
        .orderBy("site_name", "month", "transport_name")
    )


def q19_pivot(source: Source) -> DataFrame:
    """One row per site and month, one column per mode; months seen anywhere are kept."""
    names = dict(zip(EMISSION_FACTORS, _MODE_COLUMNS, strict=True))
    labels = source.labels
    monthly = stored(q19_monthly_transport_site(source), "site-months")
    wide = (
        monthly.groupBy("site_name", "month")
        .pivot("transport_name", list(names))
        .agg(F.sum("tco2e"))
        .withColumnsRenamed(names)
    )
    period = F.sequence(F.lit(labels.first_month).cast("long"), F.lit(labels.last_month).cast("long"))
    sites = monthly.select("site_name").distinct()
    spine = sites.withColumn("month", F.explode(period)).join(
        monthly.select("month").distinct(), "month", "left_semi"
    )
    return (
        spine.join(wide, ["site_name", "month"], "left")
        .select("site_name", "month", *(zero_if_null(F.col(mode)).alias(mode) for mode in _MODE_COLUMNS))
        .orderBy("site_name", "month")
    )


# --- missions and purchases together ----------------------------------------------


def _both_totals(missions: DataFrame, purchases: DataFrame, key: str) -> DataFrame:
    """Sums of both facts per ``key`` from one union instead of a full outer join."""
    nothing = F.lit(None).cast("double")
    tagged = missions.select(
        key, F.col("co2_kg").alias("mission_kg"), nothing.alias("equip_kg")
    ).unionByName(
        purchases.select(key, nothing.alias("mission_kg"), F.col("co2_kg").alias("equip_kg"))
    )
    return tagged.groupBy(key).agg(
        F.sum("mission_kg").alias("mission_kg"), F.sum("equip_kg").alias("equip_kg")
    )


def _total_by_staff_attribute(source: Source, key: str, sited: bool) -> DataFrame:
    period = source.labels.period
    made = source.missions(*period, sited=sited).where("staff_known")
    bought = source.purchases(*period, staffed=True, sited=sited).where("staff_known")
    both = _both_totals(
        _mission_sums(source, made, key), _purchase_sums(source, bought, key), key
    )
    total = zero_if_null(F.col("mission_kg")) + zero_if_null(F.col("equip_kg"))
    return both.orderBy(total.desc(), key).select(
        key,
        rounded(F.col("mission_kg"), 1).alias("co2_mission_kg"),
        rounded(F.col("equip_kg"), 1).alias("co2_equip_kg"),
        rounded(total, 1).alias("co2_total_kg"),
    )


def q10_sector_total(source: Source) -> DataFrame:
    return _total_by_staff_attribute(source, "activity_sector", sited=False)


def q11_site_total(source: Source) -> DataFrame:
    return _total_by_staff_attribute(source, "site_name", sited=True)


def q20_monthly_total(source: Source) -> DataFrame:
    period = source.labels.period
    month = F.month("date_iso").cast("long")
    made = source.missions(*period).withColumn("month", month)
    bought = source.purchases(*period).withColumn("month", month)
    both = _both_totals(
        _mission_sums(source, made, "month"), _purchase_sums(source, bought, "month"), "month"
    )
    monthly = both.select(
        "month",
        zero_if_null(tonnes(F.col("mission_kg"), 2)).alias("tco2e_missions"),
        zero_if_null(tonnes(F.col("equip_kg"), 2)).alias("tco2e_equipements"),
    )
    # The total adds the two figures as reported, that is after rounding.
    total = F.round(F.col("tco2e_missions") + F.col("tco2e_equipements"), 2)
    return monthly.withColumn("tco2e_total", total).orderBy("month")


# --- rankings ---------------------------------------------------------------------


def _summed(groups: DataFrame, key: str) -> DataFrame:
    return groups.groupBy(key).agg(F.sum("co2_kg").alias("kg"))


def _reported(key: str) -> list[Column]:
    return [F.col(key), rounded(F.col("kg"), 1).alias("co2_kg")]


def _ranked(groups: DataFrame, key: str) -> DataFrame:
    return _summed(groups, key).orderBy(F.col("kg").desc(), key).select(*_reported(key))


def _top(groups: DataFrame, key: str, k: int) -> DataFrame:
    best = _summed(groups, key).orderBy(F.col("kg").desc(), key).limit(k)
    return best.select(*_reported(key))


QUESTIONS: dict[str, Callable[[Source], DataFrame]] = {
    question.__name__: question
    for question in (
        q01_managers_on_site,
        q02_data_engineers_country,
        q03_it_engineers,
        q04_desktop_count,
        q05_desktop_co2,
        q06_laptops_role_sites,
        q07_screens_managers,
        q08_eu_missions,
        q09_top_days,
        q10_sector_total,
        q11_site_total,
        q12_intersite,
        q13_seminars_site,
        q14_conference_sector,
        q15_avg_age,
        q16_top_destinations,
        q17_top_mission_types,
        q18_top_missions,
        q19_monthly_transport_site,
        q19_pivot,
        q20_monthly_total,
    )
}
