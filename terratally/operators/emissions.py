"""Emission rules, applied to single rows or to groups of equal rows.

What a mission emits depends only on its two ends, the transport and the return flag;
what a purchase emits only on type and model. So totals are taken the other way round:
count equal rows first, where the partial aggregation collapses any hot key inside each
map task, and price the few groups that remain. Row-level results use the same pricing
with every row as its own group.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terratally.functions import vocabulary
from terratally.operators.dimensions import with_ends, with_trip_distance
from terratally.sources.warehouse import stored

_MISSION_RULE_INPUTS = ("sk_origin", "sk_destination", "transport_raw", "round_trip")
_MISSION_RULE_RESULTS = ("sk_origin", "sk_destination", "transport_name", "has_factor")


# --- missions ---------------------------------------------------------------------


def transport_mode(raw: Column, distance: Column) -> Column:
    """Flights split at 1000 km; a flight of unknown length keeps its raw name."""
    flight = raw == vocabulary.FLIGHT
    far = distance >= vocabulary.LONG_HAUL_FROM_KM
    return (
        F.when(flight & far, vocabulary.LONG_HAUL)
        .when(flight & ~far, vocabulary.SHORT_HAUL)
        .otherwise(raw)
    )


def _has_factor(raw: Column, located: Column) -> Column:
    """Same answer as looking the mode up, but cheap enough to be pushed to the scan."""
    listed = raw.isin(*vocabulary.EMISSION_FACTORS)
    return F.coalesce(F.when(raw == vocabulary.FLIGHT, located).otherwise(listed), F.lit(False))


def _by_mode(values: list, mode: Column) -> Column:
    entries = zip(vocabulary.EMISSION_FACTORS, values, strict=True)
    literal = ", ".join(f"{vocabulary.sql_text(name)}, {value}" for name, value in entries)
    return F.expr(f"map({literal})")[mode]


def with_mission_emission(measured: DataFrame) -> DataFrame:
    """Price rows that have ``distance_km`` and ``located``.

    Adds transport_name, sk_transport_type, co2_factor, has_factor and co2_kg (of one
    mission). To select missions by whether they could be priced, filter on ``located``
    and ``has_factor``: unlike co2_kg they cost nothing to push down.
    """
    factors = vocabulary.EMISSION_FACTORS.values()
    mode = F.col("transport_name")
    ways = F.when(F.col("round_trip"), 2).otherwise(1)
    return measured.select(
        "*",
        transport_mode(F.col("transport_raw"), F.col("distance_km")).alias("transport_name"),
        _has_factor(F.col("transport_raw"), F.col("located")).alias("has_factor"),
        _by_mode([f"{key}L" for key, _ in enumerate(factors, 1)], mode).alias(
            "sk_transport_type"
        ),
        _by_mode([f"{factor}D" for factor in factors], mode).alias("co2_factor"),
        (F.col("distance_km") * F.col("co2_factor") * ways).alias("co2_kg"),
    )


def priced_missions(
    missions: DataFrame, cities: DataFrame, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Missions, or groups of equal ones, with distance, mode and CO2; ends are city keys.

    The distance is worked out for each row, so this is for few rows.
    """
    ended = with_ends(missions, cities, "sk_origin", "sk_destination", "sk_city", carry)
    return with_mission_emission(with_trip_distance(ended))


def mission_ledger(
    missions: DataFrame, cities: DataFrame, carry: tuple[str, ...] = ()
) -> DataFrame:
    """The same for every mission: distances come from a stored table of the pairs that occur.

    The pairs are counted out of two columns of the missions, at most one row per ordered pair of
    cities, and written once, so the planner knows whether they can be broadcast.
    """
    ends = ("sk_origin", "sk_destination")
    pairs = missions.select(*ends).distinct()
    known = stored(with_trip_distance(with_ends(pairs, cities, *ends, "sk_city", carry)), "distances")
    side = known.withColumnsRenamed({end: f"_{end}" for end in ends})
    same = [missions[end].eqNullSafe(side[f"_{end}"]) for end in ends]
    measured = missions.join(side, same, "left").drop(*(f"_{end}" for end in ends))
    return with_mission_emission(measured)


def mission_ledger_by_trip(
    missions: DataFrame, cities: DataFrame, trips: DataFrame
) -> DataFrame:
    """The same from city names and a DIM_TRIP table, where distances are ready."""
    for end in ("origin", "destination"):
        side = cities.select(
            F.col("city_name").alias(f"{end}_city"), F.col("sk_city").alias(f"sk_{end}")
        )
        missions = missions.join(side, f"{end}_city", "left")
    pairs = trips.select(
        F.col("sk_city_origin").alias("sk_origin"),
        F.col("sk_city_destination").alias("sk_destination"),
        "distance_km",
    )
    measured = missions.join(pairs, ["sk_origin", "sk_destination"], "left")
    return with_mission_emission(
        measured.withColumn("located", F.col("distance_km").isNotNull())
    )


def mission_totals(
    missions: DataFrame, cities: DataFrame, *by: str, carry: tuple[str, ...] = ()
) -> DataFrame:
    """CO2 and number of missions per ``by``, ends and transport mode.

    ``carry`` names city columns to attach to both ends of the groups. ``missions`` that
    already have ``co2_kg`` (a loaded fact) are only summed up.
    """
    if "co2_kg" in missions.columns:
        groups = dict.fromkeys([*_MISSION_RULE_RESULTS, *by])
        summed = missions.groupBy(*groups).agg(
            F.count("*").alias("missions"), F.sum("co2_kg").alias("co2_kg")
        )
        if not carry:
            return summed
        return with_ends(summed, cities, "sk_origin", "sk_destination", "sk_city", carry)
    groups = dict.fromkeys([*_MISSION_RULE_INPUTS, *by])
    counted = missions.groupBy(*groups).agg(F.count("*").alias("missions"))
    priced = priced_missions(counted, cities, carry)
    return priced.withColumn("co2_kg", F.col("missions") * F.col("co2_kg"))


# --- purchases --------------------------------------------------------------------


def with_purchase_emission(
    rows: DataFrame, catalogue: DataFrame, default_model: str = vocabulary.DEFAULT_MODEL
) -> DataFrame:
    """Look (type, model) up in the catalogue, else the default model of the type.

    Adds co2_kg, ``listed`` (either look-up found a row), ``exact`` and, when the catalogue has it,
    sk_equipment. Key and value fall back separately. The pairs that occur are looked up once each
    and stored, and rows are joined to them; a pair stands there once, so no row is doubled.
    """
    pairs = rows.select("type", "model").distinct()
    known = stored(priced_purchases(pairs, catalogue, default_model), "purchase-prices")
    side = known.withColumnsRenamed({"type": "_type", "model": "_model"})
    same = [rows["type"].eqNullSafe(side["_type"]), rows["model"].eqNullSafe(side["_model"])]
    return rows.join(side, same, "left").drop("_type", "_model")


def priced_purchases(
    rows: DataFrame, catalogue: DataFrame, default_model: str = vocabulary.DEFAULT_MODEL
) -> DataFrame:
    """``with_purchase_emission`` for few rows: one join with a row per type.

    That row maps the type's models to key and impact and holds those of its default model; a model
    listed twice under a type is an error. Of several spellings of the default the first by name
    counts.
    """
    wanted = [c for c in ("sk_equipment", "co2_impact_kg_ref") if c in catalogue.columns]
    entry = F.struct(*wanted, F.lit(True).alias("hit"))
    model = F.col("model")
    is_default = vocabulary.is_default_model(model, default_model)
    per_type = catalogue.where(F.col("type").isNotNull()).groupBy(F.col("type").alias("_type")).agg(
        F.map_from_entries(
            F.collect_list(F.when(model.isNotNull(), F.struct(model, entry.alias("entry"))))
        ).alias("_models"),
        F.min_by(F.when(is_default, entry), F.when(is_default, model)).alias("_default"),
    )
    found = rows.join(per_type, F.col("type") == F.col("_type"), "left").withColumn(
        "_exact", F.try_element_at("_models", F.trim("model"))
    )

    def first_of(name: str) -> Column:
        return F.coalesce(f"_exact.{name}", f"_default.{name}")

    return found.select(
        *rows.columns,
        *[first_of("sk_equipment").alias("sk_equipment") for c in wanted if c == "sk_equipment"],
        F.coalesce(first_of("hit"), F.lit(False)).alias("listed"),
        F.coalesce("_exact.hit", F.lit(False)).alias("exact"),
        first_of("co2_impact_kg_ref").alias("co2_kg"),
    )


def purchase_totals(
    purchases: DataFrame,
    catalogue: DataFrame,
    *by: str,
    default_model: str = vocabulary.DEFAULT_MODEL,
) -> DataFrame:
    """CO2 and number of purchases per ``by``, type and model.

    ``purchases`` that already carry ``co2_kg`` (a loaded fact) are only summed up.
    """
    if "co2_kg" in purchases.columns:
        groups = ["type", "listed", *by]
        return purchases.groupBy(*dict.fromkeys(groups)).agg(
            F.count("*").alias("purchases"), F.sum("co2_kg").alias("co2_kg")
        )
    groups = ["type", "model", *by]
    counted = purchases.groupBy(*dict.fromkeys(groups)).agg(F.count("*").alias("purchases"))
    priced = priced_purchases(counted, catalogue, default_model)
    return priced.withColumn("co2_kg", F.col("purchases") * F.col("co2_kg"))
