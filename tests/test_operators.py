from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terratally.functions import keys, measures, vocabulary
from terratally.operators import dimensions, emissions, facts
from terratally.operators.joins import salted_lookup

CITIES = [
    (1, "Paris", 48.8566, 2.3522, True),
    (2, "Berlin", 52.52, 13.405, True),
    (3, "Atlantis", None, None, False),
    (4, "Shanghai", 31.2304, 121.4737, True),
]


@pytest.fixture(scope="module")
def cities(spark):
    return spark.createDataFrame(
        CITIES, "sk_city long, city_name string, lat double, lon double, is_org_site boolean"
    )


# --- vocabulary, dates and keys ---------------------------------------------------


def column_values(spark, values, build, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in frame.orderBy("i").select(build(F.col("v"))).collect()]


def test_every_spelling_translates(spark):
    for mapping, build in (
        (vocabulary.JOB_TITLES, vocabulary.job_title),
        (vocabulary.MISSION_TYPES, vocabulary.mission_type),
        (vocabulary.COUNTRIES, vocabulary.country_iso2),
    ):
        assert column_values(spark, [*mapping, "?", None], build) == [
            *mapping.values(),
            None,
            None,
        ]
    assert set(vocabulary.JOB_TITLES.values()) == set(vocabulary.SECTORS)


def test_empty_vocabulary_gives_null(spark):
    assert column_values(spark, ["x"], lambda c: vocabulary.translate(c, {})) == [None]


def test_return_flags(spark):
    flags = ["oui", "yes", "ja", "1", "non", "no", "nein", "0", None]
    found = column_values(spark, flags, vocabulary.is_round_trip)
    assert found == [True] * 4 + [False] * 5


def test_unreadable_dates_are_null(spark):
    found = column_values(
        spark,
        ["2026-05-01 23:59:59", "2026-05-01", "gestern", None],
        lambda c: measures.parsed_date(c, measures.SECOND_FORMAT),
    )
    assert found == [date(2026, 5, 1), None, None, None]


def test_age_counts_whole_years(spark):
    frame = spark.createDataFrame(
        [("2026-02-28", "2000-02-29"), ("2026-02-27", "2000-02-29"), ("2026-06-14", "1990-06-15")],
        "d string, b string",
    )
    age = measures.age_in_years(F.to_date("d"), F.to_date("b"))
    assert [r[0] for r in frame.select(age).collect()] == [26, 25, 35]


def test_rounding_does_not_hang_on_the_last_bit(spark):
    noisy = [1234.25, 1234.2499999999998, 0.1 + 0.2]
    found = column_values(spark, noisy, lambda c: measures.rounded(c, 1), "double")
    assert found == [1234.3, 1234.3, 0.3]


def test_calendar(spark):
    days = dimensions.calendar(spark)
    assert days.count() == 730
    assert days.agg(F.min("sk_date"), F.max("sk_date")).first()[:] == (1, 730)
    known = days.where("date_iso = '2026-03-01'").first().sk_date
    frame = spark.createDataFrame([("2026-03-01",), ("2025-12-31",), (None,)], "d string")
    key = measures.calendar_key(
        F.to_date("d"), dimensions.CALENDAR_FIRST, dimensions.CALENDAR_LAST
    )
    assert [r[0] for r in frame.select(key).collect()] == [known, None, None]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text("abcé", max_size=4), unique=True, max_size=60), st.integers(0, 9))
def test_dense_key_numbers_in_order(spark, names, after):
    frame = spark.createDataFrame([(n,) for n in names], "name string").repartition(5)
    found = keys.with_dense_key(frame, "k", [F.col("name")], after=after)
    expected = {n: after + i for i, n in enumerate(sorted(names, key=str.encode), 1)}
    assert {r.name: r.k for r in found.collect()} == expected


def test_dense_key_numbers_many_copies(spark):
    rows = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, "m").otherwise(F.col("id").cast("string")).alias("name")
    )
    found = keys.with_dense_key(rows, "k", [F.col("name")])
    span = found.agg(F.count("*"), F.countDistinct("k"), F.min("k"), F.max("k")).first()
    assert tuple(span) == (60000, 60000, 1, 60000)
    # "m" sorts after all digits.
    hot = found.where("name = 'm'").agg(F.count("*"), F.min("k")).first()
    assert tuple(hot) == (20000, 40001)


def test_places_within_groups(spark):
    """A group with half of all rows, groups of one, and no group name at all."""
    rows = spark.range(5000).select(
        F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 5 > 0, F.concat(F.lit("g"), F.col("id") % 700)).alias("g"),
        F.pmod(F.xxhash64("id"), F.lit(100000)).alias("v"),
        "id",
    )
    found = keys.numbered(rows, "place", [F.col("v"), F.col("id")], ["g"]).collect()
    groups = {}
    for row in found:
        groups.setdefault(row.g, []).append(row)
    assert len(found) == 5000 and None in groups
    for members in groups.values():
        members.sort(key=lambda r: (r.v, r.id))
        assert [r.place for r in members] == list(range(len(members)))
    whole = keys.numbered(rows, "place", [F.col("id")]).collect()
    assert {(r.id, r.place) for r in whole} == {(i, i) for i in range(5000)}
    assert keys.numbered(rows.limit(0), "place", [F.col("id")], ["g"]).collect() == []


def test_trip_keys_are_unique(spark):
    ends = spark.range(40).withColumnRenamed("id", "o")
    pairs = ends.select("o", F.explode(F.sequence(F.lit(0), F.lit(39))).alias("d"))
    found = pairs.select(keys.trip_key(F.col("o"), F.col("d")).alias("k"))
    assert found.distinct().count() == 1600


# --- dimensions -------------------------------------------------------------------


def test_cities_keep_known_keys_and_number_new_ones(spark):
    places = spark.createDataFrame(
        [("Paris", 48.8, 2.3, "Europe/Paris"), ("Lima", -12.0, -77.0, "America/Lima")],
        "city_name string, lat double, lon double, timezone_iana string",
    )
    personnel = spark.createDataFrame(
        [("Paris", "France"), ("Berlin", "Allemagne"), ("Paris", "France"), (None, None)],
        "city_name string, country string",
    )
    initial = dimensions.site_cities(dimensions.one_row_per_city(personnel), places)
    missions = spark.createDataFrame(
        [
            ("Paris", "Frankreich", "Lima", "Peru"),
            ("Zagreb", "Croatie", "Berlin", "X"),
            ("Lima", "Mexico", None, None),
        ],
        "origin_city string, origin_country string, "
        "destination_city string, destination_country string",
    )
    new = dimensions.new_cities(initial, missions)
    found = dimensions.augmented_cities(initial, new, places).orderBy("sk_city").collect()
    assert [(r.sk_city, r.city_name, r.country_iso2, r.is_org_site) for r in found] == [
        (1, "Berlin", "DE", True),
        (2, "Paris", "FR", True),
        (3, "Lima", "MX", False),
        (4, "Zagreb", None, False),
    ]
    assert [r.timezone_iana for r in found] == [None, "Europe/Paris", "America/Lima", None]


def test_equipment_is_ordered_with_blanks_first(spark):
    raw = spark.createDataFrame(
        [("b", "x", "1.5"), ("a", None, "2"), ("a", "y", "oops"), ("b", "a", None)],
        "Type string, `Modèle` string, Impact string",
    )
    found = dimensions.equipment(dimensions.cleaned_impacts(raw)).orderBy("sk_equipment")
    assert [tuple(r) for r in found.collect()] == [
        (1, "a", None, 2.0),
        (2, "a", "y", None),
        (3, "b", "a", None),
        (4, "b", "x", 1.5),
    ]


# --- emission rules ---------------------------------------------------------------


def priced(spark, cities, rows):
    missions = spark.createDataFrame(
        rows, "id int, sk_origin long, sk_destination long, transport_raw string, round_trip boolean"
    )
    return {r.id: r for r in emissions.mission_ledger(missions, cities).collect()}


def test_mission_rules(spark, cities):
    found = priced(
        spark,
        cities,
        [
            (1, 1, 2, "Avion", False),
            (2, 1, 4, "Avion", True),
            (3, 1, 3, "Avion", True),
            (4, 1, 2, "Bateau", True),
            (5, 1, 2, None, True),
            (6, 1, 1, "Taxi", True),
            (7, 1, 3, "Train", True),
            (8, None, 2, "Train", True),
            (9, 1, 2, "Train", True),
        ],
    )
    assert found[1].transport_name == "Avion court-courrier"
    assert found[1].co2_kg == pytest.approx(879.699 * 0.230, abs=0.001)
    assert found[2].transport_name == "Avion long-courrier"
    assert found[2].co2_kg == pytest.approx(found[2].distance_km * 0.187 * 2)
    assert (found[3].transport_name, found[3].sk_transport_type) == ("Avion", None)
    assert [found[i].co2_kg for i in (3, 4, 5, 7, 8)] == [None] * 5
    assert found[6].co2_kg == 0.0
    assert found[9].co2_kg == pytest.approx(2 * 879.699 * 0.006, abs=0.001)
    for row in found.values():
        assert row.has_factor == (row.sk_transport_type is not None)
        assert (row.has_factor and row.located) == (row.co2_kg is not None)


def test_haul_boundary_belongs_to_long_haul(spark):
    frame = spark.createDataFrame(
        [("Avion", 999.999999), ("Avion", 1000.0), ("Avion", None), ("Train", 2000.0), (None, 1.0)],
        "t string, km double",
    )
    found = [r[0] for r in frame.select(emissions.transport_mode(F.col("t"), F.col("km"))).collect()]
    assert found == ["Avion court-courrier", "Avion long-courrier", "Avion", "Train", None]


def test_grouped_pricing_equals_row_pricing(spark, cities):
    rows = [
        (i, 1 + i % 3, 1 + i % 4, ["Avion", "Train", "Bateau", None][i % 4], i % 5 > 0)
        for i in range(400)
    ]
    missions = spark.createDataFrame(
        rows, "id int, sk_origin long, sk_destination long, transport_raw string, round_trip boolean"
    )
    def sums(frame, count):
        return {
            r.sk_origin: (r.n, r.kg and round(r.kg, 6))
            for r in frame.groupBy("sk_origin")
            .agg(count.alias("n"), F.sum("co2_kg").alias("kg"))
            .collect()
        }

    by_group = sums(emissions.mission_totals(missions, cities), F.sum("missions"))
    by_row = sums(emissions.mission_ledger(missions, cities), F.count("*"))
    assert by_group == by_row


def test_purchase_lookup(spark):
    catalogue = spark.createDataFrame(
        [
            (1, "pc", "a", 10.0),
            (2, "pc", "Modèle par défaut ", 7.0),
            (3, "pc", "unknown impact", None),
            (4, "tv", "a", 5.0),
        ],
        "sk_equipment long, type string, model string, co2_impact_kg_ref double",
    )
    purchases = spark.createDataFrame(
        [
            (1, "pc", "a "),
            (2, "pc", "b"),
            (3, "pc", None),
            (4, "tv", "b"),
            (5, None, "a"),
            (6, "pc", "unknown impact"),
            (7, "pc", "modèle par défaut"),
        ],
        "id int, type string, model string",
    )
    priced_rows = emissions.with_purchase_emission(purchases, catalogue)
    found = {r.id: (r.sk_equipment, r.co2_kg, r.listed) for r in priced_rows.collect()}
    assert found == {
        1: (1, 10.0, True),
        2: (2, 7.0, True),
        3: (2, 7.0, True),
        4: (None, None, False),
        5: (None, None, False),
        # Key from the exact row, value from the default row.
        6: (3, 7.0, True),
        7: (2, 7.0, True),
    }
    totals = emissions.purchase_totals(purchases, catalogue).agg(
        F.sum("purchases").alias("n"), F.sum("co2_kg").alias("kg")
    )
    assert tuple(totals.first()) == (7, 38.0)


def test_marts_leave_out_incomplete_rows(spark, cities):
    missions = spark.createDataFrame(
        [("m1", "s", 1, 2, "Train"), ("m2", "s", 1, 2, "Bateau"), ("m3", "?", 1, 2, "Train")],
        "nk_mission string, nk_staff string, sk_origin long, sk_destination long, "
        "transport_raw string",
    ).select(
        "*",
        F.lit(True).alias("round_trip"),
        F.lit(date(2026, 5, 1)).alias("date_iso"),
        F.lit("Formation").alias("mission_type"),
    )
    staff = spark.createDataFrame(
        [("s", "Cadre", "Management", date(1980, 1, 1), 1)],
        "nk_staff string, job_title string, activity_sector string, birth_date date, sk_site long",
    )
    sited = facts.with_site(staff, cities.withColumn("country_iso2", F.lit("FR")))
    ledger = emissions.mission_ledger(
        facts.with_staff(missions, sited), cities, carry=("city_name",)
    )
    rows = facts.mission_mart(ledger).collect()
    assert [(r.nk_mission, r.year, r.month, r.site_name) for r in rows] == [
        ("m1", 2026, 5, "Paris")
    ]


def test_salted_lookup_keeps_every_row_of_a_hot_key(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k")
    )
    dimension = spark.createDataFrame([(7, "hot"), (10, "cold")], "k long, name string")
    found = salted_lookup(rows, dimension, "k", "row").groupBy("name").count()
    plain = rows.join(dimension, "k").groupBy("name").count()
    assert dict(found.collect()) == dict(plain.collect())
