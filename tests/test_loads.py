"""Files to star to answers, against a plain-Python reckoning of the same drop."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from terratally import schemas
from terratally.functions import vocabulary
from terratally.operators import quality
from terratally.operators.dimensions import CALENDAR_FIRST
from terratally.plans.loads import load_period, load_reference, star_of
from terratally.plans.questions import QUESTIONS
from terratally.plans.warehouse import StarSource, open_star, save_star
from terratally.sources.places import CITIES
from terratally.streaming.ingest import ingest_missions, ingest_purchases, read_ingested
from tests.drop import MISSIONS, PURCHASES, STAFF, UNDATED, write_missions
from tests.test_geodesy import vincenty

FIRST, LAST = date(2026, 5, 1), date(2026, 10, 31)
SPOTS = {name: (lat, lon) for name, lat, lon, _ in CITIES}
IN_PERIOD = [m for m in MISSIONS if "20260501" <= m[1] <= "20261031"]
DATED = [m for m in IN_PERIOD if m[2] != UNDATED]
KNOWN_STAFF = {s[1]: s for s in STAFF if s[3]}


@pytest.fixture(scope="module")
def reference(spark, drop):
    return load_reference(spark, drop)


@pytest.fixture(scope="module")
def star(spark, drop, reference):
    return load_period(spark, drop, FIRST, LAST, reference)


@pytest.fixture(scope="module")
def source(star):
    return StarSource(star)


def expected_co2(mission):
    _, _, _, _, _, origin, _, destination, _, mode, flag = mission
    if origin not in SPOTS or destination not in SPOTS:
        return None
    km = vincenty(SPOTS[origin], SPOTS[destination])
    if mode == "Avion":
        mode = "Avion long-courrier" if km >= 1000 else "Avion court-courrier"
    factor = vocabulary.EMISSION_FACTORS.get(mode)
    if factor is None:
        return None
    return km * factor * (2 if flag in ("oui", "yes", "ja", "1") else 1)


def answer(source, name):
    return [tuple(r) for r in QUESTIONS[name](source).collect()]


def test_tables_have_the_published_columns(star):
    for name, table in star.tables().items():
        layout = getattr(schemas, name.upper())
        assert table.columns == layout.names, name
        assert [f.dataType for f in table.schema] == [f.dataType for f in layout], name


def test_staff(star):
    rows = {r.nk_staff: r for r in star.dim_staff.collect()}
    assert set(rows) == {"P1", "P2", "P3", "B1", "L1", "N1", "A1", "S1"}
    assert (rows["B1"].job_title, rows["B1"].activity_sector) == ("Cadre", "Management")
    assert (rows["P3"].job_title, rows["P3"].activity_sector) == (None, None)
    assert rows["P3"].birth_date is None
    assert rows["P1"].birth_date == date(1980, 2, 29)
    assert len({r.sk_staff for r in rows.values()}) == len(rows)


def test_cities(star):
    rows = star.dim_city.orderBy("sk_city").collect()
    assert [r.city_name for r in rows] == [
        "Berlin", "London", "Los Angeles", "New-York", "Paris", "Shanghai",
        "Atlantis", "Lille", "Tokyo",
    ]
    assert [r.sk_city for r in rows] == list(range(1, 10))
    assert [r.is_org_site for r in rows] == [True] * 6 + [False] * 3
    assert {r.city_name for r in rows if r.country_iso2 is None} == {"Atlantis"}
    assert {r.city_name: r.timezone_iana for r in rows}["Tokyo"] == "Asia/Tokyo"


def test_one_fact_row_per_source_row(star):
    assert star.fact_mission.count() == len(IN_PERIOD)
    assert star.fact_equipment.count() == len(PURCHASES)
    assert star.dim_trip.count() == len({(m[5], m[7]) for m in IN_PERIOD})


def test_counts(star):
    counted = {r.table_name: r for r in star.counts().collect()}
    assert set(counted) == set(star.tables())
    assert counted["fact_mission"].row_count == len(IN_PERIOD)
    assert counted["dim_date"].row_count == 730
    assert counted["dim_date"].column_list == "sk_date, date_iso"


def test_mission_emissions(star):
    found = {r.nk_mission: r for r in star.fact_mission.collect()}
    for mission in IN_PERIOD:
        co2 = expected_co2(mission)
        row = found[mission[2]]
        assert row.co2_impact_kg == (None if co2 is None else pytest.approx(co2, abs=0.001))
        assert row.mission_type == vocabulary.MISSION_TYPES.get(mission[4])
        assert (row.sk_staff is None) == (mission[3] not in KNOWN_STAFF)
    assert found["M01"].sk_date_mission == (date(2026, 5, 1) - CALENDAR_FIRST).days + 1
    assert found["M04"].sk_transport_type is None
    assert found[UNDATED].sk_date_mission is None
    assert found["M08"].co2_impact_kg == 0.0


def test_facts_join_their_dimensions(star):
    trips = star.fact_mission.join(star.dim_trip, "sk_trip")
    assert trips.count() == len(IN_PERIOD)
    dated = star.fact_mission.join(
        star.dim_date, F.col("sk_date_mission") == F.col("sk_date")
    )
    assert dated.where("nk_mission = 'M01'").first().date_iso == date(2026, 5, 1)


def test_purchase_emissions(star):
    found = {r.nk_equipment: r.co2_impact_kg for r in star.fact_equipment.collect()}
    assert found == {
        "E01": 300.5, "E02": 250.0, "E03": 120.0, "E04": 900.0, "E05": None,
        "E06": 250.0, "E07": 180.25, "E08": None, "E09": None,
    }


def test_checks(star):
    missing = [m for m in IN_PERIOD if expected_co2(m) is None]
    total = quality.fact_total(star.fact_mission, "missions").first()
    assert total.missions == len(IN_PERIOD)
    assert total.tco2e == pytest.approx(
        sum(expected_co2(m) or 0 for m in IN_PERIOD) / 1000, abs=0.006
    )
    by_type = quality.fact_without_co2(star.fact_mission, "missions", "mission_type")
    assert sum(r.missions for r in by_type.collect()) == len(missing)
    assert tuple(quality.city_counts(star.dim_city).first()) == (9, 6)
    assert quality.cities_without_country(star.dim_city).first().city_name == "Atlantis"
    assert tuple(quality.trips_without_distance(star.dim_trip).first()) == (11, 1)
    longest = quality.longest_trips(star.dim_trip, 1).first()
    assert longest.distance_km == pytest.approx(8416.064, abs=0.01)
    repeated = quality.repeated_keys("dim_staff", star.dim_staff, "nk_staff").first()
    assert (repeated["keys"], repeated.repeated) == (8, 0)


def test_views(spark, star):
    star.register()
    counted = spark.sql("SELECT count(*) AS n FROM FACT_MISSION WHERE CO2_IMPACT_KG IS NULL")
    assert counted.first().n == sum(expected_co2(m) is None for m in IN_PERIOD)


def test_answers(source):
    co2 = {m[2]: expected_co2(m) for m in MISSIONS}

    def tonnes(*ids):
        return pytest.approx(sum(co2[i] or 0 for i in ids) / 1000, abs=0.0006)

    assert answer(source, "q01_managers_on_site") == [(1,)]
    assert answer(source, "q02_data_engineers_country") == [(0,)]
    assert answer(source, "q03_it_engineers") == [(1,)]
    assert answer(source, "q04_desktop_count") == [(2,)]
    assert answer(source, "q05_desktop_co2") == [(0.18,)]
    assert answer(source, "q06_laptops_role_sites") == [(0.25,)]
    assert answer(source, "q07_screens_managers") == [(0.12,)]
    eu = [m[2] for m in IN_PERIOD if m[3] in ("P1", "P2", "P3", "B1", "L1")]
    assert answer(source, "q08_eu_missions")[0][0] == tonnes(*eu)
    assert [d for d, _ in answer(source, "q09_top_days")] == [
        date(2026, 5, 15), date(2026, 5, 1), date(2026, 9, 2),
    ]
    assert answer(source, "q12_intersite")[0][0] == tonnes("M07", "M08", "M09")
    assert answer(source, "q13_seminars_site")[0][0] == tonnes("M10")
    assert [s for s, _ in answer(source, "q14_conference_sector")] == ["Management"]
    # P2 is 36 on both trainings, L1 is 40.
    assert answer(source, "q15_avg_age") == [(37.3,)]
    by_destination = {}
    for mission in DATED:
        by_destination.setdefault(mission[7], []).append(co2[mission[2]] or 0)
    ranked = sorted(by_destination, key=lambda c: -sum(by_destination[c]))
    assert [d for d, _ in answer(source, "q16_top_destinations")] == ranked[:5]
    assert [t for t, _ in answer(source, "q17_top_mission_types")] == [
        "Formation", "Réunion", "Conférence",
    ]
    assert [r[0] for r in answer(source, "q18_top_missions")] == ["M02", "M01", "M03"]


def test_sector_and_site_totals_agree(source):
    by_sector, by_site = answer(source, "q10_sector_total"), answer(source, "q11_site_total")
    for column in (1, 2, 3):
        totals = [sum(r[column] or 0 for r in rows) for rows in (by_sector, by_site)]
        assert totals[0] == pytest.approx(totals[1], abs=0.5)
    known = [m for m in DATED if m[3] in KNOWN_STAFF]
    assert sum(r[1] or 0 for r in by_site) == pytest.approx(
        sum(expected_co2(m) or 0 for m in known), abs=0.5
    )


def test_monthly_answers(source):
    monthly = {r[0]: r for r in answer(source, "q20_monthly_total")}
    assert sorted(monthly) == [5, 6, 7, 8, 9, 10]
    may = sum(expected_co2(m) or 0 for m in DATED if m[1][4:6] == "05") / 1000
    assert monthly[5][1] == pytest.approx(may, abs=0.006)
    assert monthly[6] == (6, 0.0, 0.55, 0.55)
    pivot = QUESTIONS["q19_pivot"](source).collect()
    modes = {(r.site_name, r.month) for r in pivot}
    assert ("Paris", 9) in modes and ("Berlin", 5) in modes


def test_saved_star_gives_the_same_answers(spark, drop, star, reference, source, tmp_path):
    root = str(tmp_path / "star")
    save_star(star, root)
    save_star(star, root)
    again = open_star(spark, root)
    assert again.fact_mission.count() == len(IN_PERIOD)
    assert again.dim_trip.count() == star.dim_trip.count()
    reopened = StarSource(again)
    for name in ("q09_top_days", "q10_sector_total", "q16_top_destinations", "q18_top_missions",
                 "q19_monthly_transport_site", "q20_monthly_total"):
        assert answer(reopened, name) == answer(source, name), name
    july = QUESTIONS["q13_seminars_site"](reopened)._jdf.queryExecution().toString()
    scans = [line for line in july.splitlines() if "FileScan" in line and "fact_mission" in line]
    assert scans and all("20260701" in line for line in scans)
    pruned = open_star(spark, root, date(2026, 9, 1), LAST)
    assert sorted(r.nk_mission for r in pruned.fact_mission.collect()) == [
        "M07", "M08", "M09", "M12",
    ]
    # A later period keeps the stored keys, and only its new rows are added.
    later = load_period(spark, drop, date(2026, 10, 1), date(2026, 11, 30), reference)
    save_star(later, root, only_new=True)
    grown = open_star(spark, root)
    assert grown.fact_mission.count() == len(MISSIONS)
    assert grown.fact_mission.where("sk_date_mission IS NULL").count() == 1
    assert grown.dim_city.count() == star.dim_city.count()


def test_ingested_files_give_the_same_star(spark, drop, reference, source, tmp_path):
    tables = {kind: str(tmp_path / kind) for kind in ("missions", "purchases")}
    ingest_missions(spark, drop, tables["missions"], str(tmp_path / "c1"))
    ingest_purchases(spark, drop, tables["purchases"], str(tmp_path / "c2"))
    missions, purchases = (read_ingested(spark, t).drop("year", "month") for t in tables.values())
    ingested = StarSource(star_of(missions, purchases, reference))
    for name in ("q10_sector_total", "q12_intersite", "q20_monthly_total"):
        assert answer(ingested, name) == answer(source, name), name


def test_other_year_stays_out(spark, tmp_path, drop, reference):
    from terratally.sources.delimited import Drop

    write_missions(tmp_path, [(*MISSIONS[0][:1], "20270501", *MISSIONS[0][2:])])
    elsewhere = Drop(str(tmp_path))
    star = load_period(spark, elsewhere, date(2027, 1, 1), date(2027, 12, 31), reference)
    assert star.fact_mission.count() == 1
    assert answer(StarSource(star), "q08_eu_missions") == [(0.0,)]


# --- several loads ----------------------------------------------------------------


def kept(spark, root):
    return {r.nk_mission for r in open_star(spark, root).fact_mission.collect()}


def a_drop(folder, **rows):
    from terratally.sources.delimited import Drop
    from tests.drop import write_drop

    folder.mkdir()
    write_drop(folder, **rows)
    return Drop(str(folder))


def saved(spark, drop, root, first=FIRST, last=LAST, **options):
    save_star(load_period(spark, drop, first, last, load_reference(spark, drop)), root, **options)
    return StarSource(open_star(spark, root))


def test_equipment_keys_stay_when_the_catalogue_grows(spark, tmp_path):
    drop, root = a_drop(tmp_path / "d"), str(tmp_path / "star")
    assert answer(saved(spark, drop, root), "q07_screens_managers") == [(0.12,)]
    catalogue = tmp_path / "d" / "materiel_informatique_impact.csv"
    catalogue.write_text(catalogue.read_text() + "Borne wifi,first by name,7\n", encoding="utf-8")
    again = saved(spark, drop, root, date(2026, 10, 1))
    assert answer(again, "q07_screens_managers") == [(0.12,)]
    assert again.star.dim_equipment.count() == again.star.dim_equipment.select("sk_equipment").distinct().count() == 8


def test_new_city_of_a_second_load_gets_its_own_key(spark, tmp_path):
    root = str(tmp_path / "star")
    saved(spark, a_drop(tmp_path / "d1", missions=MISSIONS[:4]), root)
    oslo = [("PARIS", "20260801", "M20", "P1", "Réunion", "Paris", "France", "Oslo", "Norvège", "Train", "oui")]
    source = saved(spark, a_drop(tmp_path / "d2", missions=oslo), root)
    cities = {r.sk_city: r.city_name for r in source.star.dim_city.collect()}
    assert {"Oslo", "Atlantis", "Lille"} <= set(cities.values()) and len(cities) == len(set(cities.values()))
    trips = {r.sk_trip: cities[r.sk_city_destination] for r in source.star.dim_trip.collect()}
    goals = {r.nk_mission: trips[r.sk_trip] for r in source.star.fact_mission.collect()}
    assert goals["M20"] == "Oslo" and goals["M04"] == "Atlantis"


def test_late_files_and_single_sites_lose_nothing(spark, tmp_path):
    root = str(tmp_path / "star")
    saved(spark, a_drop(tmp_path / "d1", missions=MISSIONS[:3]), root)
    late = [("LONDON", "20260501", "M30", "L1", "Réunion", "London", "England", "Paris", "France", "Train", "oui")]
    saved(spark, a_drop(tmp_path / "d2", missions=late), root, only_new=True)
    assert kept(spark, root) == {"M01", "M02", "M03", "M30"}
    saved(spark, a_drop(tmp_path / "d3", missions=late), root)
    assert kept(spark, root) == {"M01", "M02", "M03", "M30"}
    # A corrected day moves the row, and its old day does not keep a copy.
    moved = [(late[0][0], "20260803", *late[0][2:])]
    saved(spark, a_drop(tmp_path / "d4", missions=moved), root)
    rows = open_star(spark, root).fact_mission.where("nk_mission = 'M30'").collect()
    assert [(r.month, r.day) for r in rows] == [(8, 3)]


def test_period_without_purchases(spark, tmp_path):
    source = saved(spark, a_drop(tmp_path / "d", purchases=[]), str(tmp_path / "star"))
    assert source.star.fact_equipment.count() == 0
    assert answer(source, "q04_desktop_count") == [(0,)]
    source = saved(spark, a_drop(tmp_path / "d2"), str(tmp_path / "star"))
    assert source.star.fact_equipment.count() == len(PURCHASES)


def test_calendar_is_the_stored_one(spark, drop, tmp_path):
    root = str(tmp_path / "star")
    first = load_reference(spark, drop, date(2026, 1, 1), date(2026, 12, 31))
    save_star(load_period(spark, drop, FIRST, LAST, first), root)
    later = load_reference(spark, drop, date(2026, 3, 1), date(2027, 6, 30))
    save_star(load_period(spark, drop, FIRST, LAST, later), root)
    again = open_star(spark, root)
    assert (again.first, again.last) == (date(2026, 1, 1), date(2027, 6, 30))
    keys = {r.nk_mission: r.sk_date_mission for r in again.fact_mission.collect()}
    assert keys["M01"] == (date(2026, 5, 1) - date(2026, 1, 1)).days + 1
    earlier = load_reference(spark, drop, date(2025, 1, 1), date(2026, 12, 31))
    with pytest.raises(ValueError, match="calendar"):
        save_star(load_period(spark, drop, FIRST, LAST, earlier), root)
    short = load_reference(spark, drop, date(2026, 1, 1), date(2026, 6, 30))
    with pytest.raises(ValueError, match="calendar"):
        load_period(spark, drop, FIRST, LAST, short)


def test_members_listed_twice_are_an_error(spark, tmp_path):
    drop = a_drop(tmp_path / "d")
    staff = tmp_path / "d" / "BDD_BGES_LONDON" / "PERSONNEL_LONDON.txt"
    text = staff.read_text()
    line = text.splitlines()[1].replace("L1;", "P1;", 1)
    staff.write_text(text + line + "\n", encoding="utf-8")
    with pytest.raises(ValueError, match="P1"):
        load_reference(spark, drop)
    staff.write_text(text, encoding="utf-8")
    catalogue = tmp_path / "d" / "materiel_informatique_impact.csv"
    catalogue.write_text(catalogue.read_text() + "Ecran,modèle par défaut,99\n", encoding="utf-8")
    with pytest.raises(ValueError, match="Ecran"):
        load_reference(spark, drop)
